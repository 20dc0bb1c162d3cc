"""Checks of user-supplied SQL, and the parser of filter fragments. Pure text functions."""

from __future__ import annotations

import re

# What a query may start with, and what a fragment must not contain.
READING = ("SELECT", "WITH", "SHOW", "DESCRIBE", "EXPLAIN")
FORBIDDEN_MARKS = (";", "--", "/*", "*/")
FORBIDDEN_WORDS = ("EXEC", "EXECUTE", "DROP", "DELETE", "INSERT", "UPDATE", "ALTER", "CREATE", "TRUNCATE")


def check_query(sql: str) -> str:
    """A single reading statement, without a trailing semicolon, or ValueError."""
    text = sql.strip().removesuffix(";").strip()
    if not re.match(rf"(?i)({'|'.join(READING)})\b", text):
        raise ValueError("only reading statements are allowed")
    if ";" in re.sub(r"'(?:[^']|'')*'", "", text):
        raise ValueError("one statement at a time")
    return text


def check_fragment(fragment: str | None) -> str | None:
    """A filter fragment without comments, further statements or changing keywords; None for a blank one."""
    if fragment is None or not fragment.strip():
        return None
    for mark in FORBIDDEN_MARKS:
        if mark in fragment:
            raise ValueError(f"forbidden in a filter: {mark}")
    if found := re.search(rf"(?i)\b({'|'.join(FORBIDDEN_WORDS)})\b", fragment):
        raise ValueError(f"forbidden in a filter: {found[1].upper()}")
    return fragment.strip()


def split_fragment(fragment: str | None) -> tuple[str, int | None, int | None]:
    """(conditions, limit, offset) of ``[WHERE] conditions [LIMIT n [OFFSET m]]``.

    White space is collapsed; the first LIMIT ends the conditions; an OFFSET
    without LIMIT stays in the conditions.
    """
    text = " ".join((fragment or "").split())
    text = re.sub(r"(?i)^where(\s+|$)", "", text)
    found = re.search(r"(?i)(?:^|\s)LIMIT\s+(\d+)(?:\s+OFFSET\s+(\d+))?\s*$", text) or re.search(r"(?i)(?:^|\s)LIMIT\s+(\d+)(?:\s+OFFSET\s+(\d+))?", text)
    if not found:
        return text, None, None
    return text[: found.start()].strip(), int(found[1]), int(found[2]) if found[2] else None
