"""Byte-pair encoding of whole texts inside tasks.

The vocabulary is a public one and its path a parameter; nothing is trained.
Ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``:
no special tokens are added, but their strings in a text are recognised. The
main encoder reads the vocabulary as ranks and gives the same ids faster; texts
that hold such a string, or a run too long for its regular expression, go to
the tokenizer itself (tests compare them).
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import public_tokenizers

#: Texts with a run of this many characters of one kind (space or other) take the second library.
LONG_RUN = 5_000
_RUN = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _ranked(path: str):
    import tiktoken

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _whole(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _special(path: str) -> tuple[str, ...]:
    """The file names them; a tokenizer, which few tasks need, would keep its whole vocabulary in each."""
    with open(path) as file:
        return tuple(t["content"] for t in json.load(file)["added_tokens"])


def encode(text: str, path: str) -> list[int]:
    """Ids of a whole text; none are added."""
    if any(s in text for s in _special(path)) or (len(text) >= LONG_RUN and _RUN.search(text)):
        return _whole(path).encode(text, add_special_tokens=False).ids
    return _ranked(path).encode_ordinary(text)
