"""Secret scan with a recursive decoding worklist.

Each layer of a text is scanned by the same patterns. A layer is unwrapped in
every way that applies (URL escapes, Unicode escapes, base64 runs, compressed
bytes inside base64); what comes out is a new layer unless the document has
already had its text from the same place, or it was unwrapped from a layer of
the same text, so the worklist ends even for texts that decode to themselves.
Every layer carries, for each of its characters, the span of the original text
it came from.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
# Fixed patterns: what counts as a finding, and the least length of what it names.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

URL_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}+(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
KEPT = re.compile(r"[A-Za-z0-9+/_-]")
SEPARATOR = re.compile(r"[+/_-]+")
COMPRESSED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Bytes; no shorter text holds a finding, or anything that decodes to one.
LEAST_TEXT = 12
UTF8_RUN = re.compile(rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){3,}+")
#: Separators of a run after which it is tried as a whole; beyond them, and always besides, all four alignments are.
STARTS = 64
#: A compressed layer that inflates beyond this many bytes goes on in windows of that size; ``oversize_layers`` counts such windows.
#: Each repeats the end of the one before: at least OVERLAP bytes, and an open run of characters that may belong together up to half a window.
MAX_INFLATED, OVERLAP = 64 << 20, 1 << 20
#: Bytes of base64, escapes, names and values, as zero: between others a finding or an encoded run may end.
_RUN_BYTES = bytes(chr(b) not in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-%\\&#;{}\r\n\t" for b in range(256))
#: Characters of decoded runs that a document keeps, so that a run which other layers hold as well is decoded once.
MEMO = 16 << 20


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every finding of one layer.

    A run of hexadecimal digits or capitals is either long enough as a whole or
    drops out, so the length is part of those patterns. An assignment is matched
    first and then dropped if its value is short: what it covers stays consumed.
    """
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Layer:
    """A text and where in the original each of its characters begins and ends: arrays, or two numbers if all characters come from one place."""

    __slots__ = ("above", "ends", "key", "starts", "text")

    def __init__(self, text: str, starts, ends, key: bytes | None = None):
        self.text, self.starts, self.ends = text, starts, ends
        self.key, self.above = key or _key(text), frozenset()

    def place(self) -> bytes:
        """The text and the origin of each of its characters."""
        spans = np.array([self.starts, self.ends], dtype="i8").reshape(2, -1)
        if len(self.text) and (spans == spans[:, :1]).all():
            spans = spans[:, :1]
        return hashlib.blake2b(self.key + spans.tobytes(), digest_size=16).digest()

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[start]), int(self.ends[end - 1])


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match of ``pattern`` decoded: decode(match) gives (text, [(start, end) in the match per character])."""
    parts, starts, ends, last, spread = [], [], [], 0, not isinstance(layer.starts, int)
    for m in pattern.finditer(layer.text):
        if (out := decode(m)) is None:
            continue
        parts += [layer.text[last : m.start()], out[0]]
        if spread:
            first, after = np.array(out[1], dtype=np.int64).reshape(-1, 2).T + m.start()
            starts += [layer.starts[last : m.start()], layer.starts[first]]
            ends += [layer.ends[last : m.start()], layer.ends[after - 1]]
        last = m.end()
    if not parts:
        return None
    text = "".join([*parts, layer.text[last:]])
    if not spread:
        return Layer(text, layer.starts, layer.ends)
    return Layer(text, np.concatenate([*starts, layer.starts[last:]]), np.concatenate([*ends, layer.ends[last:]]))


def _url(m: re.Match):
    raw = bytes.fromhex(m[0].replace("%", ""))
    text, spans, i = [], [], 0
    while i < len(raw):  # a character's escapes are 1 to 4 bytes; bytes that are no UTF-8 stand for themselves
        n = next((n for n in (1, 2, 3, 4) if i + n <= len(raw) and _utf8(raw[i : i + n]) is not None), 1)
        text.append(_utf8(raw[i : i + n]) or chr(raw[i]))
        spans.append((3 * i, 3 * (i + n)))
        i += n
    return "".join(text), spans


def _utf8(raw: bytes) -> str | None:
    try:
        return str(raw, "utf-8")
    except UnicodeDecodeError:
        return None


def _unicode(m: re.Match):
    code = int(m[5]) if m[5] else int(next(x for x in m.groups()[:4] if x), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), [(0, m.end() - m.start())]


def _packed(raw) -> bool:
    return raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 2 and int.from_bytes(raw[:2], "big") % 31 == 0)


def _kept_from(window: bytes) -> int:
    """Where the next window begins in this one: before the run that is open at its end."""
    least, at = len(window) - len(window) // 2, len(window)
    flags = window[least:].translate(_RUN_BYTES)
    while (stop := flags.rfind(1, 0, at - least)) >= 0:
        at = least + stop
        before = len(window[least:at].rstrip(b" "))
        if window[at : at + 1] != b" " or not before or window[least + before - 1 : least + before] not in (b"\n", b"\t"):
            return min(at + 1, len(window) - OVERLAP)
        at = least + before  # the indent of a wrapped line
    return min(least, len(window) - OVERLAP)


def _inflate(raw):
    """Windows of what ``raw`` unpacks to: all compressed members that it begins with, and what follows them if it is text.

    One window up to MAX_INFLATED bytes, more beyond. None at all if ``raw``
    begins with no member that gives anything.
    """
    held, rest = b"", raw
    while _packed(rest):
        unpack, more, got = zlib.decompressobj(47), rest, False
        try:
            while more:
                part = unpack.decompress(more, MAX_INFLATED - len(held))
                got, held, more = got or bool(part), held + part, unpack.unconsumed_tail
                if len(held) >= MAX_INFLATED:
                    yield held
                    held = held[max(0, _kept_from(held)) :]
                elif not part:
                    break
        except zlib.error:
            pass
        if not unpack.eof:
            rest = b""
            break
        rest = unpack.unused_data
    if len(rest) < len(raw) and _utf8(bytes(rest)) is not None:
        held += rest
    if held:
        yield held


def _texts(raw: bytes):
    """(text, first byte, last byte + 1) of every stretch of UTF-8 that may hold a finding."""
    for m in UTF8_RUN.finditer(raw):
        if m.end() - m.start() >= LEAST_TEXT:
            yield m[0].decode(), m.start(), m.end()


def _decoded(run: str) -> bytes:
    return base64.b64decode(run[: len(run) - (len(run) % 4 == 1)] + "=" * (-len(run) % 4 % 3))


def _base64(run: str, breaks: list[int]):
    """(text, start, end in ``run``, whether a further window) of what a run without padding holds; ``breaks`` are the places where its lines begin."""
    run = run.translate(_URL_SAFE)
    starts = [0, *dict.fromkeys([*breaks[:STARTS], *(m.end() for _, m in zip(range(STARTS), SEPARATOR.finditer(run), strict=False))])]
    whole = {}
    for start in starts:
        if start % 4 in whole or len(run) - start < 16:
            continue
        packed = _decoded(run[start:]) if (len(run) - start) % 4 != 1 else b""
        windows = _inflate(packed)
        first = next(windows, None)
        if first is not None and (second := next(windows, None)) is not None:
            whole[start % 4] = start
            for i, window in enumerate(chain((first, second), windows)):
                for text, _, _ in _texts(window):
                    yield text, start, len(run), i > 0
            continue
        raw = packed if first is None else first
        if raw and (start == 0 or first is not None or len(raw) >= LEAST_TEXT) and (text := _utf8(raw)) is not None:
            whole[start % 4] = start
            yield text, start, len(run), False
    for shift in range(4):  # text or compressed bytes between other characters: all of them are decoded with it
        part = run[shift : whole.get(shift, len(run))]
        if len(part) < 16:
            continue
        raw = _decoded(part)
        for text, a, b in _texts(raw):
            yield text, shift + a // 3 * 4, min(shift + -(-b // 3) * 4, shift + len(part)), False
        for m in COMPRESSED.finditer(raw):
            for i, window in enumerate(_inflate(memoryview(raw)[m.start() :])):
                for text, _, _ in _texts(window):
                    yield text, shift + m.start() // 3 * 4, shift + len(part), i > 0


class Runs:
    """What the base64 runs of one document hold. Layers of a whole text repeat the runs of the layer above them; each is decoded once, up to MEMO characters."""

    def __init__(self):
        self.known: dict[tuple, list] = {}
        self.left = MEMO

    def decoded(self, run: str, breaks: list[int]):
        """``_base64`` with the key of each text."""
        name = (run, *breaks)
        if (known := self.known.get(name)) is not None:
            yield from known
            return
        out, room = [], self.left - len(run)
        for text, a, b, further in _base64(run, breaks):
            found = (text, a, b, further, _key(text))
            room -= len(text)
            if room >= 0:
                out.append(found)
            else:
                out = []
            yield found
        if room >= 0:
            self.known[name], self.left = out, room


def unwrap(layer: Layer, runs: Runs):
    """Yields (layer, whether a further window) for each way of decoding that applies."""
    if "%" in layer.text and (out := _replaced(layer, URL_ESCAPE, _url)):
        yield out, False
    if ("\\" in layer.text or "&#" in layer.text) and (out := _replaced(layer, UNICODE_ESCAPE, _unicode)):
        yield out, False
    for pattern in (BASE64_RUN, WRAPPED_RUN):
        for m in pattern.finditer(layer.text):
            lines = "\n" in m[0]
            if pattern is WRAPPED_RUN and not lines:
                continue
            at = [x.start() for x in KEPT.finditer(m[0])] if lines else range(len(m[0].rstrip("=")))
            breaks = [i for i in range(1, len(at)) if at[i] > at[i - 1] + 1] if lines else []
            for text, a, b, further, key in runs.decoded("".join(m[0][i] for i in at) if lines else m[0].rstrip("="), breaks):
                start, end = layer.origin(m.start() + at[a], m.end() if b == len(at) else m.start() + at[b - 1] + 1)
                yield Layer(text, start, end, key), further


_URL_SAFE = str.maketrans("-_", "+/")


def find_secrets(text: str) -> tuple[list, list, int, int]:
    """(base findings, all findings, layers, further windows of oversize layers); spans are code points of ``text``, end exclusive."""
    base = scan(text)
    spans, seen, texts, oversize = set(base), set(), 1, 0
    # Most texts have nothing to unwrap; only the others pay for the per-character origins.
    if "%" in text or "\\" in text or "&#" in text or BASE64_RUN.search(text):
        whole = Layer(text, np.arange(len(text)), np.arange(1, len(text) + 1))
        work, distinct, runs = [whole], {whole.key}, Runs()
        while work:
            upper = work.pop()
            above = upper.above | {upper.key}
            for layer, further in unwrap(upper, runs):
                oversize += further
                if layer.key not in above and (place := layer.place()) not in seen:
                    seen.add(place)
                    distinct.add(layer.key)
                    layer.above = above
                    spans.update((kind, *layer.origin(a, b)) for kind, a, b in scan(layer.text))
                    work.append(layer)
        texts = len(distinct)
    return base, sorted(spans, key=_order), texts, oversize


def _order(span):
    return span[1], KINDS.index(span[0]), span[2]


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans_base, spans, layers, oversize_layers): findings as ``kind:start:end``, comma-joined, by start, then kind.

    Null text is empty and has none; repeated rows and null ids give a row each;
    an empty table gives no rows; other columns are ignored. A pure map over
    the scan: nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            rows = [(base, spans, layers, big) for base, spans, layers, big in (find_secrets(x.as_py() or "") for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([_joined(sorted(r[0], key=_order)) for r in rows], pa.string()),
                    pa.array([_joined(r[1]) for r in rows], pa.string()),
                    *[pa.array([sum(kind == k for kind, _, _ in r[0]) for r in rows], pa.int64()) for k in KINDS],
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.int32()),
                ],
                names=[id_col, "spans_base", "spans", "n_assign", "n_access", "n_hex", "layers", "oversize_layers"],
            )

    kept = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, f"{id_col} long, spans_base string, spans string, n_assign long, n_access long, n_hex long, layers int, oversize_layers int")


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[{}]") -> DataFrame:
    """``docs`` with every finding in ``text_col`` replaced by its kind in brackets; overlapping findings become one, named after the first.

    Null texts stay null, texts without findings as they are; repeated rows
    give repeated rows; other columns are untouched, whatever their names, and
    an empty table stays empty.
    """

    def clean(batches):
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            out = []
            for x in batch.column(place):
                text, parts, last = x.as_py(), [], 0
                if text is None:
                    out.append(None)
                    continue
                for kind, start, end in find_secrets(text)[1]:
                    if start >= last:
                        parts += [text[last:start], mark.format(kind)]
                    last = max(last, end)
                out.append("".join([*parts, text[last:]]))
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(clean, docs.schema)
