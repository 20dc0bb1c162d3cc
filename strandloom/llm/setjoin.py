"""Exact set-similarity joins over hashed tokens, spread over tasks.

Steps, the same for documents and lines:

1. Equal sets become one class.
2. Sets that cannot be similar to any other are left out (possible_classes).
   The tokens of the others are counted over the corpus and stand in order of
   rarity. Two sets of similarity t share one of the first n - ceil(t n) + 1 of
   them. Tokens that only one class holds take their places at the front, but
   stand in no list.
3. A list of a token holds the sets with it in their prefix. Length and
   positional filter cut the list into runs; a run only ties its members to its
   first one, so m entries give m - 1 edges, not m * m.
4. Connected components of these edges hold every possible link. They are put
   into blocks of bounded size and joined in the tasks over index lists, with
   prefix, length and positional filters and an exact overlap. A component of
   several blocks is compared with one pivot set first; only members left
   undecided meet the other blocks.

The tokens of step 2 are shuffled as packed arrays, for a row per token would
be several times the input. Their parts grow in number with the corpus;
tokens of very many sets (see heavy_tokens) are not sent there, so no part does
in size. Any order that all sets share keeps the prefixes exact, so
neither sampled counts of these nor tokens that share a hash lose a link.

A class is named by a 64-bit hash of its sorted tokens: among 10^9 different
texts the chance that any two share a name is about 3 %, among 10^12 some
30,000 pairs are expected to.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, small

#: Sets that one task joins with each other at a time.
BLOCK = 512
SLICE = 512
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(58)


# One odd multiplier's powers and their inverses (modulo 2^64).
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes to 1 where they are ASCII white space.
_SPACE = bytes(int(i in (9, 10, 11, 12, 13, 32)) for i in range(256))
#: Bytes hashed at a time, so that the arrays stay in the processor's cache; bytes of text in a batch.
PIECE, BATCH_BYTES = 1 << 16, 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, dtype=np.uint64))]) for x in (_BASE, _INVERSE))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of a text: runs without ASCII white space, A-Z lower-cased, nothing else changed.

    A word's hash is a polynomial of its bytes, taken for all words at once
    from one running sum. Texts are worked on in pieces that end at white space.
    """
    whole = np.frombuffer(data.lower(), dtype=np.uint8)
    spaces = np.frombuffer(data.translate(_SPACE), dtype=bool)
    hashes, starts, at = [], [], 0
    while at < len(whole):
        end = min(at + PIECE, len(whole))
        while end < len(whole) and not spaces[end]:
            end += 1
        part = whole[at:end]
        power, inverse = _powers(max(2 * PIECE, 1 << (len(part) - 1).bit_length()))
        space = np.ones(len(part) + 2, dtype=bool)
        space[1:-1] = spaces[at:end]
        edge = np.flatnonzero(space[1:] != space[:-1])
        a, b = edge[0::2], edge[1::2]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.multiply(part, power[: len(part)], out=total[1:])
        np.cumsum(total, out=total)
        hashes.append(_mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64)))
        starts.append(a + at)
        at = end
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _encoded(texts: list[str | bytes | None]) -> list[bytes]:
    return [x.encode() if isinstance(x, str) else x or b"" for x in texts]


def document_words(texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, number of words of each text)."""
    raw = _encoded(texts)
    hashes, starts = hash_words(b"\n".join(raw))
    return hashes, np.diff(np.searchsorted(starts, np.cumsum([len(x) + 1 for x in raw])), prepend=0)


def line_words(texts: list[str | bytes | None], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words of each line, text of each line, line number) of the lines with at least ``least`` words."""
    raw = _encoded(texts)
    data = b"\n".join(raw)
    hashes, starts = hash_words(data)
    breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)
    count = np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts))
    kept = np.flatnonzero(count >= least)
    begins = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])[:-1]])
    first_line = np.searchsorted(breaks, begins)
    text = np.searchsorted(first_line, kept, side="right") - 1
    own = hashes if least <= 1 else hashes[np.repeat(count >= least, count)]
    return own, count[kept], text, kept - first_line[text]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the k-word shingles of each of the consecutive runs of words, repeats included; fewer than k words are one shingle."""
    total = len(words)
    starts = np.concatenate([[0], np.cumsum(counts)])
    n_shingles = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n_shingles)])
    rolled = np.zeros(max(total - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        rolled *= _M1
        rolled += words[i : i + len(rolled)]
    owner = np.repeat(np.arange(len(counts)), n_shingles)
    place = starts[owner] + np.arange(int(offsets[-1])) - offsets[owner]
    out = np.empty(int(offsets[-1]), dtype=np.uint64)
    full = (counts >= k)[owner]
    out[full] = rolled[place[full]]
    for n in range(1, k):
        at = np.flatnonzero(counts == n)
        short = np.full(len(at), n, dtype=np.uint64)
        for i in range(n):
            short = short * _M1 + words[starts[at] + i]
        out[offsets[at]] = short * _M2
    return _mix(out), offsets


def _sort_each(tokens: np.ndarray, offsets: np.ndarray) -> None:
    """Sorts each run in place; runs of up to 256 tokens stand in the rows of a few tables, filled up with the largest number."""
    sizes, least = np.diff(offsets), 1
    for width in (16, 32, 48, 64, 96, 128, 192, 256):
        at = np.flatnonzero((sizes > least) & (sizes <= width))
        if len(at):
            inside = np.arange(width) < sizes[at, None]
            table = np.full(inside.shape, np.iinfo(np.uint64).max)
            places = (offsets[at, None] + np.arange(width))[inside]
            table[inside] = tokens[places]
            table.sort(axis=1)
            tokens[places] = table[inside]
        least = width
    for i in np.flatnonzero(sizes > least).tolist():
        tokens[offsets[i] : offsets[i + 1]].sort()


def distinct_sets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, offsets, classes): each set's distinct tokens in order, as 58-bit numbers, and the name of each set (0: empty)."""
    tokens = hashes >> np.uint64(6)
    _sort_each(tokens, offsets)
    keep = np.ones(len(tokens), dtype=bool)
    keep[1:] = tokens[1:] != tokens[:-1]
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    if not keep.all():
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        tokens = tokens[keep]
    sizes = np.diff(offsets)
    raw, cuts = tokens.tobytes(), (offsets * 8).tolist()
    classes = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) | 1 if b > a else 0 for a, b in zip(cuts[:-1], cuts[1:], strict=True)), dtype=np.uint64, count=len(sizes))
    return tokens, offsets, classes.view(np.int64)


def prefix_length(n, num: int, den: int):
    return n - (num * n + den - 1) // den + 1


def slices(batches, size: int = SLICE):
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def by_bytes(batches, column: int, limit: int = BATCH_BYTES):
    """Slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        lengths = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype("f8"))
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


#: Words of 64 bits that the filter of classes has at least and at most. It has 16 bits a class up to 2^24 classes; then more and more others pass, which costs time but no result.
FILTER = 1 << 14, 1 << 22


def filter_places(column: str, size: int) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """(word, bit) of the two marks that a hash has in a Bloom filter of ``size`` words."""
    word = lambda shift: F.shiftrightunsigned(column, shift).bitwiseAND(size - 1)
    bit = lambda shift: F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {shift}) & 63 as int))")
    return (word(6), bit(0)), (word(34), bit(28))


def filter_words(classes: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(w, b): the words of a Bloom filter of the column ``class`` that are not 0; and their number in all, ``most`` at most."""
    size = min(max(FILTER[0], 1 << (classes.count() // 4).bit_length()), most)
    marks = classes.select(F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in filter_places("class", size)])).alias("m"))
    return marks.groupBy("m.w").agg(F.bit_or("m.b").alias("b")), size


def class_filter(classes: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``class``, put together by the executors; at most FILTER[1] words come to the driver."""
    words, size = filter_words(classes, FILTER[1])
    found = words.toPandas()
    out = np.zeros(size, dtype=np.int64)
    out[found["w"].to_numpy(dtype=np.int64)] = found["b"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def passes(bits: np.ndarray, classes: np.ndarray) -> np.ndarray:
    c = classes.view(np.uint64)
    hit = lambda a, b: (bits[((c >> np.uint64(a)) & np.uint64(len(bits) - 1)).astype(np.int64)] >> ((c >> np.uint64(b)) & np.uint64(63))) & np.uint64(1)
    return (hit(6, 0) & hit(34, 28)).astype(bool)


def first_seen(classes: np.ndarray, seen: set) -> np.ndarray:
    """Which classes a task has not met before; 0, the empty set, counts as met."""
    new = np.zeros(len(classes), dtype=bool)
    for i, cls in enumerate(classes.tolist()):
        if cls and cls not in seen:
            seen.add(cls)
            new[i] = True
    return new


#: One in so many (token, class) pairs is counted to find the heavy tokens; a token is one from so many such pairs on, or from this share of them.
SAMPLED, LEAST_SAMPLED, HEAVIEST = 64, 32, 1 << 18
#: Tokens that one part of the counting holds about, and that a task gathers before it sends them.
PART_TOKENS, CHUNK_TOKENS = 1 << 22, 1 << 20


def sampled_tokens(tokens: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> pa.Array:
    """Of each set the tokens that count towards heavy_tokens; equal sets give equal ones."""
    owner = np.repeat(np.arange(len(classes)), np.diff(offsets))
    at = np.flatnonzero(_mix(tokens + _mix(classes.view(np.uint64))[owner]) % np.uint64(SAMPLED) == 0)
    cuts = np.searchsorted(owner[at], np.arange(len(classes) + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(tokens[at].view(np.int64)))


def heavy_tokens(rows: DataFrame, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, levels), by token, of those that a large share of all classes holds: HEAVIEST at most, however large the corpus.

    ``rows`` is (class, sample), ``pairs`` the number of tokens of all sets.
    """
    least = max(LEAST_SAMPLED, -(-pairs // (SAMPLED * HEAVIEST)))
    counted = rows.select("class", F.explode("sample").alias("token")).distinct().groupBy("token").count().filter(F.col("count") >= least)
    found = counted.orderBy(F.desc("count")).limit(HEAVIEST).toPandas()
    order = np.argsort(found["token"].to_numpy(dtype=np.int64))
    often = found["count"].to_numpy(dtype=np.int64)[order]
    return found["token"].to_numpy(dtype=np.int64)[order].view(np.uint64), (128 + np.log2(np.maximum(often, 1))).astype(np.uint8)


def level_of(counts: np.ndarray) -> np.ndarray:
    """The rank of a count: itself, then its logarithm."""
    return np.where(counts <= 64, counts, 58 + np.log2(np.maximum(counts, 1))).astype(np.uint8)


#: Columns of a packed row: sets (class, tokens in all, heavy ones of them, tokens held in this row) and their tokens in the same order.
_ARRAYS = ("class", "n", "heavy", "held", "token", "level")
_PACKED = "part int, of int, " + ", ".join(f"{k} binary" for k in _ARRAYS)


def _packed(x: np.ndarray) -> bytes:
    """An array in as few bytes an item as its largest needs; the first byte is that number."""
    if x.dtype != np.int64:
        most = int(x.max(initial=0))
        x = x.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")
    return bytes([x.itemsize]) + x.tobytes()


def _unpacked(table: pa.Table) -> dict:
    kinds = {1: "u1", 2: "<u2", 4: "<u4", 8: "<i8"}
    return {k: np.concatenate([np.frombuffer(b, dtype=kinds[b[0]], offset=1) for b in table[k].to_pylist()]) for k in _ARRAYS}


def _by_part(parts: np.ndarray, owner: np.ndarray, of, refs: dict, token: np.ndarray, level: np.ndarray):
    """A packed row for each part: its tokens, and the sets that hold them. ``refs`` has class, n and heavy by owner; owners ascend."""
    order = np.argsort(parts, kind="stable")
    parts, owner, token, level = parts[order], owner[order], token[order], level[order]
    cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]])) if len(parts) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        begins = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]]))
        sets = owner[a:b][begins]
        row = {k: v[sets] for k, v in refs.items()} | {"held": np.diff(np.append(begins, b - a)).astype(np.uint32), "token": token[a:b], "level": level[a:b]}
        yield {"part": int(parts[a]), "of": of} | {k: _packed(row[k]) for k in _ARRAYS}


_FIELDS = pa.schema([("part", pa.int32()), ("of", pa.int32()), *((k, pa.binary()) for k in _ARRAYS)])
#: Parts that the tokens are dealt into at least.
LEAST_PARTS = 32


def parts_of(tokens: int) -> int:
    return max(LEAST_PARTS, min(1 << 24, tokens // PART_TOKENS))


def _low(tokens: np.ndarray, parts: int) -> np.ndarray:
    """What tells a token from the others of its part: 32 bits, so that the corpus has log2(parts) more."""
    return ((tokens // np.uint64(parts)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _heavy_at(tokens: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which tokens are among the known ones, their places there)."""
    place = np.searchsorted(known, tokens)
    return (known[np.minimum(place, len(known) - 1)] == tokens) if len(known) else np.zeros(len(tokens), dtype=bool), place


def _gathered(sets, send, parts: int):
    """Batches from (tokens, sizes, classes) of several sets, sent together from so many tokens on."""
    chunk = min(max(CHUNK_TOKENS, 64 * parts), 1 << 24)
    held, size = [], 0
    for one in sets:
        held.append(one)
        size += len(one[0])
        if size >= chunk:
            yield from _batched(send(*(np.concatenate(x) for x in zip(*held, strict=True))))
            held, size = [], 0
    if held:
        yield from _batched(send(*(np.concatenate(x) for x in zip(*held, strict=True))))


def _batched(rows: list[dict]):
    for start in range(0, len(rows), 64):
        yield pa.RecordBatch.from_pylist(rows[start : start + 64], schema=_FIELDS)


def _in_part(table: pa.Table) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """(class, n and heavy of each set of a part; their tokens' owners, tokens and levels); a class that several tasks have met counts once."""
    x = _unpacked(table)
    first = np.zeros(len(x["class"]), dtype=bool)
    first[np.unique(x["class"], return_index=True)[1]] = True
    own = slice(None) if first.all() else np.repeat(first, x["held"])
    held = x["held"][first]
    return {k: x[k][first] for k in ("class", "n", "heavy")}, np.repeat(np.arange(len(held), dtype=np.int32), held), x["token"][own], x["level"][own] if len(x["level"]) else x["level"]


def _repeated(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, in order, of the tokens that occur more than once; how often)."""
    # Token and place in one number: sorted, equal tokens are neighbours.
    together = token.astype(np.uint64) << np.uint64(32)
    together |= np.arange(len(token), dtype=np.uint64)
    together.sort()
    same = (together >> np.uint64(32)).astype(np.uint32)
    begins = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]])) if len(token) else np.empty(0, dtype=np.int64)
    counts = np.diff(np.append(begins, len(token))).astype(np.uint32)
    several = counts > 1
    at = (together[np.repeat(several, counts)] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    order = np.argsort(at)
    return at[order], np.repeat(counts[several], counts[several])[order]


def _class_part(classes: np.ndarray, parts: int) -> np.ndarray:
    return (classes.view(np.uint64) // np.uint64(1 << 20) % np.uint64(parts)).astype(np.int32)


def possible_classes(rows: DataFrame, texts: DataFrame, sets_of: Callable, num: int, den: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(class) of the sets that may be similar to another one; only what cannot be is left out.

    A set of n tokens lacks at most d = n - ceil(t n) of them in a similar set.
    So of any of its tokens, here those of every m-th hash, all but d are shared
    with some other set. These alone are counted, packed by part of their hash.
    """
    every = max(1, 3 * den // (5 * (den - num)))
    pairs = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = parts_of(pairs // every)
    shared = texts.sparkSession.sparkContext.broadcast(heavy[0])
    nothing = np.zeros(0, dtype=np.uint8)

    def send(tokens, sizes, classes, need):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        refs = {"class": classes, "n": np.maximum(need, 0).astype(np.uint32), "heavy": np.zeros(len(classes), dtype=np.uint32)}
        out = list(_by_part((tokens % np.uint64(parts)).astype(np.int32), owner, 0, refs, _low(tokens, parts), np.zeros(len(tokens), dtype=np.uint8)))
        for row in out:
            row["level"] = _packed(nothing)
        sure = np.flatnonzero(need <= 0)
        if len(sure):
            row = {k: v[sure] for k, v in refs.items()} | {"held": np.zeros(len(sure), dtype=np.uint32), "token": nothing, "level": nothing}
            out.append({"part": -1 - int(classes.view(np.uint64)[sure[0]] % np.uint64(parts)), "of": 0} | {k: _packed(row[k]) for k in _ARRAYS})
        return out

    def sample(batches):
        seen: set = set()
        for batch in by_bytes(batches, 0):
            tokens, offsets, classes = sets_of(batch.column(0).cast(pa.binary()).to_pylist())
            n = np.diff(offsets)
            # Sets so small that only an equal one is similar to them are left out.
            new = first_seen(classes, seen) & ((n * den // num > n) | (n - prefix_length(n, num, den) + 1 < n))
            owner = np.repeat(np.arange(len(n)), n)
            at = np.flatnonzero(new[owner] & (((tokens * _M1) >> np.uint64(40)) % np.uint64(every) == 0))
            is_heavy, _ = _heavy_at(tokens[at], shared.value)
            need = np.bincount(owner[at], minlength=len(n)) - np.bincount(owner[at[is_heavy]], minlength=len(n)) - (prefix_length(n, num, den) - 1)
            at = at[~is_heavy]
            yield tokens[at], np.bincount(owner[at], minlength=len(n))[new], classes[new], need[new]

    def count(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        refs, owner, token, _ = _in_part(table)
        if part >= 0:
            at, _ = _repeated(token)
            held = np.bincount(owner[at], minlength=len(refs["class"])).astype(np.uint32)
            keep = held > 0
            refs, held = {k: v[keep] for k, v in refs.items()}, held[keep]
        else:
            held = np.zeros(len(refs["class"]), dtype=np.uint32)
        to = _class_part(refs["class"], parts)
        rows = []
        for q in np.unique(to).tolist():
            row = {k: v[to == q] for k, v in refs.items()} | {"held": held[to == q], "token": nothing, "level": nothing}
            rows.append({"part": q, "of": 0} | {k: _packed(row[k]) for k in _ARRAYS})
        return pa.Table.from_pylist(rows, schema=_FIELDS)

    def decide(table: pa.Table) -> pa.Table:
        x = _unpacked(table)
        classes, at, index = np.unique(x["class"], return_index=True, return_inverse=True)
        return pa.table({"class": classes[np.bincount(index, weights=x["held"]) >= x["n"][at]]})

    counted = texts.mapInArrow(lambda batches: _gathered(sample(batches), send, parts), _PACKED).groupBy("part").applyInArrow(count, _PACKED)
    return pin(counted.groupBy("part").applyInArrow(decide, "class long"))


def prefix_lists(sets: DataFrame, num: int, den: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, n, pos, class) for each set and each token of its prefix that other sets hold as well; ``sets`` is (class, tokens).

    The tokens go to parts by their hash to be counted, packed; those that
    several sets hold go back to their sets, which put them in order of rarity.
    Heavy tokens only come along, in parts below 0, for sets whose prefix may
    reach them. A token's name is unique but for hash collisions of
    log2(parts) + 32 bits, which only add candidates.
    """
    pairs = sets.agg(F.coalesce(F.sum(F.length("tokens")), F.lit(0))).first()[0] // 8
    parts = parts_of(pairs)
    shared = sets.sparkSession.sparkContext.broadcast(heavy)

    def send(tokens, sizes, classes):
        known, levels = shared.value
        owner = np.repeat(np.arange(len(sizes)), sizes)
        is_heavy, place = _heavy_at(tokens, known)
        heavies = np.bincount(owner[is_heavy], minlength=len(sizes))
        refs = {"class": classes, "n": sizes.astype(np.uint32), "heavy": heavies.astype(np.uint32)}
        rest = tokens[~is_heavy]
        out = list(_by_part((rest % np.uint64(parts)).astype(np.int32), owner[~is_heavy], 0, refs, _low(rest, parts), np.zeros(len(rest), dtype=np.uint8)))
        for row in out:
            row["level"] = _packed(np.zeros(0, dtype=np.uint8))
        reached = is_heavy & (sizes - heavies < prefix_length(sizes, num, den))[owner]
        to = -1 - (classes.view(np.uint64)[owner[reached]] % np.uint64(parts)).astype(np.int32)
        return out + list(_by_part(to, owner[reached], 0, refs, place[reached].astype(np.uint32), levels[place[reached]]))

    def packed(batches):
        for batch in slices(batches, 4_096):
            classes, rows = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            yield np.frombuffer(b"".join(rows), dtype="<u8"), np.array([len(x) // 8 for x in rows], dtype=np.int64), classes

    def common(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        refs, owner, token, level = _in_part(table)
        if part >= 0:
            at, often = _repeated(token)
            owner, token, level = owner[at], token[at], level_of(often)
        return pa.Table.from_pylist(list(_by_part(_class_part(refs["class"], parts)[owner], owner, part, refs, token, level)), schema=_FIELDS)

    def prefixes(table: pa.Table) -> pa.Table:
        x = _unpacked(table)
        # A row of ``table`` holds tokens of one part.
        of = np.repeat(np.array(table["of"].to_pylist(), dtype=np.int64), [(len(b) - 1) // b[0] for b in table["token"].to_pylist()])
        token = np.where(of < 0, -1 - x["token"].astype(np.int64), x["token"].astype(np.int64) * parts + of)
        classes, at, index = np.unique(x["class"], return_index=True, return_inverse=True)
        owner = np.repeat(index, x["held"])
        order = np.lexsort((token, x["level"], owner))
        owner, token, of = owner[order], token[order], of[order]
        n = x["n"][at].astype(np.int64)
        alone = n - x["heavy"][at] - np.bincount(owner[of >= 0], minlength=len(classes))
        pos = alone[owner] + np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(classes)))[owner]
        keep = pos < prefix_length(n, num, den)[owner]
        owner, pos = owner[keep], pos[keep]
        return pa.table({"token": pa.array(token[keep]), "n": pa.array(n[owner], pa.int32()), "pos": pa.array(pos, pa.int32()), "class": pa.array(classes[owner])})

    counted = sets.select("class", "tokens").mapInArrow(lambda batches: _gathered(packed(batches), send, parts), _PACKED).groupBy("part").applyInArrow(common, _PACKED)
    return counted.groupBy("part").applyInArrow(prefixes, "token long, n int, pos int, class long")


def candidates(rows: DataFrame, texts: DataFrame, sets_of: Callable, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(edges (a, b) that connect every pair of similar classes, sets (class, tokens) of the classes in question).

    ``rows`` is (class, n, sample), a row per set; ``sets_of`` turns texts into (tokens, offsets, classes).
    """
    pairs = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = heavy_tokens(rows, pairs)
    sets = class_sets(texts, sets_of, possible_classes(rows, texts, sets_of, num, den, heavy))
    return list_edges(pin(prefix_lists(sets, num, den, heavy)), num, den), sets


def list_edges(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that tie the entries of each list together so that every similar pair in it is connected.

    A set of n tokens with the list's token at position p can share n - p of
    them at most, so it is similar to none of more than reach = (n - p) (1 + t) / t - n
    tokens: its length filter and its positional filter in one. Entries are
    scanned by size; where a size is beyond the reach of all before it, a new run
    starts. Entries of one size are summed up first (and so map-side), the
    scan is over distinct sizes: a token that a third of all sets hold is no
    task of its own.
    """
    reach = F.expr(f"((n - pos) * {num + den}L) div {num} - n")
    entries = postings.withColumn("reach", reach)
    sizes = entries.groupBy("token", "n").agg(F.min("class").alias("head"), F.max("reach").alias("reach"), F.count("*").alias("count"))
    along = Window.partitionBy("token").orderBy("n")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.when(F.coalesce(F.max("reach").over(before), F.lit(-1)) < F.col("n"), F.col("head"))
    runs = pin(sizes.withColumn("_start", starts).withColumn("run", F.last("_start", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))).select("token", "n", "head", "run", "count"))
    heads = runs.filter("head != run").select(F.col("head").alias("a"), F.col("run").alias("b"))
    several = runs.filter("count > 1").select("token", "n", "head")
    members = entries.join(several, ["token", "n"]).filter(F.col("class") != F.col("head")).select(F.col("class").alias("a"), F.col("head").alias("b"))
    return heads.union(members).distinct()


def class_sets(texts: DataFrame, sets_of: Callable, classes: DataFrame) -> DataFrame:
    """(class, tokens) of the wanted classes: the texts are scanned once more, and a filter of fixed size keeps nearly all others back."""
    bits = texts.sparkSession.sparkContext.broadcast(class_filter(classes))

    def run(batches):
        seen: set = set()
        for batch in by_bytes(batches, 0):
            tokens, offsets, found = sets_of(batch.column(0).cast(pa.binary()).to_pylist())
            at = np.flatnonzero(passes(bits.value, found))
            at = at[first_seen(found[at], seen)]
            rows = [tokens[offsets[i] : offsets[i + 1]].tobytes() for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(found[at]), pa.array(rows, pa.binary())], names=["class", "tokens"])

    found = texts.mapInArrow(run, "class long, tokens binary").join(classes.select("class"), "class", "left_semi")
    return pin(found.groupBy("class").agg(F.first("tokens").alias("tokens")))


#: Edges that one task of a round of ``components`` holds.
EDGES_PER_TASK = 50_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Alternates the large-star and the small-star step until nothing changes;
    the number of rounds grows with the logarithm of the longest path. Edges are
    held in as many partitions as they need, for every round writes a few
    shuffle files for each.
    """
    e = pin(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = (e.count(), None)
    for _ in range(rounds):
        tasks = before[0] // EDGES_PER_TASK + 1
        e = e.coalesce(tasks)
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        least = e.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        moved = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").coalesce(tasks)
        e = pin(moved.union(least.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks))
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())


def by_rarity(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets with their tokens in one order, those of the fewest sets first; how many sets a token is in goes into its top bits."""
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.minimum(counts, 63).astype(np.uint64)[inverse]
    cuts = np.cumsum([len(x) for x in sets])[:-1]
    return [np.sort(x | (c << _TOP)) for x, c in zip(sets, np.split(often, cuts), strict=True)]


def prefix_join(sets: list[np.ndarray], num: int, den: int, probe: list[bool], skip: Callable[[int, int], bool], match: Callable[[int, int, int], None], derived: list | None = None) -> None:
    """Calls match(i, j, overlap) for pairs of sets with Jaccard >= num / den of which one is in ``probe``.

    Sets come in by size. Index lists are kept in blocks by the token's
    position in its set; the tokens after it bound the overlap, so once a block
    of a list fails, so do all later ones. A set that is similar to one already
    answered derives its overlaps with that one's answers from the difference
    of the two; ``derived`` gets these pairs. skip(i, j) drops pairs whose answer is known already.
    """
    whole: dict[int, dict[int, list[int]]] = {}
    probing: dict[int, dict[int, list[int]]] = {}
    members: list[set | None] = [None] * len(sets)
    answers: list[dict[int, int]] = [{} for _ in sets]
    sizes = [len(s) for s in sets]

    def tokens_of(z: int) -> set:
        if members[z] is None:
            members[z] = set(sets[z].tolist())
        return members[z]

    def decide(x: int, y: int, overlap: int) -> bool:
        if overlap * (num + den) < num * (sizes[x] + sizes[y]):
            return False
        answers[x][y] = answers[y][x] = overlap
        match(x, y, overlap)
        return True

    for x in sorted(range(len(sets)), key=sizes.__getitem__):
        n = sizes[x]
        tokens = sets[x][: prefix_length(n, num, den)].tolist()
        least = (num * n + den - 1) // den
        index, seen = whole if probe[x] else probing, {x}
        for i, token in enumerate(tokens):
            blocks = index.get(token)
            for j in sorted(blocks) if blocks else ():
                if n - j < least:  # no set here is larger than this one, so later blocks fail too
                    break
                for y in blocks[j]:
                    if y in seen:
                        continue
                    seen.add(y)
                    m = sizes[y]
                    if m < least or (1 + min(n - i - 1, m - j - 1)) * (num + den) < num * (n + m) or skip(x, y):
                        continue
                    if decide(x, y, len(tokens_of(x) & tokens_of(y))):
                        # What the similar set y was found similar to is tested by the few tokens in which x and y differ.
                        more, less = tokens_of(x) - tokens_of(y), tokens_of(y) - tokens_of(x)
                        for z, known in list(answers[y].items()):
                            if z not in seen and (probe[x] or probe[z]) and not skip(x, z):
                                seen.add(z)
                                if derived is not None:
                                    derived.append((x, z))
                                decide(x, z, known + len(more & tokens_of(z)) - len(less & tokens_of(z)))
        for i, token in enumerate(tokens):
            whole.setdefault(token, {}).setdefault(i, []).append(x)
            if probe[x]:
                probing.setdefault(token, {}).setdefault(i, []).append(x)


def grouped(batches, keys: int):
    """Lists of row tuples with the same first ``keys`` columns, from sorted batches; one group is in memory at a time."""
    last, rows = None, []
    for batch in slices(batches, 2048):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != last and rows:
                yield rows
                rows = []
            last = row[:keys]
            rows.append(row)
    if rows:
        yield rows


def blocked_links(members: DataFrame, sets: DataFrame, num: int, den: int, earlier: bool, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between classes; ``members`` is (component, class, rank), ``sets`` (class, tokens).

    With ``earlier`` it finds for each class one class of smaller rank that it
    is similar to, if there is any: (a: the class, b: the earlier one). Without,
    links that connect exactly the classes that all links connect.
    """
    members = pin(members)
    sizes = members.groupBy("component").agg(F.count("*").alias("_n"), F.min(F.struct("rank", "class"))["class"].alias("_pivot"))
    large = small(pin(sizes.filter(F.col("_n") > block)))
    dealt = members.join(large, "component", "left").withColumn("_blocks", F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("class"), F.col("_blocks")))
    tasks = F.when(F.col("class") == F.col("_pivot"), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(own)
    first = dealt.select("component", F.explode(tasks).alias("task"), "class", "rank", F.col("class").alias("label"), F.lit(True).alias("probe"))
    links = pin(_joined(first.join(sets, "class"), num, den, earlier))
    if large.limit(1).count() == 0:
        return links

    # What the first round has decided: by component label, or by having an earlier match.
    many = dealt.filter("_blocks > 1").select("component", "class", "rank", "_blocks", "_pivot")
    if earlier:
        done = links.select(F.col("a").alias("class")).distinct().withColumn("_done", F.lit(True))
        state = many.join(done, "class", "left").withColumn("label", F.col("class")).withColumn("_open", F.col("_done").isNull() & (F.col("class") != F.col("_pivot")))
    else:
        found = components(links.join(many.select(F.col("class").alias("a")), "a", "left_semi"))
        state = many.join(found.select(F.col("node").alias("class"), F.col("component").alias("_label")), "class", "left").withColumn("label", F.coalesce("_label", "class"))
        most = state.groupBy("component", "label").agg(F.count("*").alias("_c")).groupBy("component").agg(F.max_by("label", "_c").alias("_most"))
        state = state.join(most, "component").withColumn("_open", F.col("label") != F.col("_most"))
    state = pin(state.select("component", "class", "rank", "label", "_blocks", "_open"))
    undecided = pin(state.filter("_open").groupBy("component").agg(F.ceil(F.count("*") / block).alias("_rows")))
    if undecided.limit(1).count() == 0:
        return links
    state = state.join(small(undecided), "component")
    side = F.pmod(F.xxhash64("class", F.lit(1)), F.col("_rows"))
    column = F.pmod(F.xxhash64("class"), F.col("_blocks"))
    number = lambda r, c: r * F.col("_blocks") + c
    across = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1), lambda r: F.struct(number(r, column).alias("task"), F.lit(False).alias("probe")))
    along = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), lambda c: F.struct(number(side, c).alias("task"), F.lit(True).alias("probe")))
    spread = F.when(F.col("_open"), F.concat(across, along)).otherwise(across)
    second = state.select("component", "class", "rank", "label", F.explode(spread).alias("t")).select("component", "t.task", "class", "rank", "label", "t.probe")
    return links.union(_joined(second.join(sets, "class"), num, den, earlier)).distinct()


def _joined(members: DataFrame, num: int, den: int, earlier: bool) -> DataFrame:
    """The join inside each (component, task)."""

    def join(batches):
        for rows in grouped(batches, 2):
            by_class: dict[int, list] = {}
            for _, _, cls, rank, label, probe, tokens in rows:
                kept = by_class.setdefault(cls, [rank, label, False, tokens])
                kept[2] |= probe
            names, info = list(by_class), list(by_class.values())
            if len(names) < 2:
                continue
            sets = by_rarity([np.frombuffer(x[3], dtype="<u8") for x in info])
            out: list[tuple[int, int]] = []
            if earlier:
                done = [False] * len(names)
                late = lambda x, y: x if (info[x][0], names[x]) > (info[y][0], names[y]) else y

                def match(x, y, _overlap):
                    late_one = late(x, y)
                    done[late_one] = True
                    out.append((names[late_one], names[x + y - late_one]))

                prefix_join(sets, num, den, [x[2] for x in info], lambda x, y: done[late(x, y)], match)
            else:
                root = {x[1]: x[1] for x in info}

                def find(a):
                    while root[a] != a:
                        root[a] = a = root[root[a]]
                    return a

                def match(x, y, _overlap):
                    a, b = find(info[x][1]), find(info[y][1])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((names[x], names[y]))

                prefix_join(sets, num, den, [x[2] for x in info], lambda x, y: False, match)
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = members.select("component", "task", "class", "rank", "label", "probe", "tokens").repartition("component", "task").sortWithinPartitions("component", "task")
    return dealt.mapInArrow(join, "a long, b long")
