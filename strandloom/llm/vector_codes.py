"""Vector codes: a codebook for each part of the vectors, by Lloyd's rounds with Elkan's bounds, in integers.

Every vector keeps, for each part, an upper bound of the distance to its entry
and a lower bound of the distance to every entry. When entries move, the bounds
move as far; an entry is only compared where the bounds leave a chance that it
is as near as the present one, so the result is that of full comparison. Bounds
are floating numbers rounded to the safe side; what decides is the squared
distance in integers, ties to the lower index.

Codebooks are the only thing the driver holds: entries times dimensions numbers,
whatever the number of vectors. Vectors and bounds stay in tables in the shared
checkpoint folder, two at most at a time, written once a round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import _matrix
from .common import discard, pin, small, stored
from .setjoin import slices

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components may not exceed this after scaling: squared distances must fit 64 bits. Larger ones are an error.
LARGEST = 1 << 27
#: Vectors that a task works on at a time.
SLICE = 1_024
#: Factors by which bounds are kept on the safe side of rounding; lower bounds are then cut to 16 bits.
_DOWN, _UP = 1 - 2.0**-20, 1 + 2.0**-40
_STATE = "vector binary, codes binary, upper binary, lower binary"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector is not null and holds no null or non-finite component."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(v.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("embedding"))


def scaled(column: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """Rows of floor(scale * x), filled up with zeros to ``width``; as doubles, which hold them exactly."""
    x = np.floor(scale * _matrix(column, width))
    if x.size and np.abs(x).max() > LARGEST:
        raise OverflowError(f"a scaled component exceeds {LARGEST}")
    return x


def packed_bounds(lower: np.ndarray) -> np.ndarray:
    """The upper halves of single-precision numbers, which are never larger than the bounds."""
    return (np.maximum(lower * _DOWN, 0).astype("<f4").view("<u4") >> 16).astype("<u2")


def unpacked_bounds(packed: np.ndarray) -> np.ndarray:
    return (packed.astype("<u4") << 16).view("<f4").astype("f8")


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, exactly."""
    d = (x - y).astype("i8")
    return (d * d).sum(axis=-1)


def all_squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every entry, exactly; by products of doubles where all sums are exact in them."""
    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    if 4 * most * most * x.shape[1] < 2**52:
        return ((x * x).sum(axis=1)[:, None] + (book * book).sum(axis=1) - 2 * (x @ book.T)).astype("i8")
    return np.stack([squared(x, e) for e in book], axis=1)


def first_assignment(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, upper, lower) of a part's rows: everything is compared."""
    d = all_squared(x, book)
    codes = d.argmin(axis=1)
    root = np.sqrt(d.astype("f8"))
    return codes, root[np.arange(len(x)), codes] * _UP, root * _DOWN


def reassignment(x: np.ndarray, book: np.ndarray, half: np.ndarray, moved: np.ndarray, codes: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after the entries moved by ``moved``, and how many distances were computed.

    ``half`` is at most half the distance between entries. An entry is left out
    only if a bound says strictly that it is farther than the present one.
    """
    codes, upper = codes.copy(), (upper + moved[codes]) * _UP
    lower = np.maximum(lower - moved, 0) * _DOWN
    nearest_other = np.where(np.eye(len(book), dtype=bool), np.inf, half).min(axis=1)
    rows = np.flatnonzero(upper >= nearest_other[codes])

    def open_entries(rows):
        u = upper[rows][:, None]
        open_ = (lower[rows] <= u) & (half[codes[rows]] <= u)
        open_[np.arange(len(rows)), codes[rows]] = False
        return open_

    rows = rows[open_entries(rows).any(axis=1)]
    own = squared(x[rows], book[codes[rows]])
    root = np.sqrt(own.astype("f8"))
    upper[rows], lower[rows, codes[rows]] = root * _UP, root * _DOWN
    i, j = np.nonzero(open_entries(rows))
    d = squared(x[rows[i]], book[j])
    lower[rows[i], j] = np.sqrt(d.astype("f8")) * _DOWN
    order = np.lexsort((j, d, i))
    best = order[np.unique(i[order], return_index=True)[1]]
    at = i[best]
    better = (d[best] < own[at]) | ((d[best] == own[at]) & (j[best] < codes[rows[at]]))
    best, at = best[better], at[better]
    codes[rows[at]], upper[rows[at]] = j[best], np.sqrt(d[best].astype("f8")) * _UP
    return codes, upper, lower, len(rows) + len(d)


def _binary(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    size = data.shape[1] * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(np.arange(0, (len(data) + 1) * size, max(size, 1), dtype="<i4")[: len(data) + 1] if size else np.zeros(len(data) + 1, "<i4")), pa.py_buffer(data)])


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def movement(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.sqrt(squared(old, new).astype("f8")) * _UP


def half_distances(book: np.ndarray) -> np.ndarray:
    return np.sqrt(all_squared(book, book).astype("f8")) * (0.5 * _DOWN)


def _sums(state: DataFrame, entries: int, parts: int, width: int) -> list:
    """(part, entry, n, s0, s1, ...): how many rows each used entry has and what they sum to."""
    own = width // parts

    def run(batches):
        count, total = np.zeros((parts, entries), "i8"), np.zeros((parts, entries, own), "i8")
        for batch in slices(batches, SLICE):
            x, codes = _rows(batch.column(0), "<i4", width), _rows(batch.column(1), "u1", parts)
            for p in range(parts):
                members = (codes[:, p, None] == np.arange(entries)).astype("f8")
                count[p] += members.sum(axis=0).astype("i8")
                total[p] += (members.T @ x[:, p * own : (p + 1) * own].astype("f8")).astype("i8")
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({"part": pa.array(p.astype("i4")), "entry": pa.array(e.astype("i4")), "n": pa.array(count[p, e]), **{f"s{i}": pa.array(total[p, e, i]) for i in range(own)}})

    columns = [f"s{i}" for i in range(own)]
    rows = state.select("vector", "codes").mapInArrow(run, f"part int, entry int, n long{''.join(f', {c} long' for c in columns)}")
    return rows.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).collect()


def train_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame | None, list[np.ndarray]]:
    """((vec_id, label, codes, error), codebooks); codes are a byte per part. (None, []) without any usable vector.

    Codebooks start as the vectors of the smallest ``entries`` distinct ids; of
    rows with one id the one with the smallest components counts. There are
    fewer entries if there are fewer ids. Vectors that are shorter than the
    longest, or whose length ``parts`` does not divide, are filled up with zeros.
    A null id is coded but gives no entry; repeated rows are coded like any others.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte per part, so there are 1 to 256 entries")
    valid = usable(vectors, id_col, vector_col, label_col)
    longest = valid.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None, []
    width = -(-longest // parts) * parts
    own = width // parts
    ids = [r[0] for r in valid.select("vec_id").filter("vec_id IS NOT NULL").distinct().orderBy("vec_id").limit(entries).collect()]
    floors = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    seeds = valid.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min(floors).alias("x")).orderBy("vec_id").collect()
    start = np.zeros((len(seeds), width))
    for i, r in enumerate(seeds):
        start[i, : len(r["x"])] = r["x"]
    books = [start[:, p * own : (p + 1) * own] for p in range(parts)]
    if not seeds:  # ids are all null
        books = [np.zeros((1, own)) for _ in range(parts)]
    k = len(books[0])
    label = valid.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, {_STATE}"

    def begin(batches):
        for batch in slices(batches, SLICE):
            x = scaled(batch.column(2), width, scale)
            found = [first_assignment(x[:, p * own : (p + 1) * own], books[p]) for p in range(parts)]
            yield _state(batch, x.astype("<i4"), found)

    def _state(batch, x, found):
        codes, upper, lower = (np.stack(part, axis=1) for part in zip(*(f[:3] for f in found), strict=True))
        columns = [batch.column(0), batch.column(1), _binary(x), _binary(codes.astype("u1")), _binary(upper.astype("<f8")), _binary(packed_bounds(lower).reshape(len(x), -1))]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "codes", "upper", "lower"])

    def reassigned(batch, books, halves, moves):
        x, codes, upper = _rows(batch.column(2), "<i4", width), _rows(batch.column(3), "u1", parts), _rows(batch.column(4), "<f8", parts)
        lower = unpacked_bounds(_rows(batch.column(5), "<u2", parts * k)).reshape(len(x), parts, k)
        cut = [x[:, p * own : (p + 1) * own].astype("f8") for p in range(parts)]
        return x, cut, [reassignment(cut[p], books[p], halves[p], moves[p], codes[:, p].astype("i8"), upper[:, p], lower[:, p]) for p in range(parts)]

    state = stored(valid.mapInArrow(begin, schema))
    for left in range(rounds, 0, -1):
        before, books = books, [b.copy() for b in books]
        for r in _sums(state, k, parts, width):
            books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(own)]  # rounds down
        halves, moves = [half_distances(b) for b in books], [movement(a, b) for a, b in zip(before, books, strict=True)]

        def follow(batches, books=books, halves=halves, moves=moves):
            for batch in slices(batches, SLICE):
                x, _, found = reassigned(batch, books, halves, moves)
                yield _state(batch, x, found)

        def finish(batches, books=books, halves=halves, moves=moves):
            for batch in slices(batches, SLICE):
                _, cut, found = reassigned(batch, books, halves, moves)
                error = sum(squared(cut[p], books[p][found[p][0]]) for p in range(parts))
                codes = np.stack([f[0] for f in found], axis=1).astype("u1")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(codes), pa.array(error)], names=["vec_id", "label", "codes", "error"])

        if left == 1:
            coded = pin(state.mapInArrow(finish, f"vec_id long, label {label}, codes binary, error long"))
            discard(state)
            return coded, books
        following = stored(state.mapInArrow(follow, schema))
        discard(state)
        state = following
    raise ValueError("there is one round at least")


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()


def vector_codes(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    ``code`` has two hexadecimal digits per part, ``error`` is the squared
    distance to the decoded vector, ``label_error`` its sum over the rows with
    the same label, nulls together. An empty table gives no rows.
    """
    coded, books = train_codes(vectors, **options)
    if coded is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    sums = small(pin(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))))
    rows = coded.join(sums, coded["label"].eqNullSafe(F.col("_label")))
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
