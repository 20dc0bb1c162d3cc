"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are turned by fast pseudo-rotations (random signs and a Hadamard
transform, three times) and fall into the cell of the signed axis they are
nearest to. A query looks into the cells of its best-scoring axes in each of
several tables, and everything found there is scored exactly.

Largest inner product becomes smallest angle by one more coordinate that lifts
all vectors of a range of lengths to the longest of that range; if they have it
already, none is added. Queries look into every range. Ranges of few vectors
are not hashed: all queries are scored against all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, small
from .setjoin import slices

TABLES = 8
PROBES = 16
#: Candidates that one task holds; fuller cells are split, and queries go to every part.
PART = 4_096
#: With more vectors a second, smaller polytope splits every cell.
ONE_POLYTOPE = 1 << 17
#: The probes grow with this power of the split: with 0.5, recall fell to 0.69 at 64; with 0.75 it stays above 0.9 (see the README).
PROBE_GROWTH = 0.75
#: The largest squared length in a range over the smallest.
RANGE = 2.0
#: A range of at most this many vectors is scored as a whole.
WHOLE = 1_024
#: Queries that one task scores against a part of the vectors that are scored as a whole.
ASKING = 8_192
#: Queries whose answers a task gathers before it passes them on.
MERGED = 16_384
#: Scores that one slice of rows may have at a time.
SCORES = 1 << 22


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    x, h = x.copy(), 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def polytope_scores(x: np.ndarray, table: int, split: int, seed: int) -> np.ndarray:
    """Score of every cell for every row: the larger, the nearer. ``split`` is the number of cells of the second polytope (1: none)."""
    y = rotated(x, seed * 1_000 + 2 * table)
    first = np.concatenate([y, -y], axis=1)
    if split == 1:
        return first
    y = rotated(x, seed * 1_000 + 2 * table + 1)[:, : split // 2]
    second = np.concatenate([y, -y], axis=1)
    return (first[:, :, None] + second[:, None, :]).reshape(len(x), -1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, filled up with zeros to ``width``."""
    out = np.zeros((len(column), width))
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype("f8")
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == sizes[0]).all():
        out[:, : sizes[0]] = values[offsets[0] : offsets[-1]].reshape(len(sizes), -1)
    else:
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            out[i, : b - a] = values[a:b]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding) without vectors that are null, empty, zero or hold null or non-finite components, and without null ids."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(finite & F.exists(v, lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), (v if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else v.cast("array<double>")).alias("embedding"))


def length_ranges(bins: list) -> list[tuple[float, float, int]]:
    """(least, most, vectors) of ranges of squared lengths, ascending, joined from the (least, most, vectors) of small bins."""
    out = []
    for least, most, n in sorted(bins, reverse=True):
        if out and out[-1][1] <= RANGE * least:
            out[-1] = least, out[-1][1], out[-1][2] + n
        else:
            out.append((least, most, n))
    return out[::-1]


def nearest_neighbours(
    vectors: DataFrame,
    top: int = 20,
    every: int = 20,
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    part: int = PART,
    one_polytope: int = ONE_POLYTOPE,
    whole: int = WHOLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every`` its ``top`` nearest found; all others if there are fewer.

    Score is the inner product in double precision; ties go to the smaller id.
    Every id with a usable vector is indexed once: repeated rows are one, and of
    several vectors of an id the least, component by component, counts. Of vectors
    that are equal in all components only the top + 1 smallest ids can be among
    anybody's nearest, so only those enter the cells; equal queries are answered once. Vectors of unequal length
    are filled up with zeros. A query whose cells hold too few is scored against
    all vectors. An empty table gives no rows.
    """
    valid = pin(usable(vectors, id_col, vector_col).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    # Floats travel as floats; they are exact as doubles, in which all sums are taken.
    kind = "<f4" if valid.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    # A bin is 1/16 of a doubling of the squared length, so the driver sees some thousands of rows at most.
    bin_of = F.coalesce(F.floor(16 * F.log2("_norm2")).cast("long"), F.lit(-(1 << 20)))
    bins = valid.select(F.size("embedding").alias("_d"), norm2.alias("_norm2")).groupBy(bin_of.alias("_bin")).agg(F.count("*").alias("n"), F.max("_d").alias("d"), F.max("_norm2").alias("most"), F.min("_norm2").alias("least")).collect()
    if not bins:
        return valid.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = max(r["d"] for r in bins)
    ranges = length_ranges([(r["least"], r["most"], r["n"]) for r in bins])
    lifts = [most - least > 1e-6 * most for least, most, n in ranges]
    hashed = [n > whole for _, _, n in ranges]
    width = 1 << max(1, (size + any(x and h for x, h in zip(lifts, hashed, strict=True)) - 1).bit_length())
    plans, cells_before = [], 1  # (range, split, probes, first cell); cell 0 holds the ranges that are scored as a whole
    for i, (_, _, n) in enumerate(ranges):
        if hashed[i]:
            split = min(1 << max(0, math.floor(math.log2(n / one_polytope))), 2 * width)
            # The lift turns the vectors away from the queries, so twice the cells are looked into.
            plans.append((i, split, min(round(probes * (1 + lifts[i]) * split**PROBE_GROWTH), 2 * width * split), cells_before))
            cells_before += tables * 2 * width * split
    bounds = np.array([least for least, _, _ in ranges[1:]])
    largest = max([2 * width * split for _, split, _, _ in plans], default=1)

    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    candidates = valid.withColumn("_r", F.row_number().over(by_vector)).filter(F.col("_r") <= top + 1).drop("_r")
    asking = valid.filter(F.col("vec_id") % every == 0)
    queries = asking.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"))

    def cells(is_query: bool):
        def run(batches):
            for batch in slices(batches, max(1, min(2_048, SCORES // largest))):
                exact = _matrix(batch.column(1), size)
                squared = (exact**2).sum(axis=1)
                within = np.searchsorted(bounds, squared, side="right")
                rows = [r.tobytes() for r in exact.astype(kind)]
                ids = batch.column(0).to_numpy()

                def placed_in(cell, owner, rows=rows, ids=ids):
                    return pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()), "vec_id": pa.array(ids[owner], pa.int64()), "vector": pa.array([rows[i] for i in owner.tolist()], pa.binary())})

                alone = np.arange(len(ids)) if is_query else np.flatnonzero(~np.array(hashed)[within])
                if not all(hashed):
                    yield placed_in(np.zeros(len(alone), "i8"), alone)
                for i, split, looked, first in plans:
                    owner = np.arange(len(ids)) if is_query else np.flatnonzero(within == i)
                    x = np.zeros((len(owner), width))
                    x[:, :size] = exact[owner]
                    if lifts[i] and not is_query:
                        x[:, size] = np.sqrt(np.maximum(ranges[i][1] - squared[owner], 0))
                    for t in range(tables if len(owner) else 0):
                        scores = polytope_scores(x, t, split, seed)
                        if is_query:
                            cell, owners = np.argpartition(-scores, looked - 1, axis=1)[:, :looked].ravel(), np.repeat(owner, looked)
                        else:
                            cell, owners = scores.argmax(axis=1), owner
                        yield placed_in(cell + first + t * 2 * width * split, owners)

        return run

    schema = "cell long, vec_id long, vector binary"
    placed = pin(candidates.select("vec_id", "embedding").mapInArrow(cells(False), schema))
    asked = queries.select("vec_id", "embedding").mapInArrow(cells(True), schema)
    parts = small(pin(placed.groupBy("cell").agg(F.ceil(F.count("*") / part).alias("_parts"))))
    # All queries meet in cell 0, so they are dealt to several blocks of it, each with a copy of its vectors.
    blocks = F.lit(max(1, math.ceil(queries.count() / ASKING)) if not all(hashed) else 1).cast("long")
    blocks = F.when(F.col("cell") == 0, blocks).otherwise(F.lit(1).cast("long"))
    held = placed.join(parts, "cell").select("cell", F.pmod(F.xxhash64("vec_id"), F.col("_parts")).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(0).alias("asks"), "vec_id", "vector")
    sent = asked.join(parts, "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("part"), F.pmod(F.xxhash64("vec_id"), blocks).alias("block"), F.lit(1).alias("asks"), "vec_id", "vector")

    def score(batches):
        """Rows come by (cell, part, block), the candidates first; queries are scored a batch at a time, and a task's answers to a query are merged."""
        here, ids, held_vectors, matrix, waiting, found = None, [], [], None, ([], []), {}

        def vectors_of(parts):
            return np.frombuffer(b"".join(parts), dtype=kind).reshape(-1, size).astype("f8")

        def merged_so_far(least):
            """The answers, once they are of ``least`` queries."""
            if len(found) >= least:
                rows = []
                for q, parts in found.items():
                    names, exact = _best(*(np.concatenate(x) for x in zip(*parts, strict=True)), top + 1)
                    rows.append((q, names, exact))
                found.clear()
                yield _merged(rows)

        def answers():
            nonlocal matrix, waiting
            if waiting[0] and ids:
                if matrix is None:
                    order = np.argsort(ids)
                    matrix = np.array(ids)[order], vectors_of(held_vectors)[order]
                names, rows = matrix
                asked_rows = vectors_of(waiting[1])
                for q, vector, line in zip(waiting[0], asked_rows, asked_rows @ rows.T, strict=True):
                    keep = top + 1
                    at = np.arange(len(line))
                    if len(line) > keep:  # whatever may tie with the last place stays until the exact scores and the ids decide
                        bound = np.partition(line, len(line) - keep)[len(line) - keep]
                        at = np.flatnonzero(line >= bound - 1e-9 * max(1.0, abs(bound)))
                    exact = (rows[at] * vector).sum(axis=1)  # one row's sum does not depend on the other rows
                    best = np.lexsort((names[at], -exact))[:keep]
                    mine = found.setdefault(q, [])
                    mine.append((names[at[best]], exact[best]))
                    if len(mine) == 16:
                        mine[:] = [_best(*(np.concatenate(x) for x in zip(*mine, strict=True)), keep)]
            waiting = ([], [])
            yield from merged_so_far(MERGED)

        for batch in slices(batches, 2_048):
            for cell, which, block, asks, vec, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, which, block) != here:
                    yield from answers()
                    here, ids, held_vectors, matrix = (cell, which, block), [], [], None
                if asks:
                    waiting[0].append(vec)
                    waiting[1].append(vector)
                    if len(waiting[0]) == 512:
                        yield from answers()
                else:
                    ids.append(vec)
                    held_vectors.append(vector)
        yield from answers()
        yield from merged_so_far(0)

    def met(held, sent):
        return held.union(sent).repartition("cell", "part", "block").sortWithinPartitions("cell", "part", "block", "asks").mapInArrow(score, "query long, ids array<long>, scores array<double>")

    def merge(batches):
        """Rows come by query."""

        def best(query, found):
            order = sorted(found.items(), key=lambda x: (-x[1], x[0]))[: top + 1]
            return query, [i for i, _ in order], [s for _, s in order]

        last, found = None, {}
        for batch in slices(batches, 2_048):
            out = []
            for query, ids, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query != last:
                    if last is not None:
                        out.append(best(last, found))
                    last, found = query, {}
                found.update(zip(ids, scores, strict=True))
                if len(found) > 50 * top:
                    found = dict(zip(*best(query, found)[1:], strict=True))
            yield _merged(out)
        yield _merged([best(last, found)] if last is not None else [])

    def merged(rows):
        return rows.repartition("query").sortWithinPartitions("query").mapInArrow(merge, "query long, ids array<long>, scores array<double>")

    def encoded(batches):
        for batch in slices(batches, 2_048):
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "vector": pa.array([r.tobytes() for r in _matrix(batch.column(1), size).astype(kind)], pa.binary())})

    answered = pin(merged(met(held, sent)))
    total = sum(n for _, _, n in ranges)
    full = answered.filter(F.size("ids") >= min(top + 1, total))  # with their own id, which is dropped below
    short = pin(queries.join(full.select("query"), F.col("vec_id") == F.col("query"), "left_anti").select("vec_id", "embedding").mapInArrow(encoded, "vec_id long, vector binary"))
    if unanswered := short.count():
        # Queries that found too few are scored against every candidate; a candidate's row of its first table stands for it.
        parts, blocks = math.ceil(total / part), math.ceil(unanswered / ASKING)
        once = F.col("cell") == 0
        for _, split, _, first in plans:
            once = once | F.col("cell").between(first, first + 2 * width * split - 1)

        def dealt(number, copies, to, along):
            return {to: F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("long"), along: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))}

        columns = ["cell", "part", "block", "asks", "vec_id", "vector"]
        held = placed.filter(once).withColumns({"cell": F.lit(0).cast("long"), "asks": F.lit(0), **dealt(parts, blocks, "part", "block")}).select(columns)
        sent = short.withColumns({"cell": F.lit(0).cast("long"), "asks": F.lit(1), **dealt(blocks, parts, "block", "part")}).select(columns)
        answered = full.union(merged(met(held, sent)))
    named = asking.join(queries.select(F.col("vec_id").alias("query"), F.col("embedding").alias("_e")), asking["embedding"].eqNullSafe(F.col("_e"))).select(F.col("vec_id").alias("query_id"), "query")
    listed = named.join(answered, "query").select("query_id", F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id")).alias("found"))
    return listed.select("query_id", F.posexplode(F.slice("found", 1, top)).alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))


def _best(names: np.ndarray, scores: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` best of answers that may name a vector more than once: by score, ties to the smaller id."""
    names, at = np.unique(names, return_index=True)
    scores = scores[at]
    order = np.lexsort((names, -scores))[:keep]
    return names[order], scores[order]


def _merged(rows: list) -> pa.RecordBatch:
    query, ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({"query": pa.array(query, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())), "scores": pa.array(scores, pa.list_(pa.float64()))})
