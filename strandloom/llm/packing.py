"""Best-fit packing of documents into fixed-length token sequences by the sum-of-squares rule.

The state of a packing is one counter per residual gap: how many open
sequences have that much room. A piece goes where the sum of the squared
counters becomes smallest, ties to the smallest gap; a new sequence is opened
only if no open one has room. Pieces are placed longest first: on the test
lengths that ends within 0.1 % of the lower bound, where random order or free
opening of sequences is 1 to 4 % above it.

Packing groups of about ``GROUP`` pieces, dealt by a hash, are independent
tasks; each leaves a few part-filled sequences, whatever the corpus size.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin, small_batches
from .tokens import default_vocabulary, encode

#: Pieces that one task packs together.
GROUP = 32_768
END_ID = 2


def cut_points(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: full pieces at the end, the first one may be shorter."""
    first = length % limit
    spans = [(0, first)] if first else []
    return spans + [(start, limit) for start in range(first, length, limit)]


def token_pieces(docs: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; null text is empty, so just the end id."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    schema = f"{id_col} long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches):
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in (id_col, "piece", "start", "length", "ids_crc32")} | ({"ids": []} if with_ids else {})
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or "", path), END_ID], dtype="<u4")
                for k, (start, length) in enumerate(cut_points(len(ids), limit)):
                    part = ids[start : start + length]
                    for name, value in zip(rows, (doc, k, start, length, zlib.crc32(part.tobytes()), part.tolist() if with_ids else None), strict=False):
                        rows[name].append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def place(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length; ``lengths`` come longest first."""
    count = np.zeros(limit + 1, dtype=np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(limit + 1)]
    sequence, offset, opened = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to g - n changes the sum of squares by 2 * (count[g - n] - count[g]) + 2.
        change = count[: limit - n + 1] - count[n:]
        change[0] = -count[n]  # a filled sequence is not open any more
        change[count[n:] == 0] = 1 << 60
        best = int(change.argmin())
        if change[best] < 1 << 60:
            gap = best + n
            number = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, number = limit, opened
            opened += 1
        sequence[i], offset[i] = number, limit - gap
        if gap > n:
            open_by_gap[gap - n].append(number)
            count[gap - n] += 1
    return sequence, offset


def pack_pieces(pieces: DataFrame, limit: int = 1024, id_col: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``limit`` tokens. Reruns agree; an empty table stays empty."""
    groups = max(1, math.ceil(pieces.count() / GROUP))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(groups)))
    columns = [id_col, "piece", "start", "length", "ids_crc32"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values(["length", id_col, "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        number, offset = place(g["length"].to_numpy(), limit)
        return g[columns].assign(sequence_id=(g["_group"].astype("int64").to_numpy() << 32) + number, offset=offset)

    return dealt.groupBy("_group").applyInPandas(pack, f"{id_col} long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The packing plan of a corpus: one row per piece.

    Null ids and repeated rows are packed like any others; columns of ``docs``
    other than the two named are ignored, whatever their names.
    """
    return pack_pieces(pin(token_pieces(docs, limit, id_col, text_col, vocabulary)), limit, id_col)


def packed_sequences(docs: DataFrame, plan: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, input_ids, docs): the token ids of each sequence, laid out by ``plan``.

    Encodes again instead of shuffling ids twice. A sequence has at most
    ``limit`` tokens, so no group grows with the input.
    """
    cut = token_pieces(docs, limit, id_col, text_col, vocabulary, with_ids=True).dropDuplicates([id_col, "piece", "start", "length", "ids_crc32"])
    keys = [id_col, "piece", "start", "length", "ids_crc32"]
    same = [plan[k].eqNullSafe(cut[k]) for k in keys]
    both = plan.join(cut, same).select(plan["sequence_id"], plan["offset"], plan[id_col].alias(id_col), cut["ids"])
    laid = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", id_col, "ids"))).alias("p"))
    return laid.select("sequence_id", F.flatten("p.ids").alias("input_ids"), F.col(f"p.{id_col}").alias("docs"))
