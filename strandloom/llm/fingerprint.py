"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a line; long ones are cut after every PIECE words, so that
one-paragraph documents are more than all or nothing. Each paragraph is hashed
to a wide vector: EXACT lanes of 32 uniform bits and SIGNS lanes of +1 or -1.
A document's fingerprint is the sum over its paragraphs, modulo 2^32 and 2^16.
Order does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector. Equal fingerprints mean equal multisets of paragraphs
up to the chance of a collision; the cosine of the signed lanes estimates how
alike two multisets are, within about 1 / sqrt(SIGNS).
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .setjoin import slices

EXACT, SIGNS, PIECE = 8, 256, 12
MAX_RANGES = 100_000
LAST = (1 << 63) - 1


def paragraphs(text: str) -> list[str]:
    """Lines, cut after every PIECE words; white space at the cuts stays with the piece before, so no character is lost."""
    out = []
    for line in text.split("\n"):
        if line.count(" ") < PIECE:
            out.append(line)
            continue
        words = line.split(" ")
        out += [" ".join(words[i : i + PIECE]) for i in range(0, len(words), PIECE)]
    return out


def vectors(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sums (uint32[EXACT], int64[SIGNS]) of the pieces' hash vectors."""
    raw = b"".join([hashlib.blake2b(p.encode(), digest_size=64).digest() for p in pieces])
    wide = np.frombuffer(raw, dtype=np.uint8).reshape(len(pieces), 64)
    exact = np.ascontiguousarray(wide[:, : 4 * EXACT]).view("<u4").sum(axis=0, dtype=np.uint32)
    ones = np.unpackbits(wide[:, 4 * EXACT :], axis=1).sum(axis=0, dtype=np.int64)
    return exact, 2 * ones - len(pieces)


class Fingerprint:
    """A sum of paragraph vectors."""

    __slots__ = ("exact", "signs")

    def __init__(self, exact: np.ndarray, signs: np.ndarray):
        self.exact, self.signs = exact, signs

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        return cls(*vectors(paragraphs(text)))

    def changed(self, deleted: list[str], inserted: list[str]) -> Fingerprint:
        """Without some paragraphs and with others."""
        exact, signs = self.exact, self.signs
        for pieces, sign in ((deleted, -1), (inserted, 1)):
            if pieces:
                e, s = vectors(pieces)
                exact, signs = (exact - e if sign < 0 else exact + e), signs + sign * s
        return Fingerprint(exact, signs)

    def __str__(self) -> str:
        return base64.b64encode(self.exact.astype("<u4").tobytes() + (self.signs & 0xFFFF).astype("<u2").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        signs = np.frombuffer(raw[4 * EXACT :], dtype="<u2").astype(np.int64)
        return cls(np.frombuffer(raw[: 4 * EXACT], dtype="<u4"), np.where(signs >= 1 << 15, signs - (1 << 16), signs))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the signed lanes, at least 0."""
        if np.array_equal(self.exact, other.exact) and np.array_equal(self.signs & 0xFFFF, other.signs & 0xFFFF):
            return 1.0
        a, b = self.signs.astype("f8"), other.signs.astype("f8")
        scale = np.sqrt((a @ a) * (b @ b))
        return float(min(max((a @ b) / scale, 0.0), 1.0)) if scale else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edited_fingerprint(own: Fingerprint, text: str, changed: str) -> Fingerprint:
    """The fingerprint of an edited text, from its original's: only paragraphs from the first differing line on are touched."""
    n = len(text) // 4
    start = text.rfind("\n", 0, len(text) - n) + 1
    return own.changed(paragraphs(text[start:]), paragraphs(changed[start:]))


def by_ranges(docs: DataFrame, id_col: str, text_col: str, ranges: int | None = None) -> DataFrame:
    """(range, halo, _id, doc_id, text): ranges of consecutive ids, each followed by the first document of the next range.

    Borders are quantiles of the ids. There are as many as tasks, at most
    MAX_RANGES, and one halo row for each, so the tables of borders and first
    ids stay small and every range is worked on by itself.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keyed = keyed.withColumn("_order", F.col("_id").cast("double"))
    spark = docs.sparkSession
    if ranges is None:
        ranges = min(MAX_RANGES, max(2 * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = sorted(set(keyed.approxQuantile("_order", [i / ranges for i in range(1, ranges)], 0.5 / ranges))) if ranges > 1 else []
    split = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_order", outputCol="_range")
    dealt = (split.transform(keyed) if cuts else keyed.withColumn("_range", F.lit(0))).withColumn("range", F.col("_range").cast("long"))
    firsts = sorted((r["range"], r["first"]) for r in dealt.groupBy("range").agg(F.min("_id").alias("first")).collect())
    # A first document is also the end of the range before; the very first one ends the last range.
    before = spark.createDataFrame([(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], "_first long, _before long")
    joined = dealt.join(F.broadcast(before), F.col("_id") == F.col("_first"), "left")
    own, end = F.struct(F.col("range"), F.lit(0).alias("halo")), F.struct(F.col("_before").alias("range"), F.lit(1).alias("halo"))
    copies = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, end))
    return joined.withColumn("at", F.explode(copies)).select("at.range", "at.halo", "_id", "doc_id", "text")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), see the module.

    The next document is by ascending id, after the last the first; null ids
    come last, rows with equal ids by their text. Null text is empty. One
    document is its own next one. An empty table gives no rows. Texts are
    shuffled once, by range; a task holds two documents at a time.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches):
        pending, out = None, []

        def emit(next_text, next_print):
            doc, text, own = pending
            changed = edited(text, next_text)
            new = edited_fingerprint(own, text, changed)
            out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), str(own), str(new), own.likeness(new), own.likeness(next_print)))

        def flush():
            columns = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        last = None
        for batch in slices(batches, 256):
            for where, halo, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if where != last:
                    pending, last, closed = None, where, False
                if closed:  # further rows with the id of the halo
                    continue
                own = Fingerprint.of(text)
                if pending is not None:
                    emit(text, own)
                pending, closed = (doc, text, own), bool(halo)
            yield flush()

    dealt = by_ranges(docs, id_col, text_col, ranges)
    tasks = dealt.repartition("range").sortWithinPartitions("range", "halo", "_id", "text").select("range", "halo", "doc_id", "text")
    return tasks.mapInArrow(run, schema)
