"""N-gram Jaccard join of whole documents by set-relation skipping.

A document's set holds its distinct k-word shingles. Equal sets are one class;
classes that may be similar meet in blocks and are joined through
position-blocked index lists there, and a class that is similar to an already
answered one takes over its answers (setjoin).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, pin, small, small_batches
from .setjoin import BLOCK, blocked_links, by_bytes, candidates, components, distinct_sets, document_words, sampled_tokens, shingle_hashes


def sets_of(k: int):
    """Texts to (tokens, offsets, classes) of their k-word shingles."""
    return lambda texts: distinct_sets(*shingle_hashes(*document_words(texts), k))


def document_classes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, class, sample); class is null for empty sets. ``docs`` is (doc_id, text)."""
    sets = sets_of(k)

    def run(batches):
        for batch in by_bytes(batches, 1):
            tokens, offsets, classes = sets(batch.column(1).cast(pa.binary()).to_pylist())
            columns = [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(classes, pa.int64(), mask=classes == 0), sampled_tokens(tokens, offsets, classes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "class", "sample"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, class long, sample array<long>")


def similar_documents(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, class, component_id): documents linked by Jaccard similarity >= num / den, as components.

    ``component_id`` is the smallest id that a document reaches by links.
    Null or word-less texts have an empty set and only themselves; fewer than k
    words are one shingle; repeated rows are alike; null ids never name a
    component unless all its ids are null. An empty table gives no rows.
    Texts are scanned three times and never shuffled.
    """
    small_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = pin(document_classes(named, k))
    counted = rows.filter("class is not null").select("class", F.col("n_shingles").alias("n"), "sample")
    edges, sets = candidates(counted, named.select("text"), sets_of(k), num, den)
    near = pin(components(edges))
    classes = pin(rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    members = near.select("component", F.col("node").alias("class")).withColumn("rank", F.lit(0).cast("long"))
    linked = components(blocked_links(members, sets, num, den, earlier=False, block=block))
    groups = classes.join(linked, classes["class"] == linked["node"], "left")
    smallest = groups.filter("component is not null").groupBy("component").agg(F.min("first").alias("_smallest"))
    shared = groups.filter("copies > 1 or component is not null").join(smallest, "component", "left").select("class", F.coalesce("_smallest", "first").alias("_component"))
    return rows.join(small(pin(shared)), "class", "left").select("doc_id", "n_shingles", "class", F.coalesce("_component", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays; columns as they were.

    Rows with a null id stay. Rows that repeat the smallest id of their
    component stay too, for they are the same document.
    """
    found = similar_documents(docs, k, num, den, id_col, text_col)
    gone = small(pin(found.filter("component_id < doc_id").select(F.col("doc_id").alias("gone")).distinct()))
    kept = aside(docs)
    return kept.join(gone, F.col(f"_{docs.columns.index(id_col)}") == F.col("gone"), "left_anti").toDF(*docs.columns)
