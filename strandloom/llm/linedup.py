"""Line dedup: an exact set-similarity join of all lines of a corpus; later matches are removed.

A line's set holds its distinct five-word shingles, in order of their rarity in
the corpus; a line of fewer words is one shingle, so it only matches equal ones.
Candidates are lines that share a token of their prefixes and pass the length
and positional filters; their overlap is then counted (setjoin). A line goes if
an earlier line, by (doc_id, line number), has a set of similarity >= 0.8,
removed or not, so the result does not depend on the order of execution. Lines
without words stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, pin, small, small_batches
from .setjoin import blocked_links, by_bytes, candidates, components, distinct_sets, filter_places, filter_words, line_words, sampled_tokens, shingle_hashes, slices

#: Lines that one task joins with each other at a time; their sets are small.
BLOCK = 8_192
LAST = (1 << 63) - 1
#: Words that the filter of texts that lose lines has at most; it is broadcast.
FILTER_WORDS = 1 << 20


def sets_of(k: int):
    """Texts to (tokens, offsets, classes) of the k-word shingles of their lines with words."""

    def sets(texts):
        words, counts, _, _ = line_words(texts, 1)
        return distinct_sets(*shingle_hashes(words, counts, k))

    return sets


def line_classes(docs: DataFrame, k: int) -> DataFrame:
    """(doc, key, line, class, n, sample) of every line with words; ``docs`` is (doc, key, text)."""

    def run(batches):
        for batch in by_bytes(batches, 2):
            words, counts, text, line = line_words(batch.column(2).cast(pa.binary()).to_pylist(), 1)
            tokens, offsets, classes = distinct_sets(*shingle_hashes(words, counts, k))
            at = pa.array(text, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(line, pa.int32()), pa.array(classes, pa.int64()), pa.array(np.diff(offsets), pa.int32()), sampled_tokens(tokens, offsets, classes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "key", "line", "class", "n", "sample"])

    return docs.mapInArrow(run, "doc long, key long, line int, class long, n int, sample array<long>")


def repeated_lines(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc, key, line) of each line that repeats an earlier one. ``doc`` is the id (null: the largest long), ``key`` the text's hash."""
    small_batches(docs.sparkSession)
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = pin(line_classes(named, k))
    edges, sets = candidates(rows, named.select("text"), sets_of(k), num, den)
    near = pin(components(edges))
    # Classes are ranked by where they first occur.
    place = F.array("doc", "key", F.col("line").cast("long"))
    classes = pin(rows.groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("copies")))
    members = near.join(classes, near["node"] == classes["class"]).select("component", "class", F.col("first").alias("rank"))
    members = pin(members)
    links = blocked_links(members, sets, num, den, earlier=True, block=block)
    later = links.select(F.col("a").alias("class")).distinct().withColumn("_later", F.lit(True))
    decided = classes.join(later, "class", "left").filter("copies > 1 or _later").select("class", "first", F.coalesce("_later", F.lit(False)).alias("_later"))
    decided = small(pin(decided))
    return rows.select("doc", "key", "line", "class").join(decided, "class").filter(F.col("_later") | (place != F.col("first"))).select("doc", "key", "line")


def drop_repeated_lines(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; with ``counts`` also n_lines and n_removed.

    A column ``n_chars`` follows the new text. Null texts stay null; rows that
    repeat both id and text are one document and keep the same lines; all other
    columns are unchanged, whatever their names, and an empty table stays empty.
    A document whose lines all go stays as an empty text.
    """
    gone = repeated_lines(docs, k, num, den, id_col, text_col).distinct()
    by_doc = pin(gone.groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key")).agg(F.collect_list("line").alias("_gone")))
    names, own = docs.columns, aside(docs)
    at = names.index(text_col)
    keyed = own.withColumns({"_d": F.coalesce(F.col(f"_{names.index(id_col)}").cast("long"), F.lit(LAST)), "_k": F.xxhash64(f"_{at}")})
    # Only texts that may lose lines go through the join and the tasks that cut; a filter of at most FILTER_WORDS rows lets all others by.
    words, size = filter_words(by_doc.select(F.xxhash64("_doc", "_key").alias("class")), FILTER_WORDS)
    words = pin(words)
    keyed = keyed.withColumn("_h", F.xxhash64("_d", "_k"))
    touched = F.lit(True)
    for i, (word, bit) in enumerate(filter_places("_h", size)):
        keyed = keyed.withColumn("_w", word).join(F.broadcast(words.select(F.col("w").alias("_w"), F.col("b").alias(f"_b{i}"))), "_w", "left").drop("_w")
        touched &= F.coalesce(F.col(f"_b{i}").bitwiseAND(bit) != 0, F.lit(False))
    joined = keyed.filter(touched).join(by_doc, (F.col("_d") == F.col("_doc")) & (F.col("_k") == F.col("_key")), "left").select(*own.columns, "_gone")

    def cut(batches):
        for batch in slices(batches, 256):
            texts, total, removed = [], [], []
            for text, lines in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if text is not None and lines:
                    out = set(lines)
                    text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in out)
                texts.append(text)
                removed.append(len(lines or ()))
                total.append(None if text is None else text.count("\n") + 1 + removed[-1])
            columns = [*batch.columns[: len(names)]]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                i = names.index("n_chars")
                old = columns[i].to_pylist()
                columns[i] = pa.array([len(t) if r else o for t, r, o in zip(texts, removed, old, strict=True)], batch.schema.field(i).type)
            more = [pa.array(total, pa.int32()), pa.array(removed, pa.int32())] if counts else []
            yield pa.RecordBatch.from_arrays([*columns, *more], names=[*batch.schema.names[: len(names)], *["lines", "removed"][: len(more)]])

    added = ["n_lines", "n_removed"] if counts else []
    text = F.col(f"_{at}")
    unchanged = [F.regexp_count(text, F.lit("\n")).cast("int") + 1, F.lit(0)]
    whole = keyed.filter(~touched).select(*own.columns, *[c.alias(x) for c, x in zip(unchanged, ("lines", "removed")[: len(added)], strict=False)])
    return whole.unionAll(joined.mapInArrow(cut, whole.schema)).toDF(*names, *added)
