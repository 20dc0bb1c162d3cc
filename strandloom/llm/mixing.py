"""Mixing sources to target weights by weighted fair queueing.

Every source is shuffled by a seeded hash. A document's virtual finish time is
the number of tokens its source has served up to and including it, divided by
the source's target. All documents are range-sorted by that time and the mix
is the prefix whose tokens fit the budget; repeats continue a source's count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, aside, pin, small

#: Rows of one bucket of the running sums at least; from its square on, the square root of all rows, so that buckets and their sums are about as many.
ROWS_PER_BUCKET = 2_000


def shuffle_key(seed: int, id_col: str, text_col: str):
    """53 random bits that depend only on the seed and the row."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 11)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to (source, source_size).

    Sources by code point, null last, take the weights in turn. A target is
    min(max_repeats * size, level * weight); the level at which the targets sum
    to the budget is what resharing the excess over and over ends at. Sorted by
    max_repeats * size / weight, the capped sources come first, so one scan of
    the source table finds it. That table has a row of a few numbers for each
    distinct source, however many documents there are; the scan is one task, so
    sources are expected in thousands, and millions take some seconds.
    """
    everything = Window.orderBy("ratio", "rank")
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(max_repeats)).withColumn("ratio", F.col("cap") / F.col("weight"))
    whole = Window.partitionBy()
    scanned = (
        ranked.withColumn("budget", F.sum("source_size").over(whole) * share)
        .withColumn("capped", F.coalesce(F.sum("cap").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
    )
    found = scanned.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(whole)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return found.select("source", "source_size", "documents", "rank", "weight", target.alias("target"), "budget")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_bucket: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, stream).

    ``rows``: one per document with ``row``, doc_id, ``shuffle``, size (words;
    null text: 0), source_size and target. ``stream``: the mix in order of
    ``position`` (tokens up to and including a row), with ``row``, ``source``, ``epoch``
    (0 to max_repeats - 1) and ``finish``. Null ids are ordinary; documents
    without words are never taken; repeated rows are separate documents; an
    empty table gives empty results. Only ids, sources and numbers are shuffled.
    """
    base = pin(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            shuffle_key(seed, id_col, text_col).alias("shuffle"),
        )
    )
    count = base.count()
    rows_per_bucket = rows_per_bucket or max(ROWS_PER_BUCKET, math.isqrt(count))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    targets = pin(source_targets(sizes, weights, share, max_repeats))
    near = small(targets)
    rows = base.join(near.withColumnRenamed("source", "_source"), base["source"].eqNullSafe(F.col("_source"))).drop("_source")
    buckets = F.ceil(F.col("documents") / rows_per_bucket)
    queue = rows.filter("size > 0").withColumn("bucket", F.floor(F.col("shuffle") * buckets / float(1 << 53)).cast("long"))

    sums = queue.groupBy("rank", "bucket").agg(F.sum("size").alias("served"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("rank", "bucket", F.coalesce(F.sum("served").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("rank", "bucket").orderBy("shuffle", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    served = queue.join(offsets, ["rank", "bucket"]).withColumn("served", F.col("ahead") + F.sum("size").over(within))

    # A row starts where the one before it finished; those that start past time 1 come after the budget is spent.
    epochs = F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda e: e * F.col("source_size") + F.col("served") - F.col("size") < F.col("target"))
    timed = served.select("row", "source", "rank", "doc_id", "shuffle", "size", "source_size", "served", "target", "budget", F.explode(epochs).alias("epoch"))
    timed = timed.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("served")) / F.col("target"))
    # Tokens are spread evenly over virtual time, so equal spans of it are ranges of about equal size.
    spans = max(1, math.ceil(max_repeats * count / rows_per_bucket))
    timed = pin(timed.withColumn("span", F.floor(F.col("finish") * spans).cast("long")))
    span_sums = timed.groupBy("span").agg(F.sum("size").alias("tokens"))
    span_before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    span_ahead = span_sums.select("span", F.coalesce(F.sum("tokens").over(span_before), F.lit(0)).alias("span_ahead"))
    order = Window.partitionBy("span").orderBy("finish", "rank", "epoch", "shuffle", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    ranged = timed.join(small(span_ahead), "span").repartitionByRange("span")
    stream = ranged.withColumn("position", F.col("span_ahead") + F.sum("size").over(order)).filter(F.col("position") <= F.col("budget"))
    return rows, stream.select("row", "source", "doc_id", "shuffle", "epoch", "size", "finish", "position")


def mixture_by_document(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words that the mix takes of each document, repeats counted."""
    rows, stream = mix_sources(docs, **options)
    taken = stream.groupBy("row").agg(F.sum("size").alias("taken"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, max_repeats: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.

    The mix takes a prefix of every source's own order, so the last place that
    it takes of each source tells for every document how often it is taken.
    Only this table of a row per source is joined; texts are not shuffled. Rows
    that repeat both id and text share one fate, that of the most taken one.
    """
    _, stream = mix_sources(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, max_repeats=max_repeats, **options)
    last = small(pin(stream.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("epoch", "shuffle", "doc_id")).alias("_last"))))
    own = aside(docs)
    ids, texts, sources = (f"_{docs.columns.index(c)}" for c in (id_col, text_col, source_col))
    keyed = own.filter(F.col(texts).rlike(WORD)).withColumn("_key", shuffle_key(seed, ids, texts))
    joined = keyed.join(last, F.col(sources).eqNullSafe(F.col("_source")))
    place = lambda e: F.struct(e.alias("epoch"), F.col("_key").alias("shuffle"), F.col(ids).alias("doc_id"))
    epochs = F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda e: place(e) <= F.col("_last"))
    return joined.withColumn("_copy", F.explode(epochs)).select(*own.columns).toDF(*docs.columns)
