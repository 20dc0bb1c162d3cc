"""Exact length histogram: token totals, quantiles and truncated totals for every context limit."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin, running_totals
from .tokens import default_vocabulary, encode


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(length, documents): how many documents encode to each length. Null text counts as empty.

    Each task adds up its own documents, so only distinct lengths are shuffled.
    An empty table gives no rows; other columns of ``docs`` do not matter.
    """
    path = vocabulary or default_vocabulary()

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            seen.update(len(encode(x.as_py() or "", path)) for x in batch.column(0))
        yield pa.RecordBatch.from_pydict({"length": pa.array(list(seen), pa.int64()), "documents": pa.array(list(seen.values()), pa.int64())})

    partial = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "length long, documents long")
    return partial.groupBy("length").agg(F.sum("documents").alias("documents"))


def context_table(histogram: DataFrame, width: int = 4096) -> DataFrame:
    """One row per distinct length L, read as a context limit.

    ``tokens_total`` of the whole corpus, ``documents_over`` longer than L,
    ``tokens_truncated`` = sum of min(length, L), ``tokens_lost`` = what the
    limit cuts, ``quantile`` = share of documents of at most L tokens. Suffix
    sums answer all of them: sum(min(length, L)) = sum(length <= L) + L * (documents over L).
    Between two distinct lengths every answer is linear in the limit.
    """
    h = pin(histogram.withColumn("tokens", F.col("length") * F.col("documents")).withColumn("_one", F.lit(1)))
    run = running_totals(h, ["_one"], "length", {"documents_upto": "documents", "tokens_upto": "tokens"}, width)
    whole = h.groupBy("_one").agg(F.sum("documents").alias("documents_total"), F.sum("tokens").alias("tokens_total"))
    return run.join(F.broadcast(whole), "_one").select(
        F.col("length").alias("context_limit"),
        "documents",
        (F.col("documents_total") - F.col("documents_upto")).alias("documents_over"),
        "tokens_total",
        (F.col("tokens_upto") + F.col("length") * (F.col("documents_total") - F.col("documents_upto"))).alias("tokens_truncated"),
        (F.col("tokens_total") - F.col("tokens_upto") - F.col("length") * (F.col("documents_total") - F.col("documents_upto"))).alias("tokens_lost"),
        (F.col("documents_upto") / F.col("documents_total")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, tokens_truncated, documents_over) for any limits, seen as lengths or not."""
    each = [F.struct(F.lit(n).cast("long").alias("context_limit"), F.sum(F.least(F.col("length"), F.lit(n)) * F.col("documents")).alias("tokens_truncated"), F.sum(F.when(F.col("length") > n, F.col("documents")).otherwise(0)).alias("documents_over")) for n in limits]
    return histogram.agg(F.array(*each).alias("a")).select(F.inline("a"))


def length_quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of the documents does not exceed."""
    each = [F.struct(F.lit(q).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("context_limit"))).alias("length")) for q in shares]
    return table.agg(F.array(*each).alias("a")).select(F.inline("a"))
