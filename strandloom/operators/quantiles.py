"""Exact quantiles without a task that holds all values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin


def exact_quantiles(rows: DataFrame, columns: list[str], shares: list[float], by: list[str] | None = None) -> DataFrame:
    """(*by, column_name, share, value): exact quantiles of number columns, interpolated between the two nearest ranks.

    Equal values are counted first, so a frequent one is one row. The distinct
    values are sorted in ranges; each knows how many values lie below it in its
    range, and the ranges' sums tell how many lie in those before. Nulls take no
    part; a column without values has no rows.
    """
    by = by or []
    groups = [f"_g{i}" for i in range(len(by))]
    keys = [*groups, "column_name"]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]))
    long = rows.select(*[F.col(f"`{b}`").alias(g) for b, g in zip(by, groups, strict=True)], each.alias("_v")).select(*groups, "_v.*").filter("value IS NOT NULL")
    counted = long.groupBy(*keys, "value").agg(F.count("*").alias("_n"))
    placed = counted.repartitionByRange(*keys, "value").sortWithinPartitions(*keys, "value").withColumn("_range", F.spark_partition_id())
    placed = pin(placed)
    sums = placed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_sum"))
    along = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(*keys, "_range", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_ahead"), F.sum("_sum").over(Window.partitionBy(*keys)).alias("_total"))
    within = Window.partitionBy(*keys, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_upto", F.sum("_n").over(within))
    same = [summed[k].eqNullSafe(ahead[k]) for k in groups] + [summed[k] == ahead[k] for k in ("column_name", "_range")]
    ranked = summed.join(ahead, same).select(*[summed[k] for k in keys], "value", (F.col("_ahead") + F.col("_upto")).alias("_end"), "_n", "_total")
    wanted = ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).withColumn("_at", (F.col("_total") - 1) * F.col("share"))
    holds = lambda rank: (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))
    low, high = F.floor("_at"), F.ceil("_at")
    near = wanted.filter(holds(low) | holds(high)).groupBy(*keys, "share").agg(F.max(F.when(holds(low), F.col("value"))).alias("_low"), F.max(F.when(holds(high), F.col("value"))).alias("_high"), F.max(F.col("_at") - low).alias("_part"))
    value = F.when(F.col("_part") == 0, F.col("_low")).otherwise(F.col("_low") * (1 - F.col("_part")) + F.col("_high") * F.col("_part"))
    return near.select(*[F.col(g).alias(b) for b, g in zip(by, groups, strict=True)], "column_name", "share", value.alias("value"))


def one_row(found: DataFrame, names: dict[tuple[str, float], str]) -> DataFrame:
    """Quantiles of a whole table as one row; a quantile that is not there is null. ``names`` maps (column, share) to a name."""
    pick = lambda c, s: F.max(F.when((F.col("column_name") == c) & (F.col("share") == s), F.col("value")))
    return found.agg(*[pick(c, s).alias(n) for (c, s), n in names.items()])
