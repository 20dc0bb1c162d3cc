"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, pin

__all__ = ["WORD", "aside", "discard", "ensure_checkpoint_dir", "pin", "running_totals", "small", "small_batches", "stored"]

#: A table is broadcast only after it was counted and found to have no more rows, and in its texts, bytes and arrays no more items, than this.
BROADCAST_ROWS, BROADCAST_ITEMS = 100_000, 4 << 20
#: What the rule "word" means everywhere here: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows and BROADCAST_ITEMS items, unchanged otherwise.

    The caller pins ``df`` first if it is costly. Beyond the bound the join is
    a shuffle join, whose skewed partitions adaptive execution splits.
    """
    wide = [F.length(c) if t in ("string", "binary") else F.size(c) for c, t in df.dtypes if t in ("string", "binary") or t.startswith("array")]
    items = sum((F.coalesce(F.sum(x), F.lit(0)) for x in wide), F.lit(0))
    n, size = df.limit(rows + 1).agg(F.count("*"), items).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_ITEMS else df


#: Rows in a batch for a Python worker at most.
BATCH_ROWS = 1_024


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on rows in a batch for a Python worker to BATCH_ROWS.

    Spark builds batches outside the heap, in buffers that it doubles, and a
    worker gets them whole: 10,000 texts are tens of megabytes several times
    over for each task, and long-lived executors keep much of it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def running_totals(df: DataFrame, keys: list[str], order: str, values: dict[str, str], width: int) -> DataFrame:
    """Inclusive running sums of ``values`` (new name -> column) along the integer column ``order``.

    Two levels, so that no task sees a whole key: rows fall into buckets of
    ``width`` consecutive values of ``order``, buckets are summed and scanned,
    and each bucket's rows are scanned on their own. ``order`` is unique per key.
    """
    binned = df.withColumn("_bin", F.floor(F.col(order) / width).cast("long"))
    sums = binned.groupBy(*keys, "_bin").agg(*[F.sum(v).alias(f"_s_{k}") for k, v in values.items()])
    along = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bin", *[F.coalesce(F.sum(f"_s_{k}").over(along), F.lit(0)).alias(f"_o_{k}") for k in values])
    within = Window.partitionBy(*keys, "_bin").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = binned.join(offsets, [*keys, "_bin"])
    for k, v in values.items():
        joined = joined.withColumn(k, F.col(f"_o_{k}") + F.sum(v).over(within))
    return joined.drop("_bin", *[f"_o_{k}" for k in values])


def aside(df: DataFrame) -> DataFrame:
    """``df`` with its columns named ``_0``, ``_1``, ..., so that none clashes with a helper column; ``toDF`` names them back."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and read from there, so that later steps read only the columns they need."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    spark = table.sparkSession
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
