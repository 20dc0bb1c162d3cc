"""One place for the session settings that the results depend on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "strandloom", **more: str) -> SparkSession:
    """A session with SETTINGS; where it runs and how many shuffle partitions it has is up to the caller."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; where it is unset, a local run makes its own and a cluster is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="strandloom-checkpoint-"))


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder once and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
