"""Sinks: FASTA text, Parquet and CSV exports, manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fasta_text(header: Column, sequence: Column, width: int = 80) -> Column:
    """``>header`` and the sequence in lines of ``width``."""
    return F.concat(F.lit(">"), header, F.lit("\n"), F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n"))


def write_fasta(records: DataFrame, path: str, width: int = 80) -> None:
    """FASTA files of (id, sequence), with the whole header if there is one; null and empty sequences are left out."""
    head = F.col("header" if "header" in records.columns else "id")
    records.filter("sequence != ''").select(fasta_text(head, F.col("sequence"), width).alias("value")).write.mode("overwrite").text(path)


def write_table(rows: DataFrame, path: str, cluster_by: str | None = None, partition_by: list[str] | None = None) -> None:
    """Parquet, range-partitioned and sorted by the lookup column, so that point lookups skip files by their min and max."""
    if cluster_by:
        rows = rows.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """A catalog table dealt to buckets by ``key`` and sorted by it; tables of one key and number of buckets join and group by it without a shuffle."""
    rows.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return rows.sparkSession.table(table)


def write_star(star: dict[str, DataFrame], prefix: str, buckets: int = 200, key: str = "Phage_ID") -> dict[str, DataFrame]:
    """The star as catalog tables named ``prefix`` + name: those with the key in buckets, the others plain."""
    out = {}
    for name, rows in star.items():
        if key in rows.columns:
            out[name] = write_bucketed(rows, prefix + name, key, buckets)
        else:
            rows.write.mode("overwrite").saveAsTable(prefix + name)
            out[name] = rows.sparkSession.table(prefix + name)
    return out


def write_csv(rows: DataFrame, path: str, quote_all: bool = True) -> None:
    """CSV files with a header each. Without ``quote_all`` numbers are not quoted, and the header stands once, in the first file: joined in order, the files are one CSV file."""
    if not quote_all:
        text = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), '"', '""'), F.lit('"'))
        fields = [text(F.col(f"`{n}`")) if t == "string" else F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n, t in rows.dtypes]
        head = ",".join('"' + c.replace('"', '""') + '"' for c in rows.columns)
        first = rows.sparkSession.createDataFrame([(head,)], "value string").coalesce(1)
        first.unionAll(rows.select(F.concat_ws(",", *fields))).write.mode("overwrite").text(path)
        return
    rows.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def manifest_json(entries: list[dict]) -> str:
    return json.dumps(entries, indent=2, sort_keys=True)
