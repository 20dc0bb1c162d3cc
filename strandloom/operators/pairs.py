"""Phage-host pairs: metadata, structured and textual filters, sequences, paging and iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.guards import check_fragment, split_fragment
from ..functions.scalars import source_type
from ..session import pin
from ..sources.writers import write_table

Star = dict[str, DataFrame]
# The columns that structured filters may name.
PHAGE_FILTERS = ("Phage_ID", "Source_DB", "Length", "GC_content", "Taxonomy", "Completeness", "Host", "Lifestyle", "Cluster", "Subcluster", "source_type")
HOST_FILTERS = ("Host_ID", "Species_Name", "Strain_Name", "Assembly_Accession", "Assembly_Name", "Assembly_Level", "Genome_Length", "GC_Content", "RefSeq_Category", "Download_Date", "Source")
HOST_ALIASES = {"Organism_Name": "Species_Name"}
PAIR_COLUMNS = {
    "Phage_ID": "pha.Phage_ID", "Host_ID": "pha.Host_ID", "Phage_Source": "p.Source_DB", "Phage_Length": "p.Length", "Phage_GC": "p.GC_content",
    "Phage_Taxonomy": "p.Taxonomy", "Phage_Completeness": "p.Completeness", "Phage_Lifestyle": "p.Lifestyle", "Phage_Cluster": "p.Cluster",
    "Phage_Subcluster": "p.Subcluster", "Species_Name": "h.Species_Name", "Host_Assembly_Level": "h.Assembly_Level", "Host_Length": "h.Genome_Length",
    "Host_GC": "h.GC_Content", "Host_RefSeq_Category": "h.RefSeq_Category",
}


def apply_fragment(rows: DataFrame, fragment: str | None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows that meet a SQL filter fragment; an explicit limit beats the fragment's, and a limit needs an order to be repeatable."""
    conditions, own_limit, offset = split_fragment(check_fragment(fragment))
    out = rows.filter(F.expr(conditions)) if conditions else rows
    limit = own_limit if limit is None else limit
    if order and (limit is not None or offset):
        out = out.orderBy(*[F.asc_nulls_last(c) for c in order])
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)


def structured(alias: str, filters: dict | None, allowed: tuple[str, ...], aliases: dict[str, str] | None = None) -> list[Column]:
    """Conditions of column -> value: LIKE if the value has a percent sign, else equality without regard to case; ("ilike", pattern) is LIKE without regard to case. Values are bound, not spliced."""
    out = []
    for name, value in (filters or {}).items():
        real = (aliases or {}).get(name, name)
        if real not in allowed:
            raise ValueError(f"unknown filter column {name!r}; allowed: {', '.join(sorted(allowed))}")
        column = F.col(f"{alias}.{real}").cast("string")
        if isinstance(value, tuple) and value[0] == "ilike":
            out.append(column.ilike(str(value[1]).replace("\\", "\\\\")))
            continue
        text = str(value)
        out.append(column.like(text.replace("\\", "\\\\")) if "%" in text else F.lower(column) == F.lower(F.lit(text)))
    return out


def joined(star: Star, edges: DataFrame) -> DataFrame:
    """Edges with fact and hosts, under the aliases pha, p and h that filter fragments use.

    A phage id that the fact has more than once multiplies its pairs. The host
    table is left to adaptive execution, which broadcasts it if it is small.
    """
    p, h, pha = star["fact_phages"].alias("p"), star["dim_hosts"].alias("h"), edges.alias("pha")
    return pha.join(p, F.col("pha.Phage_ID") == F.col("p.Phage_ID")).join(h, F.col("pha.Host_ID") == F.col("h.Host_ID"))


def pair_metadata(star: Star, edges: DataFrame, fragment: str | None = None, phage_filters: dict | None = None, host_filters: dict | None = None, limit: int | None = None) -> DataFrame:
    """Distinct pairs with the metadata of both sides; filters apply before anything is deduplicated."""
    conditions, own_limit, offset = split_fragment(check_fragment(fragment))
    rows = joined(star, edges)
    if conditions:
        rows = rows.filter(F.expr(conditions))
    for c in structured("p", phage_filters, PHAGE_FILTERS) + structured("h", host_filters, HOST_FILTERS, HOST_ALIASES):
        rows = rows.filter(c)
    out = rows.select(*[F.col(c).alias(k) for k, c in PAIR_COLUMNS.items()], source_type(F.col("p.source_type")).alias("Phage_Source_Type")).distinct()
    limit = own_limit if limit is None else limit
    if limit is None and not offset:
        return out
    out = out.orderBy(*[F.asc_nulls_last(c) for c in ("Phage_ID", "Host_ID", "Phage_Source")])
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)


def pairs_with_sequences(pairs: DataFrame, phage_sequences: DataFrame, host_sequences: DataFrame) -> DataFrame:
    """Pairs that have both sequences; sequence tables are (id, sequence). Strings join last and are never deduplicated."""
    p = phage_sequences.select(F.col("id").alias("Phage_ID"), F.col("sequence").alias("Phage_Sequence"))
    h = host_sequences.select(F.col("id").alias("Host_ID"), F.col("sequence").alias("Host_Sequence"))
    return pairs.join(p, "Phage_ID").join(h, "Host_ID")


def missing_sequences(pairs: DataFrame, phage_sequences: DataFrame, host_sequences: DataFrame) -> DataFrame:
    """(side, id) of pairs' ids without a sequence."""
    sides = ((pairs.select(F.col("Phage_ID").alias("id")), phage_sequences, "phage"), (pairs.select(F.col("Host_ID").alias("id")), host_sequences, "host"))
    a, b = (ids.distinct().join(seqs.select("id"), "id", "left_anti").select(F.lit(side).alias("side"), "id") for ids, seqs, side in sides)
    return a.unionAll(b)


def interactions(star: Star, edges: DataFrame, kind: str | None = None, source: str | None = None) -> DataFrame:
    rows = edges.join(star["fact_phages"].select("Phage_ID", "Source_DB", source_type(F.col("source_type")).alias("source_type")), "Phage_ID").select("Phage_ID", "Host_ID", "Source_DB", "source_type")
    if kind is not None:
        rows = rows.filter(F.col("source_type") == kind)
    if source is not None:
        rows = rows.filter(F.col("Source_DB") == source)
    return rows.distinct()


def phages(star: Star, kind: str | None = None, source: str | None = None) -> DataFrame:
    rows = star["fact_phages"]
    if kind is not None:
        rows = rows.filter(source_type(F.col("source_type")) == kind)
    return rows.filter(F.col("Source_DB") == source) if source is not None else rows


def hosts_of_phage(star: Star, edges: DataFrame, phage_id: str) -> DataFrame:
    return star["dim_hosts"].join(edges.filter(F.col("Phage_ID") == phage_id).select("Host_ID").distinct(), "Host_ID", "left_semi")


def table_metadata(table: DataFrame, columns: list[str], fragment: str | None = None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    return apply_fragment(table, fragment, limit, order).select(*columns)


def missing_host_pairs(pairs: DataFrame, host_sequences: DataFrame) -> DataFrame:
    """The pairs, as ``pair_metadata`` gives them, whose host has no sequence or an empty one, with the reason."""
    have = host_sequences.select(F.col("id").alias("Host_ID"), (F.length("sequence") > 0).alias("_filled")).groupBy("Host_ID").agg(F.max("_filled").alias("_filled"))
    rows = pairs.join(have, "Host_ID", "left").filter(~F.coalesce("_filled", F.lit(False)))
    reason = F.when(F.col("_filled").isNull(), "no sequence").otherwise("empty sequence").alias("Failure_Reason")
    return rows.select("Phage_ID", "Host_ID", "Species_Name", "Phage_Source", "Phage_Length", "Phage_Taxonomy", "Host_Assembly_Level", reason)


def missing_hosts(edges: DataFrame, host_sequences: DataFrame) -> DataFrame:
    """Hosts without a sequence and how many pairs that costs."""
    return edges.join(host_sequences.select(F.col("id").alias("Host_ID")), "Host_ID", "left_anti").groupBy("Host_ID").agg(F.count("*").alias("n_pairs"), F.lit("no sequence").alias("Failure_Reason"))


def diagnose_empty(star: Star, edges: DataFrame, fragment: str | None) -> dict:
    """Why a filter leaves no pairs: edges in all, pairs that match, and the values there are."""
    conditions, _, _ = split_fragment(check_fragment(fragment))
    rows = joined(star, edges)
    matching = rows.filter(F.expr(conditions)) if conditions else rows
    values = lambda table, c: [r[0] for r in star[table].select(c).distinct().orderBy(F.asc_nulls_last(c)).limit(100).collect()]
    return {"edges": edges.count(), "matching": matching.count(), "Completeness": values("fact_phages", "Completeness"), "Assembly_Level": values("dim_hosts", "Assembly_Level")}


def batches(rows: DataFrame, size: int) -> Iterator[list[dict]]:
    """Lists of ``size`` rows as dicts, fetched partition by partition."""
    part: list[dict] = []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        part.append(row.asDict())
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def collate(part: list[dict]) -> dict[str, list]:
    """A list of dicts as a dict of lists, with the keys of the first."""
    return {k: [row.get(k) for row in part] for k in part[0]} if part else {}


def transformed(rows: DataFrame, transform: Callable[[dict], dict], schema: str) -> DataFrame:
    """User code on each sample, in Arrow batches on the executors; its output needs a declared schema."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([transform(r) for r in frame.to_dict("records")])

    return rows.mapInPandas(run, schema)


def streamed(pairs: DataFrame, phage_contigs: DataFrame, host_contigs: DataFrame) -> DataFrame:
    """Pairs with the first contig of each side in file order; pairs of which either is absent or empty are skipped.

    Contig tables are (genome_id, file_pos, contig_id, sequence).
    """
    first = lambda t: t.groupBy("genome_id").agg(F.min_by("sequence", F.struct("file_pos", "contig_id")).alias("sequence")).filter("sequence != ''").withColumnRenamed("genome_id", "id")
    return pairs_with_sequences(pairs, first(phage_contigs), first(host_contigs))


def indexed(pairs: DataFrame, phage_sequences: DataFrame, host_sequences: DataFrame, order: tuple[str, ...] = ("Phage_ID", "Host_ID")) -> DataFrame:
    """Pairs with ``idx`` and both sequences, empty ones and nulls included, for random access by ``idx``."""
    placed = dense_index(pairs, list(order))
    p = phage_sequences.select(F.col("id").alias("Phage_ID"), F.col("sequence").alias("Phage_Sequence"))
    h = host_sequences.select(F.col("id").alias("Host_ID"), F.col("sequence").alias("Host_Sequence"))
    return placed.join(p, "Phage_ID", "left").join(h, "Host_ID", "left")


def write_samples(samples: DataFrame, path: str) -> None:
    """``indexed`` samples, sorted by position, so that a span of positions is a few row groups."""
    write_table(samples, path, cluster_by="idx")


def shard_bounds(n: int, reader: int, readers: int) -> tuple[int, int]:
    """The positions from the first up to but without the second that are a reader's; sizes differ by one at most."""
    if not 0 <= reader < readers:
        raise ValueError(f"reader {reader} of {readers}")
    return reader * n // readers, (reader + 1) * n // readers


def shard(spark: SparkSession, path: str, reader: int = 0, readers: int = 1) -> DataFrame:
    """A reader's samples of a table of ``write_samples``, in order: shards are disjoint, and together they are all. The scan skips what is other readers'."""
    samples = spark.read.parquet(path)
    first, end = shard_bounds((samples.agg(F.max("idx")).first()[0] or -1) + 1 if not samples.isEmpty() else 0, reader, readers)
    return samples.filter((F.col("idx") >= first) & (F.col("idx") < end)).orderBy("idx")


def shard_batches(spark: SparkSession, path: str, size: int, reader: int = 0, readers: int = 1) -> Iterator[list[dict]]:
    """Lists of ``size`` samples of a reader's shard."""
    return batches(shard(spark, path, reader, readers), size)


def at_indexes(rows: DataFrame, wanted: list[int]) -> list[dict]:
    """The samples at some positions of ``indexed``, in the order asked for; a position beyond the end is an error."""
    found = {r["idx"]: r.asDict() for r in rows.filter(F.col("idx").isin(wanted)).collect()}
    if absent := [i for i in wanted if i not in found]:
        raise IndexError(f"no sample at {absent}")
    return [found[i] for i in wanted]


def dense_index(rows: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """0-based positions in a total order, without one task seeing all rows: positions inside each range of the sort plus the sizes of the ranges before it.

    The sorted rows are pinned, so that sizes and positions are of one deal of the ranges even if executors are lost.
    """
    placed = rows.orderBy(*[F.asc_nulls_last(c) for c in order]).withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")
    placed = pin(placed)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over a row per range
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
