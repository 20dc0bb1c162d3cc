"""Contracts, drift, long and wide attributes, repairs."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import column_fingerprint, number
from ..schemas import Contract


@dataclass
class ColumnPlan:
    """What a contract makes of a file's columns."""

    columns: list[tuple[str, str | None]] = field(default_factory=list)  # (name, where it comes from; None: default)
    renamed: dict[str, str] = field(default_factory=dict)
    duplicates: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    added: list[str] = field(default_factory=list)
    unknown: list[str] = field(default_factory=list)

    @property
    def drifted(self) -> bool:
        return bool(self.renamed or self.duplicates or self.missing or self.added or self.unknown)


def plan_columns(columns: list[str], contract: Contract) -> ColumnPlan:
    """Names are stripped, repeated ones keep the first, aliases give way to the real name; unknown columns come last, sorted."""
    plan, sources = ColumnPlan(), {}
    for raw in columns:
        name = raw.strip()
        if name in sources:
            plan.duplicates.append(name)
        else:
            sources[name] = raw
    for alias, real in contract.aliases.items():
        if alias in sources and real not in sources:
            sources[real] = sources.pop(alias)
            plan.renamed[alias] = real
    plan.missing = [c for c in contract.required if c not in sources]
    plan.added = [c for c in contract.optional if c not in sources]
    known = (*contract.required, *contract.optional)
    plan.unknown = sorted(c for c in sources if c not in known)
    plan.columns = [(c, sources.get(c)) for c in known] + [(c, sources[c]) for c in plan.unknown]
    return plan


def normalize(rows: DataFrame, contract: Contract) -> DataFrame:
    """Rows in the contract's shape, numbers coerced; missing required columns are an error."""
    plan = plan_columns(rows.columns, contract)
    if plan.missing:
        raise ValueError(f"missing columns: {', '.join(plan.missing)}")

    def one(name: str, source: str | None) -> Column:
        c = F.lit(contract.defaults.get(name)).cast("string") if source is None else F.col(f"`{source}`")
        return (number(F.trim(c)) if name in contract.numeric else c).alias(name)

    return rows.select(*[one(name, source) for name, source in plan.columns])


def drift_report(columns: list[str], contract: Contract) -> dict:
    plan = plan_columns(columns, contract)
    return {"missing": plan.missing, "added": plan.added, "renamed": plan.renamed, "duplicates": plan.duplicates, "unknown": plan.unknown, "ok": not plan.missing}


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Columns by first appearance, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def insert_positional(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` with ``rows`` added by position, whatever their columns are called; the numbers of columns must agree."""
    if len(table.columns) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} columns for a table of {len(table.columns)}")
    return table.unionAll(rows)


def flatten(rows: DataFrame, column: str) -> DataFrame:
    """The fields of a struct column, or of each struct in an array column, as columns of their own."""
    kind = rows.schema[column].dataType.typeName()
    opened = rows.select(F.explode(column).alias(column)) if kind == "array" else rows
    return opened.select(f"{column}.*")


def register(frames: dict[str, DataFrame]) -> None:
    """Frames as relations that SQL can name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def melt(rows: DataFrame, ids: list[str], values: list[str] | None = None, key: str = "attribute_key", value: str = "attribute_value") -> DataFrame:
    """Wide to long; empty and null values are dropped."""
    values = [c for c in rows.columns if c not in ids] if values is None else values
    text = rows.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in values])
    return text.unpivot(ids, values, key, value).filter(F.col(value).isNotNull() & (F.col(value) != ""))


def pivot(rows: DataFrame, id_col: str, key: str, value: str, keys: list[str]) -> DataFrame:
    """Long to wide with the given keys; of several values the smallest, so that reruns agree."""
    return rows.groupBy(id_col).pivot(key, keys).agg(F.min(value))


def entity_attributes(interactions: DataFrame, extras: list[str]) -> DataFrame:
    """The private attribute table: one row per extra column of each interaction that has a value."""
    keyed = interactions.withColumn("entity_id", F.concat_ws("|", "Phage_ID", "Host_ID"))
    long = melt(keyed, ["Source_DB", "entity_id"], extras) if extras else keyed.limit(0).select("Source_DB", "entity_id", F.lit("").alias("attribute_key"), F.lit("").alias("attribute_value"))
    return long.select("Source_DB", F.lit("private").alias("source_type"), F.lit("interaction").alias("entity_type"), "entity_id", "attribute_key", "attribute_value", F.lit("string").alias("value_type"))


def split_entity(c: Column) -> tuple[Column, Column]:
    parts = F.split(c, r"\|", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key; later columns of ``order`` break ties. Tasks keep one row per key before the shuffle."""
    newest = rows.groupBy(*keys).agg(F.max(F.struct(*order, F.struct(*[c for c in rows.columns if c not in keys]).alias("_row"))).alias("_m"))
    return newest.select(*keys, "_m._row.*")


def repair_source_type(rows: DataFrame, private_keys: DataFrame, keys: list[str], column: str = "source_type") -> DataFrame:
    """Blank and ``nan`` types become private if the key is among the private ones, else public; other values stay."""
    blank = F.col(column).isNull() | (F.trim(column) == "") | (F.lower(F.trim(column)) == "nan")
    marked = rows.join(private_keys.select(*keys).distinct().withColumn("_p", F.lit(True)), keys, "left")
    return marked.withColumn(column, F.when(blank, F.when(F.col("_p"), "private").otherwise("public")).otherwise(F.col(column))).drop("_p").select(*rows.columns)


def fingerprint_drift(manifest: DataFrame) -> DataFrame:
    """Successful downloads whose column fingerprint differs from the one before of the same (feature, source)."""
    order = Window.partitionBy("feature", "source_key").orderBy("retrieved_at")
    ok = manifest.filter("status = 'success'").withColumn("previous", F.lag("schema_fingerprint").over(order))
    return ok.filter(F.col("previous").isNotNull() & (F.col("previous") != F.col("schema_fingerprint")))


def schema_fingerprint(rows: DataFrame) -> Column:
    return column_fingerprint(F.array(*[F.lit(c) for c in rows.columns]))


def replace_sources(table: DataFrame, rows: DataFrame, sources: list[str]) -> DataFrame:
    """The table without the private rows of some sources, and with the new rows."""
    kept = table.filter(~((F.col("source_type") == "private") & F.col("Source_DB").isin(sources)) | F.col("source_type").isNull())
    return kept.unionByName(rows, allowMissingColumns=True)
