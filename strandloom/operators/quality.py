"""Profiles and integrity checks of the star tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DIMENSIONS
from .quantiles import exact_quantiles, one_row
from .views import share_of_total

KEYS = {
    "fact_phages": ["Phage_ID"],
    "dim_proteins": ["Protein_ID"],
    "dim_terminators": ["Phage_ID", "terminator_type", "terminator_start", "terminator_end"],
    "dim_anti_crispr": ["Protein_ID"],
    "dim_virulent_factors": ["Protein_ID"],
    "dim_transmembrane_proteins": ["Protein_ID"],
    "dim_trna_tmrna": ["trna_tmrna_id"],
    "dim_antimicrobial_resistance_genes": ["Protein_ID"],
    "dim_crispr_arrays": ["crispr_id"],
    "dim_hosts": ["Host_ID"],
}


def null_profile(table: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_nulls) of every column in one pass."""
    one = table.agg(F.count("*").alias("_n"), *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"_{i}") for i, c in enumerate(table.columns)])
    each = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.coalesce(F.col(f"_{i}"), F.lit(0)).alias("n_nulls")) for i, c in enumerate(table.columns)]
    return one.select(F.inline(F.array(*each)))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type, n_rows, n_nulls) of every column of some tables, one pass over each."""
    def one(name: str, table: DataFrame) -> DataFrame:
        types = F.create_map(*[F.lit(x) for pair in table.dtypes for x in pair])
        return null_profile(table).select(F.lit(name).alias("table_name"), "column_name", types[F.col("column_name")].alias("data_type"), "n_rows", "n_nulls")

    return reduce(DataFrame.unionAll, [one(n, t) for n, t in tables.items()])


def failed(rows: DataFrame, column: str = "status", good: tuple[str, ...] = ("success",)) -> DataFrame:
    """Rows whose status is not a good one; null and blank count as ``unknown``."""
    return rows.filter(~F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit("unknown")).isin(*good))


def type_breakdown(fact: DataFrame) -> DataFrame:
    """(source_type, Source_DB, n) of the phages, most of each type first."""
    return fact.groupBy("source_type", "Source_DB").agg(F.count("*").alias("n")).orderBy("source_type", F.desc("n"), "Source_DB")


def link_stats(links: DataFrame) -> DataFrame:
    """(total_links, unique_phages, unique_host_assemblies)."""
    return links.agg(F.count("*").alias("total_links"), F.countDistinct("Phage_ID").alias("unique_phages"), F.countDistinct("Assembly_Accession").alias("unique_host_assemblies"))


def protein_stats(proteins: DataFrame) -> DataFrame:
    """Per source, of proteins with a known weight: how many, phages, proteins a phage, and mean weight and isoelectric point."""
    known = proteins.filter("Molecular_weight IS NOT NULL").groupBy("Source_DB")
    out = known.agg(F.count("*").alias("protein_count"), F.countDistinct("Phage_ID").alias("phage_count"), F.avg("Molecular_weight").alias("avg_mw"), F.avg("Isoelectric_point").alias("avg_pi"))
    return out.withColumn("proteins_per_phage", F.col("protein_count") / F.col("phage_count")).orderBy(F.desc("protein_count"), "Source_DB")


def typed_stats(table: DataFrame, kind: str, mean: str, top: int | None = None) -> DataFrame:
    """Per value of ``kind`` (null left out): rows, phages and the mean of a column, most first; for tRNA types, helices and the like."""
    rows = table.filter(F.col(kind).isNotNull()).groupBy(kind).agg(F.count("*").alias("n"), F.countDistinct("Phage_ID").alias("unique_phages"), F.avg(mean).alias(f"avg_{mean}")).orderBy(F.desc("n"), kind)
    return rows.limit(top) if top else rows


def described(rows: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the numeric columns, a row per column; quartiles are exact and made without gathering a column."""
    numeric = [n for n, t in rows.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]

    def one(i: int, name: str):
        c = F.col(f"`{name}`").cast("double")
        return F.struct(F.lit(name).alias("column_name"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max")).alias(f"_{i}")

    facts = rows.agg(*[one(i, n) for i, n in enumerate(numeric)]).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(numeric))])))
    at = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    found = exact_quantiles(rows, numeric, list(at)).groupBy("column_name").agg(*[F.max(F.when(F.col("share") == q, F.col("value"))).alias(n) for q, n in at.items()])
    return facts.join(found, "column_name", "left").select("column_name", "n", "mean", "stddev", "min", *at.values(), "max")


def duplicate_keys(table: DataFrame, keys: list[str], skip_null: bool = True) -> DataFrame:
    """(n_duplicate_keys, n_extra_rows): how many keys occur more than once, and how many rows that is too many."""
    rows = table.dropna(subset=keys) if skip_null else table
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("n_duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra_rows"))


def orphans(dim: DataFrame, fact: DataFrame, key: str = "Phage_ID") -> DataFrame:
    """Rows of ``dim`` whose key the fact does not have; a null key is an orphan."""
    return dim.join(fact.select(key).distinct(), key, "left_anti")


def distribution(table: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n) most frequent first; ties by value, nulls last."""
    rows = table.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return rows.limit(top) if top else rows


def number_stats(table: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    facts = table.agg(F.count("*").alias("n_rows"), F.count(c).alias("n_known"), F.min(c).alias("min_value"), F.max(c).alias("max_value"), F.avg(c).alias("avg_value"))
    return facts.join(one_row(exact_quantiles(table, [column], [0.5]), {(column, 0.5): "median_value"}))  # two tables of one row


def mean_and_median(rows: DataFrame, group: str, column: str) -> DataFrame:
    """(group, mean, median) of a column; the median is exact and no group is gathered."""
    means = rows.groupBy(group).agg(F.avg(column).alias("mean"))
    medians = exact_quantiles(rows, [column], [0.5], [group]).select(F.col(group).alias("_g"), F.col("value").alias("median"))
    return means.join(medians, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def pair_correlation(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pearson's correlation of two columns as one row."""
    return pairs.agg(F.corr(left, right).alias("corr"))


def first_of_digest(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, first_id): the smallest id with the same text, by MD5; texts do not travel. Null texts are alike."""
    digested = rows.select(id_col, F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("")).alias("_h"))
    return digested.join(digested.groupBy("_h").agg(F.min(id_col).alias("first_id")), "_h").drop("_h")


def association_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(association, n): rows of ``left`` with and without any row of ``right``; a kind without rows is left out."""
    marked = left.select(key).join(right.select(key).distinct().withColumn("_f", F.lit(True)), key, "left")
    return marked.groupBy(F.when(F.col("_f"), "with").otherwise("without").alias("association")).agg(F.count("*").alias("n"))


def broad_host_range(edges: DataFrame, phage: str = "Phage_ID", host: str = "Host_ID") -> DataFrame:
    """(n_hosts, n_phages, pct, broad): how many phages have how many distinct hosts."""
    ranges = edges.groupBy(phage).agg(F.countDistinct(host).alias("n_hosts"))
    return share_of_total(ranges, "n_hosts").withColumnRenamed("n", "n_phages").withColumn("broad", F.col("n_hosts") > 1)


def coverage_sketches(tables: dict[str, DataFrame], source: str = "Source_DB", key: str = "Phage_ID", lg_k: int = 14) -> DataFrame:
    """(annotation, source, sketch) of the distinct keys of each table and source: mergeable, so that a new source is added to those stored without another scan."""
    parts = [t.groupBy(F.col(source).alias("source")).agg(F.hll_sketch_agg(key, lg_k).alias("sketch")).select(F.lit(name).alias("annotation"), "source", "sketch") for name, t in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def sketched_coverage(sketches: DataFrame, total: str) -> DataFrame:
    """(annotation, n_phages, pct), approximate, over all sources of stored sketches; ``total`` is the annotation that counts as all."""
    merged = sketches.groupBy("annotation").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_phages"))
    whole = merged.filter(F.col("annotation") == total).select(F.col("n_phages").alias("_total"))
    return merged.filter(F.col("annotation") != total).join(F.broadcast(whole)).select("annotation", "n_phages", F.round(F.col("n_phages") * 100.0 / F.col("_total"), 2).alias("pct"))


def quality_gate(star: dict[str, DataFrame]) -> DataFrame:
    """(check_name, n_bad, passed) of the gating checks: no repeated fact key, no orphans in any dimension."""
    fact = star["fact_phages"]
    checks = [duplicate_keys(fact, KEYS["fact_phages"], skip_null=False).select(F.lit("fact_phages duplicates").alias("check_name"), F.col("n_duplicate_keys").alias("n_bad"))]
    checks += [orphans(star[t], fact).agg(F.count("*").alias("n_bad")).select(F.lit(f"{t} orphans").alias("check_name"), "n_bad") for t in DIMENSIONS if t in star]
    return reduce(DataFrame.unionAll, checks).withColumn("passed", F.col("n_bad") == 0)


def gate_passes(star: dict[str, DataFrame]) -> bool:
    return quality_gate(star).filter("NOT passed").limit(1).count() == 0


def coverage(fact: DataFrame, dims: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """(annotation, n_phages, pct) of phages that each dimension covers."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    total = fact.agg(distinct("Phage_ID").alias("_total"))
    parts = [d.agg(distinct("Phage_ID").alias("n_phages")).select(F.lit(name).alias("annotation"), "n_phages") for name, d in dims.items()]
    return reduce(DataFrame.unionAll, parts).join(F.broadcast(total)).select("annotation", "n_phages", F.round(F.col("n_phages") * 100.0 / F.col("_total"), 2).alias("pct"))


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [t.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("entity"), "n_rows") for name, t in tables.items()])


def id_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, n_ids): ids in both, only left, only right."""
    a = left.select(key).dropna().distinct().withColumn("_l", F.lit(1))
    b = right.select(key).dropna().distinct().withColumn("_r", F.lit(1))
    side = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both").when(F.col("_r").isNull(), "left only").otherwise("right only")
    return a.join(b, key, "full").groupBy(side.alias("side")).agg(F.count("*").alias("n_ids"))


def match_rate(rows: DataFrame, found: DataFrame, key: str, group: str) -> DataFrame:
    """Per group: rows, found, missing and the share found."""
    marked = rows.join(found.select(key).distinct().withColumn("_f", F.lit(1)), key, "left")
    out = marked.groupBy(group).agg(F.count("*").alias("total"), F.count("_f").alias("found"))
    return out.withColumn("missing", F.col("total") - F.col("found")).withColumn("match_pct", F.round(F.col("found") * 100.0 / F.col("total"), 2))


def mismatches(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Ids only on the left and only on the right."""
    return (a.select(key).distinct().join(b.select(key), key, "left_anti") for a, b in ((left, right), (right, left)))


def id_census(ids: DataFrame, column: str, shapes: dict[str, str]) -> DataFrame:
    """(shape, n_ids, pct) for each pattern, in one pass."""
    one = ids.agg(F.count("*").alias("_n"), *[F.coalesce(F.sum(F.col(column).rlike(p).cast("long")), F.lit(0)).alias(f"_{i}") for i, p in enumerate(shapes.values())])
    each = [F.struct(F.lit(name).alias("shape"), F.col(f"_{i}").alias("n_ids"), F.when(F.col("_n") > 0, F.round(F.col(f"_{i}") * 100.0 / F.col("_n"), 2)).otherwise(0.0).alias("pct")) for i, name in enumerate(shapes)]
    return one.select(F.inline(F.array(*each)))


def failure_report(rows: DataFrame, category: str, item: str) -> DataFrame:
    """Failures by category: how many, and the first and last item; most frequent first."""
    return rows.groupBy(category).agg(F.count("*").alias("n_failures"), F.min(item).alias("first_item"), F.max(item).alias("last_item")).orderBy(F.desc("n_failures"), category)
