"""The analytical views of the star, each a function from tables to a lazy DataFrame.

``star`` maps table names to DataFrames. Views over several dimensions first
reduce each dimension to one row per phage, so their joins never multiply rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import size_class

Star = dict[str, DataFrame]
EVIDENCE = {4: "Very High", 3: "High", 2: "Medium", 1: "Low"}


def pct(part: Column, whole: Column) -> Column:
    """Share in percent as a double, 2 digits."""
    return F.round(part.cast("double") * 100.0 / whole.cast("double"), 2)


def per_phage(dim: DataFrame, **aggregates: Column) -> DataFrame:
    return dim.groupBy("Phage_ID").agg(*[c.alias(k) for k, c in aggregates.items()])


def profile(fact: DataFrame, keys: list[str], parts: list[DataFrame], counts: list[str]) -> DataFrame:
    """Distinct fact keys with the reduced dimensions beside them; missing counts are 0."""
    base = fact.select("Phage_ID", *keys).distinct()
    joined = reduce(lambda a, b: a.join(b, "Phage_ID", "left"), parts, base)
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def phage_summary(star: Star) -> DataFrame:
    known = star["fact_phages"].filter("Length IS NOT NULL AND GC_content IS NOT NULL")
    return known.groupBy("Source_DB").agg(
        F.count("*").alias("total_phages"), F.avg("Length").alias("avg_length"), F.min("Length").alias("min_length"), F.max("Length").alias("max_length"), F.avg("GC_content").alias("avg_gc_content")
    )


def size_distribution(star: Star) -> DataFrame:
    known = star["fact_phages"].filter("Length IS NOT NULL")
    return known.groupBy("Source_DB", size_class(F.col("Length")).alias("size_category")).agg(F.count("*").alias("count"), F.avg("Length").alias("avg_length"))


def complete_profile(star: Star) -> DataFrame:
    counted = {
        "protein_count": ("dim_proteins", "Protein_ID"),
        "terminator_types": ("dim_terminators", "terminator_type"),
        "anti_crispr_count": ("dim_anti_crispr", "Protein_ID"),
        "virulent_factor_count": ("dim_virulent_factors", "Protein_ID"),
        "transmembrane_protein_count": ("dim_transmembrane_proteins", "Protein_ID"),
        "trna_tmrna_count": ("dim_trna_tmrna", "trna_tmrna_id"),
        "amr_gene_count": ("dim_antimicrobial_resistance_genes", "Protein_ID"),
    }
    parts = [per_phage(star[t], **{k: F.countDistinct(c)}) for k, (t, c) in counted.items()]
    parts.append(per_phage(star["dim_crispr_arrays"], crispr_array_count=F.countDistinct("crispr_id"), avg_spacers_per_array=F.avg("spacers_count"), max_crispr_evidence=F.max("evidence_level")))
    return profile(star["fact_phages"], ["Source_DB", "Length", "GC_content", "Host", "Lifestyle"], parts, [*counted, "crispr_array_count"])


def _with_phages_of_source(rows: DataFrame, star: Star, covered: str, share: str) -> DataFrame:
    totals = star["fact_phages"].groupBy("Source_DB").agg(F.countDistinct("Phage_ID").alias("_total"))
    return rows.join(totals, "Source_DB", "left").withColumn(share, pct(F.col(covered), F.col("_total"))).drop("_total")


def amr_summary(star: Star) -> DataFrame:
    rows = star["dim_antimicrobial_resistance_genes"].groupBy("Source_DB").agg(
        F.countDistinct("Phage_ID").alias("phages_with_amr"), F.countDistinct("Protein_ID").alias("total_amr_proteins"), F.countDistinct("aligned_protein_card").alias("unique_card_matches")
    )
    return _with_phages_of_source(rows, star, "phages_with_amr", "percentage_phages_with_amr")


def crispr_summary(star: Star) -> DataFrame:
    rows = star["dim_crispr_arrays"].filter("crispr_length IS NOT NULL").groupBy("Source_DB").agg(
        F.countDistinct("Phage_ID").alias("phages_with_crispr"),
        F.countDistinct("crispr_id").alias("total_crispr_arrays"),
        F.avg("crispr_length").alias("avg_array_length"),
        F.avg("spacers_count").alias("avg_spacers_per_array"),
        F.avg("repeat_length").alias("avg_repeat_length"),
        F.avg("mean_spacer_size").alias("avg_spacer_size"),
        F.avg("conservation_repeats_pct").alias("avg_repeat_conservation"),
    )
    return _with_phages_of_source(rows, star, "phages_with_crispr", "percentage_phages_with_crispr")


def evidence_distribution(star: Star) -> DataFrame:
    label = reduce(lambda acc, kv: acc.when(F.col("evidence_level") == kv[0], kv[1]), EVIDENCE.items(), F.when(F.lit(False), "")).otherwise("Unknown")
    known = star["dim_crispr_arrays"].filter("evidence_level IS NOT NULL")
    return known.groupBy("evidence_level", label.alias("evidence_category")).agg(
        F.count("*").alias("array_count"), F.avg("spacers_count").alias("avg_spacers"), F.avg("crispr_length").alias("avg_length"), F.avg("conservation_repeats_pct").alias("avg_conservation")
    )


def defense_profile(star: Star) -> DataFrame:
    parts = [
        per_phage(star["dim_crispr_arrays"], crispr_arrays=F.countDistinct("crispr_id"), max_crispr_evidence=F.max("evidence_level")),
        per_phage(star["dim_anti_crispr"], anti_crispr_proteins=F.countDistinct("Protein_ID")),
        per_phage(star["dim_antimicrobial_resistance_genes"], amr_genes=F.countDistinct("Protein_ID")),
    ]
    rows = profile(star["fact_phages"], ["Source_DB", "Host", "Lifestyle"], parts, ["crispr_arrays", "anti_crispr_proteins", "amr_genes"])
    crispr, anti, amr = (F.col(c) > 0 for c in ("crispr_arrays", "anti_crispr_proteins", "amr_genes"))
    category = F.when(crispr & anti, "CRISPR + Anti-CRISPR").when(crispr, "CRISPR only").when(anti, "Anti-CRISPR only").when(amr, "AMR only").otherwise("None detected")
    return rows.withColumn("defense_category", category)


def _hosts_of_phages(star: Star) -> DataFrame:
    return star["fact_phages"].filter("Host IS NOT NULL AND Host != '-'").select("Phage_ID", "Host", "Source_DB")


def host_amr_profile(star: Star, more_than: int = 10) -> DataFrame:
    hits = star["dim_antimicrobial_resistance_genes"].filter("Phage_ID IS NOT NULL").select("Phage_ID", F.col("Phage_ID").alias("_with"), "Protein_ID")
    rows = _hosts_of_phages(star).join(hits, "Phage_ID", "left").groupBy("Host", "Source_DB").agg(
        F.countDistinct("Phage_ID").alias("total_phages"), F.countDistinct("_with").alias("phages_with_amr"), F.countDistinct("Protein_ID").alias("total_amr_genes")
    )
    return rows.filter(F.col("total_phages") > more_than).withColumn("amr_prevalence_pct", pct(F.col("phages_with_amr"), F.col("total_phages")))


def host_crispr_profile(star: Star, more_than: int = 10) -> DataFrame:
    arrays = star["dim_crispr_arrays"].select("Phage_ID", F.col("Phage_ID").alias("_with"), "spacers_count", "conservation_repeats_pct")
    rows = _hosts_of_phages(star).join(arrays, "Phage_ID", "left").groupBy("Host", "Source_DB").agg(
        F.countDistinct("Phage_ID").alias("total_phages"),
        F.countDistinct("_with").alias("phages_with_crispr"),
        F.avg("spacers_count").alias("avg_spacers"),
        F.max("spacers_count").alias("max_spacers"),
        F.avg("conservation_repeats_pct").alias("avg_repeat_conservation"),
    )
    return rows.filter(F.col("total_phages") > more_than).withColumn("crispr_prevalence_pct", pct(F.col("phages_with_crispr"), F.col("total_phages")))


def prefix_join(left: DataFrame, value: str, right: DataFrame, prefix: str) -> DataFrame:
    """Pairs whose ``value`` starts with ``prefix``.

    An equi-join instead of a nested loop: each value meets the prefixes of the
    lengths that occur among them (a handful of distinct numbers), cut to that
    length.
    """
    lengths = [r[0] for r in right.select(F.length(prefix)).filter(F.col(prefix).isNotNull()).distinct().collect()]
    if not lengths:
        return left.join(right, F.lit(False))
    cuts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length(value))
    cut = left.withColumn("_cut", F.explode(F.transform(cuts, lambda n: F.substring(F.col(value), F.lit(1), n))))
    return cut.join(right, cut["_cut"] == right[prefix]).drop("_cut")


def phage_host_genomes(star: Star) -> DataFrame:
    hosts = star["dim_hosts"].select(
        "Host_ID", "Species_Name", "Strain_Name", "Assembly_Accession", F.col("Genome_Length").alias("Host_Genome_Length"), F.col("GC_Content").alias("Host_GC_Content")
    )
    phages = star["fact_phages"].filter("Host IS NOT NULL AND Host != '-'").select(
        "Phage_ID", F.col("Host").alias("Host_Name"), F.col("Length").alias("Phage_Length"), F.col("GC_content").alias("Phage_GC_Content"), "Source_DB"
    )
    # Prefixes are few distinct species; the genomes of a species join after that.
    species = prefix_join(phages.select("Host_Name").distinct(), "Host_Name", hosts.select(F.col("Species_Name").alias("_species")).distinct(), "_species")
    return phages.join(species, "Host_Name").join(hosts, F.col("_species") == hosts["Species_Name"]).drop("_species")


def host_genome_summary(star: Star) -> DataFrame:
    return star["dim_hosts"].groupBy("Species_Name", "Assembly_Level", "RefSeq_Category").agg(F.count("*").alias("genome_count"), F.avg("Genome_Length").alias("avg_genome_length"), F.avg("GC_Content").alias("avg_gc_content"))


def phage_host_associations(star: Star) -> DataFrame:
    """Distinct (Phage_ID, Host_ID) from public links and private edges, whichever tables there are."""
    if "dim_hosts" not in star:
        raise KeyError("dim_hosts")
    hosts, parts = star["dim_hosts"], []
    if "dim_phage_host_links" in star:
        parts.append(star["dim_phage_host_links"].join(hosts.select("Assembly_Accession", "Host_ID"), "Assembly_Accession").select("Phage_ID", "Host_ID").filter("Phage_ID IS NOT NULL AND Host_ID IS NOT NULL"))
    if "private_phage_host_associations" in star:
        parts.append(star["private_phage_host_associations"].select("Phage_ID", "Host_ID"))
    if not parts:
        return hosts.sparkSession.createDataFrame([], "Phage_ID string, Host_ID string")
    return reduce(DataFrame.union, parts).distinct()


def large_phage_profile(star: Star, longer_than: int = 50_000, top: int = 100) -> DataFrame:
    """The longest phages with their counts; only they are joined with the dimensions."""
    keys = ["Source_DB", "Length", "GC_content", "Host", "Lifestyle"]
    longest = star["fact_phages"].filter(F.col("Length") > longer_than).select("Phage_ID", *keys).distinct().orderBy(F.desc("Length"), "Phage_ID", "Source_DB", "GC_content").limit(top)
    chosen = longest.select("Phage_ID").distinct()
    counted = {
        "terminator_types": ("dim_terminators", "terminator_type"),
        "anti_crispr_count": ("dim_anti_crispr", "Protein_ID"),
        "virulent_factor_count": ("dim_virulent_factors", "Protein_ID"),
        "transmembrane_count": ("dim_transmembrane_proteins", "Protein_ID"),
        "trna_count": ("dim_trna_tmrna", "trna_tmrna_id"),
    }
    of = lambda t: star[t].join(F.broadcast(chosen), "Phage_ID", "left_semi")  # noqa: E731  at most ``top`` ids
    parts = [per_phage(of("dim_proteins"), protein_count=F.countDistinct("Protein_ID"), avg_protein_mw=F.avg("Molecular_weight"))]
    parts += [per_phage(of(t), **{k: F.countDistinct(c)}) for k, (t, c) in counted.items()]
    return profile(longest, keys, parts, ["protein_count", *counted])


def share_of_total(rows: DataFrame, key: str) -> DataFrame:
    """Counts of a column and their share; the window only sees the aggregate."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2))


def dimension_stats(dims: dict[str, DataFrame]) -> DataFrame:
    """(dimension, n_rows, n_phages, rows_per_phage) of each dimension."""
    parts = [d.agg(F.count("*").alias("n_rows"), F.countDistinct("Phage_ID").alias("n_phages")).select(F.lit(name).alias("dimension"), "*") for name, d in dims.items()]
    return reduce(DataFrame.unionAll, parts).withColumn("rows_per_phage", F.round(F.try_divide("n_rows", "n_phages"), 4))


def top_by_phages(rows: DataFrame, column: str, top: int = 20) -> DataFrame:
    """The values of ``column`` with the most rows, and their distinct phages; ties by value."""
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.countDistinct("Phage_ID").alias("n_phages"))
    return counted.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(top)


ALL = {
    f.__name__: f
    for f in (phage_summary, size_distribution, complete_profile, amr_summary, crispr_summary, evidence_distribution, defense_profile, host_amr_profile, host_crispr_profile, phage_host_genomes, host_genome_summary, phage_host_associations)
}
