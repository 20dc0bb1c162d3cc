"""Registered queries over the test tables, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import features, negatives, pairs, quality, reshape, resolve, sequences, views
from ..sources.writers import fasta_text
from ..streaming import windows
from .adapters import STAR_SQL, contigs, edges, records, star, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, base: str = ""):
    """Register a function under its name, with the oracle ``base`` + ``sql``."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = base + sql
        return f

    return register


def on_star(sql: str):
    return query(sql, STAR_SQL)


def tidy(rows: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return rows.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])


# Views of the star.


@on_star("SELECT Source_DB, COUNT(*) AS total_phages, ROUND(AVG(Length), 4) AS avg_length, MIN(Length) AS min_length, MAX(Length) AS max_length, ROUND(AVG(GC_content), 4) AS avg_gc_content FROM fact_phages WHERE Length IS NOT NULL AND GC_content IS NOT NULL GROUP BY Source_DB")
def source_summary(spark, sf_dir):
    return tidy(views.phage_summary(star(spark, sf_dir)))


@on_star("SELECT Source_DB, CASE WHEN Length < 10000 THEN 'Small (<10kb)' WHEN Length < 100000 THEN 'Medium (10-100kb)' ELSE 'Large (>100kb)' END AS size_category, COUNT(*) AS count, ROUND(AVG(Length), 4) AS avg_length FROM fact_phages GROUP BY 1, 2")
def size_distribution(spark, sf_dir):
    return tidy(views.size_distribution(star(spark, sf_dir)))


PER_PHAGE = """,
p AS (SELECT Phage_ID, COUNT(DISTINCT Protein_ID) AS n, AVG(Molecular_weight) AS mw FROM dim_proteins GROUP BY 1),
t AS (SELECT Phage_ID, COUNT(DISTINCT terminator_type) AS n FROM dim_terminators GROUP BY 1),
a AS (SELECT Phage_ID, COUNT(DISTINCT Protein_ID) AS n FROM dim_anti_crispr GROUP BY 1),
v AS (SELECT Phage_ID, COUNT(DISTINCT Protein_ID) AS n FROM dim_virulent_factors GROUP BY 1),
tm AS (SELECT Phage_ID, COUNT(DISTINCT Protein_ID) AS n FROM dim_transmembrane_proteins GROUP BY 1),
tr AS (SELECT Phage_ID, COUNT(DISTINCT trna_tmrna_id) AS n FROM dim_trna_tmrna GROUP BY 1),
amr AS (SELECT Phage_ID, COUNT(DISTINCT Protein_ID) AS n FROM dim_antimicrobial_resistance_genes GROUP BY 1),
cr AS (SELECT Phage_ID, COUNT(DISTINCT crispr_id) AS n, AVG(spacers_count) AS s, MAX(evidence_level) AS e FROM dim_crispr_arrays GROUP BY 1)
"""


@on_star(PER_PHAGE + """SELECT f.Phage_ID, f.Source_DB, f.Length, f.GC_content, f.Host, f.Lifestyle, COALESCE(p.n, 0) AS protein_count, COALESCE(t.n, 0) AS terminator_types, COALESCE(a.n, 0) AS anti_crispr_count,
COALESCE(v.n, 0) AS virulent_factor_count, COALESCE(tm.n, 0) AS transmembrane_protein_count, COALESCE(tr.n, 0) AS trna_tmrna_count, COALESCE(amr.n, 0) AS amr_gene_count, COALESCE(cr.n, 0) AS crispr_array_count,
ROUND(cr.s, 4) AS avg_spacers_per_array, cr.e AS max_crispr_evidence FROM (SELECT DISTINCT Phage_ID, Source_DB, Length, GC_content, Host, Lifestyle FROM fact_phages) f
LEFT JOIN p USING (Phage_ID) LEFT JOIN t USING (Phage_ID) LEFT JOIN a USING (Phage_ID) LEFT JOIN v USING (Phage_ID) LEFT JOIN tm USING (Phage_ID) LEFT JOIN tr USING (Phage_ID) LEFT JOIN amr USING (Phage_ID) LEFT JOIN cr USING (Phage_ID)""")
def complete_profile(spark, sf_dir):
    return tidy(views.complete_profile(star(spark, sf_dir)))


@on_star(PER_PHAGE + """SELECT f.Phage_ID, f.Source_DB, f.Length, f.GC_content, f.Host, f.Lifestyle, COALESCE(p.n, 0) AS protein_count, ROUND(p.mw, 8) AS avg_protein_mw, COALESCE(t.n, 0) AS terminator_types,
COALESCE(a.n, 0) AS anti_crispr_count, COALESCE(v.n, 0) AS virulent_factor_count, COALESCE(tm.n, 0) AS transmembrane_count, COALESCE(tr.n, 0) AS trna_count
FROM (SELECT DISTINCT Phage_ID, Source_DB, Length, GC_content, Host, Lifestyle FROM fact_phages WHERE Length > 50000 ORDER BY Length DESC, Phage_ID, Source_DB, GC_content LIMIT 100) f
LEFT JOIN p USING (Phage_ID) LEFT JOIN t USING (Phage_ID) LEFT JOIN a USING (Phage_ID) LEFT JOIN v USING (Phage_ID) LEFT JOIN tm USING (Phage_ID) LEFT JOIN tr USING (Phage_ID)""")
def large_phage_profile(spark, sf_dir):
    return tidy(views.large_phage_profile(star(spark, sf_dir)), 8)


@on_star("SELECT Source_DB, COUNT(DISTINCT Phage_ID) AS phages_with_amr, COUNT(DISTINCT Protein_ID) AS total_amr_proteins, COUNT(DISTINCT aligned_protein_card) AS unique_card_matches, ROUND(COUNT(DISTINCT Phage_ID) * 100.0 / ANY_VALUE(total), 2) AS percentage_phages_with_amr FROM (SELECT p.Source_DB, a.Phage_ID, a.Protein_ID, a.aligned_protein_card FROM dim_antimicrobial_resistance_genes a JOIN fact_phages p ON p.Phage_ID = a.Phage_ID) LEFT JOIN (SELECT Source_DB, COUNT(DISTINCT Phage_ID) AS total FROM fact_phages GROUP BY 1) USING (Source_DB) GROUP BY Source_DB")
def amr_summary(spark, sf_dir):
    return views.amr_summary(_with_fact_source(star(spark, sf_dir), "dim_antimicrobial_resistance_genes"))


@on_star("SELECT Source_DB, COUNT(DISTINCT Phage_ID) AS phages_with_crispr, COUNT(DISTINCT crispr_id) AS total_crispr_arrays, ROUND(AVG(crispr_length), 4) AS avg_array_length, ROUND(AVG(spacers_count), 4) AS avg_spacers_per_array, ROUND(AVG(repeat_length), 4) AS avg_repeat_length, ROUND(AVG(mean_spacer_size), 4) AS avg_spacer_size, ROUND(AVG(conservation_repeats_pct), 4) AS avg_repeat_conservation, ROUND(COUNT(DISTINCT Phage_ID) * 100.0 / ANY_VALUE(total), 2) AS percentage_phages_with_crispr FROM (SELECT p.Source_DB, c.* EXCLUDE (Source_DB) FROM dim_crispr_arrays c JOIN fact_phages p ON p.Phage_ID = c.Phage_ID) LEFT JOIN (SELECT Source_DB, COUNT(DISTINCT Phage_ID) AS total FROM fact_phages GROUP BY 1) USING (Source_DB) GROUP BY Source_DB")
def crispr_summary(spark, sf_dir):
    return tidy(views.crispr_summary(_with_fact_source(star(spark, sf_dir), "dim_crispr_arrays")))


def _with_fact_source(tables, dim):
    """The dimension labelled with the source of its phage, as the ingest does."""
    label = tables["fact_phages"].select("Phage_ID", "Source_DB")
    return tables | {dim: tables[dim].drop("Source_DB").join(label, "Phage_ID")}


@on_star("SELECT evidence_level, CASE evidence_level WHEN 4 THEN 'Very High' WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' ELSE 'Unknown' END AS evidence_category, COUNT(*) AS array_count, ROUND(AVG(spacers_count), 4) AS avg_spacers, ROUND(AVG(crispr_length), 4) AS avg_length, ROUND(AVG(conservation_repeats_pct), 4) AS avg_conservation FROM dim_crispr_arrays GROUP BY evidence_level")
def evidence_distribution(spark, sf_dir):
    return tidy(views.evidence_distribution(star(spark, sf_dir)))


@on_star(PER_PHAGE + "SELECT f.Phage_ID, f.Source_DB, f.Host, f.Lifestyle, COALESCE(cr.n, 0) AS crispr_arrays, cr.e AS max_crispr_evidence, COALESCE(a.n, 0) AS anti_crispr_proteins, COALESCE(amr.n, 0) AS amr_genes, CASE WHEN cr.n > 0 AND a.n > 0 THEN 'CRISPR + Anti-CRISPR' WHEN cr.n > 0 THEN 'CRISPR only' WHEN a.n > 0 THEN 'Anti-CRISPR only' WHEN amr.n > 0 THEN 'AMR only' ELSE 'None detected' END AS defense_category FROM (SELECT DISTINCT Phage_ID, Source_DB, Host, Lifestyle FROM fact_phages) f LEFT JOIN cr USING (Phage_ID) LEFT JOIN a USING (Phage_ID) LEFT JOIN amr USING (Phage_ID)")
def defense_profile(spark, sf_dir):
    return views.defense_profile(star(spark, sf_dir))


@on_star("SELECT f.Host, f.Source_DB, COUNT(DISTINCT f.Phage_ID) AS total_phages, COUNT(DISTINCT a.Phage_ID) AS phages_with_amr, COUNT(DISTINCT a.Protein_ID) AS total_amr_genes, ROUND(COUNT(DISTINCT a.Phage_ID) * 100.0 / COUNT(DISTINCT f.Phage_ID), 2) AS amr_prevalence_pct FROM fact_phages f LEFT JOIN dim_antimicrobial_resistance_genes a ON f.Phage_ID = a.Phage_ID GROUP BY 1, 2 HAVING COUNT(DISTINCT f.Phage_ID) > 10")
def host_amr_profile(spark, sf_dir):
    return views.host_amr_profile(star(spark, sf_dir))


@on_star("SELECT f.Host, f.Source_DB, COUNT(DISTINCT f.Phage_ID) AS total_phages, COUNT(DISTINCT c.Phage_ID) AS phages_with_crispr, ROUND(AVG(c.spacers_count), 4) AS avg_spacers, MAX(c.spacers_count) AS max_spacers, ROUND(AVG(c.conservation_repeats_pct), 4) AS avg_repeat_conservation, ROUND(COUNT(DISTINCT c.Phage_ID) * 100.0 / COUNT(DISTINCT f.Phage_ID), 2) AS crispr_prevalence_pct FROM fact_phages f LEFT JOIN dim_crispr_arrays c ON f.Phage_ID = c.Phage_ID GROUP BY 1, 2 HAVING COUNT(DISTINCT f.Phage_ID) > 10")
def host_crispr_profile(spark, sf_dir):
    return tidy(views.host_crispr_profile(star(spark, sf_dir)))


@query("WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part) SELECT p_partkey, p_name, word FROM part JOIN w ON p_name LIKE word || '%'")
def prefix_host_join(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = parts.select(F.split("p_name", " ")[0].alias("word")).distinct()
    return views.prefix_join(parts, "p_name", words, "word")


@on_star("SELECT Species_Name, Assembly_Level, RefSeq_Category, COUNT(*) AS genome_count, ROUND(AVG(Genome_Length), 4) AS avg_genome_length, ROUND(AVG(GC_Content), 4) AS avg_gc_content FROM dim_hosts GROUP BY 1, 2, 3")
def host_genome_summary(spark, sf_dir):
    return tidy(views.host_genome_summary(star(spark, sf_dir)))


@on_star("SELECT e.Phage_ID, h.Host_ID FROM edges e JOIN dim_hosts h ON 'GCF_' || e.Host_ID = h.Assembly_Accession UNION SELECT Phage_ID, Host_ID FROM edges JOIN fact_phages USING (Phage_ID) WHERE Lifestyle = 'P'")
def associations_union(spark, sf_dir):
    tables, e = star(spark, sf_dir), edges(spark, sf_dir)
    tables["dim_phage_host_links"] = e.select("Phage_ID", F.concat(F.lit("GCF_"), "Host_ID").alias("Assembly_Accession"))
    tables["private_phage_host_associations"] = e.join(tables["fact_phages"].filter("Lifestyle = 'P'").select("Phage_ID"), "Phage_ID", "left_semi")
    return views.phage_host_associations(tables)


# Pairs.

PAIRS = """SELECT DISTINCT pha.Phage_ID, pha.Host_ID, p.Source_DB AS Phage_Source, CASE WHEN LOWER(TRIM(p.source_type)) = 'private' THEN 'private' ELSE 'public' END AS Phage_Source_Type, p.Length AS Phage_Length, p.GC_content AS Phage_GC,
'Viruses' AS Phage_Taxonomy, p.Completeness AS Phage_Completeness, p.Lifestyle AS Phage_Lifestyle, p.Cluster AS Phage_Cluster, CAST(NULL AS VARCHAR) AS Phage_Subcluster, h.Species_Name, h.Assembly_Level AS Host_Assembly_Level,
h.Genome_Length AS Host_Length, h.GC_Content AS Host_GC, h.RefSeq_Category AS Host_RefSeq_Category FROM edges pha JOIN fact_phages p ON pha.Phage_ID = p.Phage_ID JOIN dim_hosts h ON pha.Host_ID = h.Host_ID"""


@on_star(PAIRS)
def pair_metadata(spark, sf_dir):
    return pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir))


@on_star(PAIRS + " WHERE p.Source_DB LIKE '%U%' AND LOWER(p.Lifestyle) = 'f' AND LOWER(h.Species_Name) = 'building' AND h.Assembly_Level LIKE 'C%'")
def pairs_structured_filter(spark, sf_dir):
    return pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir), phage_filters={"Source_DB": "%U%", "Lifestyle": "f"}, host_filters={"Organism_Name": "building", "Assembly_Level": "C%"})


@on_star(PAIRS + " WHERE p.Length BETWEEN 20000 AND 90000 AND h.GC_Content > 40 ORDER BY Phage_ID, Host_ID, Phage_Source LIMIT 50 OFFSET 100")
def pairs_page(spark, sf_dir):
    return pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir), "WHERE p.Length BETWEEN 20000 AND 90000 AND h.GC_Content > 40 LIMIT 50 OFFSET 100")


@on_star("SELECT DISTINCT e.Phage_ID, e.Host_ID, p.Source_DB, CASE WHEN LOWER(TRIM(p.source_type)) = 'private' THEN 'private' ELSE 'public' END AS source_type FROM edges e JOIN fact_phages p USING (Phage_ID)")
def interactions(spark, sf_dir):
    return pairs.interactions(star(spark, sf_dir), edges(spark, sf_dir))


@on_star("SELECT Phage_ID, Source_DB, Length, source_type FROM fact_phages WHERE LOWER(TRIM(source_type)) = 'private'")
def private_phages(spark, sf_dir):
    return pairs.phages(star(spark, sf_dir), kind="private").select("Phage_ID", "Source_DB", "Length", "source_type")


@on_star("SELECT Phage_ID, row_number() OVER (ORDER BY Phage_ID, Host_ID) - 1 AS idx, Host_ID FROM edges")
def pair_index(spark, sf_dir):
    return pairs.dense_index(edges(spark, sf_dir), ["Phage_ID", "Host_ID"])


@on_star("SELECT e.Host_ID, COUNT(*) AS n_pairs, 'no sequence' AS Failure_Reason FROM edges e WHERE NOT EXISTS (SELECT 1 FROM dim_hosts h WHERE h.Host_ID = e.Host_ID AND h.RefSeq_Category <> 'na') GROUP BY e.Host_ID")
def missing_hosts(spark, sf_dir):
    have = star(spark, sf_dir)["dim_hosts"].filter("RefSeq_Category <> 'na'").select(F.col("Host_ID").alias("id"))
    return pairs.missing_hosts(edges(spark, sf_dir), have)


# Quality.


@on_star("SELECT item_id, Source_DB FROM line l WHERE NOT EXISTS (SELECT 1 FROM fact_phages f WHERE f.Phage_ID = l.Phage_ID AND f.Lifestyle <> 'P')")
def orphans(spark, sf_dir):
    tables = star(spark, sf_dir)
    found = quality.orphans(tables["dim_proteins"], tables["fact_phages"].filter("Lifestyle <> 'P'"))
    return found.select(F.col("Protein_ID").alias("item_id"), "Source_DB")


@on_star("SELECT COUNT(*) AS n_duplicate_keys, CAST(SUM(n - 1) AS BIGINT) AS n_extra_rows FROM (SELECT Protein_ID, COUNT(*) AS n FROM dim_proteins GROUP BY 1 HAVING COUNT(*) > 1)")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(star(spark, sf_dir)["dim_proteins"], ["Protein_ID"])


GATE_PARTS = " UNION ALL ".join(
    f"SELECT '{d} orphans' AS check_name, COUNT(*) AS n_bad FROM {d} x WHERE NOT EXISTS (SELECT 1 FROM fact_phages f WHERE f.Phage_ID = x.Phage_ID)"
    for d in ("dim_proteins", "dim_terminators", "dim_anti_crispr", "dim_virulent_factors", "dim_transmembrane_proteins", "dim_trna_tmrna", "dim_antimicrobial_resistance_genes", "dim_crispr_arrays")
)


@on_star("SELECT check_name, n_bad, n_bad = 0 AS passed FROM (SELECT 'fact_phages duplicates' AS check_name, COUNT(*) AS n_bad FROM (SELECT Phage_ID FROM fact_phages GROUP BY 1 HAVING COUNT(*) > 1) UNION ALL " + GATE_PARTS + ")")
def quality_gate(spark, sf_dir):
    return quality.quality_gate(star(spark, sf_dir))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(NULLIF({c}, {v})) AS n_nulls FROM orders" for c, v in (("o_orderstatus", "'F'"), ("o_custkey", "1"), ("o_orderpriority", "'1-URGENT'"))))
def null_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), F.nullif("o_custkey", F.lit(1)).alias("o_custkey"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"))
    return quality.null_profile(orders)


@on_star("SELECT Host AS value, COUNT(*) AS n FROM fact_phages GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def distribution_topk(spark, sf_dir):
    return quality.distribution(star(spark, sf_dir)["fact_phages"], "Host", 20)


@on_star("SELECT COUNT(*) AS n_rows, COUNT(Length) AS n_known, MIN(Length) AS min_value, MAX(Length) AS max_value, ROUND(AVG(Length), 4) AS avg_value, ROUND(MEDIAN(Length), 4) AS median_value FROM fact_phages")
def summary_stats(spark, sf_dir):
    return tidy(quality.number_stats(star(spark, sf_dir)["fact_phages"], "Length"))


@on_star("SELECT Lifestyle, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct FROM fact_phages GROUP BY 1")
def pct_of_total(spark, sf_dir):
    return views.share_of_total(star(spark, sf_dir)["fact_phages"], "Lifestyle")


ANNOTATIONS = ("dim_proteins", "dim_anti_crispr", "dim_crispr_arrays", "dim_virulent_factors")


@on_star("SELECT annotation, n_phages, ROUND(n_phages * 100.0 / (SELECT COUNT(DISTINCT Phage_ID) FROM fact_phages), 2) AS pct FROM (" + " UNION ALL ".join(f"SELECT '{d}' AS annotation, COUNT(DISTINCT Phage_ID) AS n_phages FROM {d}" for d in ANNOTATIONS) + ")")
def annotation_coverage(spark, sf_dir):
    tables = star(spark, sf_dir)
    return quality.coverage(tables["fact_phages"], {d: tables[d] for d in ANNOTATIONS})


ENTITIES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query(" UNION ALL ".join(f"SELECT '{t}' AS entity, COUNT(*) AS n_rows FROM {t}" for t in ENTITIES))
def entity_counts(spark, sf_dir):
    return quality.entity_counts({t: table(spark, sf_dir, t) for t in ENTITIES})


@on_star("SELECT f.Phage_ID, COUNT(DISTINCT p.Protein_ID) AS n_proteins, ROUND(AVG(p.Molecular_weight), 8) AS avg_weight, ROUND(AVG(p.Aromaticity), 8) AS avg_aromaticity, ROUND(AVG(p.Instability_index), 8) AS avg_instability, CAST(SUM(CASE WHEN p.Protein_classification LIKE '%R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned FROM fact_phages f LEFT JOIN dim_proteins p USING (Phage_ID) GROUP BY 1")
def protein_features(spark, sf_dir):
    tables = star(spark, sf_dir)
    one = views.per_phage(
        tables["dim_proteins"],
        n_proteins=F.countDistinct("Protein_ID"),
        avg_weight=F.avg("Molecular_weight"),
        avg_aromaticity=F.avg("Aromaticity"),
        avg_instability=F.avg("Instability_index"),
        n_returned=F.sum(F.col("Protein_classification").endswith("R").cast("long")),
    )
    return tidy(views.profile(tables["fact_phages"], [], [one], ["n_proteins", "n_returned"]), 8)


@query("SELECT n_hosts, COUNT(*) AS n_phages, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct, n_hosts > 1 AS broad FROM (SELECT l_partkey, COUNT(DISTINCT l_suppkey) AS n_hosts FROM lineitem GROUP BY 1) GROUP BY n_hosts")
def broad_host_range(spark, sf_dir):
    return quality.broad_host_range(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("SELECT CASE WHEN o IS NULL THEN 'without' ELSE 'with' END AS association, COUNT(*) AS n FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON c_custkey = o GROUP BY 1")
def association_coverage(spark, sf_dir):
    return quality.association_coverage(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT source, COUNT(*) AS total, COUNT(l.doc_id) AS found, COUNT(*) - COUNT(l.doc_id) AS missing, ROUND(COUNT(l.doc_id) * 100.0 / COUNT(*), 2) AS match_pct FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source")
def match_rate(spark, sf_dir):
    return quality.match_rate(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id", "source")


@query("SELECT CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 'both' WHEN b IS NULL THEN 'left only' ELSE 'right only' END AS side, COUNT(*) AS n_ids FROM (SELECT DISTINCT doc_id AS a FROM documents WHERE lang = 'en') FULL JOIN (SELECT DISTINCT doc_id AS b FROM labels) ON a = b GROUP BY 1")
def id_setdiff(spark, sf_dir):
    return quality.id_overlap(table(spark, sf_dir, "documents").filter("lang = 'en'"), table(spark, sf_dir, "labels"), "doc_id")


CENSUS = "SELECT '{0}' AS shape, CAST(SUM(CASE WHEN regexp_matches(c_name, '{1}') THEN 1 ELSE 0 END) AS BIGINT) AS n_ids, ROUND(SUM(CASE WHEN regexp_matches(c_name, '{1}') THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS pct FROM customer"


@query(" UNION ALL ".join(CENSUS.format(k, v) for k, v in sc.ID_SHAPES.items()))
def id_census(spark, sf_dir):
    return quality.id_census(table(spark, sf_dir, "customer"), "c_name", sc.ID_SHAPES)


@query("SELECT event_type, COUNT(*) AS n_failures, MIN(event_id) AS first_item, MAX(event_id) AS last_item FROM events WHERE value > 50 GROUP BY 1")
def failure_report(spark, sf_dir):
    return quality.failure_report(table(spark, sf_dir, "events").filter("value > 50"), "event_type", "event_id")


# Sequences.


@query("SELECT conv_id AS genome_id, md5(string_agg(text, 'NNNNN' ORDER BY length(text) DESC, turn)) AS genome_md5 FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def genome_concat(spark, sf_dir):
    rows = sequences.assemble_genomes(contigs(spark, sf_dir), "concat", gap=5)
    return rows.select("genome_id", F.md5(F.col("genome").cast("binary")).alias("genome_md5"))


@query("SELECT conv_id AS genome_id, text AS genome FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS r FROM conversations) WHERE r = 1")
def genome_first(spark, sf_dir):
    return sequences.assemble_genomes(contigs(spark, sf_dir), "first")


@query("SELECT conv_id AS genome_id, COUNT(*) AS contig_count, string_agg(CAST(length(text) AS VARCHAR), ',' ORDER BY length(text) DESC, turn) AS lengths, CAST(SUM(length(text)) AS BIGINT) AS total_length, CAST(MAX(length(text)) AS INTEGER) AS longest FROM conversations GROUP BY conv_id")
def genome_stats(spark, sf_dir):
    rows = sequences.genome_stats(contigs(spark, sf_dir))
    return rows.withColumn("lengths", F.array_join(F.transform("lengths", lambda n: n.cast("string")), ","))


LETTERS = "CAST(length(text) - length(translate(text, '{0}', '')) AS INTEGER)"


@query("SELECT doc_id, " + ", ".join(f"{LETTERS.format(x + x.lower())} AS {x.lower()}_count" for x in "ACGT") + ", ROUND((" + LETTERS.format("GCgc") + ") * 100.0 / NULLIF(length(text), 0), 2) AS gc_pct FROM documents")
def composition(spark, sf_dir):
    parts = sc.composition(F.col("sequence"))
    return records(spark, sf_dir).select("doc_id", *[parts[k].alias(k) for k in ("a_count", "c_count", "g_count", "t_count", "gc_pct")])


@query("SELECT doc_id, CASE WHEN n_chars * 50 > 200000 THEN 'jumbo' WHEN n_chars * 50 > 50000 THEN 'large' WHEN n_chars * 50 > 10000 THEN 'medium' ELSE 'small' END AS size_category FROM documents")
def size_category(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sc.size_category(F.col("n_chars") * 50).alias("size_category"))


@query("SELECT MIN(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY md5(text)")
def dedupe_first(spark, sf_dir):
    rows = records(spark, sf_dir).select("doc_id", "pos", F.md5(F.col("sequence").cast("binary")).alias("digest"))
    return sequences.dedupe_first(rows, "digest").select("doc_id", "digest")


@query("SELECT md5(text) AS digest, COUNT(*) AS n, MIN(doc_id) AS first_id FROM documents GROUP BY 1 HAVING COUNT(*) > 1")
def identical_groups(spark, sf_dir):
    return sequences.identical_groups(records(spark, sf_dir), "doc_id", "sequence")


@query("WITH x AS (SELECT l_orderkey, l_linenumber, md5(CAST(l_partkey AS VARCHAR)) AS h, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey) AS r FROM lineitem), f AS (SELECT l_orderkey, l_linenumber, h FROM x WHERE r = 1) SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS header, COUNT(*) FILTER (WHERE x.h = f.h) - 1 AS identical, COUNT(*) FILTER (WHERE x.h <> f.h) AS different FROM x JOIN f USING (l_orderkey, l_linenumber) GROUP BY 1 HAVING COUNT(*) > 1")
def duplicate_report(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("header"), "l_suppkey", "l_partkey", F.col("l_partkey").cast("string").alias("sequence"))
    return sequences.duplicate_report(rows, order=("l_suppkey", "l_partkey"), top=None)


@query("WITH k AS (SELECT lang, unnest([substr(text, CAST(i AS BIGINT), 4) for i in range(1, length(text) - 2)]) AS kmer FROM documents WHERE length(text) >= 4), c AS (SELECT lang, kmer, COUNT(*) AS n FROM k GROUP BY 1, 2) SELECT lang, kmer, n, ROUND(n / SUM(n) OVER (PARTITION BY lang), 9) AS frequency FROM c")
def kmer_counts(spark, sf_dir):
    return tidy(features.kmer_totals(table(spark, sf_dir, "documents").select("lang", "text"), 4, "text", "lang"), 9)


@query("WITH t AS (SELECT conv_id, turn, text FROM conversations), k AS (SELECT conv_id, turn, kmer, COUNT(*) AS n FROM (SELECT conv_id, turn, unnest([substr(text, CAST(i AS BIGINT), 3) for i in range(1, length(text) - 1)]) AS kmer FROM t) GROUP BY 1, 2, 3), s AS (SELECT conv_id, turn, sqrt(SUM(n * n)) AS norm FROM k GROUP BY 1, 2), d AS (SELECT a.conv_id, a.turn, SUM(a.n * b.n) AS dot FROM k a JOIN k b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn AND a.kmer = b.kmer GROUP BY 1, 2) SELECT CAST(x.conv_id AS VARCHAR) || ':' || CAST(x.turn AS VARCHAR) AS a, CAST(x.conv_id AS VARCHAR) || ':' || CAST(x.turn + 1 AS VARCHAR) AS b, COALESCE(ROUND(d.dot / (p.norm * q.norm), 6), 0) AS cosine FROM t x JOIN t y ON x.conv_id = y.conv_id AND x.turn + 1 = y.turn LEFT JOIN d ON d.conv_id = x.conv_id AND d.turn = x.turn LEFT JOIN s p ON p.conv_id = x.conv_id AND p.turn = x.turn LEFT JOIN s q ON q.conv_id = x.conv_id AND q.turn = x.turn + 1")
def kmer_cosine(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "conv_id", "turn", "text")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("id").alias("b"))
    follow = turns.join(after, ["conv_id", "turn"]).select(F.col("id").alias("a"), "b")
    return tidy(features.kmer_cosine(features.kmer_counts(turns, 3, "id", "text"), follow, "id"), 6)


@query("SELECT d.doc_id, f.first_id FROM documents d JOIN (SELECT md5(text) AS h, MIN(doc_id) AS first_id FROM documents GROUP BY 1) f ON md5(d.text) = f.h")
def by_digest(spark, sf_dir):
    return quality.first_of_digest(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT source AS source_db, COUNT(*) AS n_records FROM documents GROUP BY 1")
def per_source_counts(spark, sf_dir):
    return sequences.per_source_counts(records(spark, sf_dir))


@query(
    "SELECT doc_id, '>' || concat_ws(' ', CAST(doc_id AS VARCHAR), source) || chr(10) || "
    r"rtrim(regexp_replace(regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g'), '(.{80})', '\1' || chr(10), 'g'), chr(10)) AS fasta FROM documents"
)
def fasta_export(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", fasta_text(F.concat_ws(" ", F.col("doc_id").cast("string"), "source"), F.regexp_replace("text", "\\s+", "")).alias("fasta"))


@on_star("SELECT Host_ID AS id, Assembly_Accession AS header, 1 AS tier FROM dim_hosts WHERE CAST(Host_ID AS INTEGER) < 0 UNION ALL SELECT 'GCF_' || s_suppkey, 'GCF_' || s_suppkey, 1 FROM supplier JOIN dim_hosts h ON h.Assembly_Accession = 'GCF_' || s_suppkey UNION ALL SELECT 'GCF_' || s_suppkey, MIN(Assembly_Accession), 2 FROM supplier JOIN dim_hosts h ON starts_with(h.Assembly_Accession, 'GCF_' || s_suppkey) WHERE NOT EXISTS (SELECT 1 FROM dim_hosts x WHERE x.Assembly_Accession = 'GCF_' || s_suppkey) GROUP BY 1")
def protein_lookup_tiers(spark, sf_dir):
    headers = star(spark, sf_dir)["dim_hosts"].select(F.col("Assembly_Accession").alias("header"), F.col("Assembly_Accession").alias("pos"))
    wanted = table(spark, sf_dir, "supplier").select(F.concat(F.lit("GCF_"), F.col("s_suppkey").cast("string")).alias("id"))
    return sequences.protein_lookup(wanted, headers)


# Host resolution, over part names as raw host fields: three words, the first capitalized, with separators.

RAW_HOSTS = "WITH raw AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'NA;GCA ' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '.1;' || p_name WHEN 1 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2) WHEN 2 THEN 'unknown;' || p_name || '; ' || p_brand WHEN 3 THEN '-' ELSE p_type END AS Host FROM part)"


def raw_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    accession = F.concat(F.lit("NA;GCA "), F.lpad(key.cast("string"), 9, "0"), F.lit(".1;"), "p_name")
    capital = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substr(p_name, 2)"))
    host = F.when(key % 5 == 0, accession).when(key % 5 == 1, capital).when(key % 5 == 2, F.concat(F.lit("unknown;"), "p_name", F.lit("; "), "p_brand")).when(key % 5 == 3, "-").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select(key.alias("Phage_ID"), host.alias("Host"))


TOKENS = RAW_HOSTS + ", parts AS (SELECT p_partkey AS Phage_ID, Host AS Host_Raw, unnest(string_split(regexp_replace(Host, '\\b(GCF|GCA)\\s+(\\d{9}\\.\\d+)\\b', '\\1_\\2', 'g'), ';')) AS tok, generate_subscripts(string_split(Host, ';'), 1) AS Token_Order FROM raw), tokens AS (SELECT Phage_ID, Host_Raw, trim(tok) AS Host_Token, CASE WHEN regexp_matches(trim(tok), '^(GCF|GCA)_\\d{9}\\.\\d+$') THEN 'assembly_accession' WHEN regexp_matches(trim(tok), '^[A-Z]\\S*\\s+\\S') THEN 'species_name' ELSE 'other' END AS Token_Type, CAST(Token_Order AS INTEGER) AS Token_Order FROM parts WHERE trim(tok) <> '' AND lower(trim(tok)) NOT IN ('-', 'na', 'none', 'null', 'nan', 'unknown', 'unidentified', 'uncultured') AND NOT regexp_matches(lower(tok), 'unknown|unidentified'))"


@query(TOKENS + " SELECT * FROM tokens")
def token_candidates(spark, sf_dir):
    return resolve.candidates(raw_hosts(spark, sf_dir))


CATALOG = """, cat AS (SELECT Host_Token AS token, CASE n % 3 WHEN 0 THEN 'GCF_' ELSE 'GCA_' END || lpad(CAST(Phage_ID * 10 + n AS VARCHAR), 9, '0') || '.1' AS accession, n,
CASE n WHEN 1 THEN 'Contig' WHEN 2 THEN 'Chromosome' ELSE 'Complete Genome' END AS level, CASE WHEN n = 3 THEN 'reference genome' ELSE 'na' END AS category
FROM (SELECT Host_Token, MIN(Phage_ID) AS Phage_ID FROM tokens GROUP BY 1), (SELECT unnest([1, 2, 3]) AS n) WHERE n <= Phage_ID % 4),
scored AS (SELECT *, CASE category WHEN 'reference genome' THEN 10000 ELSE 0 END + CASE level WHEN 'Complete Genome' THEN 1000 WHEN 'Chromosome' THEN 500 ELSE 50 END + CASE WHEN n = 2 THEN 10 ELSE 0 END AS score, accession LIKE 'GCF%' AS ref FROM cat),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY token ORDER BY score DESC, accession) AS rk, COUNT(*) OVER (PARTITION BY token) AS several FROM scored s JOIN (SELECT token AS t, bool_or(ref) AS anyref FROM scored GROUP BY 1) ON token = t WHERE ref OR NOT anyref),
links AS (SELECT t.*, accession AS Assembly_Accession, CASE Token_Type WHEN 'assembly_accession' THEN 'accession_in_host_field' WHEN 'species_name' THEN 'species_to_taxid_to_assembly' ELSE 'fallback' END AS Resolution_Source, CAST(rk AS INTEGER) AS Resolution_Rank,
ROUND(GREATEST(0.0, CASE Token_Type WHEN 'assembly_accession' THEN 0.95::DOUBLE WHEN 'species_name' THEN 0.70::DOUBLE ELSE 0.30::DOUBLE END - (rk - 1) * 0.1::DOUBLE), 3) AS Confidence, level AS Assembly_Level, category AS RefSeq_Category, CAST(score AS INTEGER) AS Quality_Score, several > 1 AS Ambiguous,
CASE WHEN several > 1 THEN CAST(several AS VARCHAR) || ' assemblies found' ELSE '' END AS Ambiguity_Reason FROM tokens t JOIN ranked ON Host_Token = token)"""


def host_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of up to three assemblies for each token of the raw hosts."""
    tokens = resolve.candidates(raw_hosts(spark, sf_dir)).groupBy(F.col("Host_Token").alias("token")).agg(F.min("Phage_ID").alias("p"))
    rows = tokens.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).filter("n <= p % 4")
    number = F.lpad((F.col("p") * 10 + F.col("n")).cast("string"), 9, "0")
    return rows.select(
        "token",
        F.concat(F.when(F.col("n") % 3 == 0, "GCF_").otherwise("GCA_"), number, F.lit(".1")).alias("assembly_accession"),
        F.when(F.col("n") == 1, "Contig").when(F.col("n") == 2, "Chromosome").otherwise("Complete Genome").alias("assembly_level"),
        F.when(F.col("n") == 3, "reference genome").otherwise("na").alias("refseq_category"),
        (F.col("n") == 2).alias("is_latest"),
    )


def _links(spark, sf_dir):
    return resolve.assembly_links(resolve.candidates(raw_hosts(spark, sf_dir)), resolve.ranked_assemblies(host_catalog(spark, sf_dir)))


@query(TOKENS + CATALOG + " SELECT * FROM links")
def token_rank(spark, sf_dir):
    return _links(spark, sf_dir)


@query(TOKENS + CATALOG + " SELECT Phage_ID, Host_Token, Assembly_Accession, Confidence FROM (SELECT *, row_number() OVER (PARTITION BY Phage_ID, Host_Token ORDER BY Resolution_Rank, Assembly_Accession) AS r FROM links) WHERE r = 1")
def best_per_token(spark, sf_dir):
    return resolve.best_per_token(_links(spark, sf_dir)).select("Phage_ID", "Host_Token", "Assembly_Accession", "Confidence")


REPORT = ", best AS (SELECT Phage_ID, Host_Token, Assembly_Accession, replace(Assembly_Accession, '.', '_') AS Host_ID FROM (SELECT *, row_number() OVER (PARTITION BY Phage_ID, Host_Token ORDER BY Resolution_Rank, Assembly_Accession) AS r FROM links) WHERE r = 1), meta AS (SELECT accession, MAX(CASE WHEN n > 1 THEN 'success' ELSE 'failed' END) AS st FROM cat GROUP BY 1), qc AS (SELECT DISTINCT replace(accession, '.', '_') AS Host_ID, CASE WHEN n = 2 THEN 'indexed' ELSE 'rejected_duplicate_headers' END AS qc_status FROM cat WHERE n > 1), report AS (SELECT t.Phage_ID, t.Host_Token, t.Token_Order, b.Assembly_Accession, m.st AS Download_Status, q.qc_status FROM tokens t LEFT JOIN best b ON t.Phage_ID = b.Phage_ID AND t.Host_Token = b.Host_Token LEFT JOIN meta m ON m.accession = b.Assembly_Accession LEFT JOIN qc q ON q.Host_ID = b.Host_ID)"


def _report(spark, sf_dir):
    tokens, cat = resolve.candidates(raw_hosts(spark, sf_dir)), host_catalog(spark, sf_dir)
    accession, latest = F.col("assembly_accession"), F.col("assembly_level") != "Contig"
    metadata = cat.select(accession.alias("Assembly_Accession"), F.when(latest, "success").otherwise("failed").alias("Download_Status"))
    qc = cat.filter(latest).select(sc.host_id(accession).alias("Host_ID"), F.when(F.col("is_latest"), "indexed").otherwise("rejected_duplicate_headers").alias("qc_status")).distinct()
    return resolve.status_report(tokens, _links(spark, sf_dir), metadata, qc)


@query(TOKENS + CATALOG + REPORT + " SELECT * FROM report")
def status_report(spark, sf_dir):
    return _report(spark, sf_dir).select("Phage_ID", "Host_Token", "Token_Order", "Assembly_Accession", "Download_Status", "qc_status")


@query(TOKENS + CATALOG + REPORT + " SELECT COUNT(DISTINCT Phage_ID) AS phages, COUNT(DISTINCT CASE WHEN Assembly_Accession IS NOT NULL THEN Phage_ID END) AS resolved, COUNT(DISTINCT CASE WHEN Download_Status = 'success' THEN Phage_ID END) AS downloaded, COUNT(DISTINCT CASE WHEN qc_status = 'indexed' THEN Phage_ID END) AS indexed, COUNT(DISTINCT CASE WHEN qc_status LIKE 'rejected%' THEN Phage_ID END) AS rejected FROM report")
def status_funnel(spark, sf_dir):
    return resolve.status_funnel(_report(spark, sf_dir))


# Reshaping.


@query("SELECT event_id, 'event_type' AS attribute_key, event_type AS attribute_value FROM events UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events WHERE json_extract_string(props, '$.k') <> ''")
def melt_attributes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    return reshape.melt(rows, ["event_id"])


@query("SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS F, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS O, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def pivot_attributes(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_row(spark, sf_dir):
    return reshape.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"])


@query("SELECT o_orderkey, CASE WHEN kind IS NULL OR trim(kind) = '' OR kind = 'nan' THEN CASE WHEN o_custkey % 3 = 0 THEN 'private' ELSE 'public' END ELSE kind END AS source_type FROM (SELECT o_orderkey, o_custkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN ' ' ELSE 'phagescope' END AS kind FROM orders)")
def source_type_repair(spark, sf_dir):
    key = F.col("o_orderkey") % 4
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(key == 1, "nan").when(key == 2, " ").when(key == 3, "phagescope").alias("source_type"))
    private = rows.filter("o_custkey % 3 = 0").select("o_custkey")
    return reshape.repair_source_type(rows, private, ["o_custkey"]).select("o_orderkey", "source_type")


@query("SELECT event_id, TRY_CAST(NULLIF(raw, '-') AS INTEGER) AS as_int, TRY_CAST(NULLIF(raw, '-') AS DOUBLE) AS as_double FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '-' WHEN 1 THEN CAST(event_id AS VARCHAR) || '.0' WHEN 2 THEN 'junk' WHEN 3 THEN CAST(event_id % 1000 AS VARCHAR) || '.6' ELSE CAST(event_id AS VARCHAR) END AS raw FROM events)")
def try_cast_sentinel(spark, sf_dir):
    key, text = F.col("event_id") % 5, F.col("event_id").cast("string")
    raw = F.when(key == 0, "-").when(key == 1, F.concat(text, F.lit(".0"))).when(key == 2, "junk").when(key == 3, F.concat((F.col("event_id") % 1000).cast("string"), F.lit(".6"))).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", sc.number(raw, "int").alias("as_int"), sc.number(raw).alias("as_double"))


@query("SELECT substr(sha256('event_id|ts|user_id|event_type|value|props'), 1, 16) AS fingerprint, COUNT(*) AS n_rows FROM events")
def schema_fingerprint(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.agg(F.count("*").alias("n_rows")).select(reshape.schema_fingerprint(rows).alias("fingerprint"), "n_rows")


# Negatives and features.

NUMBER = "(('0x' || substr(md5({0}), 1, 8))::BIGINT)"
PICKED = """, hosts_no AS (SELECT Host_ID, row_number() OVER (ORDER BY Host_ID) - 1 AS no FROM (SELECT DISTINCT Host_ID FROM dim_hosts)),
picked AS (SELECT DISTINCT f.Phage_ID, h.Host_ID FROM (SELECT DISTINCT Phage_ID FROM fact_phages) f CROSS JOIN (SELECT unnest([1, 2]) AS k) JOIN hosts_no h ON h.no = """ + NUMBER.format("f.Phage_ID || '|' || k || '|42'") + """ % (SELECT COUNT(*) FROM hosts_no)),
negatives AS (SELECT p.* FROM picked p WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.Phage_ID = p.Phage_ID AND e.Host_ID = p.Host_ID))"""


def _negatives(spark, sf_dir):
    tables = star(spark, sf_dir)
    return negatives.random_negatives(tables["fact_phages"], tables["dim_hosts"], edges(spark, sf_dir), per_phage=2)


@on_star(PICKED + " SELECT * FROM negatives")
def negatives_all(spark, sf_dir):
    return _negatives(spark, sf_dir)


@on_star(PICKED + " SELECT n.*, abs(f.GC_content - h.GC_Content) AS GC_Difference FROM negatives n JOIN fact_phages f USING (Phage_ID) JOIN dim_hosts h USING (Host_ID) WHERE abs(f.GC_content - h.GC_Content) >= 20")
def negatives_gc(spark, sf_dir):
    tables = star(spark, sf_dir)
    return negatives.gc_negatives(_negatives(spark, sf_dir), tables["fact_phages"], tables["dim_hosts"])


@on_star(PICKED + " SELECT n.Host_ID, n.Phage_ID, h.Species_Name FROM negatives n JOIN dim_hosts h USING (Host_ID) WHERE NOT EXISTS (SELECT 1 FROM edges e JOIN dim_hosts g ON g.Host_ID = e.Host_ID WHERE e.Phage_ID = n.Phage_ID AND g.Species_Name = h.Species_Name)")
def negatives_taxonomy(spark, sf_dir):
    return negatives.taxonomy_negatives(_negatives(spark, sf_dir), star(spark, sf_dir)["dim_hosts"], edges(spark, sf_dir))


@on_star(PICKED + " SELECT * FROM negatives ORDER BY md5(Phage_ID || '|' || Host_ID || '|42'), Phage_ID, Host_ID LIMIT 500")
def negatives_sampled(spark, sf_dir):
    return negatives.sample_by_hash(_negatives(spark, sf_dir), ["Phage_ID", "Host_ID"], 500)


@on_star(PICKED + ", good AS (SELECT DISTINCT Phage_ID, Host_ID FROM edges) SELECT Phage_ID, Host_ID, 1 AS label FROM good UNION ALL SELECT Phage_ID, Host_ID, 0 AS label FROM (SELECT * FROM negatives ORDER BY md5(Phage_ID || '|' || Host_ID || '|42'), Phage_ID, Host_ID LIMIT (SELECT COUNT(*) FROM good))")
def balanced_dataset(spark, sf_dir):
    return negatives.balanced_dataset(edges(spark, sf_dir), [_negatives(spark, sf_dir)])


@on_star("SELECT Phage_ID, Host_ID, ROUND(abs(pg - hg), 6) AS GC_Difference, ROUND(pg / (hg + 1e-6), 6) AS GC_Ratio, pg + hg AS GC_Sum, pg * hg AS GC_Product, ROUND(pl / (hl + 1), 6) AS Length_Ratio, ROUND(log10(pl + 1), 6) AS Log_Phage_Length, ROUND(log10(hl + 1), 6) AS Log_Host_Length, hl - pl AS Length_Difference, ROUND(pg / (hg + 1e-6) * (pl / (hl + 1)), 6) AS GC_x_Length_Ratio FROM (SELECT e.Phage_ID, e.Host_ID, f.GC_content AS pg, h.GC_Content AS hg, CAST(f.Length AS DOUBLE) AS pl, CAST(h.Genome_Length AS DOUBLE) AS hl FROM edges e JOIN fact_phages f USING (Phage_ID) JOIN dim_hosts h USING (Host_ID))")
def pair_features(spark, sf_dir):
    rows = features.pair_features(pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir)))
    names = ("GC_Difference", "GC_Ratio", "GC_Sum", "GC_Product", "Length_Ratio", "Log_Phage_Length", "Log_Host_Length", "Length_Difference", "GC_x_Length_Ratio")
    return tidy(rows.select("Phage_ID", "Host_ID", *names), 6)


@on_star("SELECT kind, ROUND(AVG(gc), 1) AS mean_gc, ROUND(MEDIAN(gc), 1) AS median_gc FROM (SELECT 'phage' AS kind, GC_content AS gc FROM fact_phages UNION ALL SELECT 'host', GC_Content FROM dim_hosts) GROUP BY kind")
def gc_by_type(spark, sf_dir):
    tables = star(spark, sf_dir)
    both = tables["fact_phages"].select(F.lit("phage").alias("kind"), F.col("GC_content").alias("gc")).unionAll(tables["dim_hosts"].select(F.lit("host"), F.col("GC_Content")))
    return quality.mean_and_median(both, "kind", "gc").select("kind", F.round("mean", 1).alias("mean_gc"), F.round("median", 1).alias("median_gc"))


@on_star("SELECT ROUND(corr(f.GC_content, h.GC_Content), 6) AS gc_corr FROM edges e JOIN fact_phages f USING (Phage_ID) JOIN dim_hosts h USING (Host_ID)")
def correlation(spark, sf_dir):
    return pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir)).transform(quality.pair_correlation, "Phage_GC", "Host_GC").select(F.round("corr", 6).alias("gc_corr"))


@query("SELECT doc_id, toxic, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id) <= floor(COUNT(*) OVER (PARTITION BY toxic) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM labels")
def stratified_split(spark, sf_dir):
    return negatives.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic", ["doc_id"])


@on_star("SELECT dimension, COUNT(*) AS n_rows, COUNT(DISTINCT Phage_ID) AS n_phages, ROUND(COUNT(*) / COUNT(DISTINCT Phage_ID), 4) AS rows_per_phage FROM (SELECT 'dim_anti_crispr' AS dimension, Phage_ID FROM dim_anti_crispr UNION ALL SELECT 'dim_trna_tmrna', Phage_ID FROM dim_trna_tmrna UNION ALL SELECT 'dim_transmembrane_proteins', Phage_ID FROM dim_transmembrane_proteins UNION ALL SELECT 'dim_virulent_factors', Phage_ID FROM dim_virulent_factors) GROUP BY dimension")
def dimension_stats(spark, sf_dir):
    tables = star(spark, sf_dir)
    return views.dimension_stats({t: tables[t] for t in ("dim_anti_crispr", "dim_trna_tmrna", "dim_transmembrane_proteins", "dim_virulent_factors")})


@on_star("SELECT Protein_classification AS value, COUNT(*) AS n, COUNT(DISTINCT Phage_ID) AS n_phages FROM dim_proteins GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def protein_class_top(spark, sf_dir):
    return views.top_by_phages(star(spark, sf_dir)["dim_proteins"], "Protein_classification")


@on_star("SELECT aligned_protein_card AS value, COUNT(*) AS n, COUNT(DISTINCT Phage_ID) AS n_phages FROM dim_antimicrobial_resistance_genes JOIN (SELECT DISTINCT Phage_ID FROM fact_phages) USING (Phage_ID) GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def amr_top(spark, sf_dir):
    tables = star(spark, sf_dir)
    return views.top_by_phages(tables["dim_antimicrobial_resistance_genes"].join(tables["fact_phages"], "Phage_ID", "left_semi"), "aligned_protein_card", 15)


@on_star("SELECT f.Host AS value, COUNT(*) AS n, COUNT(DISTINCT Phage_ID) AS n_phages FROM fact_phages f GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def top_hosts(spark, sf_dir):
    return views.top_by_phages(star(spark, sf_dir)["fact_phages"], "Host")


@on_star("SELECT Lifestyle, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct FROM fact_phages WHERE Lifestyle IN ('F', 'O') GROUP BY 1")
def lifestyle_share(spark, sf_dir):
    return views.share_of_total(star(spark, sf_dir)["fact_phages"].filter(F.col("Lifestyle").isin("F", "O")), "Lifestyle")


@on_star("SELECT COUNT(*) AS n_rows, COUNT(Length) AS n_known, MIN(Length) AS min_value, MAX(Length) AS max_value, ROUND(AVG(Length), 4) AS avg_value, ROUND(MEDIAN(Length), 4) AS median_value FROM fact_phages")
def length_stats(spark, sf_dir):
    return tidy(quality.number_stats(star(spark, sf_dir)["fact_phages"], "Length"))


@on_star("SELECT Phage_ID, Host_ID, CASE WHEN row_number() OVER (ORDER BY Phage_ID, Host_ID) <= COUNT(*) OVER () - CAST(floor(COUNT(*) OVER () * 0.2::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM edges")
def sequential_split(spark, sf_dir):
    return negatives.sequential_split(edges(spark, sf_dir), ["Phage_ID", "Host_ID"])


# Streaming extension: the same windows that run on a stream, over the table.


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    return tidy(windows.tumbling(table(spark, sf_dir, "events"), "1 hour"))


@query("SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS last_event, COUNT(*) AS n FROM (SELECT user_id, ts, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS brk FROM events)) GROUP BY user_id, s")
def event_sessions(spark, sf_dir):
    return windows.sessions(table(spark, sf_dir, "events"), "30 minutes")


@query("SELECT w AS window_start, w + INTERVAL '1 hour' AS window_end, event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM (SELECT event_type, value, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS w FROM events) GROUP BY 1, 2, 3")
def event_sliding(spark, sf_dir):
    return tidy(windows.sliding(table(spark, sf_dir, "events"), "1 hour", "30 minutes"))
