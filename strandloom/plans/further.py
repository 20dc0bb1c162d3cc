"""Registered queries of resolution, routing, repair and exact quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import negatives, pairs, prefixes, quality, quantiles, reshape, resolve, sequences, views
from .adapters import edges, star, table
from .catalog import CATALOG, PAIRS, PICKED, TOKENS, _links, _negatives, host_catalog, on_star, query, raw_hosts, tidy


@query(TOKENS + " SELECT Host_Token, MIN(Token_Type) AS Token_Type FROM tokens GROUP BY 1")
def unique_tokens(spark, sf_dir):
    return resolve.unique_tokens(resolve.candidates(raw_hosts(spark, sf_dir)))


@query(TOKENS + CATALOG + " SELECT accession AS assembly_accession, MIN(token) AS token, CAST(arg_min(rk, token) AS INTEGER) AS Resolution_Rank FROM ranked GROUP BY 1")
def unique_assemblies(spark, sf_dir):
    return resolve.unique_assemblies(resolve.ranked_assemblies(host_catalog(spark, sf_dir))).select("assembly_accession", "token", "Resolution_Rank")


@query(TOKENS + CATALOG + " SELECT DISTINCT Phage_ID, Host_Raw AS Host_Full_Name, Assembly_Accession, CASE WHEN Assembly_Accession LIKE 'GCF%' THEN 'direct' ELSE 'genbank' END AS Link_Quality FROM links")
def phage_host_links(spark, sf_dir):
    return resolve.phage_host_links(_links(spark, sf_dir)).select("Phage_ID", "Host_Full_Name", "Assembly_Accession", "Link_Quality")


@query(TOKENS + CATALOG + ", kept AS (SELECT token, accession FROM cat WHERE level <> 'Chromosome') SELECT token, COUNT(*) AS n FROM kept GROUP BY 1 UNION ALL SELECT DISTINCT token, 0 FROM cat WHERE token NOT IN (SELECT token FROM kept)")
def bacterial_only(spark, sf_dir):
    """Assemblies left of each token when chromosomes count as something else and contigs as unknown."""
    level = F.col("assembly_level")
    kept, lost = resolve.bacterial_only(host_catalog(spark, sf_dir).withColumn("is_bacterial", F.when(level == "Chromosome", False).when(level == "Complete Genome", True)))
    return kept.groupBy("token").agg(F.count("*").alias("n")).unionAll(lost.select("token", F.lit(0).cast("long")))


@query(TOKENS + CATALOG + " SELECT accession AS Assembly_Accession, level AS Assembly_Level, category AS RefSeq_Category, CAST(MAX(score) AS INTEGER) AS Quality_Score, accession LIKE 'GCF%' AS Is_RefSeq, CASE WHEN level = 'Contig' THEN 'failed' ELSE 'success' END AS Download_Status, '-' AS BioSample FROM ranked GROUP BY ALL")
def assembly_records(spark, sf_dir):
    rows = resolve.unique_assemblies(resolve.ranked_assemblies(host_catalog(spark, sf_dir))).withColumn("organism_name", F.col("token"))
    done = rows.select(F.col("assembly_accession").alias("Assembly_Accession"), F.when(F.col("assembly_level") == "Contig", "failed").otherwise("success").alias("status"))
    found = resolve.assembly_records(rows.drop("token"), done, "2024-01-01")
    return found.select("Assembly_Accession", "Assembly_Level", "RefSeq_Category", "Quality_Score", "Is_RefSeq", "Download_Status", "BioSample")


@query("SELECT 'documents' AS side, COUNT(*) AS n, SUM(doc_id)::BIGINT AS ids FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'labels', COUNT(*), COALESCE(SUM(doc_id), 0)::BIGINT FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def mismatch_report(spark, sf_dir):
    sides = zip(("documents", "labels"), quality.mismatches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"), strict=True)
    first, second = (ids.agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_id"), F.lit(0)).alias("ids")).select(F.lit(name).alias("side"), "n", "ids") for name, ids in sides)
    return first.unionAll(second)


@query("""WITH pub AS (SELECT doc_id AS id, md5(text) AS s FROM documents WHERE doc_id % 2 = 0),
priv AS (SELECT doc_id AS id, CASE WHEN doc_id % 9 = 0 THEN 'elsewhere' ELSE lower(trim(source)) END AS src, 'p' || doc_id AS s FROM documents WHERE doc_id % 3 = 0),
asked AS (SELECT doc_id AS id, source AS source_db, lower(trim(source)) AS k, coalesce(lower(trim(source)) IN (SELECT src FROM priv WHERE src IS NOT NULL), false) OR doc_id % 5 = 0 AS own FROM documents),
found AS (SELECT id, source_db, s, 1 AS tier, NULL AS src FROM asked JOIN pub USING (id) UNION ALL SELECT id, source_db, s, CASE WHEN own AND src = k THEN 0 ELSE 2 END, src FROM asked JOIN priv USING (id))
SELECT CAST(id AS VARCHAR) AS id, source_db, s AS sequence FROM (SELECT *, row_number() OVER (PARTITION BY id, source_db ORDER BY tier, src NULLS FIRST) AS r FROM found) WHERE r = 1""")
def routed_sequences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    public = docs.filter("doc_id % 2 = 0").select("id", F.md5(F.col("text").cast("binary")).alias("sequence"))
    private = docs.filter("doc_id % 3 = 0").select("id", F.when(F.col("doc_id") % 9 == 0, "elsewhere").otherwise(F.col("source")).alias("source_db"), F.concat(F.lit("p"), "id").alias("sequence"))
    wanted = docs.select("id", F.col("source").alias("source_db"), F.when(F.col("doc_id") % 5 == 0, " Private").otherwise("public").alias("source_type"))
    return sequences.routed(public, private, wanted)


@on_star("SELECT f.Phage_ID, f.Host AS Host_Name, h.Host_ID, h.Species_Name FROM fact_phages f JOIN (SELECT Host_ID, 'Host ' || Host_ID AS Species_Name FROM dim_hosts) h ON starts_with(f.Host, h.Species_Name)")
def phage_host_genomes(spark, sf_dir):
    tables = star(spark, sf_dir)
    hosts = tables["dim_hosts"].withColumn("Species_Name", F.concat(F.lit("Host "), "Host_ID"))
    return views.phage_host_genomes(tables | {"dim_hosts": hosts}).select("Phage_ID", "Host_Name", "Host_ID", "Species_Name")


@on_star("SELECT f.Phage_ID, h.Host_ID FROM fact_phages f JOIN dim_hosts h ON h.Host_ID = split_part(f.Host, ' ', 2) GROUP BY ALL")
def links_by_species(spark, sf_dir):
    """Hosts named by what species names are cut to: the first two words."""
    tables = star(spark, sf_dir)
    return resolve.links_by_species(tables["fact_phages"], tables["dim_hosts"].withColumn("Species_Name", F.concat(F.lit("Host "), "Host_ID")))


@query("WITH m AS (SELECT event_type AS feature, user_id AS source_key, strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(event_id AS VARCHAR), 12, '0') AS retrieved_at, 'f' || (event_id % 3) AS schema_fingerprint, event_id FROM events WHERE event_id % 4 <> 0) SELECT event_id, schema_fingerprint, previous FROM (SELECT *, lag(schema_fingerprint) OVER (PARTITION BY feature, source_key ORDER BY retrieved_at) AS previous FROM m) WHERE previous <> schema_fingerprint")
def fingerprint_drift(spark, sf_dir):
    number = F.col("event_id")
    manifest = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feature"), F.col("user_id").alias("source_key"), F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lpad(number.cast("string"), 12, "0")).alias("retrieved_at"),
        F.concat(F.lit("f"), (number % 3).cast("string")).alias("schema_fingerprint"), F.when(number % 4 == 0, "failed").otherwise("success").alias("status"), "event_id",
    )
    return reshape.fingerprint_drift(manifest).select("event_id", "schema_fingerprint", "previous")


@on_star("SELECT Phage_ID, Source_DB, kind AS source_type FROM (SELECT *, CASE WHEN Lifestyle = 'P' THEN 'private' WHEN Lifestyle = 'F' THEN 'public' END AS kind FROM fact_phages) WHERE NOT (coalesce(kind, '') = 'private' AND Source_DB IN ('1-URGENT', '2-HIGH')) UNION ALL SELECT 'new' || Phage_ID, Source_DB, 'private' FROM fact_phages WHERE Lifestyle = 'P' AND Source_DB = '1-URGENT'")
def replaced_sources(spark, sf_dir):
    fact = star(spark, sf_dir)["fact_phages"].select("Phage_ID", "Source_DB", F.when(F.col("Lifestyle") == "P", "private").when(F.col("Lifestyle") == "F", "public").alias("source_type"))
    fresh = fact.filter("source_type = 'private' AND Source_DB = '1-URGENT'").withColumn("Phage_ID", F.concat(F.lit("new"), "Phage_ID"))
    return reshape.replace_sources(fact, fresh, ["1-URGENT", "2-HIGH"])


QUANTILES = "SELECT l_returnflag, '{0}' AS column_name, CAST({1} AS DOUBLE) AS share, ROUND(quantile_cont({0}, {1}), 4) AS value FROM lineitem GROUP BY 1"


@query(" UNION ALL ".join(QUANTILES.format(c, s) for c in ("l_quantity", "l_extendedprice", "l_tax") for s in (0.1, 0.5, 0.99)))
def grouped_quantiles(spark, sf_dir):
    return tidy(quantiles.exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], [0.1, 0.5, 0.99], ["l_returnflag"]))


@query("SELECT w.id, arg_min(p.p_name, p.p_partkey) AS text FROM (SELECT DISTINCT substr(p_name, 1, CAST(p_partkey % 12 + 1 AS BIGINT)) AS id FROM part) w JOIN part p ON starts_with(p.p_name, w.id) GROUP BY w.id")
def first_by_beginning(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    ids = parts.select(F.expr("substr(p_name, 1, cast(p_partkey % 12 + 1 as int))").alias("id"))
    return prefixes.first_with_prefix(ids, parts.select(F.col("p_name").alias("text"), F.col("p_partkey").alias("pos")))


@on_star(PAIRS + " WHERE p.Source_DB ILIKE '%urgent%' AND h.Species_Name ILIKE 'b%'")
def pairs_ilike_filter(spark, sf_dir):
    return pairs.pair_metadata(star(spark, sf_dir), edges(spark, sf_dir), phage_filters={"Source_DB": ("ilike", "%urgent%")}, host_filters={"Species_Name": ("ilike", "b%")})


ORDER = "ORDER BY md5(Phage_ID || '|' || Host_ID || '|42'), Phage_ID, Host_ID"


@on_star(PICKED + f""", good AS (SELECT DISTINCT Phage_ID, Host_ID FROM edges),
far AS (SELECT n.Phage_ID, n.Host_ID FROM negatives n JOIN fact_phages f USING (Phage_ID) JOIN dim_hosts h USING (Host_ID) WHERE abs(f.GC_content - h.GC_Content) >= 20),
a AS (SELECT * FROM far {ORDER} LIMIT (SELECT COUNT(*) // 2 FROM good)),
b AS (SELECT * FROM (SELECT * FROM negatives n WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.Phage_ID = n.Phage_ID AND a.Host_ID = n.Host_ID)) {ORDER} LIMIT (SELECT COUNT(*) - COUNT(*) // 2 FROM good))
SELECT Phage_ID, Host_ID, 1 AS label FROM good UNION ALL SELECT Phage_ID, Host_ID, 0 FROM a UNION ALL SELECT Phage_ID, Host_ID, 0 FROM b""")
def balanced_mixed(spark, sf_dir):
    """Two kinds of negatives: half by distance of their GC shares, the rest at random."""
    tables, drawn = star(spark, sf_dir), _negatives(spark, sf_dir)
    return negatives.balanced_dataset(edges(spark, sf_dir), [negatives.gc_negatives(drawn, tables["fact_phages"], tables["dim_hosts"]), drawn])
