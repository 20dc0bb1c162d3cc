"""Further registered queries: statistics, samples, checks and writes that ``catalog`` does not hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import negatives, pairs, quality, reshape, resolve, sequences
from .adapters import edges, star, table
from .catalog import on_star, query, tidy

HASH = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"


@on_star("SELECT Source_DB, COUNT(*) AS protein_count, COUNT(DISTINCT Phage_ID) AS phage_count, ROUND(AVG(Molecular_weight), 4) AS avg_mw, ROUND(AVG(Isoelectric_point), 4) AS avg_pi, ROUND(COUNT(*) / COUNT(DISTINCT Phage_ID), 4) AS proteins_per_phage FROM dim_proteins WHERE Molecular_weight IS NOT NULL GROUP BY 1")
def protein_stats(spark, sf_dir):
    return tidy(quality.protein_stats(star(spark, sf_dir)["dim_proteins"]))


@on_star("SELECT COUNT(*) AS total_links, COUNT(DISTINCT Phage_ID) AS unique_phages, COUNT(DISTINCT Host_ID) AS unique_host_assemblies FROM edges")
def link_stats(spark, sf_dir):
    return quality.link_stats(edges(spark, sf_dir).withColumnRenamed("Host_ID", "Assembly_Accession"))


@on_star("SELECT source_type, Source_DB, COUNT(*) AS n FROM fact_phages GROUP BY 1, 2")
def type_breakdown(spark, sf_dir):
    return quality.type_breakdown(star(spark, sf_dir)["fact_phages"])


@on_star("SELECT Strand AS kind, COUNT(*) AS n, COUNT(DISTINCT Phage_ID) AS unique_phages, ROUND(AVG(Start), 4) AS avg_start FROM dim_proteins GROUP BY 1 ORDER BY n DESC, 1 LIMIT 25")
def typed_stats(spark, sf_dir):
    found = quality.typed_stats(star(spark, sf_dir)["dim_proteins"], "Strand", "Start", 25)
    return tidy(found.withColumnsRenamed({"Strand": "kind", "avg_Start": "avg_start"}))


PROFILED = {
    "nation": (("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")),
    "documents": (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")),
    "customer": (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")),
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls FROM {name}" for name, columns in PROFILED.items() for c, t in columns))
def table_profile(spark, sf_dir):
    return quality.table_profile({name: table(spark, sf_dir, name) for name in PROFILED})


@query("SELECT o_orderkey, s FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' success ' WHEN 2 THEN '' ELSE 'failed' END AS s FROM orders) WHERE coalesce(nullif(trim(s), ''), 'unknown') NOT IN ('success')")
def failed_rows(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 1, " success ").when(k == 2, "").when(k == 3, "failed").alias("s"))
    return quality.failed(rows, "s")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT({c}) AS n, ROUND(AVG({c}), 2) AS mean, ROUND(STDDEV({c}), 2) AS stddev, CAST(MIN({c}) AS DOUBLE) AS \"min\", ROUND(quantile_cont({c}, 0.25), 2) AS p25, ROUND(quantile_cont({c}, 0.5), 2) AS p50, ROUND(quantile_cont({c}, 0.75), 2) AS p75, CAST(MAX({c}) AS DOUBLE) AS \"max\" FROM lineitem" for c in ("l_quantity", "l_linenumber")))
def described_features(spark, sf_dir):
    return tidy(quality.described(table(spark, sf_dir, "lineitem").select("l_quantity", "l_linenumber", "l_returnflag")), 2)


@query(f"SELECT c_custkey FROM customer WHERE {HASH.format(chr(39) + chr(39) + ' || c_custkey || ' + chr(39) + '|42' + chr(39))} < 429496729")
def percent_sample(spark, sf_dir):
    return negatives.percent_sample(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], 10)


@query("SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey || '|42'), c_custkey) - 1 AS place FROM customer")
def shuffled_rows(spark, sf_dir):
    return negatives.shuffled_places(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "place")


DRAW = HASH.format("i || '|{}|42'")


@on_star(f""", p AS (SELECT Phage_ID, row_number() OVER (ORDER BY Phage_ID) - 1 AS no FROM (SELECT DISTINCT Phage_ID FROM fact_phages)), h AS (SELECT Host_ID, row_number() OVER (ORDER BY Host_ID) - 1 AS no FROM (SELECT DISTINCT Host_ID FROM dim_hosts)),
draws AS (SELECT i, {DRAW.format("p")} % (SELECT COUNT(*) FROM p) AS np, {DRAW.format("h")} % (SELECT COUNT(*) FROM h) AS nh FROM range((SELECT CAST(floor(COUNT(*) / 2) * 10 AS BIGINT) FROM edges)) r(i)),
named AS (SELECT Phage_ID, Host_ID, MIN(i) AS i FROM draws JOIN p ON np = p.no JOIN h ON nh = h.no GROUP BY 1, 2)
SELECT Phage_ID, Host_ID FROM named n WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.Phage_ID = n.Phage_ID AND e.Host_ID = n.Host_ID) ORDER BY i LIMIT (SELECT CAST(floor(COUNT(*) / 2) AS BIGINT) FROM edges)""")
def negatives_by_ratio(spark, sf_dir):
    tables = star(spark, sf_dir)
    return negatives.negatives_for(tables["fact_phages"], tables["dim_hosts"], edges(spark, sf_dir), ratio=0.5)


@query("SELECT o_orderkey AS id, o_orderpriority AS name FROM orders UNION ALL SELECT c_custkey, c_name FROM customer")
def insert_positional(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"))
    return reshape.insert_positional(orders, table(spark, sf_dir, "customer").select("c_custkey", "c_name"))


@query("SELECT o_orderpriority, MIN(o_clerk) FILTER (o_orderstatus = 'F') AS F, MIN(o_clerk) FILTER (o_orderstatus = 'O') AS O, MIN(o_clerk) FILTER (o_orderstatus = 'P') AS P FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS o_clerk FROM orders) GROUP BY 1")
def pivot_values(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string").alias("v"))
    return reshape.pivot(rows, "o_orderpriority", "o_orderstatus", "v", ["F", "O", "P"])


@query("SELECT lang, ROUND(COALESCE(SUM(share * n) / NULLIF(SUM(n), 0), 0) * 100, 1) AS gc FROM (SELECT lang, len(x) AS n, CASE WHEN len(list_filter(x, lambda c: contains('acgtswu', c))) = 0 THEN 0 ELSE len(list_filter(x, lambda c: contains('cgs', c))) / len(list_filter(x, lambda c: contains('acgtswu', c))) END AS share FROM (SELECT lang, list_transform(string_split(text, ''), lambda c: CASE WHEN ascii(c) BETWEEN 65 AND 90 THEN chr(ascii(c) + 32) ELSE c END) AS x FROM documents WHERE text IS NOT NULL)) GROUP BY 1")
def weighted_gc(spark, sf_dir):
    rows = sequences.weighted_gc(table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("lang", F.col("text").alias("sequence")), "lang")
    return rows.select("lang", F.round("GC_Content", 1).alias("gc"))


@query("SELECT 'GCF_' || (s_suppkey + 1000000) || '_1' AS Host_ID, 'GCF_' || (s_suppkey + 1000000) || '.1' AS Assembly_Accession, '/g/GCF_' || (s_suppkey + 1000000) || '.1_genomic.fna' AS path, CASE WHEN s_suppkey % 3 > 0 THEN 'success' ELSE 'failed' END AS status FROM supplier")
def download_status(spark, sf_dir):
    name = F.concat(F.lit("/g/GCF_"), (F.col("s_suppkey") + 1_000_000).cast("string"), F.lit(".1_genomic.fna"))
    return resolve.downloads(table(spark, sf_dir, "supplier").select(name.alias("path"), (F.col("s_suppkey") % 3).alias("size")))


@query("""WITH hosts AS (SELECT o_orderkey, CASE o_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Genus' || k WHEN 2 THEN ' Genus' || k || '   kind' || k || ' ; Other' || k || ' type' WHEN 3 THEN 'unknown bacterium ' || k WHEN 4 THEN '-'
WHEN 5 THEN 'Genus' || k || ' sp' || lpad(k, 9, '0') WHEN 6 THEN '' WHEN 7 THEN ';Genus' || k || ' kind' ELSE 'Genus' || k || ' kind strain ' || k END AS h FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS k FROM orders)),
words AS (SELECT o_orderkey, h, string_split_regex(trim(split_part(h, ';', 1)), '\\s+') AS w FROM hosts)
SELECT o_orderkey, CASE WHEN h IS NULL OR trim(h) IN ('', '-') OR h ILIKE '%unknown%' OR regexp_matches(h, ' sp[0-9]{9}') OR w[1] = '' THEN NULL ELSE array_to_string(w[1:2], ' ') END AS species FROM words""")
def species_names(spark, sf_dir):
    """Hosts of nine forms: none, a genus, several hosts, placeholders, numbered species, a strain."""
    k = F.col("o_custkey").cast("string")
    forms = [
        F.lit(None).cast("string"), F.concat(F.lit("Genus"), k), F.concat(F.lit(" Genus"), k, F.lit("   kind"), k, F.lit(" ; Other"), k, F.lit(" type")), F.concat(F.lit("unknown bacterium "), k), F.lit("-"),
        F.concat(F.lit("Genus"), k, F.lit(" sp"), F.lpad(k, 9, "0")), F.lit(""), F.concat(F.lit(";Genus"), k, F.lit(" kind")), F.concat(F.lit("Genus"), k, F.lit(" kind strain "), k),
    ]
    host = F.element_at(F.array(*forms), (F.col("o_custkey") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", sc.species_name(host).alias("species"))


@on_star("SELECT Host_ID, Species_Name FROM dim_hosts WHERE Host_ID IN (SELECT Host_ID FROM edges WHERE Phage_ID = '1')")
def hosts_of_phage(spark, sf_dir):
    return pairs.hosts_of_phage(star(spark, sf_dir), edges(spark, sf_dir), "1").select("Host_ID", "Species_Name")


@on_star("SELECT pha.Phage_ID, pha.Host_ID, h.Species_Name, p.Source_DB AS Phage_Source, p.Length AS Phage_Length, 'Viruses' AS Phage_Taxonomy, h.Assembly_Level AS Host_Assembly_Level, 'no sequence' AS Failure_Reason FROM (SELECT DISTINCT * FROM edges) pha JOIN fact_phages p ON pha.Phage_ID = p.Phage_ID JOIN dim_hosts h ON pha.Host_ID = h.Host_ID WHERE h.RefSeq_Category = 'na'")
def missing_host_pairs(spark, sf_dir):
    tables = star(spark, sf_dir)
    have = tables["dim_hosts"].filter("RefSeq_Category <> 'na'").select(F.col("Host_ID").alias("id"), F.lit("ACGT").alias("sequence"))
    return pairs.missing_host_pairs(pairs.pair_metadata(tables, edges(spark, sf_dir)), have)


@query("""WITH r AS (SELECT 'f' || doc_id % 40 AS file, CAST(CASE WHEN doc_id % 40 < 20 THEN doc_id % 80 ELSE doc_id END AS VARCHAR) AS id, coalesce(text, '') AS s FROM documents),
d AS (SELECT file, COUNT(*) AS n, array_to_string((list(id ORDER BY id))[1:5], '; ') AS ids FROM (SELECT file, id FROM r GROUP BY 1, 2 HAVING COUNT(*) > 1) GROUP BY 1),
g AS (SELECT file, array_to_string((list(id ORDER BY id))[1:3], ', ') AS ids FROM r WHERE file NOT IN (SELECT file FROM d) GROUP BY file, md5(upper(s)) HAVING COUNT(*) > 1),
h AS (SELECT file, COUNT(*) AS n, array_to_string((list(ids ORDER BY ids))[1:3], '; ') AS ids FROM g GROUP BY 1)
SELECT t.file, total AS total_sequences, CASE WHEN d.n IS NULL THEN 'accepted' ELSE 'rejected' END AS header_qc_status, coalesce(d.n, 0) AS n_duplicate_headers, coalesce(d.ids, '') AS duplicate_header_examples,
CASE WHEN d.n IS NOT NULL THEN 'skipped' WHEN h.n IS NOT NULL THEN 'duplicates_found' ELSE 'ok' END AS seq_qc_status, coalesce(h.n, 0) AS n_identical_seq_groups, coalesce(h.ids, '') AS identical_seq_group_examples
FROM (SELECT file, COUNT(*) AS total FROM r GROUP BY 1) t LEFT JOIN d USING (file) LEFT JOIN h USING (file)""")
def header_qc(spark, sf_dir):
    number = F.col("doc_id")
    name = F.when(number % 40 < 20, number % 80).otherwise(number)
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("f"), (number % 40).cast("string")).alias("file"), name.cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("sequence"))
    return sequences.run_qc(rows)
