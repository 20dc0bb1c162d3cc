"""The star over the test tables: which of their columns play which role."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same roles in SQL, for the oracles. Every oracle may start with this text.
STAR_SQL = """
WITH fact_phages AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Phage_ID, o_orderpriority AS Source_DB, CAST(floor(o_totalprice) AS INTEGER) AS Length,
         CAST(o_custkey % 61 + 20 AS DOUBLE) AS GC_content, 'Host ' || CAST(o_custkey % 40 AS VARCHAR) AS Host, o_orderstatus AS Lifestyle,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Complete' ELSE 'Partial' END AS Completeness, 'C' || CAST(o_custkey % 10 AS VARCHAR) AS Cluster,
         CASE WHEN o_orderstatus = 'P' THEN ' Private' WHEN o_orderstatus = 'F' THEN 'phagescope' ELSE 'public' END AS source_type, o_orderdate AS released
  FROM orders),
line AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS Phage_ID, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS item_id, 'S' || CAST(l_suppkey % 7 AS VARCHAR) AS Source_DB, l.*
  FROM lineitem l),
dim_proteins AS (
  SELECT Phage_ID, item_id AS Protein_ID, Source_DB, l_linenumber * 100 AS "Start", l_returnflag AS Strand, l_linestatus || l_returnflag AS Protein_classification,
         l_extendedprice AS Molecular_weight, l_discount AS Aromaticity, l_tax AS Instability_index, 4 + l_quantity / 10 AS Isoelectric_point FROM line),
dim_antimicrobial_resistance_genes AS (SELECT Phage_ID, item_id AS Protein_ID, 'card' || CAST(l_partkey % 50 AS VARCHAR) AS aligned_protein_card, Source_DB FROM line WHERE l_returnflag = 'R'),
dim_anti_crispr AS (SELECT Phage_ID, item_id AS Protein_ID, Source_DB FROM line WHERE l_returnflag = 'A'),
dim_crispr_arrays AS (
  SELECT Phage_ID, item_id AS crispr_id, Source_DB, CAST(l_quantity AS INTEGER) AS spacers_count, l_linenumber AS evidence_level, CAST(floor(l_extendedprice) AS INTEGER) AS crispr_length,
         CAST(l_quantity * 2 AS INTEGER) AS repeat_length, l_discount * 100 AS mean_spacer_size, l_tax * 100 AS conservation_repeats_pct FROM line WHERE l_linestatus = 'O'),
dim_virulent_factors AS (SELECT Phage_ID, item_id AS Protein_ID, Source_DB FROM line WHERE l_quantity > 40),
dim_transmembrane_proteins AS (SELECT Phage_ID, item_id AS Protein_ID, Source_DB FROM line WHERE l_linenumber = 2),
dim_trna_tmrna AS (SELECT Phage_ID, item_id AS trna_tmrna_id, Source_DB FROM line WHERE l_linenumber = 1),
dim_terminators AS (SELECT Phage_ID, 'T' || CAST(l_suppkey % 5 AS VARCHAR) AS terminator_type, Source_DB FROM line WHERE l_linenumber = 3),
dim_hosts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS Host_ID, c_mktsegment AS Species_Name, 'GCF_' || CAST(c_custkey AS VARCHAR) AS Assembly_Accession,
         CASE c_nationkey % 4 WHEN 0 THEN 'Complete Genome' WHEN 1 THEN 'Chromosome' WHEN 2 THEN 'Scaffold' ELSE 'Contig' END AS Assembly_Level,
         CAST(floor(c_acctbal + 1000) AS BIGINT) * 100 AS Genome_Length, CAST(c_custkey % 41 + 30 AS DOUBLE) AS GC_Content,
         CASE WHEN c_custkey % 5 = 0 THEN 'reference genome' ELSE 'na' END AS RefSeq_Category FROM customer),
edges AS (SELECT CAST(o_orderkey AS VARCHAR) AS Phage_ID, CAST(o_custkey AS VARCHAR) AS Host_ID FROM orders)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star tables as lazy projections; each query reads only the columns it uses."""
    orders, lineitem, customer = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    text = lambda c: F.col(c).cast("string")
    fact = orders.select(
        text("o_orderkey").alias("Phage_ID"),
        F.col("o_orderpriority").alias("Source_DB"),
        F.floor("o_totalprice").cast("int").alias("Length"),
        (F.col("o_custkey") % 61 + 20).cast("double").alias("GC_content"),
        F.lit("Viruses").alias("Taxonomy"),
        F.concat(F.lit("Host "), (F.col("o_custkey") % 40).cast("string")).alias("Host"),
        F.col("o_orderstatus").alias("Lifestyle"),
        F.when(F.col("o_orderkey") % 3 == 0, "Complete").otherwise("Partial").alias("Completeness"),
        F.concat(F.lit("C"), (F.col("o_custkey") % 10).cast("string")).alias("Cluster"),
        F.lit(None).cast("string").alias("Subcluster"),
        F.when(F.col("o_orderstatus") == "P", " Private").when(F.col("o_orderstatus") == "F", "phagescope").otherwise("public").alias("source_type"),
        F.col("o_orderdate").alias("released"),
    )
    line = lineitem.withColumns(
        {
            "Phage_ID": text("l_orderkey"),
            "item_id": F.concat_ws("-", text("l_orderkey"), text("l_linenumber")),
            "Source_DB": F.concat(F.lit("S"), (F.col("l_suppkey") % 7).cast("string")),
        }
    )
    item = lambda name, where, *more: line.filter(where).select("Phage_ID", F.col("item_id").alias(name), "Source_DB", *more)
    return {
        "fact_phages": fact,
        "dim_proteins": item(
            "Protein_ID", "true", (F.col("l_linenumber") * 100).alias("Start"), F.col("l_returnflag").alias("Strand"), F.concat("l_linestatus", "l_returnflag").alias("Protein_classification"),
            F.col("l_extendedprice").alias("Molecular_weight"), F.col("l_discount").alias("Aromaticity"), F.col("l_tax").alias("Instability_index"), (4 + F.col("l_quantity") / 10).alias("Isoelectric_point"),
        ),
        "dim_antimicrobial_resistance_genes": item("Protein_ID", "l_returnflag = 'R'", F.concat(F.lit("card"), (F.col("l_partkey") % 50).cast("string")).alias("aligned_protein_card")),
        "dim_anti_crispr": item("Protein_ID", "l_returnflag = 'A'"),
        "dim_crispr_arrays": item(
            "crispr_id", "l_linestatus = 'O'", F.col("l_quantity").cast("int").alias("spacers_count"), F.col("l_linenumber").alias("evidence_level"), F.floor("l_extendedprice").cast("int").alias("crispr_length"),
            (F.col("l_quantity") * 2).cast("int").alias("repeat_length"), (F.col("l_discount") * 100).alias("mean_spacer_size"), (F.col("l_tax") * 100).alias("conservation_repeats_pct"),
        ),
        "dim_virulent_factors": item("Protein_ID", "l_quantity > 40"),
        "dim_transmembrane_proteins": item("Protein_ID", "l_linenumber = 2"),
        "dim_trna_tmrna": item("trna_tmrna_id", "l_linenumber = 1"),
        "dim_terminators": line.filter("l_linenumber = 3").select("Phage_ID", F.concat(F.lit("T"), (F.col("l_suppkey") % 5).cast("string")).alias("terminator_type"), "Source_DB"),
        "dim_hosts": customer.select(
            text("c_custkey").alias("Host_ID"),
            F.col("c_mktsegment").alias("Species_Name"),
            F.lit(None).cast("string").alias("Strain_Name"),
            F.concat(F.lit("GCF_"), text("c_custkey")).alias("Assembly_Accession"),
            F.element_at(F.array(*[F.lit(x) for x in ("Complete Genome", "Chromosome", "Scaffold", "Contig")]), F.col("c_nationkey") % 4 + 1).alias("Assembly_Level"),
            (F.floor(F.col("c_acctbal") + 1000).cast("long") * 100).alias("Genome_Length"),
            (F.col("c_custkey") % 41 + 30).cast("double").alias("GC_Content"),
            F.when(F.col("c_custkey") % 5 == 0, "reference genome").otherwise("na").alias("RefSeq_Category"),
        ),
    }


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("Phage_ID"), F.col("o_custkey").cast("string").alias("Host_ID"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as genomes whose turns are contigs."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("genome_id"), F.col("turn").alias("file_pos"), F.col("turn").alias("contig_id"), F.col("text").alias("sequence"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sequence records."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("sequence"), F.col("source").alias("source_db"), "lang", F.col("doc_id").alias("pos"))
