"""Host resolution: candidates, ranked assemblies, links and the status report, against a supplied catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import assembly_score, base_confidence, best_identifier, confidence, host_id, host_tokens, is_refseq, link_quality, resolution_source, species_name, strip, valid_host
from ..session import pin
from ..sources.versions import KeyedTable


def candidates(phages: DataFrame) -> DataFrame:
    """(Phage_ID, Host_Raw, Host_Token, Token_Type, Token_Order) of every usable part of the Host column."""
    rows = phages.select("Phage_ID", F.col("Host").alias("Host_Raw"), F.explode(host_tokens(F.col("Host"))).alias("t"))
    return rows.select("Phage_ID", "Host_Raw", F.col("t.token").alias("Host_Token"), F.col("t.token_type").alias("Token_Type"), F.col("t.token_order").alias("Token_Order"))


def unique_tokens(rows: DataFrame) -> DataFrame:
    """Each token once, with the type of its first candidate."""
    return rows.groupBy("Host_Token").agg(F.min_by("Token_Type", F.struct("Phage_ID", "Token_Order")).alias("Token_Type"))


def ranked_assemblies(catalog: DataFrame, top: int | None = None) -> DataFrame:
    """Catalog rows with Quality_Score and Resolution_Rank in their token; tokens with any RefSeq assembly lose the others."""
    scored = catalog.withColumn("Quality_Score", assembly_score(F.col("refseq_category"), F.col("assembly_level"), F.col("is_latest"))).withColumn("_ref", is_refseq(F.col("assembly_accession")))
    best = scored.groupBy("token").agg(F.max("_ref").alias("_any"))
    kept = scored.join(best, "token").filter(F.col("_ref") | ~F.col("_any")).drop("_ref", "_any")
    ranked = kept.withColumn("Resolution_Rank", F.row_number().over(Window.partitionBy("token").orderBy(F.desc("Quality_Score"), "assembly_accession")))
    return ranked.filter(F.col("Resolution_Rank") <= top) if top else ranked


def bacterial_only(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assemblies that are not known to be something else, tokens that lost all of theirs)."""
    kept = catalog.filter(F.coalesce("is_bacterial", F.lit(True)))
    return kept, catalog.select("token").distinct().join(kept.select("token"), "token", "left_anti")


def assembly_links(rows: DataFrame, ranked: DataFrame) -> DataFrame:
    """Candidates with each of their token's assemblies: source, confidence by rank, and whether there are several."""
    several = ranked.groupBy("token").agg(F.count("*").alias("_n"))
    joined = rows.join(ranked.join(several, "token"), F.col("Host_Token") == F.col("token"))
    return joined.select(
        *rows.columns,
        F.col("assembly_accession").alias("Assembly_Accession"),
        resolution_source(F.col("Token_Type")).alias("Resolution_Source"),
        "Resolution_Rank",
        confidence(base_confidence(F.col("Token_Type")), F.col("Resolution_Rank")).alias("Confidence"),
        F.col("assembly_level").alias("Assembly_Level"),
        F.col("refseq_category").alias("RefSeq_Category"),
        "Quality_Score",
        (F.col("_n") > 1).alias("Ambiguous"),
        F.when(F.col("_n") > 1, F.concat(F.col("_n").cast("string"), F.lit(" assemblies found"))).otherwise("").alias("Ambiguity_Reason"),
    )


def unique_assemblies(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("assembly_accession").agg(*[F.min_by(c, F.struct("token", "Resolution_Rank")).alias(c) for c in ranked.columns if c != "assembly_accession"])


def phage_host_links(links: DataFrame) -> DataFrame:
    """Distinct (phage, assembly) with the first token's description and the quality of the link."""
    first = links.groupBy("Phage_ID", "Assembly_Accession").agg(F.min(F.struct("Token_Order", "Host_Token", "Host_Raw", "Assembly_Level", "RefSeq_Category")).alias("f"))
    return first.select(
        "Phage_ID", F.coalesce(species_name(F.col("f.Host_Token")), F.lit("-")).alias("Host_Species"), F.col("f.Host_Raw").alias("Host_Full_Name"), "Assembly_Accession", F.col("f.Assembly_Level").alias("Assembly_Level"),
        F.col("f.RefSeq_Category").alias("RefSeq_Category"), link_quality(F.col("Assembly_Accession")).alias("Link_Quality"),
    )


def best_per_token(links: DataFrame) -> DataFrame:
    """The best-ranked assembly of each (phage, token)."""
    return links.withColumn("_r", F.row_number().over(Window.partitionBy("Phage_ID", "Host_Token").orderBy("Resolution_Rank", "Assembly_Accession"))).filter("_r = 1").drop("_r")


def status_report(rows: DataFrame, links: DataFrame, metadata: DataFrame, qc: DataFrame) -> DataFrame:
    """Candidates with their best assembly, its download status and its FASTA check; ``qc`` is (Host_ID, qc_status)."""
    best = best_per_token(links).select("Phage_ID", "Host_Token", "Assembly_Accession", "Resolution_Source", "Resolution_Rank", "Confidence").withColumn("Host_ID", host_id(F.col("Assembly_Accession")))
    status = metadata.groupBy("Assembly_Accession").agg(F.max("Download_Status").alias("Download_Status"))
    return rows.join(best, ["Phage_ID", "Host_Token"], "left").join(status, "Assembly_Accession", "left").join(qc, "Host_ID", "left")


def status_funnel(report: DataFrame) -> DataFrame:
    """Distinct phages in all, resolved, downloaded, indexed and rejected."""
    at = lambda c: F.countDistinct(F.when(c, F.col("Phage_ID")))
    return report.agg(
        F.countDistinct("Phage_ID").alias("phages"), at(F.col("Assembly_Accession").isNotNull()).alias("resolved"), at(F.col("Download_Status") == "success").alias("downloaded"),
        at(F.col("qc_status").isin("indexed", "already_indexed")).alias("indexed"), at(F.col("qc_status").startswith("rejected")).alias("rejected"),
    )


def unique_hosts(phages: DataFrame) -> DataFrame:
    return phages.filter(valid_host(F.col("Host"))).select(strip(F.col("Host")).alias("Host")).distinct().orderBy("Host")


def best_identifiers(phages: DataFrame) -> DataFrame:
    return phages.filter(valid_host(F.col("Host"))).select(best_identifier(F.col("Host")).alias("identifier")).dropna().distinct().orderBy("identifier")


def links_by_species(phages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(Phage_ID, Host_ID) of hosts with the species that the phage's host field begins with."""
    return phages.select("Phage_ID", species_name(F.col("Host")).alias("_s")).join(hosts.select(F.col("Species_Name").alias("_s"), "Host_ID"), "_s").select("Phage_ID", "Host_ID").distinct()


def unresolved(tokens: DataFrame, cache: DataFrame) -> DataFrame:
    """Tokens that the resolution cache does not have yet."""
    return tokens.join(cache.select(F.col("token").alias("Host_Token")).distinct(), "Host_Token", "left_anti")


def upsert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` with ``rows`` in place of those with equal keys."""
    return table.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def resolution_cache(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """(token, assemblies) of every token that was ever looked up, on disk; tokens without any assembly have an empty list."""
    return KeyedTable(spark, path, ["token"], buckets)


def resolve_tokens(tokens: DataFrame, catalog: DataFrame, cache: KeyedTable, top: int = 100) -> DataFrame:
    """(token, and a row for each of its assemblies with its rank): from the cache what it has, the rest from the catalog, which the cache then keeps.

    ``top`` assemblies of a token at most are kept. Only the parts of the cache
    that new tokens fall into are rewritten.
    """
    wanted = tokens.select(F.col("Host_Token").alias("token")).filter("token IS NOT NULL").distinct()
    known = cache.lookup(wanted)
    missing = pin(wanted if known is None else wanted.join(known.select("token"), "token", "left_anti"))
    if not missing.isEmpty():
        ranked = ranked_assemblies(catalog.join(missing, "token", "left_semi"), top)
        one = F.struct("Resolution_Rank", *[c for c in ranked.columns if c not in ("token", "Resolution_Rank")])
        nested = missing.join(ranked, "token", "left").groupBy("token").agg(F.array_sort(F.collect_list(F.when(F.col("Resolution_Rank").isNotNull(), one))).alias("assemblies"))
        cache.upsert(nested)
    return cache.lookup(wanted).select("token", F.inline("assemblies"))


def genome_cache(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """Host records with ``path`` and ``status``, one per Host_ID, on disk."""
    return KeyedTable(spark, path, ["Host_ID"], buckets)


def record_downloads(cache: KeyedTable, records: DataFrame, done: DataFrame) -> int:
    """Put the outcome of downloads into the genome cache; ``done`` is (Host_ID, path, status). Returns how many parts were rewritten."""
    return cache.upsert(records.join(done.select("Host_ID", "path", "status"), "Host_ID"))


def assembly_records(assemblies: DataFrame, downloads: DataFrame, download_date: str, metadata_only: bool = False) -> DataFrame:
    """Rows of the assembly table, 17 columns; ``downloads`` is (Assembly_Accession, status). Without any download, as when only metadata is wanted, all are successes."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-")) if c in assemblies.columns else F.lit("-")
    own = lambda c, kind: F.col(c).cast(kind) if c in assemblies.columns else F.lit(None).cast(kind)
    status = downloads.groupBy(F.col("Assembly_Accession").alias("assembly_accession")).agg(F.max("status").alias("_status"))
    level, category, latest = F.coalesce(own("assembly_level", "string"), F.lit("Contig")), F.coalesce(own("refseq_category", "string"), F.lit("na")), F.coalesce(own("is_latest", "boolean"), F.lit(True))
    rows = assemblies.join(status, "assembly_accession", "left")
    return rows.select(
        F.col("assembly_accession").alias("Assembly_Accession"), own("assembly_name", "string").alias("Assembly_Name"), own("organism_name", "string").alias("Organism_Name"), own("species_taxid", "long").alias("Species_TaxID"),
        text("strain").alias("Strain"), level.alias("Assembly_Level"), category.alias("RefSeq_Category"), text("biosample").alias("BioSample"), text("bioproject").alias("BioProject"), text("ftp_path").alias("FTP_Path"),
        text("submission_date").alias("Submission_Date"), latest.alias("Is_Latest"), assembly_score(category, level, latest).alias("Quality_Score"), is_refseq(F.col("assembly_accession")).alias("Is_RefSeq"),
        F.when(F.lit(metadata_only) | (F.col("_status") == "success"), "success").otherwise("failed").alias("Download_Status"), F.lit(download_date).alias("Download_Date"), F.lit(metadata_only).alias("Metadata_Only"),
    )


def host_records(assemblies: DataFrame, download_date: str, source: str = "assembly_resolver") -> DataFrame:
    """Rows of the host table; what is missing is a dash."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return assemblies.select(
        host_id(F.col("assembly_accession")).alias("Host_ID"), text("organism_name").alias("Species_Name"), text("strain").alias("Strain_Name"), text("assembly_accession").alias("Assembly_Accession"),
        text("assembly_name").alias("Assembly_Name"), text("assembly_level").alias("Assembly_Level"), text("refseq_category").alias("RefSeq_Category"), F.lit(download_date).alias("Download_Date"), F.lit(source).alias("Source"),
        *[text(c).alias(c) for c in ("Genome_Length", "GC_Content") if c in assemblies.columns],
    )


def downloads(files: DataFrame) -> DataFrame:
    """(Host_ID, Assembly_Accession, path, status) of genome files (path, size): the accession is in the file's name; empty files failed."""
    name = F.element_at(F.split("path", "/"), -1)
    accession = F.nullif(F.regexp_extract(name, r"(GC[AF]_\d+\.\d+)", 1), F.lit(""))
    status = F.when(F.col("size") > 0, "success").otherwise("failed")
    return files.select(F.coalesce(host_id(accession), F.regexp_replace(name, r"\.[^.]*$", "")).alias("Host_ID"), accession.alias("Assembly_Accession"), "path", status.alias("status"))


def to_download(wanted: DataFrame, done: DataFrame, key: str = "Assembly_Accession") -> DataFrame:
    """The wanted rows without a successful download: a run that stopped goes on where it was."""
    return wanted.join(done.filter("status = 'success'").select(key).distinct(), key, "left_anti")


def cached_genomes(cache: DataFrame, species: str | None = None) -> DataFrame:
    """Successful rows of the genome cache, of one species if asked for."""
    rows = cache.filter("status = 'success'")
    return rows if species is None else rows.filter(F.col("Species_Name") == species)
