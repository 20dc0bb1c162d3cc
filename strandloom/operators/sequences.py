"""Sequence operators over tables (genome_id, file_pos, contig_id, sequence) and (id, sequence)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import gc_percent, letters
from ..session import pin
from .prefixes import first_with_prefix

MODES = ("first", "concat", "list", "dict")
ORDERS = ("length_desc", "file")


def check_assembly(mode: str, gap: int, order: str) -> None:
    if gap < 0:
        raise ValueError("gap must not be negative")
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _ordered(order: str) -> Column:
    """The contigs of a genome as structs: longest first, ties by id, or by place in the file."""
    if order == "file":
        return F.array_sort(F.collect_list(F.struct("file_pos", "contig_id", "sequence")))
    return F.array_sort(F.collect_list(F.struct((-F.length("sequence")).alias("_rank"), "contig_id", "sequence")))


def assemble_genomes(contigs: DataFrame, mode: str = "concat", gap: int = 100, order: str = "length_desc") -> DataFrame:
    """(genome_id, genome): the first contig, all joined by ``gap`` N, a list or a map of contigs.

    A genome's contigs meet in one row, which any of the results but ``first``
    is itself. ``first`` only keeps the best contig of each task.
    """
    check_assembly(mode, gap, order)
    if mode == "first":
        rank = F.struct("file_pos", "contig_id") if order == "file" else F.struct((-F.length("sequence")).alias("_l"), "contig_id")
        return contigs.groupBy("genome_id").agg(F.min_by("sequence", rank).alias("genome"))
    rows = contigs.groupBy("genome_id").agg(_ordered(order).alias("_c"))
    if mode == "concat":
        genome = F.array_join("_c.sequence", "N" * gap)
    elif mode == "list":
        genome = F.col("_c.sequence")
    else:
        genome = F.map_from_arrays("_c.contig_id", "_c.sequence")
    return rows.select("genome_id", genome.alias("genome"))


def genome_stats(contigs: DataFrame, order: str = "length_desc") -> DataFrame:
    """(genome_id, contig_count, lengths, total_length, longest); sequences do not travel, only their lengths."""
    check_assembly("first", 0, order)
    sizes = contigs.select("genome_id", "file_pos", "contig_id", F.length("sequence").alias("_n"))
    key = F.struct("file_pos", "contig_id", "_n") if order == "file" else F.struct((-F.col("_n")).alias("_r"), "contig_id", "_n")
    return sizes.groupBy("genome_id").agg(
        F.count("*").alias("contig_count"), F.array_sort(F.collect_list(key)).getField("_n").alias("lengths"), F.sum("_n").alias("total_length"), F.max("_n").alias("longest")
    )


def host_genome(contigs: DataFrame, host: str, mode: str = "concat", gap: int = 100, order: str = "length_desc") -> DataFrame:
    """One genome; an unknown id gives no row. Single-record sequences come out the same in every mode."""
    return assemble_genomes(contigs.filter(F.col("genome_id") == host), mode, gap, order)


def host_sequences(contigs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, sequence, Length, GC_Content) of the longest contig of each wanted host; ambiguous letters do not count."""
    chosen = contigs.join(ids.select(F.col("Host_ID").alias("genome_id")).distinct(), "genome_id", "left_semi")
    rows = assemble_genomes(chosen, "first")
    return rows.select(F.col("genome_id").alias("id"), F.col("genome").alias("sequence"), F.length("genome").alias("Length"), gc_percent(F.col("genome"), "remove").alias("GC_Content"))


def by_query(rows: DataFrame, sequences: DataFrame, key: str) -> DataFrame:
    """The result of a user's query with the sequences of its ids, in the query's order; the query must return ``key``."""
    if key not in rows.columns:
        raise ValueError(f"the query must return {key}")
    joined = rows.withColumn("_at", F.monotonically_increasing_id()).join(sequences.select(F.col("id").alias(key), F.col("sequence").alias("Sequence")), key, "left")
    return joined.orderBy("_at").select(*rows.columns, "Sequence")


def by_ids(sequences: DataFrame, ids: list[str]) -> DataFrame:
    """The wanted sequences, in the order asked for."""
    wanted = sequences.sparkSession.createDataFrame([(i, x) for i, x in enumerate(ids)], "_at int, id string")
    return wanted.join(sequences, "id").orderBy("_at").drop("_at")


def proteins_of_phage(proteins: DataFrame, sequences: DataFrame, phage_id: str) -> DataFrame:
    """(id, sequence) of the proteins of one phage that have a sequence."""
    wanted = proteins.filter(F.col("Phage_ID") == phage_id).select(F.col("Protein_ID").alias("id")).distinct()
    return sequences.join(wanted, "id", "left_semi").select("id", "sequence")


def named_by_folder(records: DataFrame) -> DataFrame:
    """FASTA records of many folders as one table: the folder's name before each header; files ending in .fa come first, each kind by path."""
    folder = F.element_at(F.split("file", "/"), -2)
    rows = records.withColumn("kind", F.when(F.col("file").endswith(".fa"), 0).otherwise(1))
    return rows.select("kind", "file", "pos", F.concat_ws(" ", folder, "header").alias("header"), "sequence")


def weighted_gc(records: DataFrame, key: str = "genome_id") -> DataFrame:
    """(key, GC_Content): the mean of the records' GC shares, weighted by length, in percent; 0 for empty genomes.

    A record's share leaves ambiguous letters out and counts S as GC; its weight
    is its whole length, so GGNN beside AT gives 66.67.
    """
    gc, known, n = (F.col(c) for c in ("_gc", "_known", "_n"))
    each = records.select(key, letters(F.col("sequence"), "GCSgcs").alias("_gc"), letters(F.col("sequence"), "ACGTSWUacgtswu").alias("_known"), F.length("sequence").alias("_n"))
    shares = F.sum(F.when(known > 0, gc / known * n).otherwise(F.when(n.isNotNull(), 0.0)))
    return each.groupBy(key).agg(F.when(F.sum(n) > 0, F.round(shares / F.sum(n) * 100, 2)).otherwise(0.0).alias("GC_Content"))


def routed(public: DataFrame, private: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, source_db, sequence): for each wanted (id, source_db, source_type) its sequence by tiers.

    Private tables are (id, source_db, sequence). A private type or the name of
    a private source, without regard to case and blanks, looks into that source
    first; then comes the public table, then every private source.
    """
    norm = lambda c: F.lower(F.trim(c))
    names = private.select(norm(F.col("source_db")).alias("_key")).distinct().withColumn("_own", F.lit(True))
    asked = wanted.withColumn("_key", norm(F.col("source_db"))).join(names, "_key", "left")
    asked = asked.withColumn("_private", F.coalesce("_own", F.lit(False)) | (norm(F.coalesce("source_type", F.lit(""))) == "private")).select("id", "source_db", "_key", "_private")
    table = public.select("id", F.lit(None).cast("string").alias("_source"), "sequence", F.lit(1).alias("_kind")).unionByName(private.select("id", norm(F.col("source_db")).alias("_source"), "sequence", F.lit(2).alias("_kind")))
    tier = F.when((F.col("_kind") == 2) & F.col("_private") & (F.col("_source") == F.col("_key")), 0).when(F.col("_kind") == 1, 1).otherwise(2)
    found = asked.join(table, "id").withColumn("_tier", tier)
    return found.groupBy("id", "source_db").agg(F.min_by("sequence", F.struct("_tier", "_source")).alias("sequence"))


def protein_lookup(wanted: DataFrame, headers: DataFrame) -> DataFrame:
    """(id, header, tier) by three tiers: the exact header, a header that starts with the id, a header with the id's token.

    ``headers`` is (pos, header). A tier only sees the ids that the tiers
    before left over. The token is the second word of the id, or its first if
    it is alone; the first header in the file wins. Beginnings are found on the
    sorted headers, so ids and headers with one common beginning meet in no key.
    """
    ids = wanted.select("id").distinct()
    exact = ids.join(headers, ids["id"] == headers["header"]).groupBy("id").agg(F.min_by("header", "pos").alias("header"), F.lit(1).alias("tier"))
    rest = pin(ids.join(exact, "id", "left_anti"))
    prefix = pin(first_with_prefix(rest.filter("id != ''"), headers.select(F.col("header").alias("text"), "pos")).select("id", F.col("text").alias("header"), F.lit(2).alias("tier")))
    rest = rest.join(prefix, "id", "left_anti")
    token = lambda c: F.coalesce(F.get(F.split(c, r"\s+"), F.lit(1)), F.split(c, r"\s+")[0])
    tokens = headers.groupBy(token(F.col("header")).alias("_t")).agg(F.min_by("header", "pos").alias("header"))
    third = rest.withColumn("_t", token(F.col("id"))).join(tokens, "_t").select("id", "header", F.lit(3).alias("tier"))
    return exact.unionByName(prefix).unionByName(third)


def dedupe_first(records: DataFrame, key: str = "header", order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The first record of each key. Only keys and places are compared; the record joins back on its place."""
    first = records.groupBy(key).agg(F.min(F.struct(*order)).alias("_f")).select(*[F.col(f"_f.{c}").alias(c) for c in order])
    return records.join(first, list(order), "left_semi")


def duplicate_report(records: DataFrame, key: str = "header", value: str = "sequence", order: tuple[str, ...] = ("pos",), top: int | None = 1000) -> DataFrame:
    """(key, identical, different): later records of a repeated key against its first, by MD5; most repeats first."""
    hashed = records.select(key, *order, F.md5(F.col(value).cast("binary")).alias("_h"))
    first = hashed.groupBy(key).agg(F.min_by("_h", F.struct(*order)).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    rows = hashed.join(first, key).groupBy(key).agg((F.sum((F.col("_h") == F.col("_first")).cast("long")) - 1).alias("identical"), F.sum((F.col("_h") != F.col("_first")).cast("long")).alias("different"))
    ranked = rows.orderBy(F.desc(F.col("identical") + F.col("different")), key)
    return ranked.limit(top) if top else rows


def audit_headers(records: DataFrame) -> DataFrame:
    """First words of headers that occur more than once; no records at all are an error."""
    if records.limit(1).count() == 0:
        raise ValueError("there are no records")
    return records.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")


def identical_groups(records: DataFrame, id_col: str, text_col: str, fold_case: bool = False) -> DataFrame:
    """(digest, n, first_id): sequences that more than one record has; ids of a group are not gathered."""
    text = F.upper(text_col) if fold_case else F.col(text_col)
    return records.groupBy(F.md5(text.cast("binary")).alias("digest")).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).filter("n > 1")


def run_qc(records: DataFrame) -> DataFrame:
    """One row per file of (file, id, header, sequence): counts, duplicate headers and, if there are none, identical sequences.

    Examples stop at 5 headers and 3 groups of 3, which is what the report shows.
    """
    total = records.groupBy("file").agg(F.count("*").alias("total_sequences"))
    twice = records.groupBy("file", "id").agg(F.count("*").alias("n")).filter("n > 1")
    headers = twice.withColumn("_r", F.row_number().over(Window.partitionBy("file").orderBy("id"))).groupBy("file").agg(
        F.count("*").alias("n_duplicate_headers"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_r") <= 5, F.col("id")))), "; ").alias("duplicate_header_examples")
    )
    accepted = records.join(headers, "file", "left_anti")
    digest = F.md5(F.upper("sequence").cast("binary"))
    member = accepted.select("file", "id", digest.alias("_h")).withColumn("_m", F.row_number().over(Window.partitionBy("file", "_h").orderBy("id")))
    groups = member.groupBy("file", "_h").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_m") <= 3, F.col("id")))), ", ").alias("_ids")).filter("n > 1")
    same = groups.withColumn("_r", F.row_number().over(Window.partitionBy("file").orderBy("_ids"))).groupBy("file").agg(
        F.count("*").alias("n_identical_seq_groups"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_r") <= 3, F.col("_ids")))), "; ").alias("identical_seq_group_examples")
    )
    out = total.join(headers, "file", "left").join(same, "file", "left")
    rejected = F.col("n_duplicate_headers").isNotNull()
    return out.select(
        "file",
        "total_sequences",
        F.when(rejected, "rejected").otherwise("accepted").alias("header_qc_status"),
        F.coalesce("n_duplicate_headers", F.lit(0)).alias("n_duplicate_headers"),
        F.coalesce("duplicate_header_examples", F.lit("")).alias("duplicate_header_examples"),
        F.when(rejected, "skipped").when(F.col("n_identical_seq_groups").isNotNull(), "duplicates_found").otherwise("ok").alias("seq_qc_status"),
        F.coalesce("n_identical_seq_groups", F.lit(0)).alias("n_identical_seq_groups"),
        F.coalesce("identical_seq_group_examples", F.lit("")).alias("identical_seq_group_examples"),
    )


def per_source_counts(records: DataFrame, source: str = "source_db") -> DataFrame:
    return records.groupBy(source).agg(F.count("*").alias("n_records")).orderBy(F.desc("n_records"), source)


def index_status(files: DataFrame, qc: DataFrame, indexed: DataFrame) -> DataFrame:
    """(file, status) of each host file: already indexed, indexed, rejected for its headers, or failed without records."""
    rows = files.join(qc.select("file", "header_qc_status"), "file", "left").join(indexed.select("file").withColumn("_i", F.lit(True)), "file", "left")
    status = F.when(F.col("_i"), "already_indexed").when(F.col("header_qc_status") == "rejected", "rejected_duplicate_headers").when(F.col("header_qc_status").isNull(), "failed").otherwise("indexed")
    return rows.select("file", status.alias("status"))


def host_mapping(public: DataFrame, private: DataFrame) -> DataFrame:
    """(Host_ID, path): where each host's sequence is; public places win, blank paths do not count, and no host at all is an error."""
    rows = public.select("Host_ID", "path", F.lit(0).alias("_t")).unionByName(private.select("Host_ID", "path", F.lit(1).alias("_t"))).filter("trim(coalesce(path, '')) != ''")
    if rows.limit(1).count() == 0:
        raise ValueError("no host has a sequence")
    return rows.groupBy("Host_ID").agg(F.min_by("path", F.struct("_t", "path")).alias("path"))


def artifact_counts(states: DataFrame) -> DataFrame:
    """(hosts, single, identical, conflicting, files) over the second table of ``private_artifacts``."""
    count = lambda s: F.count(F.when(F.col("state") == s, 1)).alias(s)
    return states.agg(F.count("*").alias("hosts"), count("single"), count("identical"), count("conflicting"), F.coalesce(F.sum("n_files"), F.lit(0)).alias("files"))


def private_artifacts(records: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of wanted hosts, one row per host: copies, and whether they are identical)."""
    chosen = records.join(wanted.select("Host_ID").distinct(), "Host_ID", "left_semi")
    hashed = chosen.groupBy("Host_ID").agg(F.count("*").alias("n_files"), F.countDistinct(F.md5(F.col("sequence").cast("binary"))).alias("_v"))
    return chosen, hashed.select("Host_ID", "n_files", F.when(F.col("n_files") == 1, "single").when(F.col("_v") == 1, "identical").otherwise("conflicting").alias("state"))
