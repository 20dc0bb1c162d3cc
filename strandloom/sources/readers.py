"""Delimited, FASTA, GFF3 and JSON sources. Files are read by Spark, so from any file system."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_token, number, source_from_path, stem_of_path, strip
from ..operators.reshape import normalize
from ..schemas import CONTRACTS, RENAMED, TABLES, schema
from .files import is_empty_or_invalid


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a delimited file; none if it is missing, empty or unreadable."""
    try:
        first = spark.read.text(path).limit(1).collect()
    except Exception:  # noqa: BLE001  any failure means that there is no header
        return []
    return [c.strip() for c in next(csv.reader([first[0][0]], delimiter=sep))] if first and first[0][0].strip() else []


def has_line_breaks(spark: SparkSession, paths: list[str]) -> bool:
    """Whether a quoted field of a delimited file may go over a line's end: some line has an odd number of quotes."""
    return not spark.read.text(paths).filter(F.length("value") % 2 != F.length(F.replace("value", F.lit('"'), F.lit(""))) % 2).isEmpty()


def delimited(spark: SparkSession, paths: str | list[str], sep: str = ",", keep_empty: bool = False, columns: list[str] | None = None, line_breaks: bool | None = None) -> DataFrame:
    """Every column as text: quoted fields may hold separators, doubled quotes and line breaks; short rows are filled with nulls, broken ones kept.

    With ``keep_empty`` empty fields are empty texts instead of nulls. Of
    columns with one name the first counts. A file is read in splits unless
    quoted fields hold line breaks, for then only a whole file tells where rows
    begin; ``line_breaks`` says so, and if it does not, one pass over the lines does.
    """
    paths = [paths] if isinstance(paths, str) else paths
    names = columns or header(spark, paths[0], sep)
    if not names:
        raise ValueError(f"no header in {paths[0]}")
    whole = has_line_breaks(spark, paths) if line_breaks is None else line_breaks
    reader = spark.read.schema(", ".join(f"_{i} string" for i in range(len(names)))).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", whole).option("mode", "PERMISSIVE")
    rows = reader.option("enforceSchema", True).csv(paths)
    first = {c: i for i, c in reversed(list(enumerate(names)))}
    rows = rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names) if first[c] == i])
    return rows.na.fill("") if keep_empty else rows


# The lineage columns of a merged feature file.
LINEAGE = ("Provider_Name", "Provider_Release", "Provider_Snapshot_Date", "Provider_Schema_Profile", "Input_Source_Key", "Input_File", "Input_Retrieved_At")


def retrieved_at(spark: SparkSession, path: str) -> str:
    """``retrieved_at`` of the file's provenance sidecar (``<stem>.provenance.json``); empty without one."""
    folder, _, name = path.rpartition("/")
    sidecar = f"{folder}/{name.rsplit('.', 1)[0]}.provenance.json"
    if is_empty_or_invalid(spark, sidecar):
        return ""
    found = spark.read.text(sidecar, wholetext=True).select(F.get_json_object("value", "$.retrieved_at")).first()
    return (found[0] or "").strip() if found else ""


def feature_files(spark: SparkSession, paths: list[str], feature: str, sep: str = "\t", provider: dict[str, str] | None = None) -> DataFrame:
    """The feature files of many sources as one frame: empty files are skipped, a missing Source_DB comes from the file name, columns follow the contract.

    With ``provider`` (its first four LINEAGE columns, empty where absent) the
    rows get all LINEAGE columns: the key and name of their file, and when it
    was retrieved.
    """
    parts = []
    for path in paths:
        names = header(spark, path, sep)
        if not names:
            continue
        rows = delimited(spark, path, sep, columns=names)
        if not {"Source_DB", *[a for a, r in CONTRACTS[feature].aliases.items() if r == "Source_DB"]} & set(names):
            rows = rows.withColumn("Source_DB", source_from_path(F.lit(path)))
        if provider is not None:
            name = path.rsplit("/", 1)[-1]
            own = {**{c: provider.get(c, "") for c in LINEAGE[:4]}, "Input_Source_Key": name.rsplit(".", 1)[0], "Input_File": name, "Input_Retrieved_At": retrieved_at(spark, path)}
            rows = rows.withColumns({c: F.lit(v) for c, v in own.items()})
        parts.append(normalize(rows, CONTRACTS[feature]))
    if not parts:
        raise ValueError("no file has any rows")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def star_table(rows: DataFrame, table: str, source_type: str = "public") -> DataFrame:
    """Feature rows as a star table: columns renamed, sentinels to null, absent columns null, rows without Phage_ID dropped."""
    renamed, have = RENAMED.get(table, {}), {c.lower(): c for c in rows.columns}

    def column(name: str, kind: str) -> Column:
        source = have.get(renamed.get(name, name).lower())
        if name == "source_type" and source is None:
            return F.lit(source_type).alias(name)
        if source is None:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(f"`{source}`")
        return (c if kind == "string" else number(c.cast("string"), kind)).alias(name)

    fields = schema(table).fields
    return rows.select(*[column(f.name, f.dataType.simpleString()) for f in fields]).filter("Phage_ID IS NOT NULL" if "Phage_ID" in TABLES[table] else "true")


def fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, pos, id, header, sequence): records split at ``>`` after a line break; line breaks in sequences go, records without an id are dropped.

    ``pos`` orders the records of a file. A record is one row, so it must fit
    in memory; a file is read in splits like any text.
    """
    text = spark.read.option("lineSep", "\n>").text(paths).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"), "value")
    body = F.regexp_replace(F.regexp_replace("value", r"^>", ""), "\r", "")
    cut = F.split(body, "\n", 2)
    head = strip(cut[0])
    rows = text.select("file", "pos", head.alias("header"), F.regexp_replace(F.coalesce(F.get(cut, F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"))
    return rows.filter("header != ''").select("file", "pos", first_token(F.col("header")).alias("id"), "header", "sequence")


def merged_fasta(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``fasta`` of the files that are there and not empty; none at all is an error."""
    there = [p for p in paths if not is_empty_or_invalid(spark, p)]
    if not there:
        raise ValueError("there is no file with any record")
    return fasta(spark, there)


def fasta_headers(records: DataFrame, sample: int | None = None) -> DataFrame:
    """(id, header, description): the description is what follows the first word; with ``sample`` the first few by place."""
    rows = records.orderBy("file", "pos").limit(sample) if sample is not None else records
    return rows.select("id", "header", F.coalesce(F.get(F.split("header", r"\s+", 2), F.lit(1)), F.lit("")).alias("description"))


def sequence_table(records: DataFrame, key: str = "id") -> DataFrame:
    """(id, sequence): of records with equal ids the first in the first file."""
    return records.groupBy(F.col(key).alias("id")).agg(F.min_by("sequence", F.struct("file", "pos")).alias("sequence"))


def gff3_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(phage_id, source_db, block_text) of ``# Sequence Data:`` blocks; of repeated ids the last wins, ``copies`` says how many there were."""
    mark = "# Sequence Data:"
    rows = spark.read.option("lineSep", "\n" + mark).text(paths).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"), "value")
    named = rows.withColumn("phage_id", F.regexp_extract("value", 'seqhdr="([^"]+)"', 1)).filter("phage_id != ''")
    block = F.when(F.col("value").startswith(mark), F.col("value")).otherwise(F.concat(F.lit(mark), F.col("value")))
    last = named.select("phage_id", "file", "pos", block.alias("block_text")).groupBy("phage_id").agg(F.max_by(F.struct("file", "block_text"), F.struct("file", "pos")).alias("b"), F.count("*").alias("copies"))
    return last.select("phage_id", stem_of_path(F.col("b.file")).alias("source_db"), F.col("b.block_text").alias("block_text"), "copies")


def gff3_attributes(c: Column) -> Column:
    """MAP of ``k=v;k=v``: split at the first ``=``, trimmed; of repeated keys the last wins."""
    parts = F.filter(F.split(c, ";"), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("k"), F.trim(F.regexp_replace(p, r"^[^=]*=", "")).alias("v")))
    later = lambda p, i: F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"])
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~later(p, i)))


def gff3_features(blocks: DataFrame) -> DataFrame:
    """Typed feature rows of lines with nine tab-separated fields or more."""
    lines = blocks.select("phage_id", F.posexplode(F.split("block_text", "\r?\n")).alias("line_no", "line")).filter(~F.col("line").startswith("#"))
    f = lines.withColumn("f", F.split("line", "\t")).filter(F.size("f") >= 9).withColumn("a", gff3_attributes(F.col("f")[8]))
    text = lambda i: F.col("f")[i]
    attribute = lambda k: F.try_element_at("a", F.lit(k))
    return f.select(
        "phage_id", "line_no", text(0).alias("seqid"), text(1).alias("source"), text(2).alias("type"), number(text(3), "int").alias("start"), number(text(4), "int").alias("end"), text(5).alias("score"),
        text(6).alias("strand"), text(7).alias("phase"), text(8).alias("attributes"), attribute("ID").alias("ID"), attribute("product").alias("product"), attribute("protein_id").alias("protein_id"),
        (number(text(4), "int") - number(text(3), "int") + 1).alias("length"),
    )


def gff3_get(blocks: DataFrame, phage_id: str) -> str:
    """The annotation text of a phage; empty if there is none."""
    found = blocks.filter(F.col("phage_id") == phage_id).select("block_text").first()
    return found[0] if found else ""


def gff3_lines(blocks: DataFrame, phage_id: str) -> list[str]:
    """The lines of a phage's annotation that are neither blank nor comments."""
    return [x for x in gff3_get(blocks, phage_id).splitlines() if x.strip() and not x.startswith("#")]


def gff3_list(blocks: DataFrame, source: str | None = None) -> DataFrame:
    """(phage_id) of the annotated phages, of one source if asked for."""
    rows = blocks if source is None else blocks.filter(F.col("source_db") == source)
    return rows.select("phage_id").orderBy("phage_id")


def gff3_source(blocks: DataFrame, phage_id: str) -> str | None:
    found = blocks.filter(F.col("phage_id") == phage_id).select("source_db").first()
    return found[0] if found else None


def gff3_has(blocks: DataFrame, phage_id: str) -> bool:
    return blocks.filter(F.col("phage_id") == phage_id).limit(1).count() > 0


def gff3_stats(blocks: DataFrame) -> DataFrame:
    """(source_db, n_phages), most first; the row without a source is the total."""
    return blocks.rollup("source_db").agg(F.count("*").alias("n_phages")).orderBy(F.desc("n_phages"), F.asc_nulls_first("source_db"))


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a JSON object of texts."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def json_sidecars(spark: SparkSession, paths: list[str], table: str = "dataset_provenance") -> DataFrame:
    """Provenance records of many JSON files, in the table's columns, all text."""
    return spark.read.schema(schema(table)).option("multiLine", True).json(sorted(paths)).filter(F.coalesce(*[F.col(c) for c in schema(table).names]).isNotNull())


def newest_sequence(records: DataFrame) -> DataFrame:
    """Records numbered inside their file, for file-order rules."""
    return records.withColumn("file_pos", F.row_number().over(Window.partitionBy("file").orderBy("pos")))
