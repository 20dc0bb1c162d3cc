"""Indexes of where each record of FASTA and annotation files lies, and reads of single records by them.

An index is a table of small rows, made in one scan that is split like any
text; written by id it answers a lookup from the row groups that may hold it.
Records are then read by their byte ranges, by the tasks.
"""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_token, stem_of_path, strip
from ..session import pin

FASTA_BREAK, GFF3_MARK = "\n>", "# Sequence Data:"
#: File systems on which tasks read byte ranges; files on any other are scanned by Spark for the wanted places.
RANGED = ("file", "hdfs", "s3", "gs", "abfs")


def located(spark: SparkSession, paths: str | list[str], separator: str, **columns: Column) -> DataFrame:
    """(file, offset, size, ...) of what stands between separators, with columns made of ``value``.

    Spark tells the block a record was read in, and the order in it. Records and
    separators fill a file without a gap, so their lengths sum up to places: in
    each block first, then over the blocks of a file.
    """
    text = spark.read.option("lineSep", separator).text(paths)
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), F.octet_length("value").alias("size"), *[c.alias(k) for k, c in columns.items()])
    rows = pin(rows)
    step = F.col("size") + len(separator.encode())
    blocks = rows.groupBy("file", "_block").agg(F.sum(step).alias("_bytes"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "_block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("file", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_in", F.coalesce(F.sum(step).over(within), F.lit(0))).join(starts, ["file", "_block"])
    return placed.select("file", (F.col("_start") + F.col("_in")).alias("offset"), "size", *columns)


def _first_line() -> Column:
    return F.substring_index("value", "\n", 1)


def fasta_index(spark: SparkSession, paths: str | list[str], whole_header: bool = False) -> DataFrame:
    """(id, file, offset, size, copies): the id is a header's first word, or with ``whole_header`` all of it; of equal ids the first in the first file counts."""
    found = located(spark, paths, FASTA_BREAK, header=strip(F.regexp_replace(_first_line(), "^>", "")))
    named = found.filter("header != ''").withColumn("id", F.col("header") if whole_header else first_token(F.col("header")))
    first = named.groupBy("id").agg(F.min(F.struct("file", "offset", "size")).alias("_f"), F.count("*").alias("copies"))
    return first.select("id", "_f.file", "_f.offset", "_f.size", "copies")


def gff3_index(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(id, source_db, file, offset, size, copies) of annotation blocks by the id in their first line; of equal ids the last in the last file counts."""
    found = located(spark, paths, "\n" + GFF3_MARK, id=F.regexp_extract(_first_line(), 'seqhdr="([^"]+)"', 1))
    last = found.filter("id != ''").groupBy("id").agg(F.max(F.struct("file", "offset", "size")).alias("_f"), F.count("*").alias("copies"))
    return last.select("id", stem_of_path(F.col("_f.file")).alias("source_db"), "_f.file", "_f.offset", "_f.size", "copies")


def wanted_places(index: DataFrame, ids: DataFrame | list[str]) -> DataFrame:
    """The index rows of some ids; a list of ids reaches the scan of a stored index as a filter."""
    if isinstance(ids, list):
        return index.filter(F.col("id").isin(ids))
    return index.join(ids.select("id").distinct(), "id", "left_semi")


def fetched(index: DataFrame, ids: DataFrame | list[str], separator: str, ranged: tuple[str, ...] = RANGED) -> DataFrame:
    """(id, file, offset, content, n_bytes) of the wanted records; unknown ids have no row. ``n_bytes`` is what was read of the file."""
    spark = index.sparkSession
    places = pin(wanted_places(index, ids).select("id", "file", "offset", "size"))
    scheme = F.substring_index("file", ":", 1)
    near = places.filter(scheme.isin(*ranged)).repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def read(batches):
        opened, path = None, None
        for batch in batches:
            contents = []
            for file, offset, size in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if file != path:
                    if opened is not None:
                        opened.close()
                    store, place = fs.FileSystem.from_uri(file)
                    opened, path = store.open_input_file(place), file
                contents.append(opened.read_at(size, offset))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([c.decode("utf-8", "replace") for c in contents], pa.string()), pa.array([len(c) for c in contents], pa.int64())], names=["id", "file", "offset", "content", "n_bytes"])
        if opened is not None:
            opened.close()

    out = near.mapInArrow(read, "id string, file string, offset long, content string, n_bytes long")
    far = [r[0] for r in places.filter(~scheme.isin(*ranged)).select("file").distinct().collect()]
    if far:
        scanned = located(spark, far, separator, content=F.col("value")).withColumnRenamed("size", "n_bytes")
        out = out.unionByName(places.drop("size").join(scanned, ["file", "offset"]).select("id", "file", "offset", "content", F.col("n_bytes").cast("long")))
    return out


def fetch_fasta(index: DataFrame, ids: DataFrame | list[str], **options) -> DataFrame:
    """(id, header, sequence, n_bytes) of the wanted ids, line breaks and blanks gone from sequences."""
    found = fetched(index, ids, FASTA_BREAK, **options)
    parts = F.split(F.regexp_replace(F.regexp_replace("content", "^>", ""), "\r", ""), "\n", 2)
    return found.select("id", strip(parts[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "").alias("sequence"), "n_bytes")


def fetch_gff3(index: DataFrame, ids: DataFrame | list[str], **options) -> DataFrame:
    """(phage_id, block_text, n_bytes) of the wanted annotation blocks, each with the mark it begins with."""
    found = fetched(index, ids, "\n" + GFF3_MARK, **options)
    return found.select(F.col("id").alias("phage_id"), F.when(F.col("content").startswith(GFF3_MARK), F.col("content")).otherwise(F.concat(F.lit(GFF3_MARK), F.col("content"))).alias("block_text"), "n_bytes")
