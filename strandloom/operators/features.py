"""Features of pairs and sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import gc_percent, size_category
from ..session import pin


def pair_features(pairs: DataFrame) -> DataFrame:
    """GC and length features of (Phage_GC, Host_GC, Phage_Length, Host_Length)."""
    pg, hg, pl, hl = (F.col(c).cast("double") for c in ("Phage_GC", "Host_GC", "Phage_Length", "Host_Length"))
    ratio, length_ratio = pg / (hg + 1e-6), pl / (hl + 1)
    return pairs.withColumns({
        "GC_Difference": F.abs(pg - hg), "GC_Ratio": ratio, "GC_Sum": pg + hg, "GC_Product": pg * hg,
        "Length_Ratio": length_ratio, "Log_Phage_Length": F.log10(pl + 1), "Log_Host_Length": F.log10(hl + 1),
        "Length_Difference": hl - pl, "GC_x_Length_Ratio": ratio * length_ratio,
    })


def sequence_features(pairs: DataFrame) -> DataFrame:
    """Lengths, their ratio, GC shares and the size category of pairs with sequences."""
    p, h = F.length("Phage_Sequence"), F.length("Host_Sequence")
    return pairs.withColumns({
        "phage_seq_length": p, "host_seq_length": h, "length_ratio": p / F.nullif(h, F.lit(0)),
        "phage_gc": gc_percent(F.col("Phage_Sequence")), "host_gc": gc_percent(F.col("Host_Sequence")), "size_category": size_category(p),
    })


def kmers(sequence: Column, k: int) -> Column:
    """The k-mers of a text, by start. The text is cut into characters once: a substring looks for its start from the beginning of the text."""
    from_each = lambda chars: F.transform(F.sequence(F.lit(1), F.size(chars) - k + 1), lambda i: F.array_join(F.slice(chars, i, k), ""))
    return F.when(F.length(sequence) >= k, F.flatten(F.transform(F.array(F.split(sequence, "")), from_each))).otherwise(F.array().cast("array<string>"))


def kmer_counts(rows: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, kmer, n) of every text.

    Texts are dealt by id before they are cut, so a text moves once, as it is,
    and its k-mers, which are k times as long together, are counted where they are made.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(id_col, text_col).repartition(tasks, id_col)
    return dealt.select(id_col, F.explode(kmers(F.col(text_col), k)).alias("kmer")).groupBy(id_col, "kmer").agg(F.count("*").alias("n"))


#: Bytes of text whose k-mers a task counts at a time.
COUNTED_BYTES = 4 << 20


def counted_kmers(groups: pa.Array, texts: pa.Array, k: int) -> pa.RecordBatch:
    """(group, kmer, n) of the k-mers of these texts, null texts having none.

    A k-mer is a number whose digits are its group and its characters; numbers
    that would pass 63 bits are ranked first, and the ranks go on.
    """
    texts = texts.fill_null("")
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4")
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype("i8")
    encoded = groups.dictionary_encode(null_encoding="encode")
    whole = np.repeat(sizes.cumsum(), sizes) - np.arange(len(points)) >= k
    present = np.zeros(0x110000, bool)
    present[points] = True
    alphabet = np.flatnonzero(present)
    digits = (present.cumsum() - 1)[points]
    m, span, ranked = max(len(alphabet), 1), len(encoded.dictionary), {}
    starts = np.flatnonzero(whole)
    keys = np.repeat(encoded.indices.to_numpy().astype("i8"), sizes)[starts]
    for j in range(k):
        if span * m >= 1 << 63:
            ranked[j], keys = np.unique(keys, return_inverse=True)
            span = len(ranked[j])
        keys = keys * m + digits[starts + j]
        span *= m
    keys, n = np.unique(keys, return_counts=True)
    chars = np.empty((len(keys), k), "<u4")
    for j in reversed(range(k)):
        keys, digit = np.divmod(keys, m)
        chars[:, j] = alphabet[digit]
        keys = ranked[j][keys] if j in ranked else keys
    data = chars.tobytes().decode("utf-32-le").encode()
    widths = (1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)).sum(axis=1)
    names = pa.StringArray.from_buffers(len(n), pa.py_buffer(np.append(0, widths.cumsum()).astype("<i4")), pa.py_buffer(data))
    return pa.RecordBatch.from_arrays([encoded.dictionary.take(pa.array(keys)), names, pa.array(n.astype("i8"))], names=["group", "kmer", "n"])


def kmer_totals(rows: DataFrame, k: int, text_col: str, group: str) -> DataFrame:
    """(group, kmer, n, frequency); rows whose group is null are a group.

    Tasks count the k-mers of a few megabytes of text at a time, so that rows
    are made for different k-mers and not for every place.
    """

    def run(batches):
        for batch in batches:
            ends = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype("i8").cumsum()
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + COUNTED_BYTES, side="right")))
                yield counted_kmers(batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start), k)
                start = stop

    kind = rows.schema[group].dataType.simpleString()
    found = rows.select(group, text_col).mapInArrow(run, f"group {kind}, kmer string, n long")
    counts = found.groupBy("group", "kmer").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(F.col("group").alias("_g")).agg(F.sum("n").alias("_t"))
    return counts.join(totals, F.col("group").eqNullSafe(F.col("_g"))).select(F.col("group").alias(group), "kmer", "n", (F.col("n") / F.col("_t")).alias("frequency"))


def kmer_cosine(counts: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """(a, b, cosine) of each listed pair of ids; 0 if they share no k-mer.

    The counts of the listed ids alone are taken. Each id's counts are one map,
    which is no larger than its text, so pairs are joined by id only and a pair's
    product is made in its row.
    """
    listed = pairs.select(F.col("a").alias(id_col)).union(pairs.select("b")).distinct()
    mine = counts.join(listed, id_col, "left_semi").groupBy(F.col(id_col).alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("kmer", "n"))).alias("of"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    mine = pin(mine)
    out = pairs.join(mine.toDF("a", "of_a", "norm_a"), "a", "left").join(mine.toDF("b", "of_b", "norm_b"), "b", "left")
    shared = F.map_zip_with("of_a", "of_b", lambda _, x, y: F.coalesce(x * y, F.lit(0)))
    dot = F.aggregate(F.map_values(shared), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select("a", "b", F.coalesce(dot / (F.col("norm_a") * F.col("norm_b")), F.lit(0.0)).alias("cosine"))
