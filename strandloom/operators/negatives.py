"""Negative pairs for training. Seeded, distinct, and without crossing phages with hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .pairs import dense_index


def hash_number(*parts: Column) -> Column:
    """32 bits of an MD5 of the parts, the same on every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def random_negatives(phages: DataFrame, hosts: DataFrame, positives: DataFrame, per_phage: int = 1, seed: int = 42) -> DataFrame:
    """(Phage_ID, Host_ID): for each phage the hosts that hashes of its id pick, less the positives.

    Each attempt picks one host by number, so this is an equi-join on the
    number; a phage related to most hosts may get fewer than asked for.
    """
    table = dense_index(hosts.select("Host_ID").distinct(), ["Host_ID"], "_no")
    total = table.agg(F.count("*").alias("_hosts"))
    attempts = phages.select("Phage_ID").distinct().join(F.broadcast(total)).withColumn("_try", F.explode(F.sequence(F.lit(1), F.lit(per_phage))))
    picked = attempts.withColumn("_no", hash_number(F.col("Phage_ID"), F.col("_try"), F.lit(seed)) % F.col("_hosts"))
    return picked.join(table, "_no").select("Phage_ID", "Host_ID").distinct().join(positives, ["Phage_ID", "Host_ID"], "left_anti")


def negatives_for(phages: DataFrame, hosts: DataFrame, positives: DataFrame, ratio: float = 1.0, attempts: int = 10, seed: int = 42) -> DataFrame:
    """(Phage_ID, Host_ID): int(number of positives * ratio) negatives, fewer if ``attempts`` draws each do not find as many.

    Draw number i picks a phage and a host by hashes of i, so draws are spread
    over tasks and two equi-joins name them; the first draws that are no
    positive and no repeat are kept, in the order of their numbers.
    """
    wanted = int(positives.count() * ratio)
    spark = positives.sparkSession
    p, h = pin(dense_index(phages.select("Phage_ID").distinct(), ["Phage_ID"], "_p")), pin(dense_index(hosts.select("Host_ID").distinct(), ["Host_ID"], "_h"))
    n_phages, n_hosts = p.count(), h.count()
    if not wanted or not n_phages or not n_hosts:
        return p.select("Phage_ID").join(h.select("Host_ID"), F.lit(False))
    known = pin(positives.select("Phage_ID", "Host_ID").distinct())
    drawn, found, good = 0, 0, None
    while found < wanted and drawn < wanted * attempts:
        # As many as are missing, and some more for repeats and positives; numbers go on where the last attempt ended.
        more = min(max(1_000, int(1.2 * (wanted - found))), wanted * attempts - drawn)
        number = spark.range(drawn, drawn + more).select(F.col("id").alias("_i"), (hash_number(F.col("id"), F.lit("p"), F.lit(seed)) % n_phages).alias("_p"), (hash_number(F.col("id"), F.lit("h"), F.lit(seed)) % n_hosts).alias("_h"))
        named = number.join(p, "_p").join(h, "_h").groupBy("Phage_ID", "Host_ID").agg(F.min("_i").alias("_i"))
        fresh = named.join(known, ["Phage_ID", "Host_ID"], "left_anti")
        good = pin(fresh if good is None else good.unionByName(fresh.join(good, ["Phage_ID", "Host_ID"], "left_anti")))
        drawn, found = drawn + more, good.count()
    return dense_index(good, ["_i"], "_at").filter(F.col("_at") < wanted).select("Phage_ID", "Host_ID")


def candidate_caches(star: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Distinct phages and hosts with a known GC share and length, from which negatives are drawn."""
    p = star["fact_phages"].filter("GC_content IS NOT NULL AND Length IS NOT NULL").select("Phage_ID", "GC_content", "Length", "Taxonomy").distinct()
    h = star["dim_hosts"].filter("GC_Content IS NOT NULL AND Genome_Length IS NOT NULL").select("Host_ID", "Species_Name", "GC_Content", "Genome_Length").distinct()
    return p, h


def gc_negatives(negatives: DataFrame, phages: DataFrame, hosts: DataFrame, least: float = 20.0) -> DataFrame:
    """Negatives whose GC shares differ by at least ``least`` points, with the difference."""
    p = phages.select("Phage_ID", F.col("GC_content").alias("_p")).dropDuplicates(["Phage_ID"])
    h = hosts.select("Host_ID", F.col("GC_Content").alias("_h")).dropDuplicates(["Host_ID"])
    rows = negatives.join(p, "Phage_ID").join(h, "Host_ID").withColumn("GC_Difference", F.abs(F.col("_p") - F.col("_h")))
    return rows.filter(F.col("GC_Difference") >= least).drop("_p", "_h")


def taxonomy_negatives(negatives: DataFrame, hosts: DataFrame, positives: DataFrame, excluded: list[str] | None = None) -> DataFrame:
    """Negatives whose host species the phage has no positive with; with a list, whose species is not in it."""
    species = hosts.select("Host_ID", "Species_Name").distinct()
    rows = negatives.join(species, "Host_ID")
    if excluded is not None:
        return rows.filter(~F.coalesce(F.col("Species_Name").isin(*excluded), F.lit(False)))
    known = positives.join(species, "Host_ID").select("Phage_ID", "Species_Name").distinct()
    return rows.join(known, ["Phage_ID", "Species_Name"], "left_anti").select("Host_ID", "Phage_ID", "Species_Name")


def sample_by_hash(rows: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded MD5: a uniform sample that reruns repeat.

    Rows are counted in 65,536 ranges of the digest; only the range that the
    border falls into is ranked.
    """
    order = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    hashed = pin(rows.withColumn("_o", order).withColumn("_b", F.substring("_o", 1, 4)))  # hexadecimal digits sort like the number
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = hashed.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = hashed.join(F.broadcast(starts.filter(F.col("_s") < n)), "_b")
    whole = placed.filter(F.col("_s") + F.col("_n") <= n)
    border = placed.filter(F.col("_s") + F.col("_n") > n)
    ranked = border.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_o", *keys))).filter(F.col("_s") + F.col("_r") <= n)
    return whole.select(*rows.columns).unionAll(ranked.select(*rows.columns))


def percent_sample(rows: DataFrame, keys: list[str], percent: float, seed: int = 42) -> DataFrame:
    """The rows whose seeded hash falls below ``percent`` of its range: a pure filter that reruns repeat; rows with equal keys share a fate."""
    return rows.filter(hash_number(*[F.col(k) for k in keys], F.lit(seed)) < int(percent / 100 * (1 << 32)))


def shuffled(rows: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """``rows`` in the order of a seeded MD5, by a range sort; reruns agree."""
    return rows.orderBy(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))), *keys)


def shuffled_places(rows: DataFrame, keys: list[str], name: str = "place", seed: int = 42) -> DataFrame:
    """``rows`` with their places, from 0, in the order of ``shuffled``."""
    ordered = shuffled(rows, keys, seed).withColumn("_o", F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))))
    return dense_index(ordered, ["_o", *keys], name).drop("_o")


def balanced_dataset(positives: DataFrame, negatives: list[DataFrame], ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """(Phage_ID, Host_ID, label): positives and int(n * ratio) negatives, shared evenly among the kinds, the rest to the last; ``shuffled`` puts them in random order."""
    keys = ["Phage_ID", "Host_ID"]
    good = pin(positives.select(*keys).distinct())
    wanted = int(good.count() * ratio)
    each = wanted // len(negatives)
    out, left = good.withColumn("label", F.lit(1)), wanted
    bad = None
    for i, kind in enumerate(negatives):
        n = left if i == len(negatives) - 1 else each
        rows = kind.select(*keys).distinct()
        part = sample_by_hash(rows if bad is None else rows.join(bad, keys, "left_anti"), keys, n, seed)
        part = part if bad is None else bad.unionByName(part)
        bad, left = pin(part) if i < len(negatives) - 1 else part, left - n  # the last is read once
    return out.unionByName(bad.withColumn("label", F.lit(0)))


def stratified_split(rows: DataFrame, label: str, keys: list[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``split``: train or test, of exact shares in each label, by hash order.

    A label's rows are ranked inside 256 hash ranges and the ranges are offset
    by their sizes, so one label does not fall to one task.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    hashed = rows.withColumn("_o", digest).withColumn("_b", F.conv(F.substring("_o", 1, 2), 16, 10).cast("int"))
    sizes = hashed.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_t", F.sum("_n").over(Window.partitionBy(label))).drop("_n")
    ranked = hashed.join(starts, [label, "_b"]).withColumn("_r", F.col("_s") + F.row_number().over(Window.partitionBy(label, "_b").orderBy("_o", *keys)))
    return ranked.withColumn("split", F.when(F.col("_r") <= F.floor(F.col("_t") * F.lit(test_share)), "test").otherwise("train")).drop("_o", "_b", "_s", "_t", "_r")


def sequential_split(rows: DataFrame, order: list[str], test: float = 0.2) -> DataFrame:
    """``rows`` with ``split``: the first in a total order are ``train``, the last floor(n * test) are ``test``."""
    placed = dense_index(rows, order, "_place")
    n = rows.count()
    first = n - int(n * test)
    return placed.withColumn("split", F.when(F.col("_place") < first, "train").otherwise("test")).drop("_place")
