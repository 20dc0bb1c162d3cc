"""A trie of conversations by their turns, without building a tree node by node.

Every prefix of a conversation has a digest: a sum of hashes of (turn, depth),
so running sums give all of them, in two levels where a conversation is long.
A prefix belongs to the smallest conversation that begins with it. Along one
conversation ownership starts at some depth and never ends, so that depth is
found by binary search: all conversations ask at once, one join against the
prefix minima a round. What a conversation owns is a chain, chains hang on
nodes of other chains, and their totals are aggregated bottom-up by doubling
the distance to the ancestor each round, so deep nests take few rounds.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pin, running_totals

#: Conversations in a block, whose first one lends its head to the others; heads have fewer turns than this.
BLOCK, HEADS = 20, 4
#: Depths of a conversation that one task sums up at a time.
STRIDE = 1_024
#: Ids that are joined to one text at most before it is hashed; a slice is this many consecutive numbers.
IDS = 1 << 16
_NOTHING = hashlib.sha256(b"").hexdigest()
_LANES = 4


def numbered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation numbered from 0, by (turn, role, text), null turns first.

    A range sort over all four places them, so a conversation with a great part
    of all turns lies in many tasks. Texts go no further than this step.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).filter("conv_id IS NOT NULL")
    keys = ["conv_id", "turn", "role", "text"]
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", F.monotonically_increasing_id().alias("_at"), digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).alias("words"))
    placed = pin(placed.withColumn("_task", F.shiftright("_at", 33)))
    spans = placed.groupBy("conv_id", "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    return placed.join(starts, ["conv_id", "_task"]).select("conv_id", (F.col("_at") + F.col("_start")).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, length), (conv_id, depth, digest, words, length)): each conversation behind the head of its block's first one."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base": F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))})
    convs = pin(convs)
    of_base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("_base_n"))
    head = F.least("h", F.coalesce("_base_n", F.lit(0)))
    convs = pin(convs.join(of_base, "base", "left").select("conv_id", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    lent = turns.filter((F.col("pos") < HEADS - 1) & (F.pmod("conv_id", F.lit(BLOCK)) == 0)).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    heads = convs.join(lent, "base").filter("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "words", "length")
    own = turns.join(convs, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head") + 1).alias("depth"), "digest", "words", "length")
    return convs.select("conv_id", "length"), heads.unionByName(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, prefix, words, length): ``prefix`` names the first ``depth`` turns in 128 bits."""
    lanes = {}
    for i in range(_LANES // 2):
        h = F.xxhash64(F.lit(i), "digest", "depth")
        lanes |= {f"_l{2 * i}": h.bitwiseAND(F.lit(0xFFFFFFFF)), f"_l{2 * i + 1}": F.shiftrightunsigned(h, 32)}
    summed = running_totals(rows.withColumns(lanes).drop("digest"), ["conv_id"], "depth", {f"_s{i}": f"_l{i}" for i in range(_LANES)}, STRIDE)
    name = F.concat(*[F.lpad(F.hex(F.pmod(f"_s{i}", F.lit(1 << 32))), 8, "0") for i in range(_LANES)])
    return summed.select("conv_id", "depth", F.unhex(name).alias("prefix"), "words", "length")


def first_owned(convs: DataFrame, paths: DataFrame, minima: DataFrame) -> DataFrame:
    """(conv_id, first): the least depth, from 1, whose prefix the conversation owns; one more than its length if none.

    Binary search: each round asks for the owner of every open conversation's
    middle prefix in one batch.
    """
    owners, at = minima.select("prefix", "owner"), paths.select("conv_id", "depth", "prefix")
    open_ = convs.select("conv_id", F.lit(1).cast("long").alias("lo"), (F.col("length") + 1).alias("hi"))
    ended = [open_.filter("lo >= hi")]
    open_ = open_.filter("lo < hi")
    while True:
        probes = open_.withColumn("depth", F.floor((F.col("lo") + F.col("hi")) / 2))
        owns = F.col("owner") == F.col("conv_id")
        asked = probes.join(at, ["conv_id", "depth"]).join(owners, "prefix")
        moved = pin(asked.select("conv_id", F.when(owns, F.col("lo")).otherwise(F.col("depth") + 1).alias("lo"), F.when(owns, F.col("depth")).otherwise(F.col("hi")).alias("hi")))
        ended.append(moved.filter("lo >= hi"))
        open_ = moved.filter("lo < hi")
        if open_.isEmpty():
            return reduce(DataFrame.unionAll, ended).select("conv_id", F.col("lo").alias("first"))


def subtree_totals(chains: DataFrame, values: list[str]) -> DataFrame:
    """(conv_id, *values) summed over each chain and all that hang below it.

    After round k a chain has the sums of those less than 2^k below it, and
    knows its 2^k-th ancestor, to which it then adds them.
    """
    now = chains.select("conv_id", F.col("parent").alias("_up"), *values)
    while True:
        now = pin(now)
        if now.filter("_up IS NOT NULL").isEmpty():
            return now.drop("_up")
        rising = now.filter("_up IS NOT NULL")
        added = rising.groupBy(F.col("_up").alias("conv_id")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
        further = rising.select("conv_id", "_up").join(now.select(F.col("conv_id").alias("_up"), F.col("_up").alias("_next")), "_up").select("conv_id", F.col("_next").alias("_up"))
        now = now.drop("_up").join(added, "conv_id", "left").join(further, "conv_id", "left").select("conv_id", "_up", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])


def _hashed(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, conv_id): ids in ascending order, joined by commas.

    SHA-256 is sequential, but the ids of a slice become one text wherever they
    are; who hashes reads texts of up to IDS ids each and keeps none.
    """
    texts = ends.groupBy("prefix", F.floor(F.col("conv_id") / IDS).alias("slice")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("text"))

    def run(batches):
        last, digest = None, None
        for batch in batches:
            out = []
            for prefix, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if prefix == last:
                    digest.update(b"," + text.encode())
                else:
                    if last is not None:
                        out.append((last, digest.hexdigest()))
                    last, digest = prefix, hashlib.sha256(text.encode())
            yield _pairs(out)
        yield _pairs([(last, digest.hexdigest())] if last is not None else [])

    return texts.repartition("prefix").sortWithinPartitions("prefix", "slice").select("prefix", "text").mapInArrow(run, "prefix binary, ends_sha256 string")


def _pairs(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"prefix": pa.array([r[0] for r in rows], pa.binary()), "ends_sha256": pa.array([r[1] for r in rows], pa.string())})


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row per distinct prefix of the rebuilt conversations.

    Null roles and texts are empty; rows without a conversation take no part;
    repeated rows are turns of their own; turns with equal numbers follow by
    role and text. An empty table has no node, not even a root.
    """
    turns = pin(numbered_turns(conversations, conv_col, turn_col, role_col, text_col))
    convs, rows = rebuilt(turns)
    root = convs.agg(F.min("conv_id"), F.count("*")).first()
    spark = conversations.sparkSession
    if root[0] is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    paths = pin(prefixes(rows))
    owner = F.struct("conv_id", (F.col("depth") == F.col("length")).alias("ends"))
    minima = paths.groupBy("prefix").agg(F.min(owner).alias("_o"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("words").cast("long").alias("words"))
    minima = pin(minima.select("prefix", F.col("_o.conv_id").alias("owner"), F.col("_o.ends").alias("ends"), "depth", "n_convs", "words"))
    first = pin(first_owned(convs, paths, minima))

    # Chains: where each begins, and the node it hangs on. The root is on the chain of the smallest conversation.
    owned = first.join(convs, "conv_id").filter(F.col("first") <= F.col("length")).select("conv_id", "first")
    deep = owned.filter("first > 1").withColumn("depth", F.col("first") - 1).join(paths.select("conv_id", "depth", "prefix"), ["conv_id", "depth"]).join(minima.select("prefix", F.col("owner").alias("parent")), "prefix")
    hung = deep.select("conv_id", "first", "parent").unionByName(owned.filter(f"first = 1 AND conv_id <> {root[0]}").select("conv_id", "first", F.lit(root[0]).alias("parent")))
    chains = pin(hung.withColumn("at", F.col("first") - 1))

    top_ends = convs.filter(f"conv_id = {root[0]}").select((F.col("length") == 0).alias("ends"))
    top = top_ends.select(F.lit(b"").alias("prefix"), F.lit(root[0]).cast("long").alias("owner"), "ends", F.lit(0).cast("long").alias("depth"), F.lit(root[1]).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("words"))
    nodes = minima.unionByName(top).withColumn("_own", (F.col("n_convs") - 1) * F.col("words"))
    hanging = chains.groupBy(F.col("parent").alias("owner"), F.col("at").alias("depth")).agg(F.count("*").alias("_hung"))
    nodes = pin(nodes.join(hanging, ["owner", "depth"], "left").withColumn("_hung", F.coalesce("_hung", F.lit(0))))
    leaf = (F.col("ends") & (F.col("_hung") == 0)).cast("long")
    per_chain = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.sum(leaf).alias("leaves"), F.sum("_own").alias("saved"))
    totals = subtree_totals(per_chain.join(chains.select("conv_id", "parent"), "conv_id", "left"), ["leaves", "saved"])

    below = chains.join(totals, "conv_id").groupBy(F.col("parent").alias("owner"), F.col("at").alias("depth")).agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    valued = nodes.withColumn("_leaf", leaf).join(below, ["owner", "depth"], "left")
    valued = valued.withColumns({"_leaves": F.col("_leaf") + F.coalesce("_leaves", F.lit(0)), "_saved": F.col("_own") + F.coalesce("_saved", F.lit(0)), "_back": -F.col("depth")})
    summed = running_totals(valued, ["owner"], "_back", {"n_leaves": "_leaves", "saved_tokens": "_saved"}, STRIDE)
    ends = paths.filter("depth = length").select("prefix", "conv_id").unionAll(convs.filter("length = 0").select(F.lit(b""), "conv_id"))
    above = chains.select(F.col("conv_id").alias("owner"), F.col("first").alias("depth"), F.col("parent"))
    out = summed.join(above, ["owner", "depth"], "left").join(_hashed(ends), "prefix", "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"), "n_convs",
        (F.col("_hung") + (~F.col("ends")).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )
