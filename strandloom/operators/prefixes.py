"""Finding texts by how they begin, on sorted texts instead of a key of leading characters."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import pin


def first_with_prefix(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text): for each id the text that begins with it and has the least ``pos``; ids without one are left out.

    ``texts`` is (text, pos). They are sorted in ranges, where an id is the
    interval of texts that begin with it. An id goes to the range its interval
    begins in and to the next ones as long as they begin with it, so the ids that
    a range gets are, beside its own, beginnings of one text. In a range both
    are merged in order: open ids form a stack, a text only counts for the
    topmost, and what is closed hands its best to the one below.
    """
    placed = texts.filter("text IS NOT NULL").repartitionByRange("text", "pos").sortWithinPartitions("text", "pos").withColumn("_range", F.spark_partition_id())
    placed = pin(placed)
    # A row per range, however many texts there are.
    ranges = sorted((r["low"], r["high"], r["_range"]) for r in placed.groupBy("_range").agg(F.min("text").alias("low"), F.max("text").alias("high")).collect())
    lows, highs, numbers = ([r[i] for r in ranges] for i in range(3))

    def send(batches):
        for batch in batches:
            found, at = [], []
            for x in batch.column(0).to_pylist():
                first = bisect_left(highs, x)
                for k in range(first, len(ranges)):
                    if k > first and not lows[k].startswith(x):
                        break
                    found.append(x)
                    at.append(numbers[k])
            yield pa.RecordBatch.from_pydict({"text": pa.array(found, pa.string()), "_range": pa.array(at, pa.int32())})

    kind = texts.schema["pos"].dataType
    sent = ids.select("id").filter("id IS NOT NULL").distinct().mapInArrow(send, "text string, _range int")
    both = placed.select("_range", "text", F.lit(1).alias("_kind"), "pos").unionByName(sent.withColumn("_kind", F.lit(0)), allowMissingColumns=True)

    def merge(batches):
        """Rows come by (range, text), an id before the texts that begin with it."""
        here, stack, out = None, [], []

        def close(text):
            while stack and (text is None or not text.startswith(stack[-1][0])):
                own, best = stack.pop()
                if best is not None:
                    out.append((own, *best))
                    if stack and (stack[-1][1] is None or best < stack[-1][1]):
                        stack[-1][1] = best

        for batch in batches:
            for number, text, is_text, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != here:
                    close(None)
                    here = number
                close(text)
                if not is_text:
                    if not stack or stack[-1][0] != text:
                        stack.append([text, None])
                elif stack and (stack[-1][1] is None or (pos, text) < stack[-1][1]):
                    stack[-1][1] = pos, text
            yield found(out)
            out.clear()
        close(None)
        yield found(out)

    def found(rows):
        return pa.RecordBatch.from_pydict({"id": pa.array([r[0] for r in rows], pa.string()), "pos": pa.array([r[1] for r in rows], to_arrow_type(kind)), "text": pa.array([r[2] for r in rows], pa.string())})

    parts = both.repartition("_range").sortWithinPartitions("_range", "text", "_kind", "pos").mapInArrow(merge, f"id string, pos {kind.simpleString()}, text string")
    return parts.groupBy("id").agg(F.min_by("text", F.struct("pos", "text")).alias("text"))
