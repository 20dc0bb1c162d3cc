"""Quantiles, weighted GC, user queries, sketches, draws and running streams."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import guarded, negatives, quality, quantiles, sequences
from strandloom.streaming import windows


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_quantiles_by_group(spark):
    """Nulls, groups of one, a null group, one value that is most of a group, and an empty column."""
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(1_000), 7, 7, 7]), None) for _ in range(2_000)] + [("one", 5, None)]
    frame = spark.createDataFrame(data, "g string, v int, empty double").repartition(5)
    shares = [0.0, 0.1, 0.5, 0.975, 1.0]
    found = {(r["g"], r["share"]): r["value"] for r in quantiles.exact_quantiles(frame, ["v", "empty"], shares, ["g"]).collect()}
    want = {(g, s): float(np.quantile([v for k, v, _ in data if k == g and v is not None], s)) for g in ("a", "b", None, "one") for s in shares}
    assert found.keys() == want.keys() and all(math.isclose(found[k], want[k]) for k in want)
    whole = quantiles.one_row(quantiles.exact_quantiles(frame, ["v", "empty"], [0.5]), {("v", 0.5): "m", ("empty", 0.5): "e"}).first()
    assert whole["m"] == float(np.median([v for _, v, _ in data if v is not None])) and whole["e"] is None
    assert quantiles.exact_quantiles(frame.limit(0), ["v"], [0.5]).count() == 0


def test_quantiles_are_not_made_in_one_task(spark):
    """No aggregate state holds a column: the plan has no percentile, and values are dealt by ranges."""
    frame = spark.range(10_000).select((F.col("id") * 7 % 10_007).alias("v"))
    stats = quality.number_stats(frame, "v")
    assert "percentile" not in stats._jdf.queryExecution().toString().lower()
    assert stats.first()["median_value"] == float(np.median([i * 7 % 10_007 for i in range(10_000)]))
    assert quality.number_stats(frame.limit(0), "v").first()["median_value"] is None


def test_weighted_gc_leaves_ambiguous_letters_out_of_shares(spark):
    data = [("g", "GGNN"), ("g", "AT"), ("n", "NNNN"), ("s", "SSAA"), ("e", ""), ("x", None), ("l", "ggcc"), ("l", "AAAAAAAA")]
    found = dict(rows(sequences.weighted_gc(spark.createDataFrame(data, "genome_id string, sequence string"))))
    assert found == {"g": 66.67, "n": 0.0, "s": 50.0, "e": 0.0, "x": 0.0, "l": 33.33}


def test_user_queries(spark):
    spark.createDataFrame([(i, float("nan") if i == 2 else i / 2) for i in range(50)], "id int, x double").createOrReplaceTempView("things")
    found = guarded.run_query(spark, "SELECT * FROM things ORDER BY id;", 3)
    assert found == {"success": True, "rows": 3, "data": [{"id": 0, "x": 0.0}, {"id": 1, "x": 0.5}, {"id": 2, "x": None}]}
    assert "Limit" in guarded.guarded(spark, "SELECT * FROM things")._jdf.queryExecution().optimizedPlan().toString()
    nested = guarded.run_query(spark, "SELECT date'2024-01-02' AS d, array(1, 2) AS a, map('k', 1.5BD) AS m, named_struct('y', x'ff') AS s")
    assert nested["data"] == [{"d": "2024-01-02", "a": [1, 2], "m": {"k": 1.5}, "s": {"y": "ff"}}]
    for bad in ("DROP TABLE things", "SELECT 1; SELECT 2", ""):
        with pytest.raises(ValueError):
            guarded.run_query(spark, bad)
    for limit in (0, 100_001):
        with pytest.raises(ValueError, match="limit"):
            guarded.run_query(spark, "SELECT 1", limit)
    assert {"name": "things", "type": "view"} in guarded.list_tables(spark)["data"]


def test_sketches_of_sources_merge(spark):
    """A new source is one more stored sketch; keys that sources share count once."""
    of = lambda source, a, b: spark.range(a, b).select(F.concat(F.lit("P"), "id").alias("Phage_ID"), F.lit(source).alias("Source_DB"))
    old = quality.coverage_sketches({"fact": of("x", 0, 3_000), "dim": of("x", 0, 900)})
    new = quality.coverage_sketches({"fact": of("y", 2_000, 5_000), "dim": of("y", 600, 1_500)})
    found = quality.sketched_coverage(old.unionAll(new), "fact").collect()
    assert len(found) == 1 and abs(found[0]["n_phages"] - 1_500) < 45 and abs(found[0]["pct"] - 30) < 1.5


def test_negatives_are_drawn_as_needed(spark):
    """The first good draws by number, whatever the attempts they come in; fewer if there are no more pairs."""
    phages = spark.createDataFrame([(f"P{i}",) for i in range(30)], "Phage_ID string")
    hosts = spark.createDataFrame([(f"H{i}",) for i in range(20)], "Host_ID string")
    known = spark.createDataFrame([(f"P{i}", f"H{j}") for i in range(30) for j in range(20) if (i + j) % 3 == 0], "Phage_ID string, Host_ID string")
    found = rows(negatives.negatives_for(phages, hosts, known, ratio=1.5, attempts=40), "Phage_ID", "Host_ID")
    assert len(found) == len(set(found)) == int(known.count() * 1.5) and not set(found) & set(rows(known))
    assert set(rows(negatives.negatives_for(phages, hosts, known, ratio=0.5, attempts=40), "Phage_ID", "Host_ID")) <= set(found)
    few = negatives.negatives_for(phages.limit(1), hosts.limit(3), known.filter("false").unionAll(known.limit(1)), ratio=50.0)
    assert 0 < few.count() <= 3
    assert negatives.negatives_for(phages, hosts, known.limit(0)).count() == 0


def test_places_are_those_of_the_shuffle(spark):
    frame = spark.range(200).select(F.col("id").alias("k"))
    order = [r["k"] for r in negatives.shuffled(frame, ["k"]).collect()]
    assert order != sorted(order) and order == [r["k"] for r in negatives.shuffled_places(frame, ["k"]).orderBy("place").collect()]


# Streams


def run_stream(spark, tmp_path, build, name, mode="append"):
    """Two batches of files and a late row, then a row far ahead that moves the watermark."""
    folder = tmp_path / "in"
    folder.mkdir()
    shape = "ts timestamp, user_id long, event_type string, value double, event_id long"
    parts = [
        ["2024-01-01 00:05:00,1,a,1.0,1", "2024-01-01 00:20:00,1,a,2.0,2", "2024-01-01 00:20:00,1,a,2.0,2"],
        ["2024-01-01 00:50:00,2,b,4.0,3", "2024-01-01 03:00:00,2,b,8.0,4"],
        ["2024-01-01 00:01:00,1,a,100.0,5", "2024-01-02 00:00:00,3,c,16.0,6"],
    ]
    events = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).csv(f"file://{folder}")
    for i, part in enumerate(parts):
        (folder / f"{i}.csv").write_text("\n".join(part) + "\n")
        query = build(events).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/state").outputMode(mode).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    return spark.read.parquet(f"file://{tmp_path}/out")


def test_stream_of_windows(spark, tmp_path):
    """Windows come once the watermark has passed them; the late row counts nowhere."""
    found = run_stream(spark, tmp_path, lambda e: windows.tumbling(e, "1 hour"), "windows")
    assert rows(found.selectExpr("hour(window_start) AS h", "event_type", "n", "total")) == [(0, "a", 3, 5.0), (0, "b", 1, 4.0), (3, "b", 1, 8.0)]


def test_stream_of_first_events(spark, tmp_path):
    found = run_stream(spark, tmp_path, lambda e: windows.first_seen(e, ["event_id"]).select("event_id", "value"), "first")
    assert rows(found) == [(1, 1.0), (2, 2.0), (3, 4.0), (4, 8.0), (6, 16.0)]


def test_stream_of_sessions(spark, tmp_path):
    found = run_stream(spark, tmp_path, lambda e: windows.sessions(e, "30 minutes"), "sessions")
    assert rows(found.selectExpr("user_id", "hour(session_start) AS h", "n")) == [(1, 0, 3), (2, 0, 1), (2, 3, 1)]
