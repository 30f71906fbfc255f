"""Live volumes against the batch query, late rows and state; rolling buffers and restarts; sketches' errors."""

import pytest
from pyspark.sql import functions as F

from capstream.operators import sketches as K
from capstream.streaming import live, sinks
from capstream.streaming.versions import VersionedFolder

T0 = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def at(minutes):
    return F.timestamp_add("MINUTE", F.lit(minutes) if isinstance(minutes, int) else minutes, F.expr(T0))


def put(spark, path, rows):
    spark.createDataFrame(rows, "m int, k string, id int").select(at(F.col("m")).cast("timestamp").alias("ts"), "k", "id").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema("ts timestamp, k string, id int").option("maxFilesPerTrigger", 1).parquet(path)


def test_windows_close_state_goes_and_late_rows_are_counted(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([(0, "a", 1), (5, "a", 2), (70, "b", 3)], [(65, "a", 4), (50, None, 5), (300, "a", 6)], [(301, "b", 11)], [(299, "b", 7), (10, "a", 8)], [(2000, "end", 9)], [(2001, "end", 10)]):
        put(spark, path, part)  # (10, "a", 8) comes two batches after its window has closed
    q = sinks.sink_files(live.live_volume(stream(spark, path), "1 hour", "30 minutes", ("k",), line="k"), out, str(tmp_path / "ck"), trigger="available_now")
    q.awaitTermination()
    got = {(r.bucket_start.day, r.bucket_start.hour, r.k, r["count"], r.bytes) for r in spark.read.parquet(out).collect()}
    everything = live.live_volume(spark.read.parquet(path).where("id not in (8, 9, 10)"), "1 hour", "30 minutes", ("k",), line="k")
    assert got == {(r.bucket_start.day, r.bucket_start.hour, r.k, r["count"], r.bytes) for r in everything.collect()}
    assert live.late_rows(q) == 1
    states = live.state_rows(q)
    assert max(states) >= 3 and states[-1] == 1  # the end's own window alone


def test_rolling_buffer(spark, tmp_path):
    path, folder = str(tmp_path / "in"), VersionedFolder(str(tmp_path / "buffer"))
    put(spark, path, [(i, "a", i) for i in range(50)] + [(1, "old", 0)])
    put(spark, path, [(i, k, i) for i in range(40, 90) for k in ("a", "b")])
    for ck in ("ck", "ck", "again"):  # run, run on without news, and all over with a new checkpoint
        sink = live.rolling_buffer(VersionedFolder(folder.path), ("k",), "ts", 5, "id", ttl="1 hour")
        q = sinks.fan_out(stream(spark, path), [sink], str(tmp_path / ck), trigger="available_now")
        q.awaitTermination()
        rows = sorted((r.k, r.id) for r in folder.newest(spark).collect())
        assert rows == [(k, i) for k in "ab" for i in range(85, 90)]
        assert len(folder.complete(spark)) <= 2
    put(spark, path, [(3000, "c", 1)])
    sinks.fan_out(stream(spark, path), [live.rolling_buffer(VersionedFolder(folder.path), ("k",), "ts", 5, "id", ttl="1 hour")], str(tmp_path / "ck"),
                  trigger="available_now").awaitTermination()
    assert [(r.k, r.id) for r in folder.newest(spark).collect()] == [("c", 1)]


@pytest.fixture(scope="module")
def values(spark):
    return spark.range(60_000).select(F.timestamp_add("SECOND", F.col("id"), F.expr(T0)).alias("ts"), (F.col("id") % 3).cast("string").alias("s"),
                                      (F.col("id") * 7919 % 20011).alias("v")).cache()


def test_distinct_sketches_merge(values):
    fine = K.distinct_sketches(values, ("s",), "v", 600_000)
    hours = K.united(fine, ("s",), 3_600_000)
    got = {r.s: r.n_values for r in K.distinct_counts(K.united(hours, ("s",))).collect()}
    assert got == {r.s: r.n_values for r in K.distinct_counts(K.united(fine, ("s",))).collect()}
    want = {r.s: r.n for r in values.groupBy("s").agg(F.count_distinct("v").alias("n")).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= K.distinct_error() * want[s] for s in got)
    none = values.limit(3).select("s", F.lit(None).cast("string").alias("v"))
    assert {r.n_values for r in K.distinct_counts(K.distinct_sketches(none, ("s",), "v")).collect()} == {0}


def test_value_sketches_merge(spark, values):
    fine = K.value_sketches(values, ("s",), "v", 600_000)
    for coarse in (K.merged(fine, ("s",)), K.merged(K.merged(fine, ("s",), 3_600_000), ("s",))):
        for r in K.percentiles(coarse, p10=0.1, p50=0.5, p99=0.99).collect():
            own = values.where(F.col("s") == r.s)
            for q, x in ((0.1, r.p10), (0.5, r.p50), (0.99, r.p99)):
                below, upto = own.agg(F.avg((F.col("v") < x).cast("double")), F.avg((F.col("v") <= x).cast("double"))).collect()[0]
                assert below - K.rank_error() <= q <= upto + K.rank_error()
    few = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("n", None)], "s string, v double")
    got = {r.s: r.p50 for r in K.percentiles(K.value_sketches(few, ("s",), "v"), p50=0.5).collect()}
    assert got == {"a": 2.0, "n": None}
