"""Offset audit: planted gaps and repeats are reported exactly, in one batch or many."""

import random

from pyspark.sql import functions as F

from capstream.operators import offsets as O
from capstream.schema import KAFKA_ROW_DDL
from capstream.streaming import sinks
from capstream.streaming.versions import VersionedFolder


def brute(rows):
    out = {}
    for t, p, o in rows:
        if o is not None:
            out.setdefault((t, p), []).append(o)
    found = {}
    for key, seen in out.items():
        there, runs = sorted(set(seen)), []
        for o in there:
            if runs and o == runs[-1][1] + 1:
                runs[-1][1] = o
            else:
                runs.append([o, o])
        found[key] = [(a, b, sum(a <= o <= b for o in seen)) for a, b in runs]
    return found


def told(ranges):
    out = {}
    for r in ranges.collect():
        out.setdefault((r.topic, r.partition), []).append((r["first"], r["last"], r.messages))
    return {k: sorted(v) for k, v in out.items()}


def test_ranges_gaps_and_repeats(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([None, *range(-20, 200)])) for _ in range(700)] + [("c", 0, 5)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long").repartition(4)
    want = brute(rows)
    for block in (7, 64, 1 << 20):
        assert told(O.offset_ranges(df, block=block)) == want
    parts = [O.offset_ranges(df.where(F.pmod(F.hash("offset"), F.lit(3)) == i), block=16) for i in range(3)]
    merged = O.merge_ranges(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert told(merged) == want
    missing = {(r.topic, r.partition): 0 for r in merged.collect()}
    for r in O.gaps(merged).collect():
        missing[r.topic, r.partition] += r.missing
        assert r.missing == r.last_missing - r.first_missing + 1 > 0
    for r in O.audit(merged).collect():
        runs = want[r.topic, r.partition]
        seen = sum(b - a + 1 for a, b, _ in runs)
        assert (r["first"], r["last"], r.ranges, r.offsets, r.repeats) == (runs[0][0], runs[-1][1], len(runs), seen, sum(m for *_, m in runs) - seen)
        assert r.missing == missing[r.topic, r.partition]
    assert O.audit(O.offset_ranges(df.limit(0))).collect() == []


def overlapping(ranges):
    out = {}
    for key, first, last, messages in sorted(ranges, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        runs = out.setdefault(key, [])
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], max(runs[-1][1], last), runs[-1][2] + messages)
        else:
            runs.append((first, last, messages))
    return out


def test_ranges_longer_than_blocks_merge(spark):
    rng = random.Random(3)
    for longest in (3, 40, 400):
        starts = [rng.randrange(-300, 3000) for _ in range(300)]
        rows = [(rng.choice(["a", "b", None]), a, a + rng.choice([0, 1, rng.randrange(longest)]), rng.randrange(1, 4)) for a in starts]
        df = spark.createDataFrame(rows, "topic string, first long, last long, messages long").repartition(3)
        want = overlapping(rows)
        merged = O.merge_ranges(df, ("topic",), block=16).persist()
        got = {}
        for r in merged.collect():
            got.setdefault(r.topic, []).append((r["first"], r["last"], r.messages))
        assert {k: sorted(v) for k, v in got.items()} == want
        missing = sorted((str(k), x[1] + 1, y[0] - 1) for k, runs in want.items() for x, y in zip(runs, runs[1:], strict=False))
        assert sorted((str(r.topic), r.first_missing, r.last_missing) for r in O.gaps(merged, ("topic",), block=16).collect()) == missing
        merged.unpersist()


def test_ranges_of_one_key_are_spread_over_tasks(spark):
    df = spark.range(0, 40_000, 2).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    ranges = O.offset_ranges(df, block=256)
    for found, n in ((ranges, 20_000), (O.merge_ranges(ranges, block=256), 20_000), (O.gaps(ranges, block=256), 19_999)):
        held = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == n and max(held) < n / 5


def test_stream_reports_planted_losses(spark, tmp_path):
    df = spark.range(1000).where("id not between 300 and 349 and id <> 777").select(F.lit(0).alias("partition"), "id")
    twice = df.unionByName(df.where("id between 100 and 109")).select(
        F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), F.lit("t").alias("topic"), "partition", F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    twice.repartition(8).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KAFKA_ROW_DDL).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    log = VersionedFolder(str(tmp_path / "ranges"))
    q = sinks.fan_out(stream, [O.range_log(log)], str(tmp_path / "ck"), trigger="available_now")
    q.awaitTermination()
    merged = O.merge_ranges(log.read(spark).drop("run", "epoch"))
    assert sorted((r.first_missing, r.last_missing) for r in O.gaps(merged).collect()) == [(300, 349), (777, 777)]
    assert [(r.missing, r.repeats) for r in O.audit(merged).collect()] == [(51, 10)]
