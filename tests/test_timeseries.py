"""Time-series operators: rollups, label reduction, gap filling, buffers, alignment."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from capstream.operators import timeseries as T

H = 3_600_000


def ts(h, m=0, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


@pytest.fixture(scope="module")
def series(spark):
    rows = [("a", ts(0, 5), 1.0, 1), ("a", ts(0, 5), 3.0, 2), ("a", ts(0, 50), 5.0, 3),  # tied timestamps
            ("a", ts(2, 1), 7.0, 4),                                                     # one-point bucket
            ("b", ts(0, 1), 10.0, 5), ("b", ts(1, 1), float("nan"), 6)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double, event_id long")


def _by(df):
    return {(r.series, r.bucket_start.hour): r.value for r in df.collect()}


def test_rollup_aggregators(series):
    get = lambda a: _by(T.bucket_rollup(series, "ts", "value", H, a, keys=("series",), tiebreak="event_id"))
    assert get("count")[("a", 0)] == 3 and get("sum")[("a", 0)] == 9.0 and get("range")[("a", 0)] == 4.0
    assert get("first")[("a", 0)] == 1.0 and get("last")[("a", 0)] == 5.0   # tie broken by event_id
    assert get("var.s")[("a", 2)] is None and get("var.p")[("a", 2)] == 0.0  # one point
    assert get("std.p")[("a", 0)] == pytest.approx(math.sqrt(8 / 3))
    assert get("avg")[("a", 0)] == 3.0


def test_rollup_none_and_range(series):
    raw = T.bucket_rollup(series, "ts", "value", H, "none", keys=("series",), start=ts(0, 30), end=ts(1, 30))
    assert sorted(r.value for r in raw.collect() if not math.isnan(r.value)) == [5.0]


def test_reduce_by_label_skips_nan_and_matches_direct_sum(spark, series):
    lab = series.withColumn("labels", F.create_map(F.lit("grp"), F.lit("g")))
    red = {r.bucket_start.hour: r.value for r in T.reduce_by_label(lab, "grp", "sum", H, agg="sum").collect()}
    direct = _by(T.bucket_rollup(series.where(~F.isnan("value")), "ts", "value", H, "sum", keys=("series",)))
    assert red[0] == direct[("a", 0)] + direct[("b", 0)]
    assert 1 not in red  # only a NaN series value in that bucket


def test_fill_missing_keeps_filled_buckets(series):
    r = T.bucket_rollup(series, "ts", "value", H, "count", keys=("series",))
    f = _by(T.fill_missing(r, H, keys=("series",)))
    assert f[("a", 1)] == 0 and f[("a", 0)] == 3 and f[("a", 2)] == 1
    assert all(f[k] == v for k, v in _by(r).items())


def test_fill_missing_spans_many_chunks(spark):
    n = T.CALENDAR_CHUNK * 2 + 5
    pts = spark.createDataFrame([("s", dt.datetime(2024, 1, 1), 1), ("s", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n - 1), 1)],
                                "series string, bucket_start timestamp_ntz, value long")
    f = T.fill_missing(pts, 60_000, keys=("series",))
    agg = f.agg(F.count("*"), F.sum("value"), F.count_distinct("bucket_start")).first()
    assert tuple(agg) == (n, 2, n)


def test_last_n_points(spark):
    df = spark.createDataFrame([("k", ts(0, i), str(i)) for i in range(10)] + [("j", ts(0, 0), "x")],
                               "key string, ts timestamp_ntz, v string")
    out = T.last_n_points(df, ("key",), "ts", 3, numeric=("v",))
    got = sorted((r.key, r.v_num) for r in out.collect())
    assert got == [("j", None), ("k", 7.0), ("k", 8.0), ("k", 9.0)]


def test_align_series(series):
    r = T.bucket_rollup(series, "ts", "value", H, "count", keys=("series",))
    w = {row.bucket_start.hour: (row.a, row.b) for row in T.align_series(r, "bucket_start", "series", "value", ["a", "b"]).collect()}
    assert w == {0: (3, 1), 1: (None, 1), 2: (1, None)}


def test_null_timestamps_form_their_own_bucket(spark):
    df = spark.createDataFrame([("a", ts(0, 5), 1.0), ("a", None, 2.0)], "series string, ts timestamp_ntz, value double")
    got = {(r.series, r.bucket_start): r.value
           for r in T.bucket_rollup(df, "ts", "value", H, "sum", keys=("series",)).collect()}
    assert got == {("a", dt.datetime(2024, 1, 1)): 1.0, ("a", None): 2.0}
    ltz = df.withColumn("ts", F.col("ts").cast("timestamp"))
    assert T.bucket_rollup(ltz, "ts", "value", H, "count", keys=("series",)).count() == 2


def test_buckets_ignore_the_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ntz = spark.createDataFrame([(dt.datetime(2024, 7, 1, 10, 30),)], "ts timestamp_ntz")
        assert ntz.select(T.bucket_start("ts", H).alias("b")).first().b == dt.datetime(2024, 7, 1, 10, 0)
        ltz = spark.sql("SELECT TIMESTAMP'2024-07-01 10:30:00 UTC' AS ts")
        micros = ltz.select(F.unix_micros(T.bucket_start("ts", H)).alias("u")).first().u
        assert micros == int(dt.datetime(2024, 7, 1, 10, 0, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
