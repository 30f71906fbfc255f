"""Property tests (seeded random inputs) checked against plain-Python brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from capstream.functions.logfields import BYTE_UNITS, DURATION_UNITS, logfmt_map, parse_quantity
from capstream.operators import timeseries as T

SETTINGS = settings(max_examples=4, deadline=None)

dur_part = st.tuples(st.integers(0, 10_000), st.sampled_from(sorted(DURATION_UNITS)))
byte_part = st.tuples(st.integers(0, 10_000), st.sampled_from(sorted(BYTE_UNITS)))


@SETTINGS
@given(st.lists(st.lists(dur_part, min_size=1, max_size=4), min_size=1, max_size=30),
       st.lists(byte_part, min_size=1, max_size=30))
def test_quantities_match_python(spark, durations, sizes):
    d_text = ["".join(f"{n}{u}" for n, u in parts) for parts in durations]
    d_want = [sum(n * DURATION_UNITS[u] for n, u in parts) for parts in durations]  # ns
    rows = spark.createDataFrame([(t,) for t in d_text], "v string")
    got = [r.x for r in rows.select(parse_quantity("v", "duration", "ns").alias("x")).collect()]
    assert got == [float(x) for x in d_want]
    b_text = [f"{n}{u}" for n, u in sizes]
    rows = spark.createDataFrame([(t,) for t in b_text], "v string")
    got = [r.x for r in rows.select(parse_quantity("v", "bytes").alias("x")).collect()]
    assert got == [n * BYTE_UNITS[u] for n, u in sizes]


key = st.from_regex(r"[a-z_][a-z0-9_]{0,6}", fullmatch=True)
value = st.text(alphabet=st.sampled_from(list("abc XYZ=019.-_\"")), max_size=12)


@SETTINGS
@given(st.lists(st.dictionaries(key, value, min_size=1, max_size=5), min_size=1, max_size=20))
def test_logfmt_roundtrip(spark, records):
    def render(v):
        if v == "" or any(c in v for c in ' ="'):
            return '"' + v.replace('"', '\\"') + '"'
        return v
    lines = [" ".join(f"{k}={render(v)}" for k, v in rec.items()) for rec in records]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = [r.m for r in df.select(logfmt_map("line").alias("m")).collect()]
    assert got == records


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5 * 24 * 60), st.integers(-1000, 1000)),
                min_size=1, max_size=200),
       st.sampled_from([60_000, 3_600_000, 7 * 60_000]))
def test_rollup_and_fill_match_brute_force(spark, points, bucket_ms):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(minutes=m), float(v)) for k, m, v in points]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")
    step = dt.timedelta(milliseconds=bucket_ms)
    epoch = dt.datetime(1970, 1, 1)  # buckets are epoch-aligned
    want: dict = {}
    for k, t, v in rows:
        b = epoch + ((t - epoch) // step) * step
        c, s = want.get((k, b), (0, 0.0))
        want[(k, b)] = (c + 1, s + v)
    r = T.bucket_rollup(df, "ts", "value", bucket_ms, "count", keys=("series",))
    got = {(x.series, x.bucket_start): x.value for x in r.collect()}
    assert got == {k: c for k, (c, _) in want.items()}
    sums = {(x.series, x.bucket_start): x.value
            for x in T.bucket_rollup(df, "ts", "value", bucket_ms, "sum", keys=("series",)).collect()}
    assert sums == {k: s for k, (_, s) in want.items()}
    filled = {(x.series, x.bucket_start): x.value for x in T.fill_missing(r, bucket_ms, keys=("series",)).collect()}
    for k in {k for k, _ in want}:
        bs = sorted(b for kk, b in want if kk == k)
        n = (bs[-1] - bs[0]) // step + 1
        assert sum(1 for kk, _ in filled if kk == k) == n
    assert all(filled[k] == c for k, (c, _) in want.items())
    assert sum(filled.values()) == len(rows)
