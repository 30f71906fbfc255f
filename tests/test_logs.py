"""Log operators: filters, parsers, quantities, levels, discovery, patterns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from capstream.functions.logfields import mask_template, normalize_level, parse_fields, parse_quantity, pattern_regex
from capstream.operators import logs as L

LINES = [
    '{"level":"ERROR","latency":"12ms","size":"3KB","user":"u1"}',
    'level=info latency=1h30m size=2KiB msg="hello \\"world\\"" user=u2',
    'WARN something happened id=7',
    'plain text without level',
    'level=Debug latency=bad size=1MB user=u1',
]


@pytest.fixture(scope="module")
def logs(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, i), {"app": "a" if i % 2 else "b", **({"zone": "z1"} if i == 0 else {})}, l)
            for i, l in enumerate(LINES)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, labels map<string,string>, line string")


def test_line_filters(logs):
    assert L.line_filter(logs, "|=", "level").count() == 4
    assert L.line_filter(logs, "|=", "LEVEL").count() == 0
    assert L.line_filter(logs, "|=", "LEVEL", case_sensitive=False).count() == 4
    assert L.line_filter(logs, "!=", "level").count() == 1
    assert L.line_filter(logs, "!~", "^level").count() == 3
    assert L.line_filter(logs, "|~", "warn", case_sensitive=False).count() == 1


def test_pattern_filter(logs):
    assert pattern_regex("a <_> b.") == r"(?s)\Aa\ (.*?)\ b\.\z"
    inc = L.pattern_filter(logs, include=["level=<_> latency=<_>", "WARN <_>"], exclude=["<_>Debug<_>"])
    assert inc.count() == 2


def test_line_breaks_inside_a_line(spark):
    df = spark.createDataFrame([("Licensed under A\rB",), ("Licensed under A\n",), ('k="a\nb" j=2 k=3',), ('q="x \\" y" z',)], "line string")
    assert L.pattern_filter(df, include=["Licensed under <_>"]).count() == 2
    assert L.pattern_filter(df, include=["Licensed under A"]).count() == 0
    got = [r.fields for r in L.with_fields(df, "logfmt").collect()]
    assert got == [{}, {}, {"k": "a\nb", "j": "2"}, {"q": 'x " y'}]


def test_fields_in_metadata(spark):
    df = spark.createDataFrame([("plain", {"trace": "1", "level": "x"}), ('{"a": 1}', {"a": "2"}), (None, None)],
                               "line string, labels map<string,string>")
    got = sorted(map(tuple, L.detected_fields(df, metadata="labels").collect()))
    assert got == [("a", 2, "json", "int"), ("trace", 1, "structuredMetadata", "int")]
    stats = {r.label: (r.percent_of_lines, r.cardinality, r.max_length) for r in L.column_stats(df).collect()}
    assert stats == {"trace": (34, 1, 1), "level": (34, 1, 1), "a": (34, 1, 1)}


def test_label_and_field_filters(logs):
    assert L.label_filter(logs, "app", "=~", "a|c").count() == 2
    assert L.label_filter(logs, "zone", "!=", "z1").count() == 4  # missing label counts as ""
    f = L.with_fields(logs, "mixed")
    assert L.field_filter(f, "latency", ">", 60, kind="duration").count() == 1
    assert L.field_filter(f, "size", ">=", 2048, kind="bytes").count() == 3


def test_parse_fields_formats(spark, logs):
    f = [r.m for r in logs.orderBy("ts").select(parse_fields(F.col("line"), "mixed").alias("m")).collect()]
    assert f[0]["latency"] == "12ms"
    assert f[1]["msg"] == 'hello "world"' and f[1]["latency"] == "1h30m"
    assert f[3] == {} and f[2] == {"id": "7"}
    j = logs.select(parse_fields(F.col("line"), "json").alias("m")).collect()
    assert sum(1 for r in j if r.m) == 1


def test_parse_quantity(spark):
    df = spark.createDataFrame([("12ms",), ("1h30m",), ("3KB",), ("2KiB",), ("1.5s",), ("bad",), (None,)], "v string")
    r = df.select(parse_quantity("v", "duration").alias("d"), parse_quantity("v", "bytes").alias("b"),
                  parse_quantity("v", "duration", "ms").alias("ms")).collect()
    assert [x.d for x in r] == [0.012, 5400.0, None, None, 1.5, None, None]
    assert [x.b for x in r] == [None, None, 3000.0, 2048.0, None, None, None]
    assert r[1].ms == 5_400_000.0


def test_levels(spark, logs):
    df = spark.createDataFrame([(x,) for x in ["INFO", "warning", "Warn", "FATAL", "crit", "unknown", None, "trace"]], "l string")
    assert [r.n for r in df.select(normalize_level("l").alias("n")).collect()] == \
        ["info", "warn", "warn", "critical", "critical", "logs", "logs", "logs"]
    lv = [r.detected_level for r in L.with_level(L.with_fields(logs, "mixed")).orderBy("ts").collect()]
    assert lv == ["error", "info", "warn", "logs", "debug"]


def test_volumes(logs):
    f = L.with_level(L.with_fields(logs, "mixed"))
    assert L.log_volume(f, 3_600_000).first()["count"] == 5
    by = {r.app: r["count"] for r in L.log_volume(f, 3_600_000, by="app").collect()}
    assert by == {"a": 2, "b": 3}
    avg = L.field_avg(f, "latency", 3_600_000, kind="duration").first()["avg"]
    assert avg == pytest.approx((0.012 + 5400) / 2)
    br = {r.user: r["count"] for r in L.field_breakdown(f, "user", 3_600_000).collect()}
    assert br == {"u1": 2, "u2": 1}
    roll = L.rollup_volume(L.log_volume(f, 60_000, by="detected_level"), 3_600_000)
    assert roll.agg(F.sum("count")).first()[0] == 5


def test_discovery(spark, logs):
    assert [(r.label, r.cardinality) for r in L.detected_labels(logs).collect()] == [("app", 2), ("zone", 1)]
    stats = {r.label: (r.percent_of_lines, r.cardinality, r.max_length) for r in L.column_stats(logs).collect()}
    assert stats == {"app": (100, 2, 1), "zone": (20, 1, 2)}
    assert all(1 <= v[0] <= 100 for v in stats.values())
    assert L.label_sparsity(logs, "zone").first().percent == pytest.approx(20.0)
    fields = {r.name: (r.cardinality, r.parsers, r.type) for r in L.detected_fields(logs).collect()}
    assert fields["latency"] == (3, "json,logfmt", "string")  # "bad" makes it text
    assert fields["size"] == (3, "json,logfmt", "bytes")
    assert fields["id"] == (1, "logfmt", "int")
    assert "level" not in fields
    top = L.top_volume(logs, "app", limit=1).collect()
    assert len(top) == 1 and top[0].app == "b"


def test_patterns_and_rank(spark, logs):
    assert spark.range(1).select(mask_template(F.lit('id=7 t="x y" 0xff 10.0.0.1 12ms'))).first()[0] == \
        'id=<_> t=<_>'  # consecutive placeholders collapse into one
    assert L.log_patterns(logs, 3_600_000).agg(F.sum("count")).first()[0] == 5  # default: last 3 hours
    p = L.log_patterns(logs, 3_600_000, recent_ms=2 * 60_000)
    assert p.agg(F.sum("count")).first()[0] == 3  # lines at minutes 2..4
    s = spark.createDataFrame([("a", float(v)) for v in range(11)] + [("b", 5.0), ("b", 5.0)], "s string, v double")
    r = [(x.s, x.score) for x in L.rank_series(s, "s", "v", "p90").collect()]
    assert r == [("a", 9.0), ("b", 5.0)]
    assert [x.s for x in L.rank_series(s, "s", "v", "stddev", desc=False).collect()] == ["b", "a"]
    assert [x.s for x in L.rank_series(s, "s", "v", "no-such-stat").collect()] == ["a", "b"]  # falls back


def test_exact_percentile_matches_brute_force(spark):
    # one group big enough for the sketch-bracketed path, one tiny, one with ties
    big = spark.range(45_000).select(F.lit("big").alias("k"), ((F.col("id") * 7919) % 10007).cast("double").alias("v"))
    small = spark.createDataFrame([("one", 3.0), ("ties", 1.0), ("ties", 1.0), ("ties", 2.0)], "k string, v double")
    df = big.unionByName(small)
    for q in (0.0, 0.1, 0.5, 0.9, 0.99, 1.0):
        got = {r.k: r.score for r in L.exact_percentile(df, ("k",), "v", q).collect()}
        want = {r.k: r.s for r in df.groupBy("k").agg(F.percentile("v", q).alias("s")).collect()}
        assert got == pytest.approx(want)


def test_with_fields_twice_replaces_and_all_null_series_kept(spark, logs):
    twice = L.with_fields(L.with_fields(logs, "json"), "logfmt")
    assert twice.columns.count("fields") == 1
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("n", None)], "s string, v double")
    got = {r.s: r.score for r in L.rank_series(df, "s", "v", "p90").collect()}
    assert got == {"a": pytest.approx(2.8), "n": None}


def test_exact_percentile_ignores_nulls_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("a", None), (None, 5.0), (None, 7.0)],
                               "k string, v double")
    got = {r.k: r.score for r in L.exact_percentile(df, ("k",), "v", 0.5).collect()}
    want = {r.k: r.s for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("s")).collect()}
    assert got == want == {"a": 2.0, None: 6.0}
