"""Plan properties that keep the operators scalable (checked on the physical plan)."""

import re

import pytest

from pyspark.sql import functions as F

from capstream.functions.parse import parse_events, schema_field_counts
from capstream.functions.shape import hash_rows_for
from capstream.operators import logs as L
from capstream.operators import serving as V
from capstream.operators import timeseries as T
from capstream.operators.aggregate import clerk_totals
from capstream.plans import standins as S


def plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


def scan_filters(text):
    return " ".join(re.findall(r"DataFilters: \[([^\]]*)\]", text))


def test_totals_combine_before_the_shuffle(spark, sf, capsys):
    p = plan(clerk_totals(parse_events(S.source_messages(spark, sf, "postgres"), "postgres"), "postgres",
                          ("count", "sum")), capsys)
    assert "partial_count" in p and "partial_sum" in p


def test_null_key_skip_stays_above_the_aggregate(spark, sf, capsys):
    totals = clerk_totals(parse_events(S.source_messages(spark, sf, "mysql"), "mysql"), "mysql", ("count", "sum"))
    p = plan(hash_rows_for(totals, "mysql"), capsys)
    assert "from_json" not in scan_filters(p)


def test_schema_counts_parse_only_distinct_schemas(spark, sf, capsys):
    p = plan(schema_field_counts(S.source_messages(spark, sf, "postgres")), capsys)
    assert "from_json" not in scan_filters(p)
    # the full schema parse happens after the count per distinct text
    assert p.index("partial_count") > p.index("Generate") if "Generate" in p else True


@pytest.mark.parametrize("n", [10, 100_000])
def test_top_n_never_sorts_a_whole_key(spark, sf, capsys, n):
    e = S.table(spark, sf, "events")
    for df in (T.last_n_points(e, ("event_type",), "ts", n, tiebreak="event_id"),
               V.range_entries(e, "ts", count=n, keys=("event_type",), tiebreak="event_id")):
        p = plan(df, capsys)
        windows = re.findall(r"row_number\(\)[^\n]*windowspecdefinition\(([^\n]*)", p)
        if n <= 1000:  # partitions, then groups of them, keep n rows per key before the key meets
            assert len(re.findall(r"WindowGroupLimit \(", p)) >= 4 and "_part" in windows[0]
        else:
            assert windows and all("_slice" in w for w in windows) and "Subquery" in p
            assert "partial_count" in p and "Cartesian" not in p and "NestedLoop" not in p  # counts per slice are aggregated before the shuffle


def test_exact_percentile_never_buffers_a_whole_group(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    p = plan(L.exact_percentile(df, ("k",), "v", 0.9), capsys)
    assert not re.search(r"\bpercentile\(", p)
    assert re.search(r"Keys \[\d\]: \[[^\n]*_v#[^\n]*\nFunctions \[1\]: \[partial_count", p)  # equal values are one counted row first


def test_distinct_counts_dedupe_first(spark, sf, capsys):
    p = plan(L.detected_labels(S.document_logs(spark, sf)), capsys)
    # (name, value) grouped without aggregate functions before the per-name count
    assert re.search(r"Keys \[2\]: \[name#\d+, value#\d+\]\s*\nFunctions: \[\]", p)


def test_no_inferred_filter_recomputes_the_split(spark, sf, capsys):
    p = plan(L.top_volume(S.document_logs(spark, sf), "source"), capsys)
    assert "split" not in scan_filters(p)


def test_mixed_index_range_ranks_by_slices(spark, capsys):
    z = spark.range(100).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("member"),
                                F.col("id").cast("double").alias("score"))
    p = plan(V.zrange(z, 1, -2), capsys)
    assert "ExistingRDD" not in p  # no checkpoint; split points are a local table
    assert all("_slice" in w for w in re.findall(r"row_number\(\)[^\n]*windowspecdefinition\(([^\n]*)", p))


def test_logfmt_pairs_are_found_once(spark, sf, capsys):
    p = plan(L.with_fields(S.event_logs(spark, sf), "logfmt"), capsys)
    assert p.count("regexp_extract_all") == 1


def test_events_declare_only_their_fields(spark):
    from capstream.functions.parse import event_schema
    assert event_schema((("purchase", "p"), ("clerk", "c"))) == "payload struct<after struct<purchase bigint, clerk string>>"


def test_fill_and_stats_scan_once(spark, sf, capsys):
    ev = S.series_by_type(spark, sf)
    r = T.bucket_rollup(ev, "ts", "value", 3_600_000, "count", keys=("series",))
    assert plan(T.fill_missing(r, 3_600_000, keys=("series",)), capsys).count("Scan parquet") <= 2  # node and its detail
    assert plan(L.column_stats(S.event_logs(spark, sf)), capsys).count("Scan parquet") <= 2


def test_filters_on_parsed_columns_stay_above_the_parse(spark, sf, capsys):
    ev = parse_events(S.source_messages(spark, sf, "mysql"), "mysql", with_op=True)
    p = plan(clerk_totals(ev, "mysql", ("count",), ops=("c", "r")), capsys)
    conditions = re.findall(r"Condition : (.*)", p)
    assert conditions and not any("from_json" in c for c in conditions)
    assert p.count("from_json(") == 1  # parsed once, in the generator's input
