"""A sample of the registered queries against their DuckDB oracles (the full set:
scripts/oracle_check.py). One or more per query family, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

duckdb = pytest.importorskip("duckdb")

SAMPLE = ["a4_envelope_roundtrip", "b6_notification_mysql", "b9_hash_rows_postgres", "b11_schema_fields",
          "d3_clerk_totals_postgres", "d4_clerk_totals_mysql", "g8_stream_hash_upsert_postgres",
          "c1_align_series", "e1_bucket_rollup_vars", "e2_reduce_by_label_avg", "e3_fill_missing_count",
          "e7_zrange_by_index_mixed", "e8_get_value", "e9_json_at_props", "e9_json_array_length", "e10_search_page1", "e14_last_n_points", "e14_last_n_points_many", "e15_values_list",
          "f3_pattern_filter", "f6_parse_mixed", "f9_field_avg_duration_ns", "f14_detected_fields", "f14_detected_fields_metadata",
          "f17_log_patterns_all", "f18_rank_series_p90", "f19_normalize_level"]


@pytest.fixture(scope="module")
def con(sf):
    from oracle_check import TABLES
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf, con, name):
    import __spark_entry__ as e
    from oracle_check import rows_of
    df = e.queries()[name](spark, sf)
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {e.oracle_sql()[name]}")
    cur = con.execute("SELECT * FROM oracle_view")
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, cur.fetchall())
