"""Registered time-series, key/value and panel queries (E1-E16, C1) over ``events``,
``documents`` and the change-stream totals, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from capstream.functions.shape import HASH_PREFIX, hash_rows_for
from capstream.operators import documents as D
from capstream.operators import labelindex as LI
from capstream.operators import panel as P
from capstream.operators import serving as V
from capstream.operators import textindex as TI
from capstream.operators import timeseries as T
from capstream.operators.aggregate import clerk_totals
from capstream.functions.parse import parse_events
from capstream.plans import standins as S
from capstream.plans import streams as ST
from capstream.plans.registry import register, round_text, spark_round_text, sql_round
from capstream.schema import TOTAL_FIELDS
from capstream.session import shared_path

HOUR_MS, DAY_MS = 3_600_000, 86_400_000
R = 6  # decimals kept for floating results on both sides

_SQL_AGG = {
    "avg": "avg(value)", "count": "count(value)", "max": "max(value)", "min": "min(value)",
    "range": "max(value) - min(value)", "sum": "sum(value)",
    # NULLS FIRST: Spark orders NULL timestamps/ids lowest in min_by/max_by
    "first": "first(value ORDER BY ts NULLS FIRST, event_id NULLS FIRST)",
    "last": "last(value ORDER BY ts NULLS FIRST, event_id NULLS FIRST)",
    "std.p": "stddev_pop(value)", "std.s": "stddev_samp(value)",
    "var.p": "var_pop(value)", "var.s": "var_samp(value)",
}


def _tag(name: str) -> str:
    return name.replace(".", "")


def _round(c, agg):
    return c if agg == "count" else sql_round(c, R)


def _round_sql(expr: str, agg: str) -> str:
    return expr if agg == "count" else round_text(expr, R)


# --- E1: bucket rollup, one query per aggregator ------------------------------

def _e1(agg):
    def fn(spark, d):
        r = T.bucket_rollup(S.series_by_type(spark, d), "ts", "value", HOUR_MS, agg, keys=("series",),
                            tiebreak="event_id")
        return r.select("series", "bucket_start", _round(F.col("value"), agg).alias("value"))
    sql = (f"SELECT event_type AS series, {S.bucket_sql('ts', HOUR_MS)} AS bucket_start, "
           f"{_round_sql(_SQL_AGG[agg], agg)} AS value FROM events GROUP BY 1, 2")
    return fn, sql


for _a in T.AGGREGATORS:
    _f, _s = _e1(_a)
    register(f"e1_bucket_rollup_{_tag(_a)}", _s)(_f)

register("e1_bucket_rollup_none_range",
         "SELECT event_type AS series, ts AS bucket_start, value FROM events "
         "WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'")(
    lambda spark, d: T.bucket_rollup(S.series_by_type(spark, d), "ts", "value", HOUR_MS, "none", keys=("series",),
                                     start="2024-01-10 00:00:00", end="2024-01-12 00:00:00"))


# --- E2: per-series sums reduced across series sharing a label ---------------

def _e2(red):
    def fn(spark, d):
        r = T.reduce_by_label(S.series_by_user(spark, d), "event_type", red, HOUR_MS, agg="sum")
        return r.select("event_type", "bucket_start", _round(F.col("value"), red).alias("value"))
    inner = (f"SELECT event_type, event_type || ':' || user_id AS series, {S.bucket_sql('ts', HOUR_MS)} AS b, "
             f"sum(value) AS value FROM events GROUP BY 1, 2, 3")
    sql = (f"SELECT event_type, b AS bucket_start, {_round_sql(_SQL_AGG[red], red)} AS value "
           f"FROM ({inner}) s WHERE event_type IS NOT NULL AND (value IS NULL OR NOT isnan(value)) GROUP BY 1, 2")
    return fn, sql


for _r in T.REDUCERS:
    _f, _s = _e2(_r)
    register(f"e2_reduce_by_label_{_tag(_r)}", _s)(_f)


# --- E3: fill empty buckets ----------------------------------------------------

register("e3_fill_missing_count", f"""
WITH r AS (SELECT event_type AS series, {S.bucket_sql('ts', HOUR_MS)} AS bucket_start, count(value) AS value
           FROM events GROUP BY 1, 2),
     b AS (SELECT series, min(bucket_start) AS lo, max(bucket_start) AS hi FROM r GROUP BY series),
     cal AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket_start FROM b)
SELECT cal.series, cal.bucket_start, COALESCE(r.value, 0) AS value
FROM cal LEFT JOIN r ON cal.series = r.series AND cal.bucket_start = r.bucket_start""")(
    lambda spark, d: T.fill_missing(
        T.bucket_rollup(S.series_by_type(spark, d), "ts", "value", HOUR_MS, "count", keys=("series",)),
        HOUR_MS, keys=("series",)))


# --- E4: latest sample per key ---------------------------------------------------

register("e4_latest_per_type",
         "SELECT event_type AS series, max(ts) AS ts, "
         "last(value ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS value FROM events GROUP BY 1")(
    lambda spark, d: V.latest_per_key(S.series_by_type(spark, d), ("series",), "ts", "value", "event_id"))
register("e4_latest_per_user",
         "SELECT user_id, max(ts) AS ts, last(value ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS value "
         "FROM events GROUP BY 1")(
    lambda spark, d: V.latest_per_key(S.table(spark, d, "events"), ("user_id",), "ts", "value", "event_id"))


# --- E5: label filter, key listing ------------------------------------------------

register("e5_list_series_click",
         "SELECT DISTINCT event_type || ':' || user_id AS series FROM events WHERE event_type = 'click'")(
    lambda spark, d: V.list_series(V.match_labels(S.series_by_user(spark, d), equals={"event_type": "click"})))
register("e5_list_series_not_view_or_error",
         "SELECT DISTINCT event_type || ':' || user_id AS series FROM events "
         "WHERE event_type NOT IN ('view', 'error')")(
    lambda spark, d: V.list_series(V.match_labels(S.series_by_user(spark, d), none_of={"event_type": ["view", "error"]},
                                                  present=("user",))))


# --- E6: stream entry ranges --------------------------------------------------------

_E6_WHERE = "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'"
register("e6_range_entries_forward",
         f"SELECT event_id, ts, event_type, value FROM events WHERE {_E6_WHERE} ORDER BY ts, event_id LIMIT 100")(
    lambda spark, d: V.range_entries(S.table(spark, d, "events").select("event_id", "ts", "event_type", "value"),
                                     "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00", 100, tiebreak="event_id"))
register("e6_range_entries_reverse",
         f"SELECT event_id, ts, event_type, value FROM events WHERE {_E6_WHERE} "
         "ORDER BY ts DESC, event_id DESC LIMIT 100")(
    lambda spark, d: V.range_entries(S.table(spark, d, "events").select("event_id", "ts", "event_type", "value"),
                                     "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00", 100, reverse=True,
                                     tiebreak="event_id"))
register("e6_range_entries_per_type",
         "SELECT event_id, ts, event_type, value FROM events "
         "QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 5")(
    lambda spark, d: V.range_entries(S.table(spark, d, "events").select("event_id", "ts", "event_type", "value"),
                                     "ts", count=5, keys=("event_type",), tiebreak="event_id"))


# --- E7: sorted sets (users scored by their total per event type) ----------------------

def _zsets(spark, d):
    return (S.table(spark, d, "events").groupBy(F.col("event_type").alias("key"),
                                                F.concat(F.lit("user:"), F.col("user_id")).alias("member"))
            .agg(sql_round(F.sum("value"), 2).alias("score")))


_ZSETS_SQL = (f"SELECT event_type AS key, 'user:' || user_id AS member, {round_text('sum(value)', 2)} AS score "
              "FROM events GROUP BY 1, 2")
register("e7_zrange_by_index",
         f"SELECT key, member, score, rn - 1 AS rank FROM (SELECT *, row_number() OVER "
         f"(PARTITION BY key ORDER BY score NULLS FIRST, member NULLS FIRST) AS rn FROM ({_ZSETS_SQL}) z) WHERE rn <= 10")(
    lambda spark, d: V.zrange(_zsets(spark, d), 0, 9).withColumn("rank", F.col("rank").cast("bigint")))
register("e7_zrange_by_index_tail",
         f"SELECT key, member, score, n - rb AS rank FROM (SELECT *, row_number() OVER "
         f"(PARTITION BY key ORDER BY score DESC, member DESC) AS rb, count(*) OVER (PARTITION BY key) AS n "
         f"FROM ({_ZSETS_SQL}) z) WHERE rb <= 3")(
    lambda spark, d: V.zrange(_zsets(spark, d), -3, -1).withColumn("rank", F.col("rank").cast("bigint")))
register("e7_zrange_by_index_mixed",
         f"SELECT key, member, score, rn - 1 AS rank FROM (SELECT *, row_number() OVER "
         f"(PARTITION BY key ORDER BY score NULLS FIRST, member NULLS FIRST) AS rn, count(*) OVER (PARTITION BY key) AS n "
         f"FROM ({_ZSETS_SQL}) z) WHERE rn - 1 >= 1 AND rn - 1 <= n - 2")(
    lambda spark, d: V.zrange(_zsets(spark, d), 1, -2))
register("e7_zrange_by_score",
         f"SELECT key, member, score FROM ({_ZSETS_SQL}) z WHERE score BETWEEN 1000 AND 1500")(
    lambda spark, d: V.zrange(_zsets(spark, d), 1000, 1500, by="score"))


# --- E8: hash, set and list reads ----------------------------------------------------

def _hashes(spark, d):
    return hash_rows_for(clerk_totals(parse_events(S.source_messages(spark, d, "postgres"), "postgres", fields=TOTAL_FIELDS),
                                      "postgres", ("count", "sum")), "postgres")


_TOTALS_PG = ("SELECT postgres_clerk, count(postgres_purchase) AS c, CAST(sum(postgres_purchase) AS BIGINT) AS s "
              f"FROM ({S.events_sql('postgres')}) e WHERE postgres_clerk IS NOT NULL GROUP BY 1")
_PG = HASH_PREFIX["postgres"]
register("e8_hash_getall",
         f"SELECT '{_PG}' || postgres_clerk AS hash_key, 'Count' AS field, CAST(c AS VARCHAR) AS value "
         f"FROM ({_TOTALS_PG}) t UNION ALL SELECT '{_PG}' || postgres_clerk, 'Sum', CAST(s AS VARCHAR) "
         f"FROM ({_TOTALS_PG}) t")(lambda spark, d: V.hash_getall(_hashes(spark, d)))
register("e8_hash_len", f"SELECT '{_PG}' || postgres_clerk AS hash_key, CAST(2 AS BIGINT) AS n_fields "
                        f"FROM ({_TOTALS_PG}) t")(lambda spark, d: V.hash_len(_hashes(spark, d)))
register("e8_hash_get_sum",
         f"SELECT '{_PG}' || postgres_clerk AS hash_key, CAST(s AS VARCHAR) AS value FROM ({_TOTALS_PG}) t")(
    lambda spark, d: V.hash_get(_hashes(spark, d), "Sum"))
register("e8_hash_mget",
         f"SELECT '{_PG}' || postgres_clerk AS hash_key, CAST(c AS VARCHAR) AS \"Count\", "
         f"CAST(s AS VARCHAR) AS \"Sum\" FROM ({_TOTALS_PG}) t")(
    lambda spark, d: V.hash_mget(_hashes(spark, d), ["Count", "Sum"]))
register("e8_hash_keys",
         f"SELECT '{_PG}' || postgres_clerk AS hash_key, f AS field FROM ({_TOTALS_PG}) t, "
         "(VALUES ('Count'), ('Sum')) v(f)")(
    lambda spark, d: V.hash_keys(_hashes(spark, d)))
register("e8_set_members",
         "SELECT DISTINCT event_type AS key, user_id AS member FROM events")(
    lambda spark, d: V.set_members(S.table(spark, d, "events").select(F.col("event_type").alias("key"),
                                                                      F.col("user_id").alias("member"))))
register("e8_set_card", "SELECT event_type AS key, count(DISTINCT user_id) AS n_members FROM events GROUP BY 1")(
    lambda spark, d: V.set_card(S.table(spark, d, "events").select(F.col("event_type").alias("key"),
                                                                   F.col("user_id").alias("member"))))
register("e8_list_len", "SELECT event_type AS key, count(*) AS n_entries FROM events GROUP BY 1")(
    lambda spark, d: V.list_len(S.table(spark, d, "events").select(F.col("event_type").alias("key"))))


register("e8_get_value", f"SELECT CAST(s AS VARCHAR) AS value FROM ({_TOTALS_PG}) t WHERE postgres_clerk = '1-URGENT'")(
    lambda spark, d: V.get_value(V.hash_get(_hashes(spark, d), "Sum"), f"{_PG}1-URGENT", key_col="hash_key"))


# --- E9: JSON at path ------------------------------------------------------------------

register("e9_json_at_props", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
            WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
            WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' END AS k_type,
       CASE WHEN json_type(props) = 'OBJECT' THEN array_to_string(json_keys(props), ',') END AS keys,
       CASE WHEN json_type(props) = 'OBJECT' THEN CAST(len(json_keys(props)) AS BIGINT) END AS n_keys
FROM events""")(
    lambda spark, d: S.table(spark, d, "events").select(
        "event_id", V.json_at("props", "$.k").alias("k_text"), V.json_at("props", ".k", "type").alias("k_type"),
        F.array_join(V.json_at("props", "$", "objkeys"), ",").alias("keys"),
        V.json_at("props", "$", "objlen").alias("n_keys")))


register("e9_variant_at_props", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
            WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
            WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' END AS k_type,
       CASE WHEN json_type(props) = 'OBJECT' THEN array_to_string(list_sort(json_keys(props)), ',') END AS keys,
       CASE WHEN json_type(props) = 'OBJECT' THEN CAST(len(json_keys(props)) AS BIGINT) END AS n_keys
FROM events""")(
    lambda spark, d: D.parsed(S.table(spark, d, "events").select("event_id", "props"), "props").select(
        "event_id", D.variant_at("doc", "$.k").alias("k_text"), D.variant_at("doc", "$.k", "type").alias("k_type"),
        F.array_join(D.variant_at("doc", "$", "objkeys"), ",").alias("keys"), D.variant_at("doc", "$", "objlen").alias("n_keys")))


def _hot_props(spark, d):
    path, hot = shared_path(spark, "documents"), {"k": ("$.k", "bigint")}
    D.write_documents(S.table(spark, d, "events").select("event_id", "event_type", "props"), path, "props", hot)
    return D.Documents(spark, path, hot)


register("e9_hot_path_totals", """
SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, max(k) AS largest FROM (
  SELECT event_type, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events)
GROUP BY event_type""")(
    lambda spark, d: (lambda docs: docs.df.groupBy("event_type").agg(
        F.count(docs.value("k", "bigint")).alias("n"), F.sum(docs.value("k", "bigint")).alias("total"),
        F.max(docs.value("k", "bigint")).alias("largest")))(_hot_props(spark, d)))
register("e9_json_array_length", """
SELECT event_id, CAST(json_array_length(CASE WHEN user_id % 3 = 0 THEN '{"a": []}' ELSE '{"a": [1, ' || user_id || ', {"b": [2]}]}' END, '$.a')
                      AS BIGINT) AS n_items FROM events""")(
    lambda spark, d: S.table(spark, d, "events").withColumn("doc", F.when(F.col("user_id") % 3 == 0, F.lit('{"a": []}')).otherwise(
        F.concat(F.lit('{"a": [1, '), F.col("user_id"), F.lit(', {"b": [2]}]}')))).select(
            "event_id", V.json_at("doc", "$.a", "arrlen").alias("n_items")))


# --- E10: search ----------------------------------------------------------------------------

_SEARCH_WHERE = "lower(text) LIKE '%license%' AND lower(text) LIKE '%the%'"
register("e10_search_page1",
         f"SELECT doc_id, n_chars, lang FROM documents WHERE {_SEARCH_WHERE} "
         "ORDER BY n_chars DESC, doc_id LIMIT 10")(
    lambda spark, d: V.search(S.table(spark, d, "documents"), "text", ["License", "the"], "n_chars", True, 0, 10,
                              ["doc_id", "n_chars", "lang"], id_col="doc_id"))
register("e10_search_page2",
         f"SELECT doc_id, n_chars, lang FROM documents WHERE {_SEARCH_WHERE} "
         "ORDER BY n_chars DESC, doc_id LIMIT 10 OFFSET 10")(
    lambda spark, d: V.search(S.table(spark, d, "documents"), "text", ["License", "the"], "n_chars", True, 10, 10,
                              ["doc_id", "n_chars", "lang"], id_col="doc_id"))


# --- E10, E5 by an index: built from the whole table, then asked -------------------------------------

def _text_index(spark, d):
    docs = S.table(spark, d, "documents")
    return TI.TextIndex(spark, TI.build_text_index(docs, shared_path(spark, "text-index"))), docs


_WORDS_SQL = r"(SELECT *, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS w FROM documents)"
register("e10_index_all_words",
         f"SELECT doc_id, lang, n_chars FROM {_WORDS_SQL} WHERE list_has_all(w, ['the', 'license', 'of'])")(
    lambda spark, d: (lambda index, docs: index.search(docs.select("doc_id", "lang", "n_chars"), ["the", "License", "of"]))(*_text_index(spark, d)))
register("e10_index_any_word",
         f"SELECT doc_id, lang, n_chars FROM {_WORDS_SQL} WHERE list_has_any(w, ['license', 'nicht'])")(
    lambda spark, d: (lambda index, docs: index.search(docs.select("doc_id", "lang", "n_chars"), ["License", "nicht"], any_of=True))(*_text_index(spark, d)))
register("e10_index_search_page1",
         f"SELECT doc_id, n_chars, lang FROM documents WHERE {_SEARCH_WHERE} "
         "ORDER BY n_chars DESC, doc_id LIMIT 10")(
    lambda spark, d: (lambda index, docs: V.search(index.search_text(docs, ["License", "the"]), "text", [], "n_chars", True, 0, 10,
                                                   ["doc_id", "n_chars", "lang"], id_col="doc_id"))(*_text_index(spark, d)))
register("e10_term_directory",
         f"SELECT term, count(DISTINCT doc_id) AS rows FROM (SELECT doc_id, unnest(w) AS term FROM {_WORDS_SQL}) WHERE term <> '' GROUP BY term")(
    lambda spark, d: _text_index(spark, d)[0].directory().select("term", "rows"))


def _label_index(spark, d):
    samples = S.series_by_user(spark, d)
    return LI.LabelIndex(spark, LI.build_label_index(samples, shared_path(spark, "label-index"))), samples


_MATCHERS = [("event_type", "=~", "c.*|view"), ("user", "!=", "3"), ("user", "!~", ".*7")]
_MATCH_SQL = "regexp_full_match(event_type, 'c.*|view') AND CAST(user_id AS VARCHAR) <> '3' AND NOT regexp_full_match(CAST(user_id AS VARCHAR), '.*7')"
register("e5_label_index_series", f"SELECT DISTINCT event_type || ':' || user_id AS series FROM events WHERE {_MATCH_SQL}")(
    lambda spark, d: _label_index(spark, d)[0].series(_MATCHERS).select("series"))


def _selected_samples(spark, d):
    index, samples = _label_index(spark, d)
    path = shared_path(spark, "label-samples")
    index.write_samples(samples.drop("labels"), path)
    return index.read_samples(path, _MATCHERS)


register("e1_rollup_of_selected_series", f"""
SELECT event_type || ':' || user_id AS series, {S.bucket_sql('ts', DAY_MS)} AS bucket_start, count(value) AS value
FROM events WHERE {_MATCH_SQL} GROUP BY 1, 2""")(
    lambda spark, d: T.bucket_rollup(_selected_samples(spark, d), "ts", "value", DAY_MS, "count", keys=("series",)))


# --- E11-E13: panel ------------------------------------------------------------------------------

register("e12_organize_totals",
         "SELECT postgres_clerk AS clerk, count(postgres_purchase) AS \"Count\" "
         f"FROM ({S.events_sql('postgres')}) e GROUP BY 1")(
    lambda spark, d: P.keep_fields(P.organize(
        clerk_totals(parse_events(S.source_messages(spark, d, "postgres"), "postgres", fields=TOTAL_FIELDS), "postgres", ("count", "sum")),
        exclude=["postgres_purchase_sum"], rename={"postgres_clerk": "clerk", "postgres_purchase_count": "Count"}),
        ["clerk", "Count"]))
register("e13_panel_mean", f"SELECT event_type, {round_text('avg(value)', R)} AS mean FROM events GROUP BY 1")(
    lambda spark, d: P.panel_calc(S.table(spark, d, "events"), "mean", "value", keys=("event_type",))
    .select("event_type", sql_round("mean", R).alias("mean")))
register("e13_panel_last_not_null",
         "SELECT event_type, last(value ORDER BY ts NULLS FIRST, event_id NULLS FIRST) FILTER (WHERE value IS NOT NULL) "
         "AS \"lastNotNull\" FROM events GROUP BY 1")(
    lambda spark, d: P.panel_calc(S.table(spark, d, "events"), "lastNotNull", "value", "ts", ("event_type",),
                                  "event_id"))


# --- E14: rolling buffer of the newest points -------------------------------------------------------

register("e14_last_n_points", """
SELECT event_id, event_type, ts, value, json_extract_string(props, '$.k') AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num
FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1000""")(
    lambda spark, d: T.last_n_points(
        S.table(spark, d, "events").select("event_id", "event_type", "ts", "value",
                                           F.get_json_object("props", "$.k").alias("k")),
        ("event_type",), "ts", 1000, numeric=("k",), tiebreak="event_id"))
register("e14_last_n_points_many", """
SELECT event_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1500""")(
    lambda spark, d: T.last_n_points(S.table(spark, d, "events").select("event_id", "event_type", "ts"),
                                     ("event_type",), "ts", 1500, tiebreak="event_id"))


register("e14_stream_rolling_buffer", """
SELECT event_type, ts, event_id, value FROM events WHERE ts IS NOT NULL AND event_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 20""")(
    lambda spark, d: ST.stream_rolling_buffer(spark, d, 20))
register("f7_stream_live_volume", f"""
SELECT event_type, {S.bucket_sql('ts', HOUR_MS)} AS bucket_start, count(*) AS count, CAST(coalesce(sum(strlen(props)), 0) AS BIGINT) AS bytes
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")(lambda spark, d: ST.stream_live_volume(spark, d))


# --- E15, E16 ----------------------------------------------------------------------------------------

register("e15_values_list",
         # the text form of timestamps and floats differs between engines: microseconds and rounded thousandths
         "SELECT unnest([CAST(event_id AS VARCHAR), CAST(epoch_us(ts) AS VARCHAR), CAST(user_id AS VARCHAR), event_type, "
         "CAST(CAST(round(value * 1000) AS BIGINT) AS VARCHAR), props]) AS value FROM events")(
    lambda spark, d: V.values_list(S.table(spark, d, "events").select(
        "event_id", F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts")).alias("ts"),
        "user_id", "event_type", F.round(F.col("value") * 1000).cast("bigint").alias("value"), "props")))
register("e16_parameterised_sql",
         f"SELECT event_type, count(*) AS n, {round_text('sum(value)', R)} AS total FROM events "
         "WHERE value > 100.0 AND event_type <> 'error' GROUP BY event_type")(
    lambda spark, d: V.run_sql(
        spark, f"SELECT event_type, count(*) AS n, {spark_round_text('sum(value)', R)} AS total FROM {{cs_events}} "
               "WHERE value > :min_value AND event_type <> :skip GROUP BY event_type",
        {"min_value": 100.0, "skip": "error"}, views={"cs_events": S.table(spark, d, "events")}))


# --- C1: align series on time --------------------------------------------------------------------

SERIES = ("click", "error", "purchase", "signup", "view")  # the event types that become columns
register("c1_align_series", f"""
PIVOT (SELECT event_type AS series, {S.bucket_sql('ts', HOUR_MS)} AS bucket_start, {round_text('avg(value)', R)} AS value
       FROM events GROUP BY 1, 2)
ON series IN ('click', 'error', 'purchase', 'signup', 'view') USING max(value) GROUP BY bucket_start""")(
    lambda spark, d: T.align_series(
        T.bucket_rollup(S.series_by_type(spark, d), "ts", "value", HOUR_MS, "avg", keys=("series",))
        .withColumn("value", sql_round("value", R)), "bucket_start", "series", "value", list(SERIES)))
