"""Registered log-exploration queries (F1-F19) over every line of ``documents`` and
the event log derived from ``events``, with their DuckDB oracles.

The oracle for event-log queries computes what each line carries from the
event columns (``standins.EVENT_LOG_SQL``), so it checks the parsers rather
than re-running them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capstream.functions.logfields import BYTE_UNITS, DURATION_UNITS, MASKS, parse_quantity
from capstream.operators import logs as L
from capstream.operators import patterns as PT
from capstream.operators import sketches as K
from capstream.operators.timeseries import bucket_of
from capstream.plans import standins as S
from capstream.plans.registry import register, round_text, sql_round

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
R = 6
EV = f"({S.EVENT_LOG_SQL}) ev"
DL = f"({S.DOC_LINES_SQL}) dl"


def _docs(spark, d):
    return S.document_logs(spark, d)


def _events(spark, d, fmt="mixed"):
    return L.with_level(L.with_fields(S.event_logs(spark, d), fmt))


def _factor_sql(units: dict, col: str) -> str:
    whens = " ".join(f"WHEN '{u}' THEN {v!r}" for u, v in units.items())
    return f"(CASE {col} {whens} END)"


# --- F1/F2: line filters on document lines ------------------------------------------------

register("f1_line_contains", f"SELECT doc_id, ln FROM {DL} WHERE contains(line, 'the')")(
    lambda spark, d: L.line_filter(_docs(spark, d), "|=", "the").select("doc_id", "ln"))
register("f1_line_not_contains_ci", f"SELECT doc_id, ln FROM {DL} WHERE NOT contains(lower(line), 'the')")(
    lambda spark, d: L.line_filter(_docs(spark, d), "!=", "THE", case_sensitive=False).select("doc_id", "ln"))
register("f1_line_regex_ci",
         f"SELECT doc_id, ln, line FROM {DL} WHERE regexp_matches(line, '(?i)(released|licensed) under')")(
    lambda spark, d: L.line_filter(_docs(spark, d), "|~", "(released|licensed) under", case_sensitive=False)
    .select("doc_id", "ln", "line"))
register("f1_line_not_regex", f"SELECT doc_id, ln FROM {DL} WHERE NOT regexp_matches(line, '[0-9]')")(
    lambda spark, d: L.line_filter(_docs(spark, d), "!~", "[0-9]").select("doc_id", "ln"))


# --- F3: pattern filter ---------------------------------------------------------------------

register("f3_pattern_filter",
         f"SELECT doc_id, ln, line FROM {DL} WHERE (regexp_full_match(line, '(.*?) under the (.*?) License(.*?)') "
         "OR regexp_full_match(line, 'Licensed under (.*?)')) AND NOT regexp_full_match(line, '(.*?)Apache(.*?)')")(
    lambda spark, d: L.pattern_filter(_docs(spark, d), include=["<_> under the <_> License<_>", "Licensed under <_>"],
                                      exclude=["<_>Apache<_>"]).select("doc_id", "ln", "line"))


# --- F4/F5: label and field filters ------------------------------------------------------------

register("f4_label_filter",
         # a missing label compares as the empty string, as in the label matcher
         f"SELECT doc_id, ln FROM {DL} WHERE regexp_full_match(COALESCE(lang, ''), 'e[ns]') "
         "AND COALESCE(source, '') <> 'src1'")(
    lambda spark, d: L.label_filter(L.label_filter(_docs(spark, d), "lang", "=~", "e[ns]"), "source", "!=", "src1")
    .select("doc_id", "ln"))
register("f4_field_filter_number", f"SELECT event_id FROM {EV} WHERE fmt IN (0, 1) AND value > 100")(
    lambda spark, d: L.field_filter(_events(spark, d), "value", ">", 100).select("event_id"))
register("f4_label_filter_equal_not_regex",
         f"SELECT doc_id, ln FROM {DL} WHERE COALESCE(lang, '') = 'en' AND NOT regexp_full_match(COALESCE(source, ''), 'src1[0-9]*')")(
    lambda spark, d: L.label_filter(L.label_filter(_docs(spark, d), "lang", "=", "en"), "source", "!~", "src1[0-9]*").select("doc_id", "ln"))
for _name, _op in (("lt", "<"), ("ge", ">="), ("le", "<=")):
    register(f"f4_field_filter_{_name}", f"SELECT event_id FROM {EV} WHERE fmt IN (0, 1) AND k {_op} 40")(
        lambda spark, d, op=_op: L.field_filter(_events(spark, d), "k", op, 40).select("event_id"))
register("f5_field_filter_duration",
         f"SELECT event_id FROM {EV} WHERE fmt IN (0, 1) AND k * {_factor_sql(DURATION_UNITS, 'dur_unit')} > 60e9")(
    lambda spark, d: L.field_filter(_events(spark, d), "latency", ">", 60, kind="duration").select("event_id"))
register("f5_parse_quantity", f"""
SELECT event_id, CAST(k AS DOUBLE) * {_factor_sql(DURATION_UNITS, 'dur_unit')} / 1e9 AS latency_s,
       CASE WHEN k >= 0 THEN CAST(k * 3 AS DOUBLE) * {_factor_sql(BYTE_UNITS, 'byte_unit')} END AS size_bytes
FROM {EV} WHERE fmt IN (0, 1)""")(
    lambda spark, d: _events(spark, d).where(F.size("fields") > 0).select(
        "event_id", parse_quantity(F.col("fields")["latency"], "duration").alias("latency_s"),
        parse_quantity(F.col("fields")["size"], "bytes").alias("size_bytes")))


# --- F6: field parsing ----------------------------------------------------------------------------

def _parsed(fmt):
    def fn(spark, d):
        f = L.with_fields(S.event_logs(spark, d), fmt)
        fl = F.col("fields")
        return f.select("event_id", fl["user"].cast("bigint").alias("user"), fl["value"].cast("double").alias("value"),
                        fl["method"].alias("method"), fl["msg"].alias("msg"),
                        F.size(fl).cast("bigint").alias("n_fields"))
    return fn


def _parsed_sql(fmts):
    keep = ", ".join(str(x) for x in fmts)
    return f"""
SELECT event_id,
       CASE WHEN fmt IN ({keep}) THEN user_id END AS "user", CASE WHEN fmt IN ({keep}) THEN value END AS value,
       CASE WHEN fmt IN ({keep}) THEN method END AS method,
       CASE WHEN fmt IN ({keep}) THEN event_type || ' by user ' || user_id END AS msg,
       CAST(CASE WHEN fmt IN ({keep})
                 THEN (CASE WHEN level IS NULL THEN 7 ELSE 8 END) - (CASE WHEN k IS NULL THEN 3 ELSE 0 END)
                 ELSE 0 END AS BIGINT) AS n_fields
FROM {EV}"""


register("f6_parse_json", _parsed_sql([0]))(_parsed("json"))
register("f6_parse_logfmt", _parsed_sql([1]))(_parsed("logfmt"))
register("f6_parse_mixed", _parsed_sql([0, 1]))(_parsed("mixed"))


# --- F7-F11: volumes and values over time ----------------------------------------------------------

HB = S.bucket_sql("ts", HOUR_MS)
register("f7_log_volume", f"SELECT {HB} AS bucket_start, count(*) AS count FROM events GROUP BY 1")(
    lambda spark, d: L.log_volume(S.event_logs(spark, d), HOUR_MS))
register("f8_volume_by_label",
         f"SELECT {HB} AS bucket_start, 'svc-' || event_type AS service_name, count(*) AS count FROM events GROUP BY 1, 2")(
    lambda spark, d: L.log_volume(S.event_logs(spark, d), HOUR_MS, by="service_name"))
register("f8_volume_by_level",
         f"SELECT {HB} AS bucket_start, detected_level, count(*) AS count FROM {EV} GROUP BY 1, 2")(
    lambda spark, d: L.log_volume(_events(spark, d), HOUR_MS, by="detected_level"))
register("f9_field_avg_duration_ns", f"""
SELECT {HB} AS bucket_start, avg(CAST(k AS DOUBLE) * {_factor_sql(DURATION_UNITS, 'dur_unit')}) AS "avg"
FROM {EV} WHERE fmt IN (0, 1) GROUP BY 1 HAVING avg IS NOT NULL""")(
    lambda spark, d: L.field_avg(_events(spark, d), "latency", HOUR_MS, kind="duration", unit="ns"))
register("f9_field_avg_bytes", f"""
SELECT {HB} AS bucket_start, {round_text(f"avg(CAST(k * 3 AS DOUBLE) * {_factor_sql(BYTE_UNITS, 'byte_unit')})", R)} AS "avg"
FROM {EV} WHERE fmt IN (0, 1) AND k >= 0 GROUP BY 1 HAVING count(k) > 0""")(
    lambda spark, d: L.field_avg(_events(spark, d), "size", HOUR_MS, kind="bytes")
    .select("bucket_start", sql_round("avg", R).alias("avg")))
register("f9_field_avg_number", f"""
SELECT {HB} AS bucket_start, {round_text("avg(CAST(k AS DOUBLE))", R)} AS "avg"
FROM {EV} WHERE fmt IN (0, 1) GROUP BY 1 HAVING count(k) > 0""")(
    lambda spark, d: L.field_avg(_events(spark, d), "k", HOUR_MS).select("bucket_start", sql_round("avg", R).alias("avg")))
register("f10_field_breakdown",
         f"SELECT {HB} AS bucket_start, method, count(*) AS count FROM {EV} WHERE fmt IN (0, 1) GROUP BY 1, 2")(
    lambda spark, d: L.field_breakdown(_events(spark, d), "method", HOUR_MS))
register("f11_rollup_volume", f"""
SELECT {S.bucket_sql('ts', DAY_MS)} AS bucket_start, detected_level, CAST(count(*) AS BIGINT) AS count
FROM {EV} GROUP BY 1, 2""")(
    lambda spark, d: L.rollup_volume(L.log_volume(_events(spark, d), HOUR_MS, by="detected_level"), DAY_MS))


# --- F12-F16: discovery ---------------------------------------------------------------------------------

register("f12_top_volume_by_source",
         f"SELECT source, CAST(sum(strlen(line)) AS BIGINT) AS volume FROM {DL} GROUP BY 1 "
         "ORDER BY volume DESC, source LIMIT 5000")(
    lambda spark, d: L.top_volume(_docs(spark, d), "source", limit=5000))
register("f12_top_volume_rows_by_lang",
         f"SELECT lang, count(*) AS volume FROM {DL} GROUP BY 1 ORDER BY volume DESC, lang LIMIT 5000")(
    lambda spark, d: L.top_volume(_docs(spark, d), "lang", limit=5000, unit="rows"))
register("f13_detected_labels", f"""
SELECT 'service_name' AS label, CAST(1 AS BIGINT) AS cardinality
UNION ALL SELECT 'lang', count(DISTINCT lang) FROM {DL}
UNION ALL SELECT 'source', count(DISTINCT source) FROM {DL}""")(
    lambda spark, d: L.detected_labels(_docs(spark, d)))
def _parsers_sql(present: str) -> str:
    return (f"concat_ws(',', CASE WHEN count(*) FILTER (WHERE fmt = 0 AND {present}) > 0 THEN 'json' END, "
            f"CASE WHEN count(*) FILTER (WHERE fmt = 1 AND {present}) > 0 THEN 'logfmt' END)")


_FIELDS_SQL = f"""
WITH f AS (SELECT * FROM {EV} WHERE fmt IN (0, 1))
SELECT 'k' AS name, count(DISTINCT k) AS cardinality, {_parsers_sql('k IS NOT NULL')} AS parsers, 'int' AS type
FROM f HAVING count(k) > 0
UNION ALL SELECT 'user', count(DISTINCT user_id), {_parsers_sql('TRUE')}, 'int' FROM f
UNION ALL SELECT 'value', count(DISTINCT value), {_parsers_sql('TRUE')}, 'float' FROM f
UNION ALL SELECT 'latency', count(DISTINCT k), {_parsers_sql('k IS NOT NULL')}, 'duration' FROM f HAVING count(k) > 0
UNION ALL SELECT 'size', count(DISTINCT (k * 3) || byte_unit), {_parsers_sql('k IS NOT NULL')},
    CASE WHEN min(k) < 0 THEN 'string' ELSE 'bytes' END FROM f HAVING count(k) > 0
UNION ALL SELECT 'method', count(DISTINCT method), {_parsers_sql('TRUE')}, 'string' FROM f
UNION ALL SELECT 'msg', count(DISTINCT event_type || user_id), {_parsers_sql('TRUE')}, 'string' FROM f"""
register("f14_detected_fields", _FIELDS_SQL)(
    lambda spark, d: L.detected_fields(S.event_logs(spark, d)))
register("f14_detected_fields_metadata", f"""{_FIELDS_SQL}
UNION ALL SELECT 'service_name', count(DISTINCT service_name), 'structuredMetadata', 'string' FROM {EV}
UNION ALL SELECT 'cluster', count(DISTINCT cluster), 'structuredMetadata', 'string' FROM {EV}
UNION ALL SELECT 'region', count(DISTINCT region), 'structuredMetadata', 'string' FROM {EV} HAVING count(region) > 0""")(
    lambda spark, d: L.detected_fields(S.event_logs(spark, d), metadata="labels"))
register("f15_column_stats", f"""
SELECT 'service_name' AS label, CAST(100 AS BIGINT) AS percent_of_lines, count(DISTINCT service_name) AS cardinality,
       CAST(max(length(service_name)) AS BIGINT) AS max_length FROM {EV}
UNION ALL SELECT 'cluster', 100, count(DISTINCT cluster), max(length(cluster)) FROM {EV}
UNION ALL SELECT 'region', CAST(ceil(100.0 * count(region) / count(*)) AS BIGINT), count(DISTINCT region),
       max(length(region)) FROM {EV} HAVING count(region) > 0""")(
    lambda spark, d: L.column_stats(S.event_logs(spark, d)))
register("f16_label_sparsity",
         f"SELECT 'region' AS label, {round_text('100.0 * count(region) / count(*)', R)} AS percent FROM {EV}")(
    lambda spark, d: L.label_sparsity(S.event_logs(spark, d), "region").select("label", sql_round("percent", R)
                                                                               .alias("percent")))


# --- F17-F19 -------------------------------------------------------------------------------------------------

_TEMPLATE_SQL = """CASE fmt
  WHEN 0 THEN '{' || CASE WHEN level IS NULL THEN '' ELSE '"level":<_>,' END
              || '"user":<_>,"value":<_>,' || CASE WHEN k IS NULL THEN '' ELSE '"k":<_>,"latency":<_>,"size":<_>,' END
              || '"method":<_>,"msg":<_>}'
  WHEN 1 THEN CASE WHEN level IS NULL THEN '' ELSE 'level=' || level || ' ' END
              || 'user=<_> value=<_> ' || CASE WHEN k IS NULL THEN '' ELSE 'k=<_> latency=<_> size=<_> ' END
              || 'method=' || method || ' msg=<_>'
  ELSE CASE WHEN level IS NULL THEN '' ELSE upper(level) || ' ' END || 'user <_> did ' || event_type
       || CASE WHEN k IS NULL THEN ' in ' ELSE ' in <_>' END
END"""
register("f17_log_patterns_recent", f"""
WITH e AS (SELECT * FROM {EV} WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR),
p AS (SELECT {_TEMPLATE_SQL} AS pattern, {HB} AS bucket_start, count(*) AS count FROM e GROUP BY 1, 2)
SELECT pattern, bucket_start, count, CAST(sum(count) OVER (PARTITION BY pattern) AS BIGINT) AS total FROM p""")(
    lambda spark, d: L.log_patterns(S.event_logs(spark, d), HOUR_MS, recent_ms=3 * HOUR_MS))
register("f17_log_patterns_all", f"""
WITH p AS (SELECT {_TEMPLATE_SQL} AS pattern, {S.bucket_sql('ts', DAY_MS)} AS bucket_start, count(*) AS count
           FROM {EV} GROUP BY 1, 2)
SELECT pattern, bucket_start, count, CAST(sum(count) OVER (PARTITION BY pattern) AS BIGINT) AS total FROM p""")(
    lambda spark, d: L.log_patterns(S.event_logs(spark, d), DAY_MS, recent_ms=None))


# the tree of the pattern miner over masked lines ``m(masked, bucket_start)``: depth 2
def _tree_sql(m: str, max_children: int, max_values: int, similarity: float) -> str:
    def step(level):
        return f"""
c{level} AS (SELECT n, path, count(DISTINCT t[{level + 1}]) AS c FROM p{level} WHERE n > {level} GROUP BY n, path),
p{level + 1} AS (SELECT p.masked, p.t, p.n, CASE WHEN p.n > {level} THEN list_append(p.path,
                        CASE WHEN c.c > {max_children} THEN '<_>' ELSE p.t[{level + 1}] END) ELSE p.path END AS path
                 FROM p{level} p LEFT JOIN c{level} c ON p.n = c.n AND p.path = c.path)"""
    return f"""
WITH m AS ({m}),
p0 AS (SELECT DISTINCT masked, string_split(masked, ' ') AS t, len(string_split(masked, ' ')) AS n, CAST([] AS VARCHAR[]) AS path
       FROM m WHERE masked IS NOT NULL),{step(0)},{step(1)},
v AS (SELECT n, path, unnest(t) AS v, generate_subscripts(t, 1) AS i FROM p2),
d AS (SELECT n, path, i, count(DISTINCT v) AS d FROM v GROUP BY n, path, i),
l AS (SELECT n, path, sum(CASE WHEN d = 1 THEN 1 ELSE 0 END) AS fixed, list(d ORDER BY i) AS d FROM d GROUP BY n, path),
r AS (SELECT p2.masked, array_to_string([CASE WHEN (CASE WHEN l.fixed >= {similarity} * l.n THEN l.d[i] > 1 ELSE l.d[i] > {max_values} END)
                                              OR (i <= len(l.path) AND l.path[i] = '<_>') THEN '<_>' ELSE p2.t[i] END FOR i IN range(1, p2.n + 1)], ' ') AS pattern
      FROM p2 JOIN l ON p2.n = l.n AND p2.path = l.path),
s AS (SELECT pattern, bucket_start, count(*) AS count FROM m LEFT JOIN r ON m.masked = r.masked GROUP BY 1, 2)
SELECT pattern, bucket_start, count, CAST(sum(count) OVER (PARTITION BY pattern) AS BIGINT) AS total FROM s"""


register("f17_mined_patterns_events", _tree_sql(f"SELECT {_TEMPLATE_SQL} AS masked, {S.bucket_sql('ts', DAY_MS)} AS bucket_start FROM {EV}", 16, 4, 0.5))(
    lambda spark, d: PT.mined_patterns(S.event_logs(spark, d), DAY_MS))


def _masked_sql(line: str) -> str:
    for rx in MASKS:
        keep = "\\1" if rx.startswith("([:=])") else ""
        line = f"regexp_replace({line}, '{rx}', '{keep}<_>', 'g')"
    return f"regexp_replace({line}, '(<_>)(\\s*<_>)+', '<_>', 'g')"


register("f17_mined_patterns_documents", _tree_sql(f"SELECT {_masked_sql('line')} AS masked, {S.bucket_sql('ts', DAY_MS)} AS bucket_start "
                                                   f"FROM ({S.DOC_LINES_SQL}) x", 3, 2, 0.6))(
    lambda spark, d: PT.mined_patterns(S.document_logs(spark, d), DAY_MS, max_children=3, max_values=2, similarity=0.6))


def _rank(by, desc=True):
    def fn(spark, d):
        e = S.table(spark, d, "events").select(F.concat(F.lit("user:"), F.col("user_id")).alias("series"), "value")
        out = L.rank_series(e, "series", "value", by, desc)
        return out.select("series", sql_round("score", R).alias("score"))
    return fn


def _placed(ranked):
    """Number the rows in the order they come (one row per series, already aggregated)."""
    from pyspark.sql import Window
    return ranked.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("bigint"))


_RANK_SQL = {"stddev": "stddev_pop(value)", "sum": "sum(value)", "max": "max(value)", "p90": "quantile_cont(value, 0.9)",
             "min": "min(value)", **{f"p{q}": f"quantile_cont(value, {q / 100})" for q in (10, 25, 75, 99)}}
for _by in ("stddev", "sum", "max", "min", "p10", "p25", "p75", "p90", "p99"):
    register(f"f18_rank_series_{_by}",
             f"SELECT 'user:' || user_id AS series, {round_text(_RANK_SQL[_by], R)} AS score FROM events GROUP BY 1")(
        _rank(_by))
# the order itself: the place of each series, lowest score first
register("f18_rank_series_sum_ascending", f"""
SELECT series, score, row_number() OVER (ORDER BY score, series) AS place FROM (
  SELECT 'user:' || user_id AS series, {round_text('sum(value)', R)} AS score FROM events GROUP BY 1)""")(
    lambda spark, d: _placed(_rank("sum", desc=False)(spark, d)))
register("f18_rank_series_name",
         "SELECT DISTINCT 'user:' || user_id AS series, CAST(NULL AS DOUBLE) AS score FROM events")(_rank("name"))

# --- sketches: estimates within their stated error of the exact answers --------------------------

def _distinct_by_sketch(spark, d):
    logs = S.event_logs(spark, d).select("ts", "labels")
    days = K.united(K.label_sketches(logs, HOUR_MS), ("label",), DAY_MS)  # hours, then days, then all
    exact = logs.select(F.explode("labels").alias("label", "value")).groupBy("label").agg(F.count_distinct("value").alias("n_values"))
    return K.distinct_counts(K.united(days, ("label",)), "estimate").join(exact, "label").select(
        "label", "n_values", (F.abs(F.col("estimate") - F.col("n_values")) <= K.distinct_error() * F.col("n_values")).alias("within"))


_LABELS_SQL = f"(SELECT unnest(['service_name', 'cluster', 'region']) AS label, unnest([service_name, cluster, region]) AS value FROM {EV})"
register("f13_distinct_values_by_sketch", f"""
SELECT label, count(DISTINCT value) AS n_values, TRUE AS within FROM {_LABELS_SQL} WHERE value IS NOT NULL GROUP BY label""")(_distinct_by_sketch)


def _users_by_sketch(spark, d):
    e = S.table(spark, d, "events")
    est = K.distinct_counts(K.united(K.distinct_sketches(e, ("event_type",), "user_id", HOUR_MS), ("event_type",), DAY_MS), "estimate")
    exact = e.groupBy("event_type", bucket_of(e, "ts", DAY_MS).alias("bucket_start")).agg(F.count_distinct("user_id").alias("n_users"))
    return est.join(exact, ["event_type", "bucket_start"]).select(
        "event_type", "bucket_start", "n_users", (F.abs(F.col("estimate") - F.col("n_users")) <= K.distinct_error() * F.col("n_users")).alias("within"))


register("f15_distinct_users_per_day_by_sketch", f"""
SELECT event_type, {S.bucket_sql('ts', DAY_MS)} AS bucket_start, count(DISTINCT user_id) AS n_users, TRUE AS within FROM events
GROUP BY 1, 2""")(_users_by_sketch)


def _percentiles_by_sketch(spark, d):
    e = S.table(spark, d, "events").select("event_type", "ts", "value")
    marks = K.percentiles(K.merged(K.value_sketches(e, ("event_type",), "value", HOUR_MS), ("event_type",)), p10=0.1, p50=0.5, p90=0.9)
    ranked = e.join(marks, "event_type").groupBy("event_type").agg(
        F.count("value").alias("n"), *[F.avg(c.cast("double")).alias(f"{p}_{side}") for p in ("p10", "p50", "p90")
                                       for side, c in (("below", F.col("value") < F.col(p)), ("upto", F.col("value") <= F.col(p)))])
    fits = [F.col(f"{p}_below").between(0, q + K.rank_error()) & (F.col(f"{p}_upto") >= q - K.rank_error()) for p, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))]
    return ranked.select("event_type", "n", *[f.alias(f"{p}_within") for p, f in zip(("p10", "p50", "p90"), fits, strict=True)])


register("f18_percentiles_by_sketch", """
SELECT event_type, count(value) AS n, TRUE AS p10_within, TRUE AS p50_within, TRUE AS p90_within FROM events GROUP BY 1""")(_percentiles_by_sketch)

register("f19_normalize_level", f"""
SELECT CASE WHEN regexp_full_match(level, '(?i)info') THEN 'info' WHEN regexp_full_match(level, '(?i)debug') THEN 'debug'
            WHEN regexp_full_match(level, '(?i)(warn|warning)') THEN 'warn'
            WHEN regexp_full_match(level, '(?i)error') THEN 'error'
            WHEN regexp_full_match(level, '(?i)(crit|critical|fatal)') THEN 'critical' ELSE 'logs' END AS level,
       count(*) AS count
FROM {EV} GROUP BY 1""")(
    lambda spark, d: L.level_counts(S.event_logs(spark, d), "level"))

