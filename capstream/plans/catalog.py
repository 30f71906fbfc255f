"""Registered queries over the driver's tables, each with its DuckDB oracle.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Every query reads whole tables (see ``standins``); computed columns carry
the same names in the Spark result and in the SQL text. Floating results are
rounded in both so the comparison does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.parse import (after_image, envelope_meta, event_time, parse_envelope, parse_events, reparse_before,
                                       schema_field_counts)
from capstream.functions.shape import HASH_PREFIX, hash_rows_for, notification_for
from capstream.operators import changes as C
from capstream.operators import offsets as OF
from capstream.operators.aggregate import clerk_totals
from capstream.plans import standins as S
from capstream.schema import AFTER_DDL, TOTAL_FIELDS

from capstream.plans.registry import QUERIES, register  # noqa: F401


# ---------------------------------------------------------------------------
# Tier A: envelope -> events -> per-clerk totals -> notification / hash rows
# ---------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str, p: str) -> DataFrame:
    return parse_events(S.source_messages(spark, sf_dir, p), p)


def _purchases(spark: SparkSession, sf_dir: str, p: str) -> DataFrame:
    """Events with the two columns that totals read."""
    return parse_events(S.source_messages(spark, sf_dir, p), p, fields=TOTAL_FIELDS)


def _totals_sql(p: str, with_sum: bool) -> str:
    s = f", CAST(sum({p}_purchase) AS BIGINT) AS {p}_purchase_sum" if with_sum else ""
    return (f"SELECT {p}_clerk, count({p}_purchase) AS {p}_purchase_count{s} "
            f"FROM ({S.events_sql(p)}) e GROUP BY {p}_clerk")


register("a4_envelope_roundtrip", """
SELECT topic, op, after_id, purchase, clerk, store, customer, ts_ms FROM (
  SELECT 'postgrestopic.public.customer' AS topic, op,
         CASE WHEN op = 'd' THEN NULL ELSE id END AS after_id,
         CASE WHEN op = 'd' THEN NULL ELSE purchase END AS purchase,
         CASE WHEN op = 'd' THEN NULL ELSE clerk END AS clerk,
         CASE WHEN op = 'd' THEN NULL ELSE store END AS store,
         CASE WHEN op = 'd' THEN NULL ELSE name END AS customer,
         CAST(floor("timestamp" / 1000) AS BIGINT) AS ts_ms
  FROM (""" + S.ORDERS_ROWS_SQL + """) a
  UNION ALL
  SELECT 'mysqltopic.mariadb.customer', op,
         CASE WHEN op = 'd' THEN NULL ELSE id END,
         CASE WHEN op = 'd' THEN NULL ELSE purchase END,
         CASE WHEN op = 'd' THEN NULL ELSE clerk END,
         CASE WHEN op = 'd' THEN NULL ELSE store END,
         CASE WHEN op = 'd' THEN NULL ELSE name END,
         CAST(floor("timestamp" / 1000) AS BIGINT)
  FROM (""" + S.LINEITEM_ROWS_SQL + """) b)""")(
    lambda spark, d: parse_envelope(
        S.source_messages(spark, d, "postgres").unionByName(S.source_messages(spark, d, "mysql")),
        keep=("topic",),
        # only the branches read below: the parser skips the rest of each message
        schema=f"payload struct<after struct<{AFTER_DDL}>, op string, ts_ms bigint>",
    ).select(
        "topic", F.col("data.payload.op").alias("op"), F.col("data.payload.after.id").alias("after_id"),
        F.col("data.payload.after.purchase").alias("purchase"), F.col("data.payload.after.clerk").alias("clerk"),
        F.col("data.payload.after.store").alias("store"), F.col("data.payload.after.name").alias("customer"),
        F.col("data.payload.ts_ms").alias("ts_ms"),
    )
)

for _p in ("postgres", "mysql"):
    register(f"b4_events_{_p}", S.events_sql(_p))(lambda spark, d, p=_p: _events(spark, d, p))

register("b3_after_image_mysql", f"""
SELECT CASE WHEN op = 'd' THEN NULL ELSE age END AS age, CASE WHEN op = 'd' THEN NULL ELSE email END AS email,
       CASE WHEN op = 'd' THEN NULL ELSE id END AS id, CASE WHEN op = 'd' THEN NULL ELSE name END AS name,
       CASE WHEN op = 'd' THEN NULL ELSE purchase END AS purchase, CASE WHEN op = 'd' THEN NULL ELSE store END AS store,
       CASE WHEN op = 'd' THEN NULL ELSE "timestamp" END AS "timestamp",
       CASE WHEN op = 'd' THEN NULL ELSE clerk END AS clerk,
       CASE WHEN op = 'd' THEN NULL ELSE make_timestamp("timestamp") END AS event_ts
FROM ({S.LINEITEM_ROWS_SQL}) r""")(
    lambda spark, d: after_image(parse_envelope(S.source_messages(spark, d, "mysql")))
    .select("after.*", event_time("after.timestamp", "micros", ntz=True).alias("event_ts")))

register("b10_envelope_meta_postgres", """
SELECT op, id AS lsn, id AS tx_id, 'postgres' AS db, 'public' AS schema_name, 'customer' AS table_name,
       'postgresql' AS connector, 'postgrestopic' AS server,
       CASE WHEN op = 'r' THEN 'true' ELSE 'false' END AS snapshot,
       CAST(floor("timestamp" / 1000) AS BIGINT) AS source_ts_ms,
       CAST(floor("timestamp" / 1000) AS BIGINT) AS ts_ms,
       CASE WHEN op IN ('u', 'd') THEN purchase END AS before_purchase,
       CASE WHEN op IN ('u', 'd') THEN clerk END AS before_clerk
FROM (""" + S.ORDERS_ROWS_SQL + ") r")(
    lambda spark, d: envelope_meta(parse_envelope(S.source_messages(spark, d, "postgres"))).select(
        "op", "lsn", "tx_id", "db", "schema_name", "table_name", "connector", "server", "snapshot",
        "source_ts_ms", "ts_ms",
        reparse_before("before").getField("purchase").alias("before_purchase"),
        reparse_before("before").getField("clerk").alias("before_clerk"),
    )
)


# --- fixed values: what each message's embedded schema says, stated apart from the code that writes the messages.
_SCHEMA_FIELDS_SQL = """
WITH row_fields(field, type, logical_name, optional, default_value) AS (VALUES
  ('id', 'int32', NULL, 'false', '0'), ('name', 'string', NULL, 'true', NULL), ('age', 'int32', NULL, 'true', NULL),
  ('email', 'string', NULL, 'true', NULL), ('purchase', 'int32', NULL, 'true', NULL),
  ('timestamp', 'int64', 'io.debezium.time.MicroTimestamp', 'true', NULL), ('store', 'string', NULL, 'true', NULL),
  ('clerk', 'string', NULL, 'true', NULL)),
source_fields(field, type, logical_name, optional, default_value, allowed) AS (VALUES
  ('version', 'string', NULL, 'false', NULL, NULL), ('connector', 'string', NULL, 'false', NULL, NULL),
  ('name', 'string', NULL, 'false', NULL, NULL), ('ts_ms', 'int64', NULL, 'false', NULL, NULL),
  ('snapshot', 'string', 'io.debezium.data.Enum', 'true', 'false', 'true,last,false,incremental'),
  ('db', 'string', NULL, 'false', NULL, NULL), ('sequence', 'string', NULL, 'true', NULL, NULL),
  ('ts_us', 'int64', NULL, 'true', NULL, NULL), ('ts_ns', 'int64', NULL, 'true', NULL, NULL),
  ('schema', 'string', NULL, 'false', NULL, NULL), ('table', 'string', NULL, 'false', NULL, NULL),
  ('txId', 'int64', NULL, 'true', NULL, NULL), ('lsn', 'int64', NULL, 'true', NULL, NULL), ('xmin', 'int64', NULL, 'true', NULL, NULL)),
transaction_fields(field, type) AS (VALUES ('id', 'string'), ('total_order', 'int64'), ('data_collection_order', 'int64')),
top_fields(field, type) AS (VALUES ('op', 'string'), ('ts_ms', 'int64'), ('ts_us', 'int64'), ('ts_ns', 'int64')),
s(prefix, connector, n) AS (
  SELECT 'postgrestopic.public.customer', 'postgresql', count(*) FROM orders
  UNION ALL SELECT 'mysqltopic.mariadb.customer', 'mysql', count(*) FROM lineitem),
f AS (
  SELECT prefix, n, parent AS parent_field, 'struct' AS parent_type, prefix || '.Value' AS parent_name, field, type, logical_name,
         optional, default_value, NULL AS allowed FROM s, row_fields, (VALUES ('before'), ('after')) p(parent)
  UNION ALL SELECT prefix, n, 'source', 'struct', 'io.debezium.connector.' || connector || '.Source', field, type, logical_name, optional,
         default_value, allowed FROM s, source_fields
  UNION ALL SELECT prefix, n, 'transaction', 'struct', 'event.block', field, type, NULL, 'false', NULL, NULL FROM s, transaction_fields
  UNION ALL SELECT prefix, n, field, type, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM s, top_fields)
SELECT prefix || '.Envelope' AS envelope, parent_field, parent_type, parent_name, field, type, logical_name, optional, default_value,
       allowed, n AS n_messages FROM f WHERE n > 0"""


register("b11_schema_fields", _SCHEMA_FIELDS_SQL)(
    lambda spark, d: schema_field_counts(
        S.source_messages(spark, d, "postgres").unionByName(S.source_messages(spark, d, "mysql"))))
register("d1_clerk_count_postgres", _totals_sql("postgres", False))(
    lambda spark, d: clerk_totals(_purchases(spark, d, "postgres"), "postgres", ("count",)))
register("d2_clerk_count_mysql", _totals_sql("mysql", False))(
    lambda spark, d: clerk_totals(_purchases(spark, d, "mysql"), "mysql", ("count",)))
register("d3_clerk_totals_postgres", _totals_sql("postgres", True))(
    lambda spark, d: clerk_totals(_purchases(spark, d, "postgres"), "postgres", ("count", "sum")))
register("d4_clerk_totals_mysql", _totals_sql("mysql", True))(
    lambda spark, d: clerk_totals(_purchases(spark, d, "mysql"), "mysql", ("count", "sum")))


def _notification_sql(p: str, with_sum: bool) -> str:
    # to_json leaves NULL members out (a NULL clerk group has no clerk member)
    # and escapes text: to_json(<text>) gives the same JSON string literal
    members = [f"""CASE WHEN {p}_clerk IS NULL THEN NULL ELSE '"{p}_clerk":' || to_json({p}_clerk) END""",
               f"""'"{p}_purchase_count":' || {p}_purchase_count"""]
    if with_sum:
        members.append(f"""CASE WHEN {p}_purchase_sum IS NULL THEN NULL
                           ELSE '"{p}_purchase_sum":' || {p}_purchase_sum END""")
    body = "concat_ws(',', " + ", ".join(members) + ")"
    return f"""
SELECT {p}_clerk AS key, '{{' || {body} || '}}' AS value
FROM ({_totals_sql(p, with_sum)}) t"""


register("b6_notification_postgres", _notification_sql("postgres", True))(
    lambda spark, d: notification_for(
        clerk_totals(_purchases(spark, d, "postgres"), "postgres", ("count", "sum")), "postgres", ("count", "sum")))
register("b6_notification_mysql", _notification_sql("mysql", False))(
    lambda spark, d: notification_for(
        clerk_totals(_purchases(spark, d, "mysql"), "mysql", ("count",)), "mysql", ("count",)))


def _hash_sql(p: str) -> str:
    return f"""
SELECT '{HASH_PREFIX[p]}' || {p}_clerk AS hash_key,
       CAST({p}_purchase_count AS VARCHAR) AS count_text,
       CAST({p}_purchase_sum AS VARCHAR) AS sum_text
FROM ({_totals_sql(p, True)}) t WHERE {p}_clerk IS NOT NULL"""


for _p in ("postgres", "mysql"):
    register(f"b9_hash_rows_{_p}", _hash_sql(_p))(
        lambda spark, d, p=_p: hash_rows_for(
            clerk_totals(_purchases(spark, d, p), p, ("count", "sum")), p
        ).select("hash_key", F.col("fields")["Count"].alias("count_text"), F.col("fields")["Sum"].alias("sum_text"))
    )


register("b9_hash_rows_mysql_null_key_compat", f"""
SELECT 'Mysql:' || COALESCE(mysql_clerk, 'None') AS hash_key,
       CAST(mysql_purchase_count AS VARCHAR) AS count_text,
       COALESCE(CAST(mysql_purchase_sum AS VARCHAR), 'None') AS sum_text
FROM ({_totals_sql("mysql", True)}) t""")(
    lambda spark, d: hash_rows_for(clerk_totals(_purchases(spark, d, "mysql"), "mysql", ("count", "sum")), "mysql",
                                   null_key="None")
    .select("hash_key", F.col("fields")["Count"].alias("count_text"), F.col("fields")["Sum"].alias("sum_text")))

register("d3_clerk_totals_postgres_inserts_snapshots", f"""
SELECT clerk AS postgres_clerk, count(purchase) AS postgres_purchase_count,
       CAST(sum(purchase) AS BIGINT) AS postgres_purchase_sum
FROM ({S.ORDERS_ROWS_SQL}) r WHERE op IN ('c', 'r') GROUP BY 1""")(
    lambda spark, d: clerk_totals(parse_events(S.source_messages(spark, d, "postgres"), "postgres", fields=TOTAL_FIELDS,
                                               with_op=True),
                                  "postgres", ("count", "sum"), ops=("c", "r")))


# --- totals corrected by the images that changes remove ----------------------------

def _corrected_sql(p: str) -> str:
    return (f"SELECT clerk AS {p}_clerk, count(purchase) AS {p}_purchase_count, CAST(sum(purchase) AS BIGINT) AS {p}_purchase_sum "
            f"FROM ({S.current_rows_sql(p)}) r GROUP BY 1")


for _p in ("postgres", "mysql"):
    register(f"s1_corrected_totals_{_p}", _corrected_sql(_p))(
        lambda spark, d, p=_p: C.corrected_totals(C.signed_rows(C.parse_changes(S.change_feed(spark, d, p))), p))
register("s1_corrected_totals_postgres_redelivered", _corrected_sql("postgres"))(
    lambda spark, d: C.corrected_totals(C.signed_rows(C.once(C.parse_changes(
        S.change_feed(spark, d, "postgres").unionByName(S.change_feed(spark, d, "postgres").where(F.col("offset") % 7 == 0))))), "postgres"))
register("s1_current_rows_postgres", S.current_rows_sql("postgres"))(
    lambda spark, d: C.current_rows(C.parse_changes(S.change_feed(spark, d, "postgres"))).select("id", "purchase", "clerk"))
register("s1_totals_of_current_rows_postgres", _corrected_sql("postgres"))(
    lambda spark, d: clerk_totals(C.current_rows(C.parse_changes(S.change_feed(spark, d, "postgres"))).select(
        F.col("clerk").alias("postgres_clerk"), F.col("purchase").alias("postgres_purchase")), "postgres", ("count", "sum")))


# --- offsets seen and lost: the messages of ``lineitem`` dealt to four topic partitions, one in eleven sent twice ---

def _offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = S.table(spark, sf_dir, "lineitem").select(
        F.lit("mysqltopic.mariadb.customer").alias("topic"), F.pmod("l_orderkey", F.lit(4)).cast("int").alias("partition"),
        (F.floor(F.col("l_orderkey") / 4) * 8 + F.col("l_linenumber")).alias("offset"))
    return m.unionByName(m.where(F.col("offset") % 11 == 0))


_OFFSETS_SQL = f"""
WITH m AS (SELECT 'mysqltopic.mariadb.customer' AS topic, CAST({S.pmod('l_orderkey', 4)} AS INTEGER) AS partition,
                  CAST(floor(l_orderkey / 4) AS BIGINT) * 8 + l_linenumber AS "offset" FROM lineitem),
a AS (SELECT * FROM m UNION ALL SELECT * FROM m WHERE "offset" % 11 = 0),
o AS (SELECT topic, partition, "offset", count(*) AS n FROM a GROUP BY ALL),
g AS (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS g FROM o),
r AS (SELECT topic, partition, min("offset") AS first, max("offset") AS last, CAST(sum(n) AS BIGINT) AS messages FROM g GROUP BY topic, partition, g)"""
register("a2_offset_ranges", f"{_OFFSETS_SQL} SELECT * FROM r")(lambda spark, d: OF.offset_ranges(_offsets(spark, d)))
register("a2_offset_gaps", f"""{_OFFSETS_SQL}, x AS (SELECT *, lead(first) OVER (PARTITION BY topic, partition ORDER BY first) AS nxt FROM r)
SELECT topic, partition, last + 1 AS first_missing, nxt - 1 AS last_missing, nxt - last - 1 AS missing FROM x WHERE nxt IS NOT NULL""")(
    lambda spark, d: OF.gaps(OF.offset_ranges(_offsets(spark, d))))
_AUDIT_SQL = f"""{_OFFSETS_SQL}
SELECT topic, partition, min(first) AS first, max(last) AS last, count(*) AS ranges, CAST(sum(last - first + 1) AS BIGINT) AS offsets,
       CAST(max(last) - min(first) + 1 - sum(last - first + 1) AS BIGINT) AS missing, CAST(sum(messages) - sum(last - first + 1) AS BIGINT) AS repeats
FROM r GROUP BY topic, partition"""
register("a2_offset_audit", _AUDIT_SQL)(lambda spark, d: OF.audit(OF.offset_ranges(_offsets(spark, d))))


# ---------------------------------------------------------------------------
# Streaming runs (file replay, availableNow) checked against the batch SQL
# ---------------------------------------------------------------------------

from capstream.plans import streams as ST  # noqa: E402

register("g8_stream_hash_upsert_postgres", _hash_sql("postgres"))(
    lambda spark, d: ST.stream_hash_store(spark, d, "postgres"))
register("g1_stream_complete_counts_mysql", _totals_sql("mysql", False))(
    lambda spark, d: ST.stream_complete_counts(spark, d, "mysql"))
register("g2_stream_append_events_postgres", S.events_sql("postgres"))(
    lambda spark, d: ST.stream_append_events(spark, d, "postgres"))
register("g6_stream_notifications_postgres", _notification_sql("postgres", True))(
    lambda spark, d: ST.stream_notifications(spark, d, "postgres"))
for _p, _metrics in (("postgres", ("count", "sum")), ("mysql", ("count",))):
    register(f"g6_stream_notifications_complete_{_p}", _notification_sql(_p, "sum" in _metrics))(
        lambda spark, d, p=_p, m=_metrics: ST.stream_notifications(spark, d, p, "complete", m))
register("g11_stream_fan_out_mysql", f"{S.events_sql('mysql')} UNION ALL {S.events_sql('mysql')}")(
    lambda spark, d: ST.stream_fan_out(spark, d, "mysql"))


register("s1_stream_corrected_totals_postgres", _corrected_sql("postgres"))(
    lambda spark, d: ST.stream_corrected_totals(spark, d, "postgres"))
register("s1_stream_current_rows_postgres", S.current_rows_sql("postgres"))(
    lambda spark, d: ST.stream_current_rows(spark, d, "postgres").select("id", "purchase", "clerk"))


register("a2_stream_offset_audit", _AUDIT_SQL)(
    lambda spark, d: ST.stream_offset_audit(spark, d, _offsets(spark, d)))


# The other query families register themselves on import.
from capstream.plans import series_queries  # noqa: E402,F401
from capstream.plans import log_queries  # noqa: E402,F401
