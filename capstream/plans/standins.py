"""Stand-ins: the driver's tables mapped onto the reference's data model.

Each captured database reads one *whole* table (no subsets):

* ``postgres`` source <- ``orders``: id ``o_orderkey``, clerk ``o_orderpriority``,
  store ``o_orderstatus``, customer ``Customer<o_custkey>``,
  purchase ``round(o_totalprice * 100)`` (integer cents), timestamp ``o_orderdate``.
* ``mysql`` source <- ``lineitem``: id ``l_orderkey * 8 + l_linenumber``,
  clerk ``l_returnflag || l_linestatus``, store ``S<l_linenumber>``,
  customer ``Customer<l_partkey>``, purchase ``round(l_extendedprice * 100)``,
  timestamp ``l_shipdate``.
* change kind from the id: ``id mod 10`` 0 -> ``d``, 1 -> ``u``, 2 -> ``r``, else ``c``.
* time series <- ``events`` (series per event type / user); log lines <- ``events``
  (structured lines) and ``documents`` (text lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.common import explode_rows
from capstream.sources.source import MYSQL, POSTGRES, CdcSource
from capstream.plans.envelopes import change_messages, epoch_micros, is_ntz, row_image, to_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: partitions to deal a stand-in's rows to before per-row work (unset: as scanned).
INPUT_PARTITIONS = "spark.capstream.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows to ``INPUT_PARTITIONS`` partitions if the session asks for it.

    For inputs stored as a few large row groups; the plan depends on the
    setting alone, never on the input's size.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def op_for(id_col: Column) -> Column:
    k = F.pmod(id_col, F.lit(10))
    return (F.when(k == 0, "d").when(k == 1, "u").when(k == 2, "r").otherwise("c"))


def orders_rows(orders: DataFrame) -> DataFrame:
    """``orders`` -> customer-shaped rows with a change kind."""
    cust = F.col("o_custkey")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Customer"), cust).alias("name"),
        (F.lit(18) + F.pmod(cust, F.lit(58))).alias("age"),
        F.concat(F.lit("user"), cust, F.lit("@example.com")).alias("email"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("purchase"),
        epoch_micros("o_orderdate", is_ntz(orders, "o_orderdate")).alias("timestamp"),
        F.col("o_orderstatus").alias("store"),
        F.col("o_orderpriority").alias("clerk"),
        op_for(F.col("o_orderkey")).alias("op"),
    )


def lineitem_rows(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` -> customer-shaped rows with a change kind."""
    rid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return lineitem.select(
        rid.alias("id"),
        F.concat(F.lit("Customer"), F.col("l_partkey")).alias("name"),
        (F.lit(18) + F.pmod(F.col("l_suppkey"), F.lit(58))).alias("age"),
        F.concat(F.lit("user"), F.col("l_suppkey"), F.lit("@example.com")).alias("email"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("purchase"),
        epoch_micros("l_shipdate", is_ntz(lineitem, "l_shipdate")).alias("timestamp"),
        F.concat(F.lit("S"), F.col("l_linenumber")).alias("store"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("clerk"),
        op_for(rid).alias("op"),
    )


SOURCES: dict[str, tuple[CdcSource, str]] = {
    "postgres": (POSTGRES, "orders"),
    "mysql": (MYSQL, "lineitem"),
}


def source_rows(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    src, name = SOURCES[prefix]
    t = spread(table(spark, sf_dir, name))
    return orders_rows(t) if name == "orders" else lineitem_rows(t)


def source_messages(spark: SparkSession, sf_dir: str, prefix: str, with_schema: bool = True) -> DataFrame:
    """Kafka-shaped change messages of one source, derived from its whole table."""
    src, _ = SOURCES[prefix]
    return to_envelope(source_rows(spark, sf_dir, prefix), src, with_schema=with_schema)


#: Changes of one row, in log order: (op, row ids by ``id mod 10``, amount added to the purchase, whether the clerk changes).
_CHANGES = (("c", range(10), 0, False), ("u", (1, 2, 3, 4), 100, False), ("u", (2, 3, 5), 50, True), ("d", (0, 3, 6), 0, False))


def change_feed(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Messages of a table whose every row was inserted, and some then updated (also to another clerk) or deleted.

    ``lsn`` = 4 x id + step; the images before and after are the row's own at
    that step. Rows come in no particular order of position.
    """
    rows, value = source_rows(spark, sf_dir, prefix), F.pmod(F.col("id"), F.lit(10))
    steps, amount, moved = [], F.lit(0), F.lit(False)
    for step, (op, ids, more, moves) in enumerate(_CHANGES):
        old = (amount, moved)
        hit = value.isin(*ids)
        amount, moved = amount + F.when(hit, more).otherwise(0), moved | (hit & F.lit(moves))
        image = [row_image(lambda c, a=a, m=m: F.col(c) + a if c == "purchase" else F.when(m, F.concat("clerk", F.lit("+"))).otherwise(F.col(c)) if c == "clerk"
                           else F.col(c)) for a, m in (old, (amount, moved))]
        steps.append(F.when(hit, F.struct(F.lit(op).alias("op"), (F.col("id") * 4 + step).alias("lsn"), F.when(F.lit(op != "c"), image[0]).alias("before"),
                                          F.when(F.lit(op != "d"), image[1]).alias("after"))))
    changes = explode_rows(rows, F.filter(F.array(*steps), lambda x: x.isNotNull()), ("c",), keep=("id", (F.col("timestamp") / 1000).cast("bigint").alias("ts_ms")))
    return change_messages(changes.select("id", "ts_ms", "c.*"), SOURCES[prefix][0])


def current_rows_sql(prefix: str) -> str:
    """The rows that the change feed leaves."""
    m = pmod("id", 10)
    return f"""
SELECT id, purchase + CASE WHEN {m} IN (1, 2, 3, 4) THEN 100 ELSE 0 END + CASE WHEN {m} IN (2, 3, 5) THEN 50 ELSE 0 END AS purchase,
       clerk || CASE WHEN {m} IN (2, 3, 5) THEN '+' ELSE '' END AS clerk
FROM ({ROWS_SQL[prefix]}) r WHERE {m} NOT IN (0, 3, 6)"""


# --- SQL text of the same mapping, for the DuckDB oracle ----------------------
def pmod(x: str, n: int) -> str:
    """``pmod`` in SQL (``%`` truncates toward zero for negative values)."""
    return f"(((({x}) % {n}) + {n}) % {n})"


ORDERS_ROWS_SQL = f"""
SELECT o_orderkey AS id, 'Customer' || o_custkey AS name, 18 + {pmod('o_custkey', 58)} AS age,
       'user' || o_custkey || '@example.com' AS email,
       CAST(round(o_totalprice * 100) AS BIGINT) AS purchase,
       CAST(epoch_us(o_orderdate) AS BIGINT) AS "timestamp",
       o_orderstatus AS store, o_orderpriority AS clerk,
       CASE {pmod('o_orderkey', 10)} WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'r' ELSE 'c' END AS op
FROM orders"""

LINEITEM_ROWS_SQL = f"""
SELECT l_orderkey * 8 + l_linenumber AS id, 'Customer' || l_partkey AS name, 18 + {pmod('l_suppkey', 58)} AS age,
       'user' || l_suppkey || '@example.com' AS email,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS purchase,
       CAST(epoch_us(l_shipdate) AS BIGINT) AS "timestamp",
       'S' || l_linenumber AS store, l_returnflag || l_linestatus AS clerk,
       CASE {pmod('l_orderkey * 8 + l_linenumber', 10)} WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'r' ELSE 'c' END AS op
FROM lineitem"""

ROWS_SQL = {"postgres": ORDERS_ROWS_SQL, "mysql": LINEITEM_ROWS_SQL}


def events_sql(prefix: str) -> str:
    """Projected events (B4) in SQL: deletes give four NULLs."""
    p = prefix
    return f"""
SELECT CASE WHEN op = 'd' THEN NULL ELSE purchase END AS {p}_purchase,
       CASE WHEN op = 'd' THEN NULL ELSE clerk END AS {p}_clerk,
       CASE WHEN op = 'd' THEN NULL ELSE store END AS {p}_store,
       CASE WHEN op = 'd' THEN NULL ELSE name END AS {p}_customer
FROM ({ROWS_SQL[prefix]}) r"""


# --- time series and key/value stand-ins (from ``events``) ---------------------

def series_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type: ``series, ts, value, event_id``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"), "ts", "value", "event_id")


def series_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per (event type, user) with labels ``event_type`` and ``user``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.col("event_type"), F.lit(":"), F.col("user_id").cast("string")).alias("series"),
        F.create_map(F.lit("event_type"), F.col("event_type"),
                     F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
        "ts", "value", "event_id")


def bucket_sql(ts: str, bucket_ms: int) -> str:
    us = int(bucket_ms) * 1000
    return f"make_timestamp(CAST(floor(epoch_us({ts}) / {us}) AS BIGINT) * {us})"


# --- log stand-ins ----------------------------------------------------------------

# fixed values: units and methods cycled through the synthetic event log lines
_DUR_UNITS = ("ms", "s", "us", "ns", "m", "h")
_BYTE_UNITS = ("B", "KB", "MB", "KiB")
_METHODS = ("GET", "POST", "PUT", "DELETE")
_LEVEL_OF_TYPE = (("error", "ERROR"), ("view", "debug"), ("click", "info"), ("signup", "Warning"))


def _cycle(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(idx, F.lit(len(values))) + 1).cast("int"))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event: a JSON, logfmt or plain line (by ``event_id mod 3``)
    with level, user, value, k, latency, size, method and msg.

    Labels: ``service_name`` (``svc-<type>``), ``cluster`` (``c<user mod 4>``) and,
    on one user in five, ``region``.
    """
    e = spread(table(spark, sf_dir, "events"))
    # like SQL TRY_CAST(text AS BIGINT): numeric text rounds, anything else is NULL
    k = F.round(F.get_json_object("props", "$.k").try_cast("double")).try_cast("bigint")
    lvl = None
    for t, l in _LEVEL_OF_TYPE:
        lvl = F.when(F.col("event_type") == t, F.lit(l)) if lvl is None else lvl.when(F.col("event_type") == t, F.lit(l))
    latency = F.concat(k.cast("string"), _cycle(_DUR_UNITS, k))
    size = F.concat((k * 3).cast("string"), _cycle(_BYTE_UNITS, F.col("user_id")))
    method = _cycle(_METHODS, F.col("event_id"))
    msg = F.concat(F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string"))
    js = F.to_json(F.struct(lvl.alias("level"), F.col("user_id").alias("user"), F.col("value"), k.alias("k"),
                            latency.alias("latency"), size.alias("size"), method.alias("method"), msg.alias("msg")))
    lf = F.concat_ws(" ", F.concat(F.lit("level="), lvl), F.concat(F.lit("user="), F.col("user_id").cast("string")),
                     F.concat(F.lit("value="), F.col("value").cast("string")), F.concat(F.lit("k="), k.cast("string")),
                     F.concat(F.lit("latency="), latency), F.concat(F.lit("size="), size),
                     F.concat(F.lit("method="), method), F.concat(F.lit('msg="'), msg, F.lit('"')))
    plain = F.concat_ws("", F.concat(F.upper(lvl), F.lit(" ")), F.lit("user "),
                        F.col("user_id").cast("string"), F.lit(" did "), F.col("event_type"), F.lit(" in "), latency)
    fmt = F.pmod(F.col("event_id"), F.lit(3))
    line = F.when(fmt == 0, js).when(fmt == 1, lf).otherwise(plain)
    labels = F.map_filter(F.create_map(
        F.lit("service_name"), F.concat(F.lit("svc-"), F.col("event_type")),
        F.lit("cluster"), F.concat(F.lit("c"), F.pmod(F.col("user_id"), F.lit(4)).cast("string")),
        F.lit("region"), F.when(F.pmod(F.col("user_id"), F.lit(5)) == 0,
                                F.concat(F.lit("eu-"), F.pmod(F.col("user_id"), F.lit(2)).cast("string")))),
        lambda _k, v: v.isNotNull())
    return e.select("event_id", "ts", labels.alias("labels"), line.alias("line"), lvl.alias("level"))


def document_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document; ``ts`` = 2024-01-01 + doc_id minutes + line number seconds.

    Labels: ``service_name`` = ``docs``, ``lang``, ``source``.
    """
    d = spread(table(spark, sf_dir, "documents"))
    x = explode_rows(d, F.split("text", "\n"), ("line",), keep=("doc_id", "lang", "source"), pos="pos")
    ln = (F.col("pos") + 1).cast("bigint")
    ts = F.timestamp_add("SECOND", F.col("doc_id") * 60 + ln, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    labels = F.create_map(F.lit("service_name"), F.lit("docs"), F.lit("lang"), F.col("lang"),
                          F.lit("source"), F.col("source"))
    return x.select("doc_id", ln.alias("ln"), ts.alias("ts"), labels.alias("labels"), "line")


DOC_LINES_SQL = """
SELECT doc_id, lang, source, CAST(ln AS BIGINT) AS ln, line,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 60 + ln) AS ts
FROM (SELECT doc_id, lang, source, generate_subscripts(parts, 1) AS ln, unnest(parts) AS line
      FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents))"""

pmod_sql = pmod


def _list_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _level_case(mapping, else_: str | None = None) -> str:
    other = f" ELSE '{else_}'" if else_ else ""
    return "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{l}'" for t, l in mapping) + other + " END"


# fixed values: level each event type's line carries, after normalisation
_DETECTED_OF_TYPE = (("error", "error"), ("view", "debug"), ("click", "info"), ("signup", "warn"))


_K_SQL = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"  # rounds numeric text
# The event log in SQL terms: the values each line carries, for the oracle.
EVENT_LOG_SQL = f"""
SELECT event_id, ts, event_type, user_id, value, {_K_SQL} AS k,
       {pmod_sql('event_id', 3)} AS fmt,
       {_level_case(_LEVEL_OF_TYPE)} AS level,
       {_level_case(_DETECTED_OF_TYPE, else_='logs')} AS detected_level,
       'svc-' || event_type AS service_name, 'c' || {pmod_sql('user_id', 4)} AS cluster,
       CASE WHEN {pmod_sql('user_id', 5)} = 0 THEN 'eu-' || {pmod_sql('user_id', 2)} END AS region,
       ({_list_sql(_DUR_UNITS)})[{pmod_sql(_K_SQL, len(_DUR_UNITS))} + 1] AS dur_unit,
       ({_list_sql(_BYTE_UNITS)})[{pmod_sql('user_id', len(_BYTE_UNITS))} + 1] AS byte_unit,
       ({_list_sql(_METHODS)})[{pmod_sql('event_id', len(_METHODS))} + 1] AS method
FROM events"""
