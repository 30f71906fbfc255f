"""Input stand-in: table rows as change envelopes, shaped like Kafka source rows.

The capture connector is an external service; this imitates its output so that
the rest of the pipeline can be driven by any DataFrame of ``customer``-shaped
rows. Everything is a projection: no shuffle, scales with the input.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from capstream.schema import AFTER_DDL
from capstream.sources.source import CdcSource


CONNECTOR_VERSION = "3.0.0.Final"

# --- fixed values: field lists of the captured row, the origin block and the transaction block as the connector
# describes them (name, type, optional)
_ROW_FIELDS = (
    ("id", "int32", False), ("name", "string", True), ("age", "int32", True),
    ("email", "string", True), ("purchase", "int32", True), ("timestamp", "int64", True),
    ("store", "string", True), ("clerk", "string", True),
)
_SOURCE_FIELDS = (
    ("version", "string", False), ("connector", "string", False), ("name", "string", False),
    ("ts_ms", "int64", False), ("snapshot", "string", True), ("db", "string", False),
    ("sequence", "string", True), ("ts_us", "int64", True), ("ts_ns", "int64", True),
    ("schema", "string", False), ("table", "string", False), ("txId", "int64", True),
    ("lsn", "int64", True), ("xmin", "int64", True),
)
_TX_FIELDS = (("id", "string", False), ("total_order", "int64", False),
              ("data_collection_order", "int64", False))


def _field(name: str, typ: str, optional: bool) -> dict:
    f = {"type": typ, "optional": optional, "field": name}
    if name == "timestamp":
        f.update(name="io.debezium.time.MicroTimestamp", version=1)
    if name == "id" and typ == "int32":
        f["default"] = 0
    if name == "snapshot":
        f.update(name="io.debezium.data.Enum", version=1, default="false",
                 parameters={"allowed": "true,last,false,incremental"})
    return f


def schema_block(source: CdcSource) -> str:
    """JSON text of the embedded schema; constant per source, built once on the driver."""
    prefix = ".".join(p for p in (source.server, source.schema_name or source.db, source.table) if p)
    row = [_field(*f) for f in _ROW_FIELDS]
    block = {
        "type": "struct", "optional": False, "name": f"{prefix}.Envelope", "version": 2,
        "fields": [
            {"type": "struct", "fields": row, "optional": True, "name": f"{prefix}.Value", "field": "before"},
            {"type": "struct", "fields": row, "optional": True, "name": f"{prefix}.Value", "field": "after"},
            {"type": "struct", "fields": [_field(*f) for f in _SOURCE_FIELDS], "optional": False,
             "name": f"io.debezium.connector.{source.connector}.Source", "field": "source"},
            {"type": "struct", "fields": [_field(*f) for f in _TX_FIELDS], "optional": True,
             "name": "event.block", "version": 1, "field": "transaction"},
            {"type": "string", "optional": False, "field": "op"},
            {"type": "int64", "optional": True, "field": "ts_ms"},
            {"type": "int64", "optional": True, "field": "ts_us"},
            {"type": "int64", "optional": True, "field": "ts_ns"},
        ],
    }
    return json.dumps(block, separators=(",", ":"))


def epoch_micros(c: Column | str, ntz: bool) -> Column:
    """Microseconds since the epoch; an NTZ wall clock is read as UTC (tz-independent)."""
    c = F.col(c) if isinstance(c, str) else c
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c)
    return F.unix_micros(c)


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, TimestampNTZType)


def to_envelope(df: DataFrame, source: CdcSource, *, op_col: str = "op", ts_col: str | None = None,
                partitions: int = 1, with_schema: bool = True) -> DataFrame:
    """Rows of the captured table -> Kafka-shaped change messages.

    ``df`` carries the columns of ``AFTER`` plus ``op`` (``c``/``r``/``u``/``d``).
    A delete carries the row as ``before`` and a NULL ``after``; an update
    carries it in both. ``ts_col`` (epoch ms) stamps the envelope; without it
    the row's own ``timestamp`` (micros) is used.
    """
    op = F.col(op_col)
    ts_ms = F.col(ts_col) if ts_col else F.floor(F.col("timestamp") / 1000)
    image = row_image(F.col)
    after = F.when(op != F.lit("d"), image)
    before = F.when(op.isin("u", "d"), image)  # an object on the wire
    return _messages(df, source, before, after, op, F.col("id"), F.col("id"), ts_ms, partitions, with_schema)


def row_image(value: Callable[[str], Column]) -> Column:
    """The captured row as the messages carry it; ``value`` gives each of its fields."""
    return F.struct(*[value(n).cast(t).alias(n) for n, t in (f.split(" ") for f in AFTER_DDL.split(", "))])


def change_messages(df: DataFrame, source: CdcSource, *, partitions: int = 1, with_schema: bool = False) -> DataFrame:
    """Changes with both images -> messages: columns ``before``, ``after`` (row images), ``op``, ``id``, ``lsn``, ``ts_ms``."""
    return _messages(df, source, *(F.col(c) for c in ("before", "after", "op", "id", "lsn", "ts_ms")), partitions, with_schema)


def _messages(df: DataFrame, source: CdcSource, before: Column, after: Column, op: Column, id_: Column, lsn: Column, ts_ms: Column,
              partitions: int, with_schema: bool) -> DataFrame:
    source_block = F.struct(
        F.lit(CONNECTOR_VERSION).alias("version"), F.lit(source.connector).alias("connector"),
        F.lit(source.server).alias("name"), ts_ms.alias("ts_ms"),
        F.when(op == F.lit("r"), F.lit("true")).otherwise(F.lit("false")).alias("snapshot"),
        F.lit(source.db).alias("db"), F.lit(None).cast("string").alias("sequence"),
        (ts_ms * 1000).alias("ts_us"), (ts_ms * 1000000).alias("ts_ns"),
        F.lit(source.schema_name or source.db).alias("schema"), F.lit(source.table).alias("table"),
        lsn.alias("txId"), lsn.alias("lsn"), F.lit(None).cast("bigint").alias("xmin"),
    )
    payload = F.struct(
        before.alias("before"), after.alias("after"), source_block.alias("source"),
        F.lit(None).cast("string").alias("transaction"), op.alias("op"),
        ts_ms.alias("ts_ms"), (ts_ms * 1000).alias("ts_us"), (ts_ms * 1000000).alias("ts_ns"),
    )
    # to_json drops NULL members; the connector writes them as null, so the
    # text is assembled around a JSON body that keeps explicit nulls.
    body = F.to_json(payload, {"ignoreNullFields": "false"})
    if with_schema:
        value = F.concat(F.lit('{"schema":' + schema_block(source) + ',"payload":'), body, F.lit("}"))
    else:
        value = F.concat(F.lit('{"payload":'), body, F.lit("}"))
    key = F.to_json(F.struct(id_.alias("id")))
    return df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(source.topic).alias("topic"),
        F.pmod(F.xxhash64(id_), F.lit(partitions)).cast("int").alias("partition"),
        lsn.cast("bigint").alias("offset"),
        F.timestamp_millis(ts_ms).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
