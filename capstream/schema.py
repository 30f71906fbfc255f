"""Fixed schemas of the change stream.

One copy of every schema the library parses or produces. The envelope is the
shape a log-based change-capture connector emits for a row of the ``customer``
table: ``{"schema": {...}, "payload": {"before", "after", "source", "op", ...}}``.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: row image of the captured ``customer`` table ------------
AFTER_DDL = (
    "age bigint, email string, id bigint, name string, purchase bigint, "
    "store string, timestamp bigint, clerk string"
)

# --- fixed values: ``payload.source`` block of the envelope ------------------
SOURCE_DDL = (
    "connector string, db string, lsn bigint, name string, schema string, "
    "sequence string, snapshot string, table string, ts_ms bigint, ts_ns bigint, "
    "ts_us bigint, txId bigint, version string, xmin string"
)

# --- fixed values: embedded ``schema`` block (declared, parsed, unused) -------
SCHEMA_BLOCK_DDL = (
    "fields array<struct<field string, "
    "fields array<struct<default string, field string, name string, optional string, "
    "parameters struct<allowed string>, type string, version bigint>>, "
    "name string, optional string, type string, version bigint>>, "
    "name string, optional string, type string, version bigint"
)

# ``before`` and ``transaction`` are objects on the wire but declared as text,
# so from_json keeps their raw JSON (re-parse ``before`` with AFTER if needed).
PAYLOAD_DDL = (
    f"after struct<{AFTER_DDL}>, before string, op string, "
    f"source struct<{SOURCE_DDL}>, transaction string, "
    "ts_ms bigint, ts_ns bigint, ts_us bigint"
)

ENVELOPE_DDL = f"payload struct<{PAYLOAD_DDL}>, schema struct<{SCHEMA_BLOCK_DDL}>"

# Only the branches the projection reads; from_json still scans the whole
# text but materialises far less (Catalyst does not prune inside a struct).
PAYLOAD_ONLY_DDL = f"payload struct<{PAYLOAD_DDL}>"

# Columns of a Kafka source row; only ``value`` is consumed downstream.
KAFKA_ROW_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

# Columns of the projected event, before the source prefix is applied.
EVENT_FIELDS = (("purchase", "purchase"), ("clerk", "clerk"), ("store", "store"), ("name", "customer"))

# The two of them that the totals read.
TOTAL_FIELDS = (("purchase", "purchase"), ("clerk", "clerk"))


def struct_type(ddl: str) -> StructType:
    """DDL text to StructType (needs an active session: parsing is JVM-side).

    Functions that take a schema accept the DDL text directly, so most code
    never needs the StructType.
    """
    return StructType.fromDDL(ddl)
