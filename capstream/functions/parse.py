"""Parsing the change envelope and projecting the row image.

All column expressions (cast, from_json, struct access) on the JVM; nothing
shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from capstream.functions.common import explode_rows, let
from capstream.schema import AFTER_DDL, ENVELOPE_DDL, EVENT_FIELDS, SCHEMA_BLOCK_DDL


def envelope_column(value: Column | str = "value", schema: str = ENVELOPE_DDL) -> Column:
    """B1 + B2: bytes -> text -> struct. PERMISSIVE: bad or NULL text gives NULL."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema)


def parse_envelope(df: DataFrame, value: str = "value", schema: str = ENVELOPE_DDL,
                   alias: str = "data", keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka-shaped rows -> one ``data`` struct column (plus any ``keep`` columns)."""
    return df.select(*keep, envelope_column(value, schema).alias(alias))


def after_image(df: DataFrame, alias: str = "data") -> DataFrame:
    """The row image after the change (NULL struct for deletes)."""
    return df.select(F.col(f"{alias}.payload.after").alias("after"))


def project_event(df: DataFrame, prefix: str, fields=EVENT_FIELDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``after.<field> AS <prefix>_<name>`` for the four event columns."""
    return df.select(*keep, *[F.col(f"after.{src}").alias(f"{prefix}_{dst}") for src, dst in fields])


def event_schema(fields=EVENT_FIELDS, with_op: bool = False) -> str:
    """The part of the envelope that ``parse_events`` declares."""
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(AFTER_DDL)}
    wanted = ", ".join(f"{src} {kinds[src]}" for src in dict.fromkeys(src for src, _ in fields))
    return f"payload struct<after struct<{wanted}>{', op string' if with_op else ''}>"


def parse_events(df: DataFrame, prefix: str, value: str = "value", fields=EVENT_FIELDS,
                 keep: tuple[str, ...] = (), with_op: bool = False) -> DataFrame:
    """B1-B4 in one projection: Kafka rows -> prefixed event columns.

    Only the members of ``after`` named in ``fields`` (and ``op`` if ``with_op``
    adds the change kind) are declared, so the parser converts nothing else.

    The parsed row leaves through a one-row generator: a later filter on an
    event column (a change-kind filter, a NULL-key skip) then stays above the
    parse instead of being pushed below it, where every message would be
    parsed a second time. ``let`` keeps it to one parse per message.
    """
    payload = envelope_column(value, event_schema(fields, with_op)).getField("payload")

    def row(p: Column) -> Column:
        after = p.getField("after")
        extra = [p.getField("op").alias("op")] if with_op else []
        return F.array(F.struct(*[after.getField(src).alias(f"{prefix}_{dst}") for src, dst in fields], *extra))

    return explode_rows(df, let(payload, row), ("_e",), keep=keep).select(*keep, "_e.*")


def reparse_before(c: Column | str = "before") -> Column:
    """The ``before`` image is kept as JSON text; parse it with the row schema."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, AFTER_DDL)


def envelope_meta(df: DataFrame, alias: str = "data") -> DataFrame:
    """The flat metadata of each change (op, position, origin, clocks)."""
    p = f"{alias}.payload"
    return df.select(
        F.col(f"{p}.op").alias("op"),
        F.col(f"{p}.source.lsn").alias("lsn"),
        F.col(f"{p}.source.txId").alias("tx_id"),
        F.col(f"{p}.source.db").alias("db"),
        F.col(f"{p}.source.schema").alias("schema_name"),
        F.col(f"{p}.source.table").alias("table_name"),
        F.col(f"{p}.source.connector").alias("connector"),
        F.col(f"{p}.source.name").alias("server"),
        F.col(f"{p}.source.snapshot").alias("snapshot"),
        F.col(f"{p}.source.ts_ms").alias("source_ts_ms"),
        F.col(f"{p}.ts_ms").alias("ts_ms"),
        F.col(f"{p}.before").alias("before"),
        F.col(f"{p}.transaction").alias("transaction"),
    )


def schema_fields(df: DataFrame, alias: str = "data", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per field of the embedded schema (``schema.fields[].fields[]``).

    Top-level fields without children (``op``, ``ts_ms``...) appear once with
    NULL child columns (``explode_outer``).
    """
    top = explode_rows(df, F.col(f"{alias}.schema.fields"), ("f",),
                       keep=(*keep, F.col(f"{alias}.schema.name").alias("envelope")))
    return top.select(
        *keep, "envelope",
        F.col("f.field").alias("parent_field"),
        F.col("f.type").alias("parent_type"),
        F.col("f.name").alias("parent_name"),
        F.explode_outer("f.fields").alias("c"),
    ).select(
        *keep, "envelope", "parent_field", "parent_type", "parent_name",
        F.col("c.field").alias("field"),
        F.col("c.type").alias("type"),
        F.col("c.name").alias("logical_name"),
        F.col("c.optional").alias("optional"),
        F.col("c.default").alias("default_value"),
        F.col("c.parameters.allowed").alias("allowed"),
    )


SCHEMA_FIELD_COLUMNS = ("envelope", "parent_field", "parent_type", "parent_name", "field", "type",
                        "logical_name", "optional", "default_value", "allowed")


def schema_field_counts(df: DataFrame, value: str = "value") -> DataFrame:
    """B11 summary: each embedded-schema field with the number of messages carrying it.

    Every message repeats its table's schema, so the schema text is cut out
    (declared as text: kept raw, not parsed), messages are counted per
    distinct text with a partial aggregate (a schema shared by all messages
    is one hot key, pre-combined on every partition), and only the distinct
    schemas are parsed and exploded.
    """
    texts = df.select(F.from_json(F.col(value).cast("string"), "schema string").getField("schema").alias("t"))
    distinct = texts.groupBy("t").agg(F.count(F.lit(1)).alias("_n"))
    parsed = distinct.select("_n", F.struct(F.from_json("t", SCHEMA_BLOCK_DDL).alias("schema")).alias("data"))
    return (schema_fields(parsed, keep=("_n",))
            .groupBy(*SCHEMA_FIELD_COLUMNS).agg(F.sum("_n").alias("n_messages")))


_UNIT_MICROS = {"seconds": 1_000_000, "millis": 1_000, "micros": 1}


def event_time(c: Column | str, unit: str = "micros", ntz: bool = False) -> Column:
    """Opt-in conversion of the row's integer ``timestamp`` to a timestamp.

    The unit differs between capture connectors, so it is a parameter.
    ``ntz=True`` gives the UTC wall clock as ``timestamp_ntz`` (independent of
    the session time zone); otherwise an instant (``timestamp``).
    """
    c = F.col(c) if isinstance(c, str) else c
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unit must be one of {sorted(_UNIT_MICROS)}")
    micros = F.round(c * F.lit(_UNIT_MICROS[unit])).cast("bigint")  # fractional inputs: nearest µs
    if ntz:
        return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.timestamp_micros(micros)
