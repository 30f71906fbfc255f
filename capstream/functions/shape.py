"""Shaping aggregate rows for the notification topic and the keyed hash store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: key prefixes of the serving hashes and their field names ---
HASH_PREFIX = {"postgres": "Postgresql:", "mysql": "Mysql:"}
HASH_FIELDS = (("Count", "purchase_count"), ("Sum", "purchase_sum"))


def to_notification(df: DataFrame, key: str, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """``key`` column as the message key, a JSON object of ``cols`` as value.

    ``to_json`` leaves out NULL members, so a NULL clerk group serialises
    without its clerk and is published with a NULL key.
    """
    return df.select(
        F.col(key).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"),
    )


def notification_for(df: DataFrame, prefix: str, metrics: tuple[str, ...] = ("count", "sum")) -> DataFrame:
    """The per-source notification: clerk, count and (optionally) sum."""
    cols = [f"{prefix}_clerk"] + [f"{prefix}_purchase_{m}" for m in metrics]
    return to_notification(df, f"{prefix}_clerk", cols)


def hash_key(prefix_text: str, key: Column, null_key: str | None = None) -> Column:
    """``<prefix><key>``; with ``null_key`` set a NULL key renders as that text."""
    k = key.cast("string")
    if null_key is not None:
        k = F.coalesce(k, F.lit(null_key))
    return F.concat(F.lit(prefix_text), k)


def to_hash_rows(df: DataFrame, key_col: str, prefix_text: str, mapping: dict[str, str],
                 null_key: str | None = None) -> DataFrame:
    """B8 + B9: rows -> ``(hash_key, fields map<string,string>)``.

    NULL keys are skipped unless ``null_key`` is given (``"None"`` reproduces
    the text a Python f-string would write, and a NULL value becomes ``"None"`` too).
    """
    def val(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.coalesce(v, F.lit(null_key)) if null_key is not None else v

    pairs = []
    for field_name, c in mapping.items():
        pairs += [F.lit(field_name), val(c)]
    row = F.struct(hash_key(prefix_text, F.col(key_col), null_key).alias("hash_key"),
                   F.create_map(*pairs).alias("fields"))
    if null_key is not None:
        return df.select(row.alias("r")).select("r.*")
    # NULL keys are dropped by a generator (no rows for a NULL array) rather
    # than a filter: a filter on the key would be pushed below the aggregate
    # into the scan and parse every message a second time.
    return df.select(F.inline(F.when(F.col(key_col).isNotNull(), F.array(row))))


def hash_rows_for(df: DataFrame, prefix: str, null_key: str | None = None) -> DataFrame:
    mapping = {name: f"{prefix}_{suffix}" for name, suffix in HASH_FIELDS}
    return to_hash_rows(df, f"{prefix}_clerk", HASH_PREFIX[prefix], mapping, null_key)
