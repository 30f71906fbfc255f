"""Corrected totals: what the table holds now, from its change feed.

The plain totals (``aggregate.clerk_totals``) add one for every change, so an
update counts twice and a delete not at all. Here every change is a pair of
signed rows: its ``before`` image is taken back, its ``after`` image added. The
sums of signed rows do not depend on the order of the changes and are a plain
grouped aggregate: combined before the shuffle in a batch, one state row per
key in a stream. ``current_rows`` gives the same answer another way: the last
image of every primary key by log position.

Both read each message once (``parse_changes``); messages without a change
(tombstones, text that is not JSON) give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from capstream.functions.common import explode_rows, let, quoted
from capstream.functions.parse import envelope_column
from capstream.schema import AFTER_DDL, TOTAL_FIELDS


def parse_changes(df: DataFrame, fields: tuple[str, ...] = tuple(src for src, _ in TOTAL_FIELDS), key: str = "id", value: str = "value",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """``op, position, <key>, before, after`` of every change; the images hold ``fields`` alone.

    ``position`` is the log position (``source.lsn``). The key is the one of the
    image that is there.
    """
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(AFTER_DDL)}
    image = ", ".join(f"{c} {kinds[c]}" for c in dict.fromkeys((key, *fields)))
    payload = envelope_column(value, f"payload struct<before struct<{image}>, after struct<{image}>, op string, source struct<lsn bigint>>").getField("payload")

    def row(p: Column) -> Column:
        before, after = p.getField("before"), p.getField("after")

        def part(x: Column) -> Column:
            return F.when(x.isNotNull(), F.struct(*[x.getField(c).alias(c) for c in fields]))

        return F.filter(F.array(F.struct(p.getField("op").alias("op"), p.getField("source").getField("lsn").alias("position"),
                                         F.coalesce(after.getField(key), before.getField(key)).alias(key),
                                         part(before).alias("before"), part(after).alias("after"))),
                        lambda r: r["op"].isNotNull())

    return explode_rows(df, let(payload, row), ("_e",), keep=keep).select(*keep, "_e.*")


def once(changes: DataFrame, key: str = "id") -> DataFrame:
    """Each change once, for feeds that may deliver a message again (same key and log position)."""
    return changes.dropDuplicates([key, "position"])


def signed_rows(changes: DataFrame) -> DataFrame:
    """``sign`` and the image's fields: -1 for the image a change removes, +1 for the one it leaves.

    Inserts and snapshots leave a row, deletes remove one, updates do both; an
    image that the message lacks gives no row.
    """
    op = F.col("op")
    signed = F.array(F.struct(F.lit(-1).alias("sign"), F.when(op.isin("u", "d"), F.col("before")).alias("image")),
                     F.struct(F.lit(1).alias("sign"), F.when(op != "d", F.col("after")).alias("image")))
    return explode_rows(changes, F.filter(signed, lambda s: s["image"].isNotNull()), ("_s",)).select("_s.sign", "_s.image.*")


def corrected_totals(signed: DataFrame, prefix: str, key: str = "clerk", value: str = "purchase", emptied: bool = False) -> DataFrame:
    """``<p>_<key>, <p>_<value>_count, <p>_<value>_sum`` over the rows that are there now.

    Names and NULL rules are those of ``clerk_totals``: NULL values do not count,
    a key whose values are all NULL has count 0 and sum NULL. With ``emptied``
    keys that hold no row any more stay, with count 0 (a stream in update mode
    needs them to clear what it published); else they go.
    """
    sign, v = F.col("sign"), quoted(value)
    count = F.sum(F.when(v.isNotNull(), sign).otherwise(0))
    out = signed.groupBy(quoted(key).alias(f"{prefix}_{key}")).agg(
        count.alias(f"{prefix}_{value}_count"), F.when(count > 0, F.sum(sign * v)).alias(f"{prefix}_{value}_sum"), F.sum(sign).alias("_rows"))
    return (out if emptied else out.where(F.col("_rows") > 0)).drop("_rows")


def last_changes(changes: DataFrame, key: str = "id") -> DataFrame:
    """The change with the highest log position of every key, deletes included.

    One aggregate row per key crosses the shuffle, whatever the number of its
    changes and in whatever order they come. The last changes of several parts of
    a feed, taken together, have the feed's last changes among them. A change
    without a position is older than any other.
    """
    last = F.max_by(F.struct("op", "position", "before", "after"), F.struct(F.coalesce("position", F.lit(-(1 << 63))), "op"))
    return changes.groupBy(quoted(key)).agg(last.alias("_l")).select(quoted(key), "_l.*")


def current_rows(changes: DataFrame, key: str = "id") -> DataFrame:
    """``<key>`` and its fields as of its last change; deleted keys go."""
    return last_changes(changes, key).where("op <> 'd'").select(quoted(key), "after.*")
