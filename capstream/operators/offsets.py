"""Which log offsets a consumer has seen: ranges, gaps and repeats per topic and partition.

A source that keeps going when offsets have vanished (``fail_on_data_loss``
off) loses messages silently. Here every batch's offsets become a set of
ranges (islands of consecutive offsets); range sets of any batches merge into
one, and what lies between its ranges was lost or has not come yet.

Offsets are cut into blocks of ``BLOCK`` consecutive numbers first, so that a
topic partition of any length is worked on block by block. Only what touches a
block's border can go on in another block: at most two ranges of a block, which
are looked at together, key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions.common import quoted
from capstream.streaming.sinks import BatchFn
from capstream.streaming.versions import VersionedFolder

#: Offsets that are looked at in one window.
BLOCK = 1 << 16
#: Partitions that blocks are dealt to, unless the session's shuffles have more. Offsets
#: compress well: partitions joined by their shuffled bytes would hold many millions of rows.
PARTITIONS = 64
KEYS = ("topic", "partition")


def _block(offset: Column, block: int) -> Column:
    """The first offset of the block that holds ``offset``."""
    return offset - F.pmod(offset, F.lit(block))


def _deal(df: DataFrame, *by: Column | str) -> DataFrame:
    """Rows with equal ``by`` in one partition, told by ``_task``: the optimizer drops constant keys from
    windows, and would shuffle once more if the keys themselves were dealt by.
    """
    n = max(PARTITIONS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.withColumn("_task", F.xxhash64(*by)).repartition(n, "_task")


def offset_ranges(df: DataFrame, keys: tuple[str, ...] = KEYS, offset: str = "offset", block: int = BLOCK) -> DataFrame:
    """``keys, first, last, messages``: maximal runs of consecutive offsets and the rows they hold (repeats included).

    NULL offsets are no offsets; NULL keys are keys of their own.
    """
    by = [quoted(k) for k in keys]
    seen = df.where(quoted(offset).isNotNull()).select(*by, quoted(offset).cast("bigint").alias("_o"))
    rows = _deal(seen.withColumn("_block", _block(F.col("_o"), block)), *by, "_block")
    inside = F.dense_rank().over(Window.partitionBy("_task", *by, "_block").orderBy("_o"))
    islands = rows.withColumn("_g", F.col("_o") - inside).groupBy("_task", *by, "_block", "_g").agg(
        F.min("_o").alias("first"), F.max("_o").alias("last"), F.count(F.lit(1)).alias("messages"))
    return _across(islands, by, block, F.col("first") == F.col("_block"))


def merge_ranges(ranges: DataFrame, keys: tuple[str, ...] = KEYS, block: int = BLOCK) -> DataFrame:
    """The union of range sets: ranges that overlap or touch become one, their messages add up."""
    by = [quoted(k) for k in keys]
    rows = ranges.select(*by, _block(F.col("first"), block).alias("_block"), "first", "last", "messages")
    # how far the ranges of earlier blocks reach: a row without ``first``, before all others of its block
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    reach = (rows.groupBy(*by, "_block").agg(F.max("last").alias("last")).withColumn("last", F.max("last").over(earlier)).where(F.col("last").isNotNull())
             .select(*by, "_block", F.lit(None).cast("bigint").alias("first"), "last", F.lit(0).cast("bigint").alias("messages")))
    # one row per first offset: no window holds more rows than a block has offsets
    starts = _deal(rows.unionByName(reach), *by, "_block").groupBy("_task", *by, "_block", "first").agg(
        F.max("last").alias("last"), F.sum("messages").alias("messages"))
    runs = _union(starts, [F.col("_task"), *by, F.col("_block")], F.max(F.col("first").isNull()).alias("_reached")).where(F.col("first").isNotNull())
    return _across(runs, by, block, F.col("_reached"))


def _across(runs: DataFrame, by: list[Column], block: int, begun: Column) -> DataFrame:
    """Ranges that are apart within each ``_block``, as ranges that are apart: those with ``begun`` may go on
    from an earlier block, those that reach their block's end into a later one; all others are as they are.
    """
    edge = begun | (F.col("last") >= F.col("_block") + (block - 1))
    strands = _deal(runs.withColumn("_strand", F.when(~edge, F.col("_block"))), *by, "_strand")
    return _union(strands, [F.col("_task"), *by, F.col("_strand")]).select(*by, "first", "last", "messages")


def _union(ranges: DataFrame, by: list[Column], *more: Column) -> DataFrame:
    """``by, first, last, messages`` and the aggregates ``more``: the union of the ranges of each ``by``, in one window each."""
    before = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max("last").over(before)
    opened = ranges.withColumn("_new", F.when(F.col("first") <= reach + 1, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(upto))
    return opened.groupBy(*by, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("messages").alias("messages"), *more).drop("_run")


def gaps(ranges: DataFrame, keys: tuple[str, ...] = KEYS, block: int = BLOCK) -> DataFrame:
    """``keys, first_missing, last_missing, missing`` between the ranges of a merged set."""
    by = [quoted(k) for k in keys]
    rows = _deal(ranges.select(*by, _block(F.col("first"), block).alias("_block"), "first", "last"), *by, "_block")
    inside = rows.withColumn("_next", F.lead("first").over(Window.partitionBy("_task", *by, "_block").orderBy("first")))
    # from the last range of a block to the first of the next one: one row per block
    between = rows.groupBy("_task", *by, "_block").agg(F.min("first").alias("first"), F.max("last").alias("last")).withColumn(
        "_next", F.lead("first").over(Window.partitionBy(*by).orderBy("_block")))
    return (inside.unionByName(between).where(F.col("_next").isNotNull())
            .select(*by, (F.col("last") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"),
                    (F.col("_next") - F.col("last") - 1).alias("missing")))


def audit(ranges: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per key of a merged set: first and last offset, ranges, offsets seen, missing between them, and repeats."""
    def total(c: Column) -> Column:
        return F.sum(c).cast("bigint")

    seen = F.col("last") - F.col("first") + 1
    return ranges.groupBy(*[quoted(k) for k in keys]).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.lit(1)).alias("ranges"), total(seen).alias("offsets"),
        (F.max("last") - F.min("first") + 1 - total(seen)).alias("missing"), (total(F.col("messages")) - total(seen)).alias("repeats"))


def range_log(folder: VersionedFolder, keys: tuple[str, ...] = KEYS) -> BatchFn:
    """A sink for ``fan_out``: every micro-batch's ranges go to the folder (a replayed one overwrites its own)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        folder.write(offset_ranges(batch, keys), epoch_id)
    return write
