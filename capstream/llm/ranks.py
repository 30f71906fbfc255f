"""Exact ranks of every row inside its group, without a group ever sorting in one task.

A window ordered over a whole group puts a hot group in one task. Here a
group's order is cut into ``buckets`` slices of a key that is uniform in
[0, 1): counts per (group, slice) are aggregated map-side first, their running
sum gives each slice's first rank, and only the rows of one slice are sorted
together. One path for all sizes; everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of a group's order. A slice of the largest group holds rows/BUCKETS rows of narrow columns.
BUCKETS = 1 << 14


def uniform(hash_col: Column) -> Column:
    """A 64-bit hash as a double in [0, 1), in the order of its top 53 bits (unsigned)."""
    return F.shiftrightunsigned(hash_col, 11) / F.lit(float(1 << 53))


def seeded(seed: int, text: Column) -> Column:
    """The first 60 bits of the MD5 of ``<seed>:<text>``, a hash that other engines have too."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 15), 16, 10).cast("long")


def text_key(col: str) -> Column:
    """``col`` as a string that is never NULL and keeps NULL apart from every value (for grouping and joins)."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(col).cast("string")))


def with_group_ranks(df: DataFrame, keys: list[str], position: Column, order: list[Column],
                     rank: str, total: str, buckets: int = BUCKETS) -> DataFrame:
    """Add ``rank`` (from 0) of each row in its group of ``keys`` and ``total``, the group's rows.

    ``position`` is in [0, 1) and rises with ``order``; ``order`` must order all
    rows that share a slice. ``keys`` must not be NULL (see ``text_key``) and may
    be empty. Rows that tie in all of ``order`` get distinct ranks in any order.
    """
    rows = df.withColumn("_slice", F.least(F.floor(position * buckets), F.lit(buckets - 1)).cast("int"))
    counts = rows.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
                           F.sum("_n").over(whole).alias(total))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    ranked = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    return (ranked.join(starts, [*keys, "_slice"])
            .withColumn(rank, F.col("_first") + F.col("_inside"))
            .drop("_slice", "_first", "_inside"))
