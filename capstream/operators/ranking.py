"""Ranks and top-N per key, however many rows one key holds.

The whole order is cut at split points: tuples of the order columns from a
bounded random sample. The number of points follows the row count, and because
they are whole tuples (with a hash of the row as the last column) no frequent
value, common prefix or tie gathers rows in one slice. Counts per (key, slice),
aggregated before the shuffle, give each slice's first rank; only rows of one
(key, slice) are sorted together. The points only steer balance: a row's slice is
the number of points before it in the exact order, so ranks are exact for any
points. They reach the tasks as the value of a scalar subquery. (Texts that
agree in more characters than a point keeps, 65,536 for 64 points, 128 for the
most points, are not cut among themselves.)

A top-N of at most ``GROUP_LIMIT`` rows needs no points: every input partition
keeps its own first N rows per key, then groups of partitions do, then the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstream.functions.common import join_keys, let, quoted

#: Rows a slice should hold, and bounds of the number of split points.
SLICE_ROWS, LEAST_POINTS, MOST_POINTS = 250_000, 64, 32_768
#: Sampled rows per split point.
OVERSAMPLE = 4
#: Characters (bytes) that the texts (binaries) of a column have in all sampled rows together; a split point keeps its share of them.
POINT_LENGTHS = 16 << 20
#: Largest N that partitions select by themselves (Spark's limit for ranking filters below a window), and partition groups.
GROUP_LIMIT, PARTITION_GROUPS = 1000, 256

Order = tuple[str, bool]  # column name, ascending


def _comparable(df: DataFrame, name: str) -> Column | None:
    """The column as a value that split points can hold, in the same order; None for other types."""
    c, kind = quoted(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.NumericType, T.BooleanType, T.StringType, T.BinaryType)):
        return c
    return None


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _order_tuple(df: DataFrame, order: list[Order]) -> list[tuple[Column, bool]]:
    """Comparable values of the leading order columns; when they are all there, a hash of the row parts ties."""
    out = []
    for name, asc in order:
        c = _comparable(df, name)
        if c is None:
            return out
        out.append((c, asc))
    return [*out, (_tie(df), order[-1][1])]


def _tie(df: DataFrame) -> Column:
    return F.xxhash64(F.lit(0), *[quoted(f.name) for f in df.schema if _hashable(f.dataType)])


def _sort(df: DataFrame, order: list[Order]) -> list[Column]:
    """The order with the hash as its last column."""
    return [c.asc() if asc else c.desc() for c, asc in [*[(quoted(c), asc) for c, asc in order], (_tie(df), order[-1][1])]]


def _before(p: Column, r: Column, asc: list[bool]) -> Column:
    """Whether the tuple ``p`` comes strictly before ``r``; NULL is the least value, as in Spark's sorts."""
    if len(set(asc)) == 1:
        return p < r if asc[0] else p > r

    def one(i: int) -> Column:
        a, b = F.struct(p[f"c{i}"]), F.struct(r[f"c{i}"])
        return a < b if asc[i] else a > b

    return reduce(lambda rest, i: one(i) | (p[f"c{i}"].eqNullSafe(r[f"c{i}"]) & rest), reversed(range(len(asc) - 1)), one(len(asc) - 1))


def n_points(rows: int) -> int:
    """Split points for so many rows."""
    return max(LEAST_POINTS, min(MOST_POINTS, -(-rows // SLICE_ROWS)))


def _points(df: DataFrame, values: list[tuple[Column, bool]], points: int | None) -> tuple[DataFrame, int] | None:
    """A one-row frame with the sorted array of split points, and their number."""
    rows = df.count()
    points = points or n_points(rows)
    asc = [a for _, a in values]
    sample = df.select(F.struct(*[c.alias(f"c{i}") for i, (c, _) in enumerate(values)]).alias("t"))
    length = POINT_LENGTHS // (OVERSAMPLE * points)
    cut = F.struct(*[(F.substring(f"t.c{i}", 1, length) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.col(f"t.c{i}")).alias(f"c{i}")
                     for i, f in enumerate(sample.schema["t"].dataType.fields)])
    sample = sample.select(cut.alias("t")).sample(min(1.0, OVERSAMPLE * points / max(1, rows)), 11)

    def compare(a: Column, b: Column) -> Column:
        return F.when(_before(a, b, asc), -1).when(_before(b, a, asc), 1).otherwise(0)

    def in_order(c: Column) -> Column:
        return F.sort_array(c, all(asc)) if len(set(asc)) == 1 else F.array_sort(c, compare)

    # one array of a few tuples per split point comes back, and goes out again as a local table
    middle = OVERSAMPLE // 2
    held = sample.agg(in_order(F.collect_list("t")).alias("p")).select(F.filter("p", lambda _, i: i % OVERSAMPLE == middle).alias("p")).toArrow()
    found = len(held["p"][0])
    return (df.sparkSession.createDataFrame(held).select(in_order(F.array_distinct("p")).alias("p")), found) if found else None


def with_slices(df: DataFrame, order: list[Order], points: int | None = None) -> DataFrame:
    """``df`` with ``_slice``, a number that never falls along ``order``.

    ``points`` defaults to what the row count asks for (``n_points``).
    """
    values = _order_tuple(df, order)
    split = _points(df, values, points) if values else None
    if split is None:
        return df.withColumn("_slice", F.lit(0))
    asc, steps, step = [a for _, a in values], [], 1
    while step <= split[1]:
        steps.insert(0, step)
        step *= 2

    def place(p: Column) -> Column:
        def seek(row: Column) -> Column:
            return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                               lambda at, s: F.when((at + s <= F.size(p)) & F.coalesce(_before(F.get(p, at + s - 1), row, asc), F.lit(False)), at + s)
                               .otherwise(at))
        return let(F.struct(*[c.alias(f"c{i}") for i, (c, _) in enumerate(values)]), seek)

    return df.withColumn("_points", split[0].scalar()).withColumn("_slice", place(F.col("_points"))).drop("_points")


def _starts(rows: DataFrame, keys: tuple[str, ...], size: str | None, count: Column | None = None) -> DataFrame:
    """First rank of every (key, slice): one row each, counted before the shuffle."""
    counts = rows.groupBy(*map(quoted, keys), "_slice").agg((F.count(F.lit(1)) if count is None else F.sum(count)).alias("_c"))
    whole = Window.partitionBy(*map(quoted, keys))
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_c").over(whole).alias(size)] if size else []
    return counts.select(*map(quoted, keys), "_slice", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), *extra)


def _first_rows(df: DataFrame, keys: tuple[str, ...], order: list[Order], out: str, first: int) -> DataFrame:
    """The first rows of every key, kept per partition, per group of partitions and per key."""
    by = _sort(df, order)
    kept, partition = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTITION_GROUPS))), [*map(quoted, keys)]
    for w in (Window.partitionBy(*partition, "_part").orderBy(*by), Window.partitionBy(*partition).orderBy(*by)):
        kept = kept.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= first)
    return kept.withColumn(out, (F.col("_at") - 1).cast("bigint")).drop("_part", "_at")


def rank_within(df: DataFrame, keys: str | tuple[str, ...], order: list[Order], out: str = "rank", size: str | None = None,
                first: int | None = None, points: int | None = None) -> DataFrame:
    """Zero-based rank ``out`` of every row within its key; with ``first``, only the rows ranked below it.

    ``size`` names an optional column with the key's row count. NULL keys rank
    like any other key. Rows tied in all of the order are told apart by a hash of
    the row. With a larger ``first`` only slices that begin below it are sorted.
    """
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    if first is not None and first <= GROUP_LIMIT:
        ranked = _first_rows(df, keys, order, out, first)
        if size is None:
            return ranked
        sizes = df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(size))
        return join_keys(ranked, sizes, keys)
    rows = with_slices(df, order, points)
    starts = _starts(rows, keys, size)
    if first is not None:
        starts = starts.where(F.col("_before") < first)
    joined = join_keys(rows, starts.drop("_c"), (*keys, "_slice"))
    inside = F.row_number().over(Window.partitionBy(*map(quoted, keys), "_slice").orderBy(*_sort(df, order))) - 1
    ranked = joined.withColumn(out, (F.col("_before") + inside).cast("bigint")).drop("_before", "_slice")
    return ranked if first is None else ranked.where(F.col(out) < first)


def exact_percentile(df: DataFrame, keys: tuple[str, ...], value: str, q: float, points: int | None = None) -> DataFrame:
    """Exact percentile ``score`` per key with linear interpolation (as ``percentile``); NULLs do not count.

    Equal values are one counted row from the first aggregate on, so ties cost
    nothing; the slices holding the two neighbouring ranks are found from the
    counts, and only they are ordered by value. A key of NULLs has score NULL.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("_v"))
    rows = with_slices(v, [("_v", True)], points)
    values = rows.groupBy(*keys, "_slice", "_v").agg(F.count("_v").alias("_n"))
    starts = _starts(values, keys, "_all", F.col("_n"))
    at = (F.col("_all") - 1) * F.lit(q)
    wanted = starts.withColumn("_k0", F.floor(at)).withColumn("_k1", F.ceil(at)).where(
        (F.col("_c") > 0) & (F.col("_before") <= F.col("_k1")) & (F.col("_k0") < F.col("_before") + F.col("_c")))
    near = join_keys(values, wanted.drop("_c"), (*keys, "_slice"))
    upto = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = near.withColumn("_end", F.col("_before") + F.sum("_n").over(upto))

    def holds(rank: str) -> Column:
        return F.max(F.when((F.col(rank) < F.col("_end")) & (F.col(rank) >= F.col("_end") - F.col("_n")), F.col("_v")))

    low, high, k0, k1 = holds("_k0"), holds("_k1"), F.first("_k0"), F.first("_k1")
    pos = (F.first("_all") - 1) * F.lit(q)
    scores = ended.groupBy(*keys).agg(F.when(k0 == k1, low).otherwise((k1 - pos) * low + (pos - k0) * high).alias("score"))
    return join_keys(starts.select(*keys).distinct(), scores, keys, "left")
