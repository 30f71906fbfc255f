"""Time-series reads over long-form ``(keys..., ts, value)`` frames.

Rollups are one aggregate each (partial aggregation before the shuffle, so a
hot series only ships one partial row per bucket per input partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.operators.ranking import rank_within


def bucket_start(ts: Column | str, bucket_ms: int) -> Column:
    """Start of the epoch-aligned bucket of ``bucket_ms`` milliseconds.

    ``window`` does the arithmetic (codegen, zone-independent for
    ``timestamp_ntz``, UTC-aligned for ``timestamp``) but drops rows whose
    timestamp is NULL; it is given a non-NULL stand-in of the same type
    (``coalesce(ts, ts - interval)`` is NULL too, so a fixed literal cast to
    the column's type) and the result is masked: a NULL timestamp gives a NULL
    bucket and the row is kept. Like ``window``, one bucket expression per
    projection.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    filler = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    w = F.window(F.coalesce(ts, filler), f"{int(bucket_ms)} milliseconds").getField("start")
    return F.when(ts.isNotNull(), w)


def bucket_of(df: DataFrame, ts: str, bucket_ms: int) -> Column:
    """``bucket_start`` of a column of ``df`` (kept for callers holding the frame)."""
    return bucket_start(ts, bucket_ms)


def _order(ts: str, tiebreak: str | None) -> Column:
    return F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)


def aggregator(name: str, value: str, ts: str = "ts", tiebreak: str | None = None) -> Column:
    """E1 aggregators. ``first``/``last`` pick by timestamp, ties by ``tiebreak``."""
    v = F.col(value)
    table = {
        "avg": lambda: F.avg(v),
        "count": lambda: F.count(v),
        "max": lambda: F.max(v),
        "min": lambda: F.min(v),
        "range": lambda: F.max(v) - F.min(v),
        "sum": lambda: F.sum(v),
        "first": lambda: F.min_by(v, _order(ts, tiebreak)),
        "last": lambda: F.max_by(v, _order(ts, tiebreak)),
        "std.p": lambda: F.stddev_pop(v),
        "std.s": lambda: F.stddev_samp(v),
        "var.p": lambda: F.var_pop(v),
        "var.s": lambda: F.var_samp(v),
    }
    if name not in table:
        raise ValueError(f"unknown aggregator {name!r}; one of {sorted(table)} or 'none'")
    return table[name]()


AGGREGATORS = ("avg", "count", "max", "min", "range", "sum", "first", "last", "std.p", "std.s", "var.p", "var.s")
REDUCERS = ("avg", "sum", "min", "max", "range", "count", "std.p", "std.s", "var.p", "var.s")


def bucket_rollup(df: DataFrame, ts: str, value: str, bucket_ms: int, agg: str,
                  keys: tuple[str, ...] = (), tiebreak: str | None = None,
                  start=None, end=None) -> DataFrame:
    """``keys..., bucket_start, value`` per bucket; ``agg='none'`` returns the raw samples.

    ``start``/``end`` bound the range (inclusive) and reach the scan as filters.
    """
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    if agg == "none":
        return df.select(*keys, F.col(ts).alias("bucket_start"), F.col(value).alias("value"))
    return (df.groupBy(*keys, bucket_of(df, ts, bucket_ms).alias("bucket_start"))
            .agg(aggregator(agg, value, ts, tiebreak).alias("value")))


def reduce_by_label(series: DataFrame, label: str, reducer: str, bucket_ms: int, agg: str = "avg",
                    series_col: str = "series", labels_col: str = "labels", ts: str = "ts",
                    value: str = "value", tiebreak: str | None = None) -> DataFrame:
    """Per-series buckets (E1), then one reducer across the series sharing a label value.

    NaN per-series values are left out of the reduction. Two aggregates; the
    second works on one row per series per bucket, not on raw samples.
    """
    if reducer not in REDUCERS:
        raise ValueError(f"unknown reducer {reducer!r}")
    tagged = series.select(series_col, F.col(labels_col)[label].alias("label_value"), ts, value,
                           *([tiebreak] if tiebreak else []))
    per_series = bucket_rollup(tagged.where(F.col("label_value").isNotNull()), ts, value, bucket_ms, agg,
                               keys=("label_value", series_col), tiebreak=tiebreak)
    clean = per_series.where(F.col("value").isNull() | ~F.isnan("value"))  # NaN out, NULL groups kept
    return (clean.groupBy("label_value", "bucket_start")
            .agg(aggregator(reducer, "value").alias("value"))
            .withColumnRenamed("label_value", label))


CALENDAR_CHUNK = 4096


def fill_missing(rollup: DataFrame, bucket_ms: int, keys: tuple[str, ...] = (), fill=0,
                 ts: str = "bucket_start", value: str = "value") -> DataFrame:
    """Every bucket between each key's first and last bucket; empty ones get ``fill``.

    Each bucket is asked how many empty ones follow it before the key's next
    bucket (``lead`` over the rollup, which is read once; it holds one row per
    bucket, however many samples a key has), and those are made from it in
    steps of at most ``CALENDAR_CHUNK`` elements per array. A bucket whose start
    is NULL has no place on the calendar and is left out.
    """
    step = int(bucket_ms)
    after = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))
    gap = F.coalesce((F.timestamp_diff("MILLISECOND", F.col(ts), after) / F.lit(step)).cast("bigint"), F.lit(1))
    rows = rollup.where(F.col(ts).isNotNull()).select(*keys, ts, value, gap.alias("_gap"))
    # levels of CALENDAR_CHUNK: a gap of any length is cut into pieces, each piece into buckets
    pieces = rows.withColumn("_p", F.explode(_pieces(F.col("_gap"), CALENDAR_CHUNK ** 2)))
    pieces = pieces.withColumn("_q", F.explode(F.sequence(
        F.col("_p"), F.least(F.col("_p") + CALENDAR_CHUNK ** 2, F.col("_gap")) - 1, F.lit(CALENDAR_CHUNK).cast("bigint"))))
    out = pieces.withColumn("_i", F.explode(F.sequence(F.col("_q"), F.least(
        F.col("_q") + CALENDAR_CHUNK, F.least(F.col("_p") + CALENDAR_CHUNK ** 2, F.col("_gap"))) - 1)))
    return out.select(*keys, F.timestamp_add("MILLISECOND", F.col("_i") * step, F.col(ts)).alias(ts),
                      F.when(F.col("_i") == 0, F.coalesce(F.col(value), F.lit(fill))).otherwise(F.lit(fill)).alias(value))


def _pieces(n: Column, size: int) -> Column:
    """Starts of the pieces of ``size`` that cover 0 to ``n`` - 1."""
    return F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(size).cast("bigint"))


def last_n_points(df: DataFrame, keys: tuple[str, ...], ts: str, n: int | None = None,
                  numeric: tuple[str, ...] = (), tiebreak: str | None = None) -> DataFrame:
    """The newest ``n`` rows per key (a rolling buffer; all rows by default), numeric-looking text as numbers.

    The newest rows are found by ``rank_within``: for any ``n`` a hot key is
    counted in slices and only the slices that reach into its newest ``n`` are sorted.
    """
    order = [(ts, False)] + ([(tiebreak, False)] if tiebreak else [])
    out = df if n is None else rank_within(df, keys, order, out="_rank", first=n).drop("_rank")
    for c in numeric:
        out = out.withColumn(f"{c}_num", F.col(c).try_cast("double"))
    return out


def align_series(df: DataFrame, ts: str, series: str, value: str, series_values: list,
                 agg: str = "max") -> DataFrame:
    """Long -> wide, one column per series of ``series_values``, rows are the union of timestamps.

    Same result as a chain of full outer joins on ``ts`` but in one shuffle.
    The caller names the series (they become columns, so their list is bounded
    and known when the frame is built); other series add no column.
    """
    fn = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum, "first": F.first}[agg]
    return df.groupBy(ts).pivot(series, series_values).agg(fn(value))
