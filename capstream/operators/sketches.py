"""Distinct counts and percentiles that merge: a sketch per group and step, united over any range.

A sketch is a column of bounded size: a theta sketch for distinct values (F13-F15;
its unions do not depend on how they were grouped), KLL for percentiles (F18, E1). One aggregate builds the sketches of
the finest step, combined before the shuffle; hours, days and label groups are
then unions of stored sketches and never read the samples again.

Stated errors (about 99 %): distinct counts ``distinct_error(log_k)`` of the count,
percentiles ``rank_error(k)`` of the rank; a sketch that has seen at most ``2 ** log_k``
different values, or ``k`` values, is exact. NULLs are in no sketch; a group of NULLs counts 0 and has NULL
percentiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.functions.common import quoted
from capstream.operators.timeseries import bucket_of

LOG_K, KLL_K = 12, 800


def distinct_error(log_k: int = LOG_K) -> float:
    """Relative error of a distinct count (three standard deviations)."""
    return 3 / 2 ** (log_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Error of a percentile's rank."""
    return 2.446 / k ** 0.9433


def distinct_sketches(df: DataFrame, keys: tuple[str, ...], value: str, step_ms: int | None = None, ts: str = "ts", log_k: int = LOG_K) -> DataFrame:
    """``keys[, bucket_start], sketch`` of the different values."""
    by = [quoted(k) for k in keys] + ([bucket_of(df, ts, step_ms).alias("bucket_start")] if step_ms else [])
    return df.groupBy(*by).agg(F.theta_sketch_agg(quoted(value).cast("string"), log_k).alias("sketch"))


def label_sketches(df: DataFrame, step_ms: int, labels: str = "labels", ts: str = "ts", log_k: int = LOG_K) -> DataFrame:
    """``label, bucket_start, sketch`` of every label's values per step."""
    entries = df.select(bucket_of(df, ts, step_ms).alias("bucket_start"), F.explode(labels).alias("label", "value"))
    return entries.groupBy("label", "bucket_start").agg(F.theta_sketch_agg("value", log_k).alias("sketch"))


def united(sketches: DataFrame, keys: tuple[str, ...], step_ms: int | None = None, log_k: int = LOG_K) -> DataFrame:
    """Distinct sketches of coarser groups: by ``keys`` and, with ``step_ms``, a longer step."""
    by = [quoted(k) for k in keys] + ([bucket_of(sketches, "bucket_start", step_ms).alias("bucket_start")] if step_ms else [])
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", log_k).alias("sketch"))


def distinct_counts(sketches: DataFrame, out: str = "n_values") -> DataFrame:
    """The sketches' estimates in place of the sketches."""
    return sketches.withColumn(out, F.coalesce(F.theta_sketch_estimate("sketch"), F.lit(0))).drop("sketch")


def value_sketches(df: DataFrame, keys: tuple[str, ...], value: str, step_ms: int | None = None, ts: str = "ts", k: int = KLL_K) -> DataFrame:
    """``keys[, bucket_start], sketch`` of the values' distribution."""
    by = [quoted(c) for c in keys] + ([bucket_of(df, ts, step_ms).alias("bucket_start")] if step_ms else [])
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(quoted(value).cast("double"), k).alias("sketch"))


def merged(sketches: DataFrame, keys: tuple[str, ...], step_ms: int | None = None, k: int = KLL_K) -> DataFrame:
    """Value sketches of coarser groups: by ``keys`` and, with ``step_ms``, a longer step."""
    by = [quoted(c) for c in keys] + ([bucket_of(sketches, "bucket_start", step_ms).alias("bucket_start")] if step_ms else [])
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def percentiles(sketches: DataFrame, **wanted: float) -> DataFrame:
    """One column per ``name=share`` in place of the sketches, e.g. ``p90=0.9``."""
    some = F.kll_sketch_get_n_double("sketch") > 0
    return sketches.select(*[quoted(c) for c in sketches.columns if c != "sketch"],
                           *[F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(n) for n, q in wanted.items()])
