"""Panel transformations on result frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Keep only the named fields, in the given order."""
    return df.select(*fields)


def organize(df: DataFrame, exclude: list[str] | None = None, rename: dict[str, str] | None = None,
             order: list[str] | None = None) -> DataFrame:
    """Drop fields, rename fields, then optionally reorder (by new names)."""
    if exclude:
        df = df.drop(*exclude)
    if rename:
        df = df.withColumnsRenamed(rename)
    if order:
        rest = [c for c in df.columns if c not in order]
        df = df.select(*order, *rest)
    return df


def panel_calc(df: DataFrame, calc: str, value: str, ts: str | None = None,
               keys: tuple[str, ...] = (), tiebreak: str | None = None) -> DataFrame:
    """Reduce a field to one number per key: ``mean``, ``lastNotNull``, ``last``,
    ``firstNotNull``, ``first``, ``min``, ``max``, ``sum``, ``count``.

    first/last follow ``ts`` (ties by ``tiebreak``), never input order. A key
    whose values are all NULL keeps its row.
    """
    v = F.col(value)
    order = F.struct(F.col(ts), F.col(tiebreak)) if (ts and tiebreak) else (F.col(ts) if ts else None)
    if calc in ("last", "first", "lastNotNull", "firstNotNull") and order is None:
        raise ValueError(f"{calc} needs a timestamp column")
    known = F.when(v.isNotNull(), order) if calc.endswith("NotNull") else None  # rows without an order do not count
    fns = {
        "mean": lambda: F.avg(v),
        "min": lambda: F.min(v),
        "max": lambda: F.max(v),
        "sum": lambda: F.sum(v),
        "count": lambda: F.count(v),
        "last": lambda: F.max_by(v, order),
        "lastNotNull": lambda: F.max_by(v, known),
        "first": lambda: F.min_by(v, order),
        "firstNotNull": lambda: F.min_by(v, known),
    }
    if calc not in fns:
        raise ValueError(f"unknown calc {calc!r}")
    return df.groupBy(*keys).agg(fns[calc]().alias(calc))
