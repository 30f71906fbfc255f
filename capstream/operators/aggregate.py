"""Running per-clerk purchase count (and sum).

Plain ``groupBy().agg()``: Spark plans a partial (map-side) aggregate, one
shuffle of at most one row per clerk per input partition, then the final
merge; in a stream the state store keeps one row per clerk. A hot clerk does
not skew the shuffle because only partial rows cross it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_METRICS = {
    "count": lambda c: F.count(c),
    "sum": lambda c: F.sum(c),
}


def clerk_totals(df: DataFrame, prefix: str, metrics: tuple[str, ...] = ("count",),
                 ops: tuple[str, ...] | None = None, op_col: str = "op") -> DataFrame:
    """``<p>_clerk, <p>_purchase_count[, <p>_purchase_sum]``.

    Default semantics count every change (snapshots, inserts and updates each
    add one; deletes form a NULL clerk group with count 0). ``ops`` is an
    opt-in filter on the change kind (needs an ``op`` column).
    """
    if ops is not None:
        df = df.where(F.col(op_col).isin(*ops))
    purchase = f"{prefix}_purchase"
    aggs = []
    for m in metrics:
        if m not in _METRICS:
            raise ValueError(f"unknown metric {m!r}")
        aggs.append(_METRICS[m](purchase).alias(f"{purchase}_{m}"))
    return df.groupBy(f"{prefix}_clerk").agg(*aggs)
