"""Live views of a stream: volumes per event-time window, and the newest points of every series.

``live_volume`` keeps state for windows that may still get rows: the watermark
closes a window ``delay`` after the newest event seen, its row is written once
and its state goes. Rows that come later than that are dropped and counted
(``late_rows``); a micro-batch drops by the watermark of the one before it.

``rolling_buffer`` keeps the newest N points per series as a versioned table: each
micro-batch unites its own newest points with the version before, so the
table holds at most N rows per series whatever has passed, and a batch that is
repeated after a failure starts from the same version again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from capstream.functions.common import quoted
from capstream.operators.timeseries import last_n_points
from capstream.streaming.sinks import BatchFn
from capstream.streaming.versions import VersionedFolder


def live_volume(df: DataFrame, step: str, delay: str, by: tuple[str, ...] = (), ts: str = "ts", line: str | None = None) -> DataFrame:
    """F7 / F8 on a stream: ``bucket_start, by..., count[, bytes]`` per window of ``step``, in append mode.

    Durations are written like ``"1 hour"``. Rows without a time are in no window.
    On a batch the same call gives every window.
    """
    rows = df.where(quoted(ts).isNotNull())
    if df.isStreaming:
        rows = rows.withWatermark(ts, delay)
    sums = [F.count(F.lit(1)).alias("count")] + ([F.coalesce(F.sum(F.octet_length(quoted(line))), F.lit(0)).cast("bigint").alias("bytes")] if line else [])
    grouped = rows.groupBy(F.window(quoted(ts), step), *[quoted(c) for c in by]).agg(*sums)
    return grouped.select(F.col("window.start").alias("bucket_start"), *[quoted(c) for c in by], *[c for c in ("count", "bytes")[:len(sums)]])


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window had closed (groups of one micro-batch and partition count once), over the recent progress."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows kept in state after each of the recent micro-batches."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]


def rolling_buffer(folder: VersionedFolder, keys: tuple[str, ...], ts: str, n: int, tiebreak: str, ttl: str | None = None, keep: int = 2) -> BatchFn:
    """A sink for ``fan_out``: the newest ``n`` rows per key so far (E14, live), newest version in ``folder``.

    Rows are told apart by key, time and ``tiebreak``, so rows that are delivered
    again change nothing. With ``ttl`` (an interval such as ``"1 day"``) keys whose newest
    row is older than the table's newest by more than that go.
    """
    by = [*keys, ts, tiebreak]

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        run = folder.begin(spark)
        older = [v for v in folder.complete(spark) if v < (run, int(epoch_id))]
        rows = batch
        if older:
            rows = batch.unionByName(folder.read(spark, older[-1:]).drop("run", "epoch"))
        newest = last_n_points(rows.dropDuplicates(by), keys, ts, n, tiebreak=tiebreak)
        if ttl:
            top = newest.agg(F.max(quoted(ts))).scalar()
            live = newest.groupBy(*[quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(quoted(ts)).alias("_top"))
            live = live.where(F.col("_top") >= top - F.expr(f"INTERVAL {ttl}"))
            cond = [quoted(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
            newest = newest.join(live, cond, "leftsemi")
        folder.write(newest, epoch_id)
        folder.delete(spark, folder.complete(spark)[:-keep])
    return write
