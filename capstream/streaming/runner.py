"""Building the change-stream jobs and running them together.

Each job function returns started ``StreamingQuery`` objects; ``run`` waits
on all of them at once, so a failure in any query is seen immediately and the
others are stopped.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from capstream.functions.parse import parse_events
from capstream.functions.shape import notification_for
from capstream.operators.aggregate import clerk_totals
from capstream.schema import TOTAL_FIELDS
from capstream.sources.source import CdcSource
from capstream.sources.kafka import cdc_source
from capstream.streaming import sinks

# --- fixed values: what each job publishes per source ----------------------------
CONSOLE_METRICS = {"postgres": ("count",), "mysql": ("count",)}
NOTIFY_METRICS = {"postgres": ("count", "sum"), "mysql": ("count",)}
HASH_METRICS = {"postgres": ("count", "sum"), "mysql": ("count", "sum")}
NOTIFY_TOPICS = {"postgres": "notification-postgres", "mysql": "notification-mysql"}
DUMP_TABLES = {"postgres": "dumped", "mysql": "dumpedMysql"}
TRIGGER_TOTALS = "45 seconds"
TRIGGER_EVENTS = "30 seconds"
TRIGGER_STORES = "30 seconds"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep aggregation state in RocksDB (off-heap) instead of executor heap."""
    from capstream.session import ROCKSDB_PROVIDER
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


@contextmanager
def state_partitions_for(spark: SparkSession, state_partitions: int | None):
    """Queries started inside split their state into ``state_partitions`` stores.

    Streaming aggregates do not use AQE: the state is split into
    ``spark.sql.shuffle.partitions`` stores, taken when a query starts and
    fixed in its checkpoint. A job keyed by a handful of clerks wants a few,
    not the thousands a batch setting may ask for. The session's own value is
    restored afterwards; ``None`` leaves it alone.
    """
    if not state_partitions:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def events_of(spark: SparkSession, source: CdcSource) -> DataFrame:
    return parse_events(cdc_source(spark, source), source.name)


def totals_of(spark: SparkSession, source: CdcSource, metrics: tuple[str, ...]) -> DataFrame:
    events = parse_events(cdc_source(spark, source), source.name, fields=TOTAL_FIELDS)
    return clerk_totals(events, source.name, metrics)


def _ck(root: str | None, job: str, source: CdcSource) -> str | None:
    return f"{root.rstrip('/')}/{job}/{source.name}" if root else None


def console_job(spark: SparkSession, sources: list[CdcSource], checkpoint_root: str | None = None,
                trigger_totals: str | None = TRIGGER_TOTALS, trigger_events: str | None = TRIGGER_EVENTS,
                metrics: dict = CONSOLE_METRICS, state_partitions: int | None = None) -> list[StreamingQuery]:
    """Per source: running totals (complete) and each new event (append) to the console."""
    qs = []
    with state_partitions_for(spark, state_partitions):
        for s in sources:
            qs.append(sinks.sink_console(totals_of(spark, s, metrics[s.name]), "complete", trigger_totals,
                                         checkpoint=_ck(checkpoint_root, "console-totals", s)))
            qs.append(sinks.sink_console(events_of(spark, s), "append", trigger_events,
                                         checkpoint=_ck(checkpoint_root, "console-events", s)))
    return qs


def notification_job(spark: SparkSession, sources: list[CdcSource], bootstrap_servers: str, checkpoint_root: str,
                     topics: dict = NOTIFY_TOPICS, metrics: dict = NOTIFY_METRICS, mode: str = "complete",
                     trigger: str | None = None, state_partitions: int | None = None) -> list[StreamingQuery]:
    """Per source: totals as JSON notifications to a topic (complete mode by default)."""
    with state_partitions_for(spark, state_partitions):
        return [sinks.sink_kafka(notification_for(totals_of(spark, s, metrics[s.name]), s.name, metrics[s.name]),
                                 topics[s.name], bootstrap_servers, _ck(checkpoint_root, "notify", s), mode, trigger)
                for s in sources]


def hash_store_job(spark: SparkSession, sources: list[CdcSource], writer_for, checkpoint_root: str,
                   trigger: str | None = TRIGGER_STORES, null_key: str | None = None,
                   metrics: dict = HASH_METRICS, state_partitions: int | None = None) -> list[StreamingQuery]:
    """Per source: changed totals upserted as ``<Prefix>:<clerk>`` hashes (update mode)."""
    with state_partitions_for(spark, state_partitions):
        return [sinks.sink_keyed_upsert(totals_of(spark, s, metrics[s.name]), writer_for(s.name), s.name,
                                        _ck(checkpoint_root, "hash", s), trigger, null_key=null_key)
                for s in sources]


def jdbc_dump_job(spark: SparkSession, sources: list[CdcSource], url: str, properties: dict, checkpoint_root: str,
                  tables: dict = DUMP_TABLES, trigger: str | None = TRIGGER_STORES,
                  idempotent: bool = True, **kw) -> list[StreamingQuery]:
    """Per source: every projected event appended to a table."""
    return [sinks.sink_jdbc(events_of(spark, s), url, tables[s.name], properties, _ck(checkpoint_root, "jdbc", s),
                            trigger, idempotent=idempotent, **kw)
            for s in sources]


def shared_job(spark: SparkSession, sources: list[CdcSource], checkpoint_root: str,
               event_sinks: dict, total_sinks: dict, metrics: dict = HASH_METRICS,
               trigger: str | None = None, state_partitions: int | None = None) -> list[StreamingQuery]:
    """G11 fan-out: two queries per source instead of one per sink.

    ``event_sinks[name]`` / ``total_sinks[name]`` are lists of
    ``(batch_df, epoch_id)`` callables; events go out in append mode, totals in
    update mode (only changed clerks).
    """
    qs = []
    with state_partitions_for(spark, state_partitions):
        for s in sources:
            if event_sinks.get(s.name):
                qs.append(sinks.fan_out(events_of(spark, s), event_sinks[s.name],
                                        _ck(checkpoint_root, "fan-events", s), "append", trigger))
            if total_sinks.get(s.name):
                qs.append(sinks.fan_out(totals_of(spark, s, metrics[s.name]), total_sinks[s.name],
                                        _ck(checkpoint_root, "fan-totals", s), "update", trigger))
    return qs


def run(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None,
        poll_s: float = 0.5) -> None:
    """Wait on all ``queries`` together; the first failure stops the rest and is raised.

    Only these queries are watched (not every query of the session), so an
    unrelated query ending elsewhere does not end this wait.
    """
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while True:
            active = [q for q in queries if q.isActive]  # before the failure scan: no query slips between
            for q in queries:
                if not q.isActive and q.exception() is not None:
                    raise q.exception()
            if not active or (deadline is not None and time.monotonic() >= deadline):
                return
            active[0].awaitTermination(poll_s)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def progress_summary(query: StreamingQuery) -> dict:
    """Rows/s, batch durations and state size from the query's recent progress."""
    ps = [p for p in query.recentProgress if p]
    durs = sorted(p["durationMs"].get("triggerExecution", 0) for p in ps if p.get("durationMs"))
    state = [o for p in ps for o in p.get("stateOperators", [])]
    return {
        "batches": len(ps),
        "input_rows": sum(p.get("numInputRows", 0) for p in ps),
        "processed_rows_per_s": max((p.get("processedRowsPerSecond") or 0.0) for p in ps) if ps else 0.0,
        "batch_ms_p50": durs[len(durs) // 2] if durs else None,
        "batch_ms_max": durs[-1] if durs else None,
        "state_rows": state[-1].get("numRowsTotal") if state else None,
        "state_bytes": state[-1].get("memoryUsedBytes") if state else None,
    }
