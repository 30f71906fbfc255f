"""Stream sinks.

Every sink that can be replayed takes a checkpoint location; writes happen on
executors (``foreachPartition`` / DataFrame writers), never through a driver
``collect``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from capstream.functions.shape import hash_rows_for
from capstream.streaming.versions import VersionedFolder

BatchFn = Callable[[DataFrame, int], None]


def trigger_kwargs(trigger: str | None) -> dict:
    """``None`` = next batch as soon as possible; ``"available_now"`` =
    drain what is there in bounded batches and stop; ``"once"``; otherwise a
    processing-time interval such as ``"30 seconds"``."""
    if trigger is None:
        return {}
    if trigger == "available_now":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def _writer(df: DataFrame, mode: str, trigger: str | None, checkpoint: str | None, name: str | None):
    w = df.writeStream.outputMode(mode)
    if trigger is not None:
        w = w.trigger(**trigger_kwargs(trigger))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w


def sink_console(df: DataFrame, mode: str = "complete", trigger: str | None = None, truncate: bool = False,
                 checkpoint: str | None = None, name: str | None = None, num_rows: int = 2**31 - 1) -> StreamingQuery:
    """Print each micro-batch (complete aggregates or appended events), all rows unless ``num_rows`` is given."""
    return (_writer(df, mode, trigger, checkpoint, name).format("console")
            .option("truncate", str(truncate).lower()).option("numRows", str(num_rows)).start())


def kafka_sink_options(topic: str, bootstrap_servers: str, extra: dict | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def sink_kafka(df: DataFrame, topic: str, bootstrap_servers: str, checkpoint: str, mode: str = "complete",
               trigger: str | None = None, name: str | None = None, options: dict | None = None) -> StreamingQuery:
    """``key``/``value`` rows to a topic; at-least-once with the checkpoint.

    ``complete`` re-publishes every key each trigger (reference behaviour);
    ``update`` publishes only keys that changed.
    """
    if not checkpoint:
        raise ValueError("checkpoint is required")
    from capstream.sources.kafka import kafka_missing, no_kafka_error
    try:
        return (_writer(df, mode, trigger, checkpoint, name).format("kafka")
                .options(**kafka_sink_options(topic, bootstrap_servers, options)).start())
    except Exception as e:  # noqa: BLE001
        if kafka_missing(e):
            raise no_kafka_error(df.sparkSession) from e
        raise


# ---------------------------------------------------------------------------
# Keyed hash store
# ---------------------------------------------------------------------------

class HashWriter:
    """Upserts ``(hash_key, fields)`` rows into a keyed store.

    ``write_batch`` runs on the driver once per micro-batch but only ships a
    function: each executor partition opens one client, writes its rows in
    pipelined chunks, and closes it.
    """

    chunk = 1000

    def client(self):  # pragma: no cover - needs a store
        raise NotImplementedError

    def partition_writer(self) -> Callable[[Iterable], None]:
        make, chunk = self.client, self.chunk

        def write(rows: Iterable) -> None:
            c = None
            pipe = None
            n = 0
            for r in rows:
                if c is None:
                    c = make()
                    pipe = c.pipeline(transaction=False)
                mapping = {k: v for k, v in (r["fields"] or {}).items() if v is not None}
                if not mapping:  # nothing to set (hset rejects an empty mapping)
                    continue
                pipe.hset(r["hash_key"], mapping=mapping)
                n += 1
                if n % chunk == 0:
                    pipe.execute()
            if pipe is not None:
                pipe.execute()
            if c is not None and hasattr(c, "close"):
                c.close()
        return write

    def write_batch(self, rows: DataFrame, epoch_id: int) -> None:
        rows.foreachPartition(self.partition_writer())


class RedisHashWriter(HashWriter):
    """Writes to a Redis server (the ``redis`` module must be on the executors)."""

    def __init__(self, host: str, port: int = 6379, db: int = 0, **kw):
        self.host, self.port, self.db, self.kw = host, port, db, kw

    def client(self):
        try:
            import redis  # noqa: PLC0415
        except ImportError as e:  # pragma: no cover
            raise RuntimeError("the redis module is not installed") from e
        return redis.Redis(host=self.host, port=self.port, db=self.db, decode_responses=True, **self.kw)


class TableHashWriter(HashWriter):
    """A keyed store kept as a table: every batch is a folder of its own (``VersionedFolder``),
    the current value of a key is its row from the newest run and epoch.

    A replayed epoch overwrites its folder; a recreated checkpoint starts a new
    run, whose values win over all earlier ones. Every ``compact_every`` batches
    the current values are written as one folder of a new run, so reads do not
    grow with the stream's age. What a compaction replaced is deleted by the next
    one: readers that have listed the folders have that long to finish.
    """

    def __init__(self, path: str, compact_every: int = 100):
        self.path, self.compact_every = path, compact_every
        self._folder = VersionedFolder(path)
        self._compacted: tuple[int, int] = (0, 0)  # the last compaction's own folder

    def write_batch(self, rows: DataFrame, epoch_id: int) -> None:
        self._folder.write(rows, epoch_id)
        if sum(v > self._compacted for v in self._folder.complete(rows.sparkSession)) >= self.compact_every:
            self.compact(rows.sparkSession)

    def compact(self, spark) -> None:
        old = self._folder.complete(spark)
        after = VersionedFolder(self.path)
        after.write(self.read(spark), 0)
        after.delete(spark, [v for v in old if v < self._compacted])
        self._compacted = (after.begin(spark), 0)
        self._folder = VersionedFolder(self.path)  # the next batch begins a run after the compacted one

    def read(self, spark) -> DataFrame:
        t = self._folder.read(spark)
        return t.groupBy("hash_key").agg(F.max_by("fields", F.struct("run", "epoch")).alias("fields"))


def sink_keyed_upsert(totals: DataFrame, writer: HashWriter, prefix: str, checkpoint: str,
                      trigger: str | None = None, mode: str = "update", null_key: str | None = None,
                      name: str | None = None) -> StreamingQuery:
    """Changed clerks of each batch -> ``<Prefix>:<clerk>`` hashes with Count/Sum."""
    if not checkpoint:
        raise ValueError("checkpoint is required (totals would restart from zero otherwise)")

    def each(batch: DataFrame, epoch_id: int) -> None:
        writer.write_batch(hash_rows_for(batch, prefix, null_key), epoch_id)

    return _writer(totals, mode, trigger, checkpoint, name).foreachBatch(each).start()


# ---------------------------------------------------------------------------
# JDBC append
# ---------------------------------------------------------------------------

def _jdbc_connection(spark, url: str, properties: dict):
    jvm = spark.sparkContext._jvm
    if properties.get("driver"):
        jvm.java.lang.Class.forName(properties["driver"])
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, props)


def jvm_execute(spark, url: str, properties: dict, sql: str, params: tuple = ()) -> None:
    """Run one statement over JDBC from the driver (DDL/DELETE only, no rows move)."""
    conn = _jdbc_connection(spark, url, properties)
    try:
        st = conn.prepareStatement(sql)
        for i, p in enumerate(params, 1):
            st.setString(i, str(p))
        st.executeUpdate()
        st.close()
    finally:
        conn.close()


def jvm_table_exists(spark, url: str, properties: dict, table: str) -> bool:
    conn = _jdbc_connection(spark, url, properties)
    try:
        meta = conn.getMetaData()
        for name in {table, table.lower(), table.upper()}:
            rs = meta.getTables(None, None, name, None)
            found = rs.next()
            rs.close()
            if found:
                return True
        return False
    finally:
        conn.close()


def checkpoint_run_id(spark, checkpoint: str) -> str:
    """The query id a checkpoint holds (its ``metadata`` file); a recreated
    checkpoint gets a new one, another spelling of the same path does not."""
    meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata")
    return meta.select(F.get_json_object("value", "$.id")).first()[0]


class JdbcAppend:
    """foreachBatch body: append each micro-batch to a table.

    ``idempotent=True`` stamps rows with a batch key, ``<run>:<epoch>``, and
    deletes that key's rows before appending where they may be there: on the
    first batch after a start and when an epoch comes again. ``run`` is the
    query's id from its checkpoint (read on the first batch): a recreated
    checkpoint restarts epochs at 0 under a new id, so earlier rows are never
    deleted. At most ``num_partitions`` connections write at once. An index on
    the batch column keeps the deletes cheap on a large table.
    """

    def __init__(self, url: str, table: str, properties: dict, idempotent: bool = False,
                 batch_col: str = "_batch_key", run: str | None = None, checkpoint: str | None = None,
                 execute: Callable | None = None, table_exists: Callable | None = None,
                 write: Callable | None = None, num_partitions: int | None = 16):
        if idempotent and not (run or checkpoint):
            raise ValueError("idempotent appends need a checkpoint (or run id): without one, runs cannot be told apart")
        self._last: int | None = None
        self.url, self.table, self.props = url, table, dict(properties)
        self.idempotent, self.batch_col, self.run, self.checkpoint = idempotent, batch_col, run, checkpoint
        self.num_partitions = num_partitions
        self._execute = execute or (lambda spark, sql, params: jvm_execute(spark, self.url, self.props, sql, params))
        self._exists = table_exists or (lambda spark: jvm_table_exists(spark, self.url, self.props, self.table))
        self._write = write or (lambda df: df.write.jdbc(self.url, self.table, mode="append",
                                                         properties=self.props))

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        if self.idempotent:
            spark = batch.sparkSession
            if self.run is None:
                self.run = checkpoint_run_id(spark, self.checkpoint)
            key = f"{self.run}:{int(epoch_id)}"
            batch = batch.withColumn(self.batch_col, F.lit(key))
            again = self._last is None or epoch_id <= self._last
            if again and self._exists(spark):  # the first batch of all creates the table
                self._execute(spark, f"DELETE FROM {self.table} WHERE {self.batch_col} = ?", (key,))
            self._last = epoch_id
        if self.num_partitions:  # bound concurrent connections, not the tasks that read and parse
            batch = batch.repartition(self.num_partitions)
        self._write(batch)


def sink_jdbc(events: DataFrame, url: str, table: str, properties: dict, checkpoint: str,
              trigger: str | None = None, idempotent: bool = False, name: str | None = None,
              **kw) -> StreamingQuery:
    """Projected events appended to a table each micro-batch."""
    if not checkpoint:
        raise ValueError("checkpoint is required (a restart would append everything again)")
    kw.setdefault("checkpoint", checkpoint)
    body = JdbcAppend(url, table, properties, idempotent=idempotent, **kw)
    return _writer(events, "append", trigger, checkpoint, name).foreachBatch(body).start()


# ---------------------------------------------------------------------------
# Table sinks (replay-safe) and fan-out
# ---------------------------------------------------------------------------

def sink_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: str | None = None,
               name: str | None = None, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append-mode file sink: exactly-once through its own commit log."""
    w = _writer(df, "append", trigger, checkpoint, name).format(fmt).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def sink_snapshot(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                  name: str | None = None, keep: int = 2) -> StreamingQuery:
    """Complete-mode result table: every batch writes the full result as a new version.

    ``read_snapshot`` gives the newest complete version, so readers never see a
    missing or half-written table; the newest ``keep`` versions stay.
    """
    folder = VersionedFolder(path)

    def each(batch: DataFrame, epoch_id: int) -> None:
        folder.write(batch, epoch_id)
        folder.delete(batch.sparkSession, folder.complete(batch.sparkSession)[:-keep])
    return _writer(df, "complete", trigger, checkpoint, name).foreachBatch(each).start()


def read_snapshot(spark, path: str) -> DataFrame:
    """The newest complete version that ``sink_snapshot`` wrote."""
    return VersionedFolder(path).newest(spark)


def append_sink(path: str, checkpoint: str | None = None) -> BatchFn:
    """A replay-safe table sink for ``fan_out``: every epoch is written to its own folder, overwriting.

    Read the rows with ``spark.read.parquet(path)``; the folders ``run`` and
    ``epoch`` are columns. With ``checkpoint`` (the query's) the run is its query id,
    so a recreated checkpoint, whose epochs begin at 0 again, overwrites nothing.
    Without it the table belongs to one checkpoint for good.
    """
    run: list[str] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        if checkpoint and not run:
            run.append(checkpoint_run_id(batch.sparkSession, checkpoint))
        top = f"{path.rstrip('/')}/run={run[0]}" if run else path.rstrip("/")
        batch.write.mode("overwrite").parquet(f"{top}/epoch={int(epoch_id)}")
    return write


def fan_out(df: DataFrame, sinks: list[BatchFn], checkpoint: str, mode: str = "append",
            trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """One query, each micro-batch computed once and handed to every sink."""
    def each(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for s in sinks:
                s(batch, epoch_id)
        finally:
            batch.unpersist()
    return _writer(df, mode, trigger, checkpoint, name).foreachBatch(each).start()
