"""G10, exactly once: rows go to a staging table first, one statement publishes them.

Deleting a batch's rows before appending it again cannot see that a task wrote
its rows twice (its commit was reported lost, so Spark ran it again), nor can it
keep readers from half a batch. Here a micro-batch fills a staging table of its
own; every row carries an identity; and one INSERT ... SELECT DISTINCT moves
the batch to the target unless its key is there already. The database runs that
statement as a whole, so whenever the driver dies, before or after it, the
repeated epoch publishes exactly once.

The identity is the rows' own position columns (``identity``, e.g. topic, partition and
offset), or else the row's place in its input partition, which the source reads again in
the same order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from capstream.functions.common import quoted
from capstream.streaming.sinks import _writer, checkpoint_run_id, jvm_execute, jvm_table_exists

ROW, BATCH = "_row", "_batch_key"


class JdbcPublish:
    """foreachBatch body: each micro-batch in the target once, whole.

    The target has the batch's columns and ``_batch_key`` (``<run>:<epoch>``, the run being
    the checkpoint's query id); an index on that column keeps the check cheap. At most
    ``num_partitions`` connections write to the staging table at once.
    """

    def __init__(self, url: str, table: str, properties: dict, run: str | None = None, checkpoint: str | None = None,
                 identity: tuple[str, ...] = (), num_partitions: int = 16, execute: Callable | None = None,
                 table_exists: Callable | None = None, write: Callable | None = None):
        if not (run or checkpoint):
            raise ValueError("a checkpoint (or run id) is needed: without one, runs cannot be told apart")
        self.url, self.table, self.props, self.run, self.checkpoint = url, table, dict(properties), run, checkpoint
        self.identity, self.num_partitions = identity, num_partitions
        self._execute = execute or (lambda spark, sql, params: jvm_execute(spark, self.url, self.props, sql, params))
        self._exists = table_exists or (lambda spark, name: jvm_table_exists(spark, self.url, self.props, name))
        self._write = write or (lambda df, name, mode: df.write.jdbc(self.url, name, mode=mode, properties=self.props))

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if self.run is None:
            self.run = checkpoint_run_id(spark, self.checkpoint)
        key, columns = f"{self.run}:{int(epoch_id)}", [c for c in batch.columns if c not in self.identity]
        staging = f"{self.table}_staging"
        if not self._exists(spark, self.table):
            self._write(batch.select(*map(quoted, columns)).withColumn(BATCH, F.lit(key)).limit(0), self.table, "append")
        row = F.concat_ws(":", *[quoted(c).cast("string") for c in self.identity]) if self.identity else F.monotonically_increasing_id().cast("string")
        rows = batch.withColumn(ROW, row).select(*map(quoted, columns), ROW)
        # the rows are read and parsed as the source is partitioned, then dealt to the connections
        self._write(rows.repartition(self.num_partitions, ROW), staging, "overwrite")
        listed = ", ".join(f'"{c}"' for c in columns)
        self._execute(spark, f'INSERT INTO {self.table} ({listed}, "{BATCH}") SELECT {listed}, ? FROM (SELECT DISTINCT {listed}, "{ROW}" FROM {staging}) s '
                             f'WHERE NOT EXISTS (SELECT 1 FROM {self.table} WHERE "{BATCH}" = ?)', (key, key))
        self._execute(spark, f"DROP TABLE {staging}", ())


def sink_jdbc_once(events: DataFrame, url: str, table: str, properties: dict, checkpoint: str, trigger: str | None = None,
                   name: str | None = None, **kw) -> StreamingQuery:
    """Projected events in a table, every micro-batch published once and whole."""
    if not checkpoint:
        raise ValueError("checkpoint is required (a restart would append everything again)")
    return _writer(events, "append", trigger, checkpoint, name).foreachBatch(JdbcPublish(url, table, properties, checkpoint=checkpoint, **kw)).start()
