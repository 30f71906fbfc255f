"""Streaming runs over the driver's tables (stream = batch checks).

Each run writes a source's change messages as a replay folder under the
shared folder, streams it in several micro-batches (so state really carries
across batches), drains it with ``availableNow`` and returns the sink's table
as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.parse import parse_events
from capstream.functions.shape import notification_for
from capstream.operators import changes as C
from capstream.operators import offsets as OF
from capstream.operators.aggregate import clerk_totals
from capstream.plans import standins as S
from capstream.schema import TOTAL_FIELDS
from capstream.session import remove_path, shared_path
from capstream.sources.kafka import cdc_source, write_replay
from capstream.streaming import live, sinks
from capstream.streaming.runner import progress_summary, run
from capstream.streaming.versions import VersionedFolder

MICRO_BATCHES = 4


def replay_source(spark: SparkSession, sf_dir: str, prefix: str, batches: int = MICRO_BATCHES, messages=S.source_messages):
    """Replay folder of a few files per core and micro-batch, drained in about ``batches`` batches."""
    src, name = S.SOURCES[prefix]
    msgs = messages(spark, sf_dir, prefix)
    rows = S.table(spark, sf_dir, name).count()  # parquet metadata, no scan
    files = 4 * batches * spark.sparkContext.defaultParallelism
    path = write_replay(msgs, shared_path(spark, f"replay-{prefix}"), files, rows=rows)
    return src.with_(kind="files", path=path, max_files_per_trigger=max(1, files // batches))


def drain(spark: SparkSession, queries: list, src) -> None:
    """Run the queries to the end, then delete the replay they have read."""
    run(spark, queries)
    remove_path(spark, src.path)


def stream_hash_store(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Update-mode totals -> keyed hash store; read back the current hashes."""
    src = replay_source(spark, sf_dir, prefix)
    writer = sinks.TableHashWriter(shared_path(spark, f"hash-{prefix}"))
    totals = clerk_totals(parse_events(cdc_source(spark, src), prefix, fields=TOTAL_FIELDS), prefix, ("count", "sum"))
    q = sinks.sink_keyed_upsert(totals, writer, prefix, shared_path(spark, f"ck-hash-{prefix}"),
                                trigger="available_now")
    drain(spark, [q], src)
    return writer.read(spark).select(
        "hash_key", F.col("fields")["Count"].alias("count_text"), F.col("fields")["Sum"].alias("sum_text"))


def stream_complete_counts(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """G1: complete-mode running counts; the final table equals the batch count."""
    src = replay_source(spark, sf_dir, prefix)
    out = shared_path(spark, f"totals-{prefix}")
    totals = clerk_totals(parse_events(cdc_source(spark, src), prefix, fields=TOTAL_FIELDS), prefix, ("count",))
    q = sinks.sink_snapshot(totals, out, shared_path(spark, f"ck-totals-{prefix}"), trigger="available_now")
    drain(spark, [q], src)
    return sinks.read_snapshot(spark, out)


def stream_append_events(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """G2 (file form of the dump, G10): every projected event appended once."""
    src = replay_source(spark, sf_dir, prefix)
    out = shared_path(spark, f"events-{prefix}")
    q = sinks.sink_files(parse_events(cdc_source(spark, src), prefix), out,
                         shared_path(spark, f"ck-events-{prefix}"), trigger="available_now")
    drain(spark, [q], src)
    return spark.read.parquet(out)


def stream_corrected_totals(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Corrected totals of a change feed that comes in several batches, out of log order."""
    src = replay_source(spark, sf_dir, prefix, messages=S.change_feed)
    out = shared_path(spark, f"corrected-{prefix}")
    totals = C.corrected_totals(C.signed_rows(C.parse_changes(cdc_source(spark, src))), prefix)
    drain(spark, [sinks.sink_snapshot(totals, out, shared_path(spark, f"ck-corrected-{prefix}"), trigger="available_now")], src)
    return sinks.read_snapshot(spark, out)


def stream_current_rows(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """The last image of every key: each batch's own last images are kept, the newest of them by position is read."""
    src = replay_source(spark, sf_dir, prefix, messages=S.change_feed)
    out = VersionedFolder(shared_path(spark, f"images-{prefix}"))

    def keep_last(batch: DataFrame, epoch_id: int) -> None:
        out.write(C.last_changes(batch), epoch_id)

    changes = C.parse_changes(cdc_source(spark, src))
    drain(spark, [sinks.fan_out(changes, [keep_last], shared_path(spark, f"ck-images-{prefix}"), trigger="available_now")], src)
    return C.current_rows(out.read(spark))


def stream_offset_audit(spark: SparkSession, sf_dir: str, offsets: DataFrame) -> DataFrame:
    """Ranges of every micro-batch of a replay, merged afterwards and audited."""
    rows = offsets.select(F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), "topic", "partition", "offset",
                          F.timestamp_micros(F.lit(0)).alias("timestamp"), F.lit(0).alias("timestampType"))
    files = MICRO_BATCHES * spark.sparkContext.defaultParallelism
    path = shared_path(spark, "replay-offsets")
    rows.repartition(files).write.parquet(path)  # any order: ranges of batches interleave
    src = S.SOURCES["mysql"][0].with_(kind="files", path=path, max_files_per_trigger=max(1, files // MICRO_BATCHES))
    log = VersionedFolder(shared_path(spark, "offset-ranges"))
    drain(spark, [sinks.fan_out(cdc_source(spark, src), [OF.range_log(log)], shared_path(spark, "ck-offsets"), trigger="available_now")], src)
    return OF.audit(OF.merge_ranges(log.read(spark).drop("run", "epoch")))


def _arrivals(spark: SparkSession, sf_dir: str, name: str, steps: int = 6) -> str:
    """A replay of ``events`` in order of arrival, up to a day after their time, as ``steps`` files; two more end the stream."""
    e = S.table(spark, sf_dir, "events").where("ts is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn("arrival", F.timestamp_add("HOUR", F.pmod("event_id", F.lit(5)) * 6, F.col("ts")))
    at = F.unix_micros("arrival")
    cuts = e.select(F.percentile_approx(at, F.array(*[F.lit(i / steps) for i in range(1, steps)])).alias("p"))  # scalar subquery
    path = shared_path(spark, name)
    placed = e.withColumn("cuts", cuts.scalar()).withColumn("at", at)
    placed = placed.withColumn("slot", F.size(F.filter("cuts", lambda c: c <= F.col("at")))).drop("cuts", "at", "arrival")
    for i in range(steps):  # one write each: files are taken in order of their times
        placed.where(F.col("slot") == i).drop("slot").coalesce(1).write.mode("append").parquet(path)
    for _ in range(2):  # the first moves the watermark, the second makes a batch that closes windows by it
        end = e.agg(F.timestamp_add("DAY", F.lit(30), F.max("ts")).alias("ts"))
        end.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(e.schema[c].dataType).alias(c) for c in e.columns if c != "arrival"]).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_live_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly volumes per event type of a replay whose rows come up to a day late, in append mode."""
    path, out = _arrivals(spark, sf_dir, "arrivals"), shared_path(spark, "live-volume")
    rows = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = sinks.sink_files(live.live_volume(rows, "1 hour", "2 days", ("event_type",), line="props"), out, shared_path(spark, "ck-live"), trigger="available_now")
    run(spark, [q])
    remove_path(spark, path)
    return spark.read.parquet(out).withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))


def stream_rolling_buffer(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The newest ``n`` points per event type after a replay in several micro-batches."""
    path, folder = _arrivals(spark, sf_dir, "points"), VersionedFolder(shared_path(spark, "buffer"))
    rows = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 2).parquet(path).where("event_id is not null")
    q = sinks.fan_out(rows.select("event_type", "ts", "event_id", "value"), [live.rolling_buffer(folder, ("event_type",), "ts", n, "event_id")],
                      shared_path(spark, "ck-buffer"), trigger="available_now")
    run(spark, [q])
    remove_path(spark, path)
    return folder.newest(spark).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_notifications(spark: SparkSession, sf_dir: str, prefix: str, mode: str = "update",
                         metrics: tuple[str, ...] = ("count", "sum")) -> DataFrame:
    """G6 without a broker: each micro-batch's ``(key, value)`` messages kept with their epoch.

    ``update`` publishes changed keys: the latest message per key is what a
    compacted topic holds after the stream (a NULL key is its own key, as on the
    topic). ``complete`` publishes every key each time: the newest epoch's
    messages alone are the whole answer.
    """
    src = replay_source(spark, sf_dir, prefix)
    out = VersionedFolder(shared_path(spark, f"notify-{prefix}"))
    totals = clerk_totals(parse_events(cdc_source(spark, src), prefix, fields=TOTAL_FIELDS), prefix, metrics)
    q = sinks.fan_out(notification_for(totals, prefix, metrics), [out.write],
                      shared_path(spark, f"ck-notify-{prefix}"), mode=mode, trigger="available_now")
    drain(spark, [q], src)
    if mode == "complete":
        return out.newest(spark)
    return out.read(spark).groupBy("key").agg(F.max_by("value", F.struct("run", "epoch")).alias("value"))


def stream_fan_out(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """One query feeds two sinks per micro-batch (a copy of the events into
    each of two tables); returns both tables together, so each sink is checked."""
    from capstream.streaming.runner import shared_job
    src = replay_source(spark, sf_dir, prefix)
    outs = [shared_path(spark, f"fan-{i}-{prefix}") for i in (1, 2)]

    qs = shared_job(spark, [src], shared_path(spark, f"ck-fan-{prefix}"),
                    event_sinks={prefix: [sinks.append_sink(p) for p in outs]}, total_sinks={}, trigger="available_now")
    drain(spark, qs, src)
    return spark.read.parquet(outs[0]).unionByName(spark.read.parquet(outs[1])).drop("epoch")


def measure_stream(spark: SparkSession, sf_dir: str, prefix: str = "mysql", batches: int = MICRO_BATCHES) -> dict:
    """Clerk totals through a replay stream into the keyed store; progress figures.

    The replay is written first (not timed); the timed part is the stream
    from start to drained.
    """
    import time
    src = replay_source(spark, sf_dir, prefix, batches)
    writer = sinks.TableHashWriter(shared_path(spark, f"hash-bench-{prefix}"))
    totals = clerk_totals(parse_events(cdc_source(spark, src), prefix, fields=TOTAL_FIELDS), prefix, ("count", "sum"))
    t0 = time.perf_counter()
    q = sinks.sink_keyed_upsert(totals, writer, prefix, shared_path(spark, f"ck-bench-{prefix}"),
                                trigger="available_now")
    drain(spark, [q], src)
    secs = time.perf_counter() - t0
    out = progress_summary(q)
    out["seconds"] = round(secs, 3)
    out["rows_per_s"] = round(out["input_rows"] / secs, 1) if secs else None
    out["files_per_batch"] = src.max_files_per_trigger
    return out
