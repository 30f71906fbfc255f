"""A1-A3, A5: change streams from a broker topic or from a replay folder.

A replay folder holds parquet files of Kafka-shaped rows (``KAFKA_ROW_DDL``),
so everything downstream of the source is identical for both kinds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from capstream.schema import KAFKA_ROW_DDL
from capstream.sources.source import CdcSource


def kafka_options(source: CdcSource) -> dict[str, str]:
    """Reader options for one topic. ``failOnDataLoss=false`` keeps going when
    offsets have been deleted (retention) instead of failing the query."""
    if not source.bootstrap_servers:
        raise ValueError(f"source {source.name!r}: bootstrap_servers is required for kind='kafka'")
    opts = {
        "kafka.bootstrap.servers": source.bootstrap_servers,
        "subscribe": source.topic,
        "failOnDataLoss": "true" if source.fail_on_data_loss else "false",
    }
    if source.starting_offsets:
        opts["startingOffsets"] = source.starting_offsets
    if source.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(source.max_offsets_per_trigger)
    if source.min_partitions:
        opts["minPartitions"] = str(source.min_partitions)
    opts.update({k: str(v) for k, v in source.options.items()})
    return opts


def file_options(source: CdcSource) -> dict[str, str]:
    opts = {}
    if source.max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(source.max_files_per_trigger)
    opts.update({k: str(v) for k, v in source.options.items()})
    return opts


def kafka_package(spark: SparkSession) -> str:
    """Maven coordinates of the Kafka connector matching this Spark build."""
    try:
        scala = spark.sparkContext._jvm.scala.util.Properties.versionNumberString()
        binary = ".".join(scala.split(".")[:2])
    except Exception:  # noqa: BLE001
        binary = "2.13"
    return f"org.apache.spark:spark-sql-kafka-0-10_{binary}:{spark.version}"


def kafka_missing(e: Exception) -> bool:
    text = str(e)
    return "kafka" in text.lower() and ("DATA_SOURCE_NOT_FOUND" in text or "Failed to find data source" in text)


def no_kafka_error(spark: SparkSession) -> RuntimeError:
    return RuntimeError(f"the Kafka connector is not on the class path; start Spark with "
                        f"--packages {kafka_package(spark)}")


def cdc_source(spark: SparkSession, source: CdcSource) -> DataFrame:
    """Unbounded DataFrame of Kafka-shaped rows for one captured table."""
    if source.kind == "kafka":
        try:
            return spark.readStream.format("kafka").options(**kafka_options(source)).load()
        except Exception as e:  # noqa: BLE001
            if kafka_missing(e):
                raise no_kafka_error(spark) from e
            raise
    if source.kind == "files":
        if not source.path:
            raise ValueError(f"source {source.name!r}: path is required for kind='files'")
        return spark.readStream.schema(KAFKA_ROW_DDL).options(**file_options(source)).parquet(source.path)
    raise ValueError(f"unknown source kind {source.kind!r}")


def cdc_batch(spark: SparkSession, source: CdcSource) -> DataFrame:
    """The same rows as a bounded DataFrame (replays, backfills, tests)."""
    if source.kind == "kafka":
        opts = kafka_options(source)
        opts.pop("maxOffsetsPerTrigger", None)  # streams only
        return spark.read.format("kafka").options(**opts).load()
    if source.kind == "files":
        return spark.read.schema(KAFKA_ROW_DDL).parquet(source.path)
    raise ValueError(f"unknown source kind {source.kind!r}")


def build_all(spark: SparkSession, sources: list[CdcSource]) -> dict[str, DataFrame]:
    """A3: one independent stream per source (never unioned: prefixes differ)."""
    return {s.name: cdc_source(spark, s) for s in sources}


def write_replay(messages: DataFrame, path: str, files: int = 4, rows: int | None = None) -> str:
    """Write Kafka-shaped rows as about ``files`` parquet files.

    With ``rows`` (the message count, e.g. from the source table's metadata)
    each partition is written as it is, cut into files of
    ``ceil(rows / files)`` rows: no shuffle of the message bytes. Without it
    the rows are range-partitioned on offset (one shuffle), so each file is a
    contiguous offset span like a log segment.

    Files are compressed by zstd: every message repeats its schema block, of
    which snappy leaves about a tenth.
    """
    if rows is not None:
        per_file = max(1, -(-int(rows) // max(1, files)))
        messages.write.mode("errorifexists").option("maxRecordsPerFile", per_file).option("compression", "zstd").parquet(path)
        return path
    messages.repartitionByRange(files, "offset").sortWithinPartitions("offset") \
        .write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return path
