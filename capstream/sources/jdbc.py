"""Parallel snapshot read of a source table over JDBC.

The id range is split into ``num_partitions`` strides, one query per
partition, so the table is read by many executors at once. Without explicit
bounds they are fetched with one small ``min/max`` query pushed to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def id_bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict) -> tuple[int, int]:
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, q, properties=properties).select(
        F.col("lo").cast("bigint"), F.col("hi").cast("bigint")).first()
    lo, hi = (row[0], row[1]) if row else (None, None)
    return (0, 0) if lo is None else (int(lo), int(hi))


def jdbc_snapshot(spark: SparkSession, url: str, table: str, properties: dict, *,
                  partition_column: str = "id", num_partitions: int = 64,
                  lower_bound: int | None = None, upper_bound: int | None = None,
                  fetch_size: int = 10000) -> DataFrame:
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if lower_bound is None or upper_bound is None:
        lower_bound, upper_bound = id_bounds(spark, url, table, partition_column, props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=max(upper_bound, lower_bound + 1),
                           numPartitions=num_partitions, properties=props)
