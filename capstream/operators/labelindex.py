"""E5 by an index: which series match, as bitmaps over dense series numbers.

Series are numbered from 0 in order of their name. For each (label, value) the
numbers of the series that carry it are a bitmap, kept as rows of 64-bit words
(only words with a bit set are there); one more bitmap holds all series. A
selection reads the words of its labels and combines them per word: OR over the
values a matcher accepts, AND over matchers, AND NOT for negated ones. So a
matcher costs a bit per series, spread over tasks by word number, and nothing
but the matching series' samples is read afterwards (``read_samples``).

Matchers are (label, op, text) with the ops ``=``, ``!=``, ``=~`` and ``!~``; regular
expressions match whole values. A series without the label matches the negated ops only.
A NULL name is a series like any other; a NULL or empty label map has no labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.common import join_keys, quoted
from capstream.operators.ranking import rank_within

#: Series whose samples share a folder.
SERIES_PER_PART = 1024
Matcher = tuple[str, str, str]


def _accepts(value: Column, op: str, text: str) -> Column:
    if op not in ("=", "!=", "=~", "!~"):
        raise ValueError(f"unknown matcher {op!r}")
    return value.rlike(rf"\A(?:{text})\z") if "~" in op else value == F.lit(text)


def matches(labels: Column, matchers: list[Matcher]) -> Column:
    """Whether a label map matches, row by row."""
    def one(m: Matcher) -> Column:
        hit = F.coalesce(_accepts(labels[m[0]], m[1], m[2]), F.lit(False))
        return ~hit if m[1].startswith("!") else hit
    return reduce(lambda a, b: a & b, map(one, matchers), F.lit(True))


def build_label_index(df: DataFrame, path: str, series: str = "series", labels: str = "labels") -> str:
    """Write the index of the series of ``df`` under ``path`` and return the path.

    ``series`` holds ``series_no``, name and labels; ``words`` holds
    ``label, value, word, bits`` (label NULL: all series), sorted by label.
    """
    path = path.rstrip("/")
    names = df.groupBy(quoted(series).alias("series")).agg(F.any_value(quoted(labels), True).alias("labels"))
    rank_within(names, (), [("series", True)], out="series_no").write.parquet(f"{path}/series")
    numbered = df.sparkSession.read.parquet(f"{path}/series")
    entries = F.array_union(F.coalesce(F.map_entries("labels"), F.array()), F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("series_no", F.lit(64)).cast("int"))
    words = (numbered.select("series_no", F.explode(entries).alias("e"))
             .groupBy(F.col("e.key").alias("label"), F.col("e.value").alias("value"), F.floor(F.col("series_no") / 64).alias("word"))
             .agg(F.bit_or(bit).alias("bits")).where("label is null or value is not null"))
    words.repartitionByRange("label", "value", "word").sortWithinPartitions("label", "value", "word").write.parquet(f"{path}/words")
    return path


class LabelIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self, matchers: list[Matcher]) -> DataFrame:
        """``series_no`` of the matching series."""
        label, used = F.col("label"), list(dict.fromkeys(m[0] for m in matchers))
        words = self.spark.read.parquet(f"{self.path}/words").where(label.isNull() | label.isin(used))
        hits = [F.coalesce(F.bit_or(F.when((label == m[0]) & _accepts(F.col("value"), m[1], m[2]), F.col("bits"))), F.lit(0).cast("bigint")) for m in matchers]
        by_word = words.groupBy("word").agg(F.bit_or(F.when(label.isNull(), F.col("bits"))).alias("all"), *[h.alias(f"m{i}") for i, h in enumerate(hits)])
        bits = reduce(lambda a, i: a.bitwiseAND(F.bitwise_not(f"m{i}") if matchers[i][1].startswith("!") else F.col(f"m{i}")),
                      range(len(matchers)), F.col("all"))
        held = by_word.select("word", bits.alias("bits")).where("bits <> 0")
        return held.select("word", F.explode(F.expr("filter(sequence(0, 63), b -> getbit(bits, b) = 1)")).alias("b")).select(
            (F.col("word") * 64 + F.col("b")).alias("series_no"))

    def series(self, matchers: list[Matcher]) -> DataFrame:
        """``series_no``, name and labels of the matching series."""
        return self.spark.read.parquet(f"{self.path}/series").join(self.numbers(matchers), "series_no", "leftsemi")

    def write_samples(self, df: DataFrame, path: str, series: str = "series", order: tuple[str, ...] = ("ts",)) -> None:
        """Samples by series number: a folder per ``SERIES_PER_PART`` series, sorted inside."""
        numbered = join_keys(df, self.spark.read.parquet(f"{self.path}/series").select(F.col("series").alias(series), "series_no"), (series,))
        part = F.floor(F.col("series_no") / SERIES_PER_PART).cast("int")
        (numbered.withColumn("part", part).repartition("part", F.pmod("series_no", F.lit(SERIES_PER_PART)))
         .sortWithinPartitions("part", "series_no", *order).write.partitionBy("part").parquet(path))

    def read_samples(self, path: str, matchers: list[Matcher]) -> DataFrame:
        """The samples of the matching series; folders without any are not read when their list is small enough to be sent round."""
        chosen = self.numbers(matchers).withColumn("part", F.floor(F.col("series_no") / SERIES_PER_PART).cast("int"))
        return self.spark.read.parquet(path).join(chosen, ["part", "series_no"]).drop("part")
