"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Each source's rows are shuffled by a seeded hash and ranked; a row's fractional
rank is (rank + phase) / rows of the source, with a seeded phase per source, so
sorting all rows by it spreads every source evenly over the whole order. The
order is cut into equal runs: every shard holds the sources in the corpus's own
proportions (to within a few rows), and shard sizes differ by one row at most.

Defined results: a NULL source is a stratum of its own; NULL and empty texts
are ordinary rows; repeated ids and repeated rows are each placed once (rows
equal in every carried column are interchangeable); an empty table gives an
empty result; columns of the input named ``shard`` or ``slot`` (in any case) are replaced,
names starting with ``_`` are reserved for the operator and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.functions.common import quoted
from capstream.llm.ranks import BUCKETS, seeded, text_key, with_group_ranks


def interleave_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", source_col: str = "source",
                      seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (from 0, no gaps).

    Every carried column moves through the shuffles: carry digests or ids here
    and join wide payloads afterwards, or use ``write_shards``.
    """
    carried = [c for c in df.columns if c.lower() not in ("shard", "slot") and not c.startswith("_")]
    tie = F.xxhash64(F.lit(0), *[quoted(c) for c, kind in df.dtypes if c in carried and "map<" not in kind and kind != "variant"])
    # rows without an id are shuffled by all they hold
    name = F.when(F.col(id_col).isNull(), F.concat(F.lit("n"), tie.cast("string"))).otherwise(text_key(id_col))
    rows = df.select(*map(quoted, carried), text_key(source_col).alias("_source"), seeded(seed, name).alias("_h"), tie.alias("_tie"))
    order = [F.col("_u"), F.col("_h"), F.col("_tie")]
    rows = rows.withColumn("_u", F.col("_h") / F.lit(float(1 << 60)))
    ranked = with_group_ranks(rows, ["_source"], F.col("_u"), order, "_rank", "_rows", buckets)
    phase = seeded(seed, F.concat(F.lit("phase:"), F.col("_source"))) / F.lit(float(1 << 60))
    spread = ranked.withColumn("_f", (F.col("_rank") + phase) / F.col("_rows"))
    placed = with_group_ranks(spread, [], F.col("_f"), [F.col("_f"), F.col("_source"), F.col("_h"), F.col("_tie")],
                              "_at", "_all", buckets)
    return (placed.withColumn("shard", F.expr(f"cast((_at * {n_shards}) div _all as int)"))
            .withColumn("slot", F.expr(f"_at - ((shard * _all + {n_shards} - 1) div {n_shards})"))
            .select(*map(quoted, carried), "shard", "slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write rows with ``shard`` and ``slot`` as Parquet under ``path``, one folder per shard, in slot order."""
    (assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
