"""Shared steps of the two vector searches.

Equal vectors meet first: a class is one distinct vector with its ``keep``
smallest ids. As many copies as can be asked for stay; further copies of a
vector have the same score and larger ids, so they can be in nobody's list.
Searches run between classes, and every row that is a query then reads its
class's list without itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.session import shared_root


def usable(col: str) -> Column:
    """A vector that is not NULL and has no NULL, NaN or infinite component."""
    fine = F.forall(F.col(col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(col).isNotNull() & F.coalesce(fine, F.lit(False))


def rows_of(df: DataFrame, id_col: str, vec_col: str, value, kind: str) -> DataFrame:
    """``id, vec, key`` of the usable rows: ``value`` of each component, shorter vectors filled up with zeros."""
    ok = df.where(usable(vec_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: value(x.cast("double"))).alias("vec"))
    width = ok.agg(F.max(F.size("vec"))).first()[0] or 0
    full = F.concat("vec", F.array_repeat(F.lit(0).cast(kind), F.lit(width) - F.size("vec")))
    # zero has one sign; 128 bits of the components' text name the vector
    return ok.select("id", F.transform(full, lambda x: x + F.lit(0).cast(kind)).alias("vec")).withColumn(
        "key", F.md5(F.array_join(F.transform("vec", lambda x: x.cast("string")), ",")))


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """``key, vec, ids``: one row per distinct vector, its ``keep`` smallest ids ascending; checkpointed."""
    shared_root(rows.sparkSession)  # names the checkpoint folder
    once = rows.groupBy("key", "id").agg(F.first("vec").alias("vec"))
    low = Window.partitionBy("key").orderBy("id")
    return (once.withColumn("n", F.row_number().over(low)).where(F.col("n") <= keep)
            .groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids")).checkpoint())


def bounded_sample(df: DataFrame, key: str, n: int, size: int) -> DataFrame:
    """About ``size`` of ``n`` rows, chosen by a hash of ``key``; at most twice as many."""
    share = min(1.0, size / max(1, n))
    return df.where(F.shiftrightunsigned(F.xxhash64(F.lit(7), key), 11) / F.lit(float(1 << 53)) < share).limit(2 * size)


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    values = flat.flatten().to_numpy(False)
    return values.reshape(n, -1).astype(kind) if n else np.zeros((0, 0), kind)


def found_table(key: pa.Array, score: np.ndarray, ids: pa.Array) -> pa.Table:
    """Rows of ``query, score, ids`` as ``ranked_lists`` takes them."""
    return pa.table({"query": key.cast(pa.string()), "score": pa.array(score), "ids": ids.cast(pa.list_(pa.field("element", pa.int64())))})


def first_ids(ids: pa.Array) -> np.ndarray:
    """The smallest id of every class (``ids`` are ascending and not empty)."""
    return ids.flatten().to_numpy(False)[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]


def best_per_query(query: np.ndarray, score: np.ndarray, first: np.ndarray, keep: int) -> np.ndarray:
    """Indices of each query's ``keep`` best by (score down, first id up), sorted by query."""
    order = np.lexsort((first, -score, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[place < keep]


def ranked_lists(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """From ``found`` (``query`` key, ``score``, ``ids`` of a class) to ``query_id, rank, vec_id, score``."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
    lists = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("query")
             .agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("down"), i.alias("id"))))).alias("all"))
             .select(F.col("query").alias("key"), F.slice(F.sort_array("all"), 1, k + 1).alias("all")))
    own = queries.join(lists, "key").select(F.col("id").alias("query_id"), F.filter("all", lambda x: x["id"] != F.col("id")).alias("all"))
    return (own.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.down")).alias("score")))
