"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` vectors) and every row is
then put into its leaf. A query walks the tree with a priority queue of nodes
by distance to their centres and visits leaves nearest first. How many leaves
a query visits is calibrated on the data: ``CALIBRATION`` sampled vectors get
their exact neighbours among all rows, and the number of visits is widened
until the wanted share of those neighbours lies in the visited leaves.

Rows meet queries per leaf. A leaf with many rows is dealt to chunks of bounded
size and its queries to blocks, so a hot leaf spreads over many tasks. Inside,
cosines are exact, in double precision, on the original vectors.

Defined results: rows with a NULL id, a NULL vector, a NULL or non-finite
component or length zero take no part; shorter vectors are filled up with
zeros; rows that repeat an id and its vector count once; fewer candidates than
k found give shorter lists, and tables of up to ``k`` + 1 distinct vectors are
searched whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.llm.vectors import (best_per_query, bounded_sample, classes_of, first_ids, found_table, matrix, ranked_lists,
                                   rows_of)

SAMPLE, CALIBRATION, LEAF, BRANCH = 16384, 256, 48, 8
ROW_CHUNK, QUERY_BLOCK = 8192, 8192
RESULT = "query_id long, rank int, vec_id long, score double"


def units(x: np.ndarray) -> np.ndarray:
    """Rows at length one (scaled by their largest component first, so that no square over- or underflows)."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * (x @ centres.T), axis=1)


class Tree:
    """Nodes with centres; inner nodes list their children, leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, seed: int = 0):
        self.children: list[np.ndarray] = []
        self.centres: list[np.ndarray] = []  # of the children
        self.leaf: list[int] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        todo = [(self._node(), sample)]
        while todo:
            node, x = todo.pop()
            parts = self._split(x, rng) if len(x) > LEAF else []
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            self.children[node] = np.array([self._node() for _ in parts])
            self.centres[node] = np.stack([p.mean(0) for p in parts])
            todo += list(zip(self.children[node].tolist(), parts, strict=True))

    def _node(self) -> int:
        self.children.append(np.zeros(0, int))
        self.centres.append(np.zeros((0, 0)))
        self.leaf.append(-1)
        return len(self.leaf) - 1

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator, rounds: int = 8) -> list[np.ndarray]:
        """k-means with k-means++ starts; empty parts go."""
        centres = [x[rng.integers(len(x))]]
        gap = ((x - centres[0]) ** 2).sum(1)
        while len(centres) < BRANCH and gap.sum() > 1e-12:
            centres.append(x[rng.choice(len(x), p=gap / gap.sum())])
            gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
        c = np.stack(centres)
        for _ in range(rounds):
            own = _nearest(x, c)
            c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
        own = _nearest(x, c)
        return [x[own == i] for i in range(len(c)) if (own == i).any()]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row: down the nearest child."""
        at = np.zeros(len(x), int)
        out = np.full(len(x), -1)
        rows = np.arange(len(x))
        while len(rows):
            inner = []
            for node in np.unique(at[rows]):
                own = rows[at[rows] == node]
                if self.leaf[node] >= 0:
                    out[own] = self.leaf[node]
                else:
                    at[own] = self.children[node][_nearest(x[own], self.centres[node])]
                    inner.append(own)
            rows = np.concatenate(inner) if inner else np.zeros(0, int)
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of one query, best bin first."""
        heap, found = [(0.0, 0)], []
        while heap and len(found) < most:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
                continue
            gap = ((self.centres[node] - q) ** 2).sum(1)
            for d, child in zip(gap.tolist(), self.children[node].tolist(), strict=True):
                heapq.heappush(heap, (d, child))
        return found


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, the same for the same two vectors wherever they stand."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: exact, and safe to square."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def block_best(q: np.ndarray, x: np.ndarray, first: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of each query's ``keep`` best rows."""
    got = []
    qu, xu, qs, xs = units(q), units(x), scaled(q), scaled(x)
    for i in range(0, len(q), 512):
        near = qu[i:i + 512] @ xu.T
        if near.shape[1] > keep:  # all within rounding of the keep-th best, then exactly
            edge = np.partition(near, near.shape[1] - keep, axis=1)[:, -keep]
            a, b = np.nonzero(near >= edge[:, None] - 1e-12)
        else:
            a, b = (v.ravel() for v in np.indices(near.shape))
        got.append((a + i, b))
    a, b = (np.concatenate(v) for v in zip(*got, strict=True))
    score = cosines(qs[a], xs[b])
    best = best_per_query(a, score, first[b], keep)
    return a[best], b[best], score[best]


def calibrate(tree: Tree, classes: DataFrame, n: int, k: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the sample's exact neighbours lie in visited leaves."""
    asked = bounded_sample(classes.withColumnRenamed("key", "name").withColumn("key", F.reverse("name")), "key", n, CALIBRATION)
    q = np.array([r.vec for r in asked.select("vec").collect()], np.float64)
    if not len(q):
        return tree.leaves

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(0))
                a, r, s = block_best(q, x, np.arange(len(x)), k + 1)
                leaf = tree.place(units(x))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(s), pa.array(leaf[r], pa.int32())], names=["q", "score", "leaf"])

    from pyspark.sql import Window
    best = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    found = (classes.select("vec").mapInArrow(exact, "q int, score double, leaf int")
             .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).collect())
    qu = units(q)
    at = [{leaf: i for i, leaf in enumerate(tree.visits(v, tree.leaves), 1)} for v in qu]
    # the query itself (cosine one, its own leaf) comes first and is not counted
    needed = sorted(at[r.q][r.leaf] for r in found if r.n > 1) or [tree.leaves]
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]


def nearest(df: DataFrame, k: int = 5, every: int = 50, recall: float = 0.96, id_col: str = "vec_id", vec_col: str = "embedding",
            seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows = rows_of(df, id_col, vec_col, lambda x: x, "double").where(F.exists("vec", lambda x: x != 0))
    classes = classes_of(rows, k + 1)
    n = classes.count()
    if n == 0:
        return spark.createDataFrame([], RESULT)
    queries = rows.where(F.col("id") % every == 0).select("id", "key").distinct()
    sample = np.array([r.vec for r in bounded_sample(classes, "key", n, SAMPLE).select("vec").collect()], np.float64)
    tree = Tree(units(sample) if len(sample) else np.zeros((0, 0)), seed)
    most = tree.leaves if n <= k + 1 else calibrate(tree, classes, n, k, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.place(units(matrix(b.column(1)))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], names=["key", "x", "ids", "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = [tree.visits(v, most) for v in units(matrix(b.column(1)))]
                row = pa.array(np.repeat(np.arange(b.num_rows), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array([x for f in found for x in f], pa.int32())],
                                                 names=["key", "vec", "leaf"])

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        key, ids = left["key"].combine_chunks(), right["ids"].combine_chunks()
        if not left.num_rows or not right.num_rows:
            return found_table(key[:0], np.zeros(0), ids[:0])
        a, b, s = block_best(matrix(left["vec"]), matrix(right["x"]), first_ids(ids), k + 1)
        return found_table(key.take(pa.array(a)), s, ids.take(pa.array(b)))

    placed = classes.select("key", F.col("vec").alias("x"), F.col("ids").alias("ids")).mapInArrow(
        place, "key string, x array<double>, ids array<long>, leaf int").checkpoint()
    asked = classes.join(queries.select("key").distinct(), "key", "leftsemi")
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / ROW_CHUNK).cast("int").alias("chunks"))  # a row per leaf
    left = (asked.select(F.col("key").alias("key"), F.col("vec").alias("vec"))
            .mapInArrow(visit, "key string, vec array<double>, leaf int").join(F.broadcast(sizes), "leaf")
            .select("leaf", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                    F.pmod(F.xxhash64("key"), F.lit(q_blocks)).cast("int").alias("block"), "key", "vec"))
    right = (placed.join(F.broadcast(sizes), "leaf")
             .select("leaf", F.pmod(F.xxhash64("key"), F.col("chunks").cast("long")).cast("int").alias("chunk"),
                     F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("block"), "x", "ids"))
    found = (left.groupBy("leaf", "chunk", "block").cogroup(right.groupBy("leaf", "chunk", "block"))
             .applyInArrow(cell, "query string, score double, ids array<long>"))
    return ranked_lists(found, queries, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
