"""Exact top-k by integer inner product: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz pruning.

Components are floor(scale * x). Vectors are rotated by the right singular
vectors of a bounded sample, so that a few leading coordinates hold most of
their length (any rotation gives right results; a better one prunes more). In
a block, vectors run by descending length. A chunk is left for a query when
|q||x| is under its k-th best score so far. Then the partial sums grow by
``STAGES``: after each, a pair goes when its sum so far plus the product of the
residual lengths is under that score, and the next is taken only over queries
and vectors that still have pairs. All bounds are strict, so ties survive. The
pairs left at the end are scored exactly in integers. Each query starts from its
k-th best score among the longest vectors of the whole table, found once.

Queries and vectors are dealt to blocks of bounded size; each pair of blocks is
one group of work, so no task and no broadcast grows with the table.

Defined results: an id with several different vectors has a list for each; rows with a NULL id, a NULL vector or a NULL or non-finite
component take no part; shorter vectors are filled up with zeros; rows that
repeat an id and its vector count once; fewer candidates than k give shorter
lists; scores beyond a long stop at its ends; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.llm.vectors import best_per_query, bounded_sample, classes_of, first_ids, found_table, matrix, ranked_lists, rows_of

#: Rows of a sample that fits the rotation; vectors that set the first thresholds.
ROTATION_SAMPLE, LONGEST = 8192, 2048
QUERY_BLOCK, ROW_BLOCK, CHUNK = 8192, 16384, 1024
#: Shares of the coordinates after which the partial sums are held against the bound.
STAGES = (0.25, 0.5, 0.625, 0.75, 0.875)
#: Pairs scored exactly at a time.
PAIRS = 1 << 18
RESULT = "query_id long, rank int, vec_id long, score long"


def rotation(sample: np.ndarray) -> np.ndarray:
    """Columns are the sample's right singular vectors, largest singular value first."""
    f = sample.astype(np.float64)
    return np.linalg.svd(f.T @ f)[0]  # square in the width only


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows (``q`` and ``x`` equally many): exact, ends of int64 beyond."""
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if peak < 2.0**62:
        return np.einsum("ij,ij->i", q, x)
    exact = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(q.tolist(), x.tolist())]
    return np.array([min(max(v, -2**63), 2**63 - 1) for v in exact], np.int64)


def stages_of(width: int) -> list[int]:
    """Numbers of leading coordinates, ascending, from one to less than all (all, for one coordinate)."""
    return sorted({min(max(1, round(share * width)), max(1, width - 1)) for share in STAGES})


def turned(x: np.ndarray, rot: np.ndarray, stages: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, rotated vectors, lengths of what is left after each stage)."""
    f = x.astype(np.float64)
    t = f @ rot
    tails = np.cumsum((t * t)[:, ::-1], axis=1)[:, ::-1]
    rest = np.stack([np.sqrt(tails[:, k]) if k < t.shape[1] else np.zeros(len(t)) for k in stages], 1)
    return np.sqrt((f * f).sum(1)), t, rest


class Block:
    """Vectors of one block by descending length, rotated, with their residual lengths; ``scored`` counts pairs scored exactly."""

    def __init__(self, x: np.ndarray, first: np.ndarray, rot: np.ndarray):
        self.rot, self.stages, self.scored = rot, stages_of(x.shape[1]), 0
        length, t, rest = turned(x, rot, self.stages)
        self.order = np.argsort(-length, kind="stable")
        self.x, self.first, self.length, self.turned, self.rest = (a[self.order] for a in (x, first, length, t, rest))

    def _left(self, query: np.ndarray, q: np.ndarray, q_rest: np.ndarray, least: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs of a chunk that no stage's bound excludes."""
        t, rest = self.turned[part], self.rest[part]
        queries, rows = np.arange(len(query)), np.arange(len(t))
        sums, alive, done = np.zeros((len(query), len(t))), np.ones((len(query), len(t)), bool), 0
        for k, stage in enumerate(self.stages):
            sums += q[queries, done:stage] @ t[rows, done:stage].T
            alive &= sums + np.outer(q_rest[queries, k], rest[rows, k]) >= least[queries, None]
            on_q, on_r = alive.any(1), alive.any(0)
            if not (on_q.all() and on_r.all()):
                queries, rows, sums, alive = queries[on_q], rows[on_r], sums[np.ix_(on_q, on_r)], alive[np.ix_(on_q, on_r)]
            done = stage
        a, b = np.nonzero(alive)
        return query[queries[a]], rows[b] + part.start

    def search(self, q: np.ndarray, threshold: np.ndarray, keep: int):
        """(query, row, score) of each query's ``keep`` best rows that reach its ``threshold``."""
        length, t, rest = turned(q, self.rot, self.stages)
        threshold = threshold.copy()
        got_q, got_r, got_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in range(0, len(self.x), CHUNK):
            least = threshold - (1e-9 * length * self.length[i] + 1e-9)  # rounding of the bounds
            active = np.flatnonzero(length * self.length[i] >= least)
            if not len(active):
                break  # lengths only fall
            hit_q, hit_r = self._left(active, t[active], rest[active], least[active], slice(i, i + CHUNK))
            self.scored += len(hit_q)
            found = []
            for j in range(0, len(hit_q), PAIRS):
                a, b = hit_q[j:j + PAIRS], hit_r[j:j + PAIRS]
                s = exact_scores(q[a], self.x[b])
                ok = s >= threshold[a]
                found.append((a[ok], b[ok], s[ok]))
            got_q, got_r, got_s = (np.concatenate(p) for p in zip((got_q, got_r, got_s), *found, strict=True))
            best = best_per_query(got_q, got_s, self.first[got_r], keep)
            got_q, got_r, got_s = got_q[best], got_r[best], got_s[best]
            full = np.flatnonzero(np.bincount(got_q, minlength=len(q)) >= keep)
            if len(full):
                low = np.full(len(q), np.iinfo(np.int64).max)
                np.minimum.at(low, got_q, got_s)
                threshold[full] = np.maximum(threshold[full], low[full])
        return got_q, self.order[got_r], got_s


def first_thresholds(q: np.ndarray, longest: np.ndarray, rot: np.ndarray, keep: int) -> np.ndarray:
    """Each query's ``keep``-th best score among the longest vectors (the least number, if they are too few)."""
    if len(longest) < keep:
        return np.full(len(q), np.iinfo(np.int64).min)
    tq, _, ts = Block(longest, np.zeros(len(longest), np.int64), rot).search(q, np.full(len(q), np.iinfo(np.int64).min), keep)
    threshold = np.full(len(q), np.iinfo(np.int64).max)
    np.minimum.at(threshold, tq, ts)
    return threshold


def exact_top_k(df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for every row whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows = rows_of(df, id_col, vec_col, lambda x: F.floor(x * scale).cast("long"), "long")
    classes = classes_of(rows, k + 1)
    queries = rows.where(F.col("id") % every == 0).select("id", "key").distinct()
    n = classes.count()
    if n == 0:
        return spark.createDataFrame([], RESULT)
    asked = classes.join(queries.select("key").distinct(), "key", "leftsemi")
    size = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = np.array([r.vec for r in classes.orderBy(F.desc(size), "key").limit(LONGEST).select("vec").collect()], np.int64)
    sample = np.array([r.vec for r in bounded_sample(classes, "key", n, ROTATION_SAMPLE).select("vec").collect()], np.int64)
    rot = rotation(sample if len(sample) else longest)
    n_queries = asked.count()
    q_blocks, r_blocks = max(1, -(-n_queries // QUERY_BLOCK)), -(-n // ROW_BLOCK)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = matrix(left["vec"], np.int64), matrix(right["x"], np.int64)
        key, ids = left["key"].combine_chunks(), right["ids"].combine_chunks()
        if not len(q) or not len(x):
            return found_table(key[:0], np.zeros(0, np.int64), ids[:0])
        a, b, s = Block(x, first_ids(ids), rot).search(q, left["least"].to_numpy(), k + 1)
        return found_table(key.take(pa.array(a)), s, ids.take(pa.array(b)))

    def with_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                least = first_thresholds(matrix(b.column(1), np.int64), longest, rot, k + 1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least)], names=["key", "vec", "least"])

    left = (asked.select("key", "vec").mapInArrow(with_least, "key string, vec array<long>, least long")
            .withColumn("qb", F.pmod(F.xxhash64("key"), F.lit(q_blocks)).cast("int"))
            .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1)))))
    right = (classes.select(F.col("vec").alias("x"), F.col("ids").alias("ids"), F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(r_blocks)).cast("int").alias("rb"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(cell, "query string, score long, ids array<long>")
    return ranked_lists(found, queries, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
