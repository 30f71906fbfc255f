"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. A
differing bit changes one count by at most one, so the Manhattan distance of
two count vectors is never above the Hamming distance of the fingerprints: it
is a lower bound to join on, and the exact distance is checked afterwards.

The range join runs on a grid over the count vectors. Its dimensions are dealt
to ``SLABS`` slabs; counts are integers, so two vectors within Manhattan
distance r differ in at most r slabs and share the cell of at least one choice
of SLABS - r slabs. Each distinct fingerprint goes to the cell of every such
choice, and only fingerprints in one cell are compared (a grid of few dense
dimensions would put a fixed share of all rows near each other and grow with
the square of the input).

Copies meet first: equal fingerprints are one row. Inside a cell the links
are found by growing components, so a dense cell costs its size times the few
rows not yet reached, and a cell of m rows gives at most m - 1 links, each to the
first row of a component. No pair list is ever made.

Defined results: NULL and empty texts have fingerprint zero and link like any
other; fewer words than the shingle length form one shingle; a NULL id is a
document but never a component's name (a component of NULL ids has NULL);
repeated ids are separate documents; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions.common import quoted
from capstream.llm.components import components
from capstream.session import shared_root

SEGMENTS, SLABS = 32, 8
LOW = 0x5555555555555555
#: Cells up to this size compare all their rows at once; larger ones grow components.
SMALL_CELL = 64


def fingerprint(text: bytes, words: int, at_once: int = 1 << 16) -> int:
    """Majority bits of the XXH64 (seed 42) of all shingles of ``words`` words of the lower-cased text."""
    from xxhash import xxh64_intdigest
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    length = np.fromiter(map(len, w), np.int64, len(w))
    stop = np.cumsum(length + 1) - 1
    start = stop - length
    if len(w) > words:
        start, stop = start[:len(w) - words + 1], stop[words - 1:]
    else:
        start, stop = start[:1], stop[-1:]
    ones, n = np.zeros(64, np.int64), len(start)
    for i in range(0, n, at_once):
        h = np.fromiter([xxh64_intdigest(joined[a:b], 42) for a, b in zip(start[i:i + at_once].tolist(), stop[i:i + at_once].tolist())],
                        np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of 255 bits still fit a byte
            ones += bits[k:k + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, kind: str = "long") -> DataFrame:
    """``id`` (of type ``kind``) and ``fp`` (the fingerprint's 64 bits as a signed long) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return df.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, fp long")


def segment_counts(fp: Column) -> Column:
    """The 32 bit counts (0, 1 or 2), two bits each in one long."""
    a, b = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))  # a + b without a signed overflow


def _slab_mask(slabs: tuple[int, ...]) -> int:
    width = 64 // SLABS
    mask = sum(((1 << width) - 1) << (width * s) for s in slabs)
    return mask - (1 << 64) if mask >> 63 else mask


def manhattan(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of packed count vectors: per segment |x - y| in {0, 1, 2}."""
    low = np.uint64(LOW)
    a1, a0, b1, b0 = x >> np.uint64(1) & low, x & low, y >> np.uint64(1) & low, y & low
    # counts as (1, 0) bits: they differ by 2 only for 0 against 2
    two = (a1 ^ b1) & ~(a0 | b0)
    one = (a0 ^ b0) & low
    return np.bitwise_count(one) + 2 * np.bitwise_count(two & low)


def _near(x: np.ndarray, cx: np.ndarray, y, cy, distance: int) -> np.ndarray:
    """Lower bound first, then the exact Hamming distance of those that pass."""
    ok = manhattan(cx, cy) <= distance
    ok[ok] = np.bitwise_count((x ^ y)[ok] if np.ndim(y) == 0 else x[ok] ^ y[ok]) <= distance
    return ok


def _counts(fp: np.ndarray) -> np.ndarray:
    low = np.uint64(LOW)
    return (fp & low) + (fp >> np.uint64(1) & low)


def cell_links(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) that keep the components of one cell: each row found from a reached row."""
    counts = _counts(fp)
    left, a, b = np.arange(len(fp)), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            hit = _near(fp[left], counts[left], fp[i], counts[i], distance)
            if hit.any():
                found = left[hit]
                a.append(np.full(len(found), i))
                b.append(found)
                front.extend(found)
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _roots(choice: np.ndarray, cell: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, first fingerprint of its component in the cell) where they differ; rows sorted by (choice, cell, fp)."""
    new = np.flatnonzero(np.concatenate([[True], (choice[1:] != choice[:-1]) | (cell[1:] != cell[:-1])]))
    size = np.diff(np.append(new, len(fp)))
    a, b = [], []
    group = np.repeat(np.arange(len(new)), size)
    rows = np.flatnonzero((size > 1)[group] & (size <= SMALL_CELL)[group])
    counts = _counts(fp)
    for step in range(1, SMALL_CELL):  # rows ``step`` apart in one cell
        rows = rows[rows + step < len(fp)]
        rows = rows[group[rows] == group[np.minimum(rows + step, len(fp) - 1)]]
        if not len(rows):
            break
        ok = _near(fp[rows], counts[rows], fp[rows + step], counts[rows + step], distance)
        a.append(rows[ok])
        b.append(rows[ok] + step)
    for g in np.flatnonzero(size > SMALL_CELL):
        i, j = cell_links(fp[new[g]:new[g] + size[g]], distance)
        a.append(new[g] + i)
        b.append(new[g] + j)
    root = np.arange(len(fp))
    if a:
        i, j = np.concatenate(a), np.concatenate(b)
        while True:
            low = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = root[root]
            if (root == before).all():
                break
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that keep all components at ``distance`` bits.

    Memory of a task: a batch and the largest cell (8 bytes a distinct fingerprint).
    """
    if not 0 < distance < SLABS:
        raise ValueError(f"distance must be from 1 to {SLABS - 1}")
    choices = list(combinations(range(SLABS), SLABS - distance))
    counts = segment_counts(F.col("fp"))
    cells = F.array(*[F.struct(F.lit(i).cast("short").alias("choice"), counts.bitwiseAND(F.lit(_slab_mask(c))).alias("cell"))
                      for i, c in enumerate(choices)])
    # dealt out anew by a stated number (by another hash, or the planner would keep the few large partitions of ``distinct``),
    # as each small row becomes many
    dealt = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    placed = dealt.select("fp", F.explode(cells).alias("at")).select("at.choice", "at.cell", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            x = [batch.column(0).to_numpy(False), batch.column(1).to_numpy(False), batch.column(2).to_numpy(False).view(np.uint64)]
            if held is not None:
                x = [np.concatenate(p) for p in zip(held, x, strict=True)]
            # the last cell may go on in the next batch
            same = (x[0] == x[0][-1]) & (x[1] == x[1][-1]) if len(x[0]) else np.zeros(0, bool)
            cut = int(np.argmax(same)) if len(same) else 0
            held = [c[cut:] for c in x]
            if cut:
                yield _as_batch(*_roots(*[c[:cut] for c in x], distance))
        if held is not None and len(held[0]):
            yield _as_batch(*_roots(*held, distance))

    # a fingerprint has a root in each of its cells at most: link it to the least of them, and the others to that one
    near = (placed.repartition("choice", "cell").sortWithinPartitions("choice", "cell", "fp")
            .mapInArrow(run, "fp long, root long").groupBy("fp").agg(F.collect_set("root").alias("roots"))
            .select("fp", "roots", F.array_min("roots").alias("least")))
    return (near.select(F.explode(F.transform(F.array_append("roots", F.col("fp")), lambda r: F.struct(r.alias("a"), F.col("least").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())


def _as_batch(fp: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(root.view(np.int64))], names=["fp", "root"])


def groups(docs: DataFrame, distance: int = 4) -> DataFrame:
    """``fp, label`` of every fingerprint in ``docs`` (column ``fp``); ``label`` is the same within a component."""
    distinct = docs.select("fp").distinct()
    label = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    return distinct.join(label, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` (smallest id linked, directly or not) of every document."""
    shared_root(df.sparkSession)  # names the checkpoint folder
    docs = fingerprints(df, id_col, text_col, words).checkpoint()
    named = groups(docs, distance).join(docs.groupBy("fp").agg(F.min("id").alias("first")), "fp")
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_fp = named.join(lowest, "label").select("fp", "component_id")
    return docs.join(by_fp, "fp").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """``df`` with one document of each group: the smallest id (NULL last), then the smallest hash of the text."""
    shared_root(df.sparkSession)
    keyed = df.withColumn("_cap_row", F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("h")))
    docs = fingerprints(keyed, "_cap_row", text_col, words, "struct<n:boolean,i:bigint,h:bigint>").checkpoint()
    kept = (docs.join(groups(docs, distance), "fp").groupBy("label").agg(F.min("id").alias("row"))
            .select(row_key(F.col("row.i"), F.col("row.h")).alias("_cap_key")))
    return one_row(df.withColumn("_cap_key", row_key(F.col(id_col).cast("long"), F.xxhash64(text_col))).join(kept, "_cap_key", "leftsemi"), "_cap_key").drop("_cap_key")


def row_key(id_: Column, *parts: Column) -> Column:
    """Names a document by its id and more (text hash, source); never NULL."""
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), *parts)


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's columns (maps and variants left out)."""
    return F.xxhash64(F.lit(0), *[quoted(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def one_row(df: DataFrame, key: str) -> DataFrame:
    """One row of each ``key``, the one with the smallest hash (rows that repeat id and text)."""
    first = Window.partitionBy(key).orderBy("_cap_hash")
    return df.withColumn("_cap_hash", row_hash(df)).withColumn("_cap_n", F.row_number().over(first)).where("_cap_n = 1").drop("_cap_n", "_cap_hash")
