"""Text quality by a generalised additive model with pairwise interactions.

Every text becomes a few shape measures (never its language, source, id or a
label). The model is a sum of lookup tables, one per measure over its quantile
bins and one per chosen pair of measures over coarser bins. Tables are learned
by cyclic boosting: measure after measure, a shallow tree is fitted to the
gradients summed per bin and a small step of it is added to the table. Pairs
are chosen by how much of the remaining gradient a four-leaf tree explains, and
boosted the same way. Scoring adds one table entry per measure and pair.

Defined results: NULL text is empty, and an empty text is scored like any other
by its measures; NULL and repeated ids are ordinary rows; labels that are NULL
or neither 0 nor 1, and labels without a document, are not learned from; if
only one class was seen the score is that class's smoothed share; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstream.llm.textvec import hashes, slices, words
from capstream.llm.vectors import bounded_sample

#: Labelled rows to learn from: about this many, at most twice as many.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
MEASURES = ("chars", "words", "word_length", "upper", "digits", "punctuation", "symbols", "bars", "exclaim", "stops", "high_bytes",
            "lines", "long_words", "short_words", "symbol_ends", "upper_words", "repeated_words", "repeated_lines", "commas", "digit_words")


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


UPPER, DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
LETTER = UPPER | _class("abcdefghijklmnopqrstuvwxyz")
PUNCTUATION = _class("".join(map(chr, range(33, 127)))) & ~LETTER & ~DIGIT
SYMBOL = PUNCTUATION & ~_class(".,;:!?'\"-()|")


def _repeats(hashed: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Share of each row's items that repeat an earlier one."""
    count = np.bincount(row, minlength=rows)
    keys = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashed >> np.uint64(20)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    kinds = np.bincount((keys[first] >> np.uint64(44)).astype(np.int64), minlength=rows)
    return 1 - kinds / np.maximum(count, 1) * (count > 0) - (count == 0)


def measure(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``MEASURES`` of each row of a slice of texts."""
    rows = len(starts) - 1
    # how often each byte value occurs in each row: all class counts are sums of its columns
    seen = np.bincount(np.repeat(np.arange(rows) << 8, np.diff(starts)) + data, minlength=rows << 8).reshape(rows, 256)
    sums = lambda table: seen[:, table].sum(1)
    size = np.maximum(np.diff(starts), 1)
    begin, end, row = words(data, starts)
    count = np.bincount(row, minlength=rows)
    each = np.maximum(count, 1)
    length = end - begin
    share = lambda mask: np.bincount(row[mask], minlength=rows) / each
    newline = np.flatnonzero(data == 10)
    line_begin = np.sort(np.concatenate([starts[:-1][np.diff(starts) > 0], newline + 1]))
    line_begin = np.unique(line_begin[line_begin < len(data)])
    line_end = np.append(line_begin[1:], len(data)) if len(line_begin) else line_begin
    line_row = np.searchsorted(starts, line_begin, "right") - 1
    chars = size - seen[:, 0x80:0xC0].sum(1)
    high = np.zeros(256, bool)
    high[0xC0:] = True
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    first = data[begin] if len(begin) else np.zeros(0, np.uint8)
    all_upper = UPPER[first] & UPPER[data[np.maximum(begin, end - 1 - PUNCTUATION[last])]] & (length > 1) if len(begin) else np.zeros(0, bool)
    digits_in = np.zeros(0, bool)
    if len(begin):
        total = np.concatenate([[0], np.cumsum(DIGIT[data])])
        digits_in = total[end] > total[begin]
    columns = [np.log1p(chars * (np.diff(starts) > 0)), np.log1p(count), np.bincount(row, length, rows) / each,
               sums(UPPER) / np.maximum(sums(LETTER), 1), sums(DIGIT) / size, sums(PUNCTUATION) / size, sums(SYMBOL) / size,
               sums(_class("|")) / each, sums(_class("!")) / each, sums(_class(".")) / each, sums(high) / size,
               np.bincount(line_row, minlength=rows) / each, share(length > 14), share(length < 3),
               share(SYMBOL[last]), share(all_upper), _repeats(hashes(data, begin, end), row, rows),
               _repeats(hashes(data, line_begin, line_end), line_row, rows), sums(_class(",")) / each, share(digits_in)]
    return np.stack([np.asarray(c, np.float32) for c in columns], 1)


def measures(df: DataFrame, keep: list[str], text_col: str = "text", schema: str = "doc_id long") -> DataFrame:
    """``keep`` columns (typed by ``schema``) and ``x``, the measures of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [measure(data, starts) for _, _, data, starts in slices(b.column(len(keep)))]
            flat = np.concatenate(x).ravel() if x else np.zeros(0, np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(MEASURES), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], names=[*keep, "x"])

    return df.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{schema}, x array<float>")


def _split(g: np.ndarray, h: np.ndarray, leaves: int = 4, ridge: float = 5.0) -> np.ndarray:
    """Values per bin of a greedy tree of up to ``leaves`` leaves on gradient sums ``g`` and curvatures ``h``."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gs, hs = g[a:b].sum(), h[a:b].sum()
            gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1]:best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _split_pair(g: np.ndarray, h: np.ndarray, ridge: float = 5.0) -> tuple[np.ndarray, float]:
    """Table and gain of the best four-leaf tree: one cut along the first axis, then one along the second on each side."""
    best_gain, best = 0.0, np.zeros(g.shape)
    base = g.sum() ** 2 / (h.sum() + ridge)
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for side in _cuts(gg, hh, ridge, base):
            if side[0] > best_gain:
                best_gain, best = side[0], side[1] if axis == 0 else side[1].T
    return best, best_gain


def _cuts(g: np.ndarray, h: np.ndarray, ridge: float, base: float) -> Iterator[tuple[float, np.ndarray]]:
    gc, hc = np.cumsum(g, 0), np.cumsum(h, 0)
    n = len(g)
    halves = []
    for gs, hs in ((gc[:-1], hc[:-1]), (gc[-1] - gc[:-1], hc[-1] - hc[:-1])):  # every first cut at once
        gl, hl = np.cumsum(gs, 1), np.cumsum(hs, 1)
        gt, ht = gl[:, -1:], hl[:, -1:]
        gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge)
        at = np.argmax(gain[:, :-1], 1)
        halves.append((gain[np.arange(n - 1), at], at + 1, gl, hl))
    total = halves[0][0] + halves[1][0] - base
    cut = int(np.argmax(total))
    table = np.zeros(g.shape)
    for (_, at, gl, hl), part in zip(halves, (slice(0, cut + 1), slice(cut + 1, n)), strict=True):
        a = at[cut]
        left_g, left_h, all_g, all_h = gl[cut, a - 1], hl[cut, a - 1], gl[cut, -1], hl[cut, -1]
        table[part, :a] = left_g / (left_h + ridge)
        table[part, a:] = (all_g - left_g) / (all_h - left_h + ridge)
    yield float(total[cut]), table


class Gam:
    """Bin edges, one table per measure, one per chosen pair, an intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(len(MEASURES))]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if len(np.unique(y)) < 2:
            return
        b = self.bins(x)
        score = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                step = RATE * _split(*self._sums(score, y, b[:, j], len(table)))
                table += step
                score += step[b[:, j]]
        c = [self.coarse(b[:, j], j) for j in range(len(MEASURES))]
        size = PAIR_BINS * PAIR_BINS
        def grid(i, j):
            return [s.reshape(PAIR_BINS, PAIR_BINS) for s in self._sums(score, y, c[i] * PAIR_BINS + c[j], size)]
        gains = {p: _split_pair(*grid(*p))[1] for p in combinations(range(len(MEASURES)), 2)}
        self.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
        self.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                step = RATE * _split_pair(*grid(i, j))[0]
                table += step
                score += step[c[i], c[j]]

    @staticmethod
    def _sums(score: np.ndarray, y: np.ndarray, bins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return np.bincount(bins, y - p, n), np.bincount(bins, p * (1 - p), n)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1) if len(x) else np.zeros((0, len(MEASURES)), int)

    def coarse(self, b: np.ndarray, j: int) -> np.ndarray:
        return b * PAIR_BINS // len(self.tables[j])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: table entries added up."""
        b = self.bins(x)
        s = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            s += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            s += table[self.coarse(b[:, i], i), self.coarse(b[:, j], j)]
        return 1 / (1 + np.exp(-s))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> Gam:
    """Learn from about ``sample`` labelled documents (a bounded number of rows comes to the driver: their measures)."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
    chosen = bounded_sample(known, "_id", known.count(), sample)  # so small that it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(chosen), "_id")
    got = measures(rows, ["_id", "_y"], "_t", "_id long, _y int").toPandas()  # a bounded number of rows
    got = got.assign(_x=got["x"].map(tuple)).sort_values(["_id", "_y", "_x"], kind="stable")  # fitted alike whatever the order of tasks
    x = np.stack(got["x"].tolist()).astype(np.float32) if len(got) else np.zeros((0, len(MEASURES)), np.float32)
    return Gam(x, got["_y"].to_numpy(np.float64))


def score(docs: DataFrame, model: Gam, keep: list[str], schema: str, text_col: str = "text") -> DataFrame:
    """``keep`` columns (typed by ``schema``) and ``score`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(measure(data, starts)) for _, _, data, starts in slices(b.column(len(keep)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.concatenate(s) if s else np.zeros(0))], names=[*keep, "score"])

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{schema}, score double")


def keep_good(docs: DataFrame, model: Gam, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(measure(data, starts)) for _, _, data, starts in slices(b.column(at))]
            yield b.filter(pa.array(np.concatenate(s) >= threshold)) if s else b

    return docs.mapInArrow(run, docs.schema)
