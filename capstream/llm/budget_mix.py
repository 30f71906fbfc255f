"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a share of the mix by weight, at most ``max_repeat`` times its
own size. Whole passes over a source are taken first; what is left of its
budget is filled to the word. For that, documents are counted by exact length;
the same fraction of every length is taken (so the mix keeps the source's
lengths), then the few words left are fitted by a bounded-knapsack dynamic
program over the lengths still in stock, and the chosen number of documents of
each length is drawn in a seeded order.

Only length counts (one row per source and length) meet in one task; documents
stay distributed and a hot (source, length) pair is ranked in slices.

Defined results: NULL text has size 0; a NULL source is a source of its own and
sorts last; documents of size 0 take nothing; a source without words has target
0; repeated ids are separate documents, ranked by a hash of id and text; an empty table gives an empty result; other columns are carried, those
named like a result column are replaced, names starting with ``_`` (in
``mixed``: ``_cap_``) are reserved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.functions.common import quoted
from capstream.llm.ranks import BUCKETS, text_key, uniform, with_group_ranks
from capstream.llm.simhash import one_row, row_key
from capstream.session import shared_root

WORD = r"[^\x20\x09-\x0D]+"
RESULT = ("size", "source_size", "target", "taken")


def shares(sizes: np.ndarray, weights: np.ndarray, total: float, max_repeat: float) -> np.ndarray:
    """Split ``total`` by ``weights``; a part over ``max_repeat`` x size stops there and its excess is reshared."""
    limit = max_repeat * sizes.astype(float)
    part = np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    left = float(total)
    while free.any():
        part[free] = left * weights[free] / weights[free].sum()
        over = free & (part > limit)
        if not over.any():
            break
        part[over] = limit[over]
        left = total - part[over | ~free].sum()
        free &= ~over
    return part


def fit_counts(lengths: np.ndarray, stock: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words sum to ``budget`` or as near as found.

    Most of the budget is spread over all lengths in proportion; the rest, about
    32 documents' words, is fitted by exact reachability: a bitset over 0..rest
    per length and binary share of its stock, walked back from the reachable sum
    nearest to the rest.
    """
    whole = int((lengths * stock).sum())
    if budget <= 0 or whole == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= whole:
        return stock.astype(np.int64)
    # longest first: keep the words taken at the same fraction of the words passed, carrying each remainder on
    bulk = max(0, budget - 32 * int(np.median(np.repeat(lengths, np.minimum(stock, 9)))))
    take, passed, rest = np.zeros(len(lengths), np.int64), 0, budget
    for i in np.argsort(-lengths, kind="stable"):
        if lengths[i] > 0:
            passed += int(lengths[i]) * int(stock[i])
            take[i] = min(int(stock[i]), max(0, passed * bulk // whole - (budget - rest)) // int(lengths[i]))
            rest -= int(take[i]) * int(lengths[i])
    left = np.flatnonzero((lengths > 0) & (stock > take))
    if rest <= 0 or not len(left):
        return take
    limit = rest + int(lengths[left].min())  # the nearest sum above cannot lie beyond
    items = []  # (length index, documents, words): the stock in powers of two
    for i in left[np.argsort(lengths[left], kind="stable")]:
        if lengths[i] <= limit:
            free, step = min(int(stock[i] - take[i]), limit // int(lengths[i])), 1
            while free > 0:
                n = min(step, free)
                items.append((i, n, n * int(lengths[i])))
                free, step = free - n, step * 2
    mask, reached, seen = (1 << (limit + 1)) - 1, 1, []
    for _, _, words in items:
        seen.append(reached)
        reached |= (reached << words) & mask
        if reached >> rest & 1:
            break
    below = (reached & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reached >> (rest + 1)
    over = (above & -above).bit_length()  # words of the nearest sum above the rest
    at = rest + over if above and over < rest - below else below
    for (i, n, words), before in zip(reversed(items[:len(seen)]), reversed(seen), strict=True):
        if not before >> at & 1:
            take[i] += n
            at -= words
    return take


def _targets(weights: tuple[float, ...], max_repeat: float, fraction: float):
    def one(totals: pd.DataFrame) -> pd.DataFrame:
        # code point order is UTF-8 byte order; the key of a NULL source starts with "n", others with "v"
        order = sorted(range(len(totals)), key=lambda i: (totals["_source"][i][0] == "n", totals["_source"][i].encode("utf-8", "surrogatepass")))
        t = totals.iloc[order].reset_index(drop=True)
        sizes = t["source_size"].to_numpy(np.int64)
        w = np.array([weights[i % len(weights)] for i in range(len(t))], float)
        t["target"] = shares(sizes, w, fraction * float(sizes.sum()), max_repeat)
        return t[["_source", "source_size", "target"]]
    return one


def _fit(hist: pd.DataFrame) -> pd.DataFrame:
    h = hist.sort_values("size", kind="stable").reset_index(drop=True)
    lengths, stock = h["size"].to_numpy(np.int64), h["_n"].to_numpy(np.int64)
    whole, target = int((lengths * stock).sum()), float(h["target"][0])
    passes = int(target // whole) if whole else 0
    h["_take"] = fit_counts(lengths, stock, int(round(target - passes * whole)))
    h["_passes"] = np.int64(passes)
    return h[["_source", "size", "source_size", "target", "_passes", "_take"]]


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (1, 2, 3), max_repeat: float = 3, fraction: float = 1.0,
                seed: int = 0, carry: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``carry`` columns (default: all but the text) with ``size``, ``source_size``, ``target`` and ``taken`` words.

    Sources take ``weights`` in turn, in code point order; ``taken`` is a
    multiple of ``size`` and at most ``ceil(max_repeat)`` times it.
    """
    carry = [c for c in df.columns if c != text_col] if carry is None else carry
    carry = [c for c in carry if c.lower() not in RESULT and not c.startswith("_")]
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    h = F.xxhash64(F.lit(seed), text_key(id_col), F.col(text_col))  # NULL and repeated ids spread by their texts
    docs = df.select(*[quoted(c) for c in carry], size.alias("size"), text_key(source_col).alias("_source"), h.alias("_h"),
                     F.xxhash64(F.lit(seed), F.col(text_col)).alias("_tie"))
    shared_root(df.sparkSession)  # names the checkpoint folder
    docs = docs.checkpoint()  # texts are read and their words counted once
    hist = docs.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("_n"))
    totals = hist.groupBy("_source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    # one row per source meets here, already summed
    targets = totals.groupBy(F.lit(0).alias("_all")).applyInPandas(
        _targets(weights, max_repeat, fraction), "_source string, source_size long, target double")
    plan = hist.join(targets, "_source").groupBy("_source").applyInPandas(
        _fit, "_source string, size long, source_size long, target double, _passes long, _take long")
    ranked = with_group_ranks(docs, ["_source", "size"], uniform(F.col("_h")), [F.col("_h"), F.col("_tie")],
                              "_rank", "_stock", buckets)
    times = F.col("_passes") + F.when(F.col("_rank") < F.col("_take"), 1).otherwise(0)
    return (ranked.join(plan, ["_source", "size"])
            .select(*[quoted(c) for c in carry], "size", "source_size", "target", (F.col("size") * times).alias("taken")))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[float, ...] = (1, 2, 3), max_repeat: float = 3, fraction: float = 1.0, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it was taken (rows without words are never taken).

    Rows that repeat id, text and source are one document here: the one with the
    smallest hash stands for all, as often as they were taken together.
    """
    key = row_key(F.col(id_col).cast("long"), F.xxhash64(text_col), text_key(source_col))
    keyed = df.withColumn("_cap_key", key)
    plan = mix_sources(keyed.withColumn("cap_key", F.col("_cap_key")), id_col, text_col, source_col, weights, max_repeat, fraction, seed, ["cap_key"])
    times = plan.where("taken > 0").groupBy(F.col("cap_key").alias("_cap_key")).agg(F.sum(F.expr("taken div size")).cast("int").alias("_cap_times"))
    return (one_row(keyed.join(times, "_cap_key"), "_cap_key").withColumn("_cap_copy", F.explode(F.sequence(F.lit(1), F.col("_cap_times"))))
            .drop("_cap_key", "_cap_times", "_cap_copy"))
