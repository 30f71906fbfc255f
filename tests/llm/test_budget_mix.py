from pyspark.sql import functions as F
import re

import numpy as np

from capstream.llm import budget_mix as B


def brute_targets(sizes, weights, cap=3):
    total, fixed = float(sum(sizes)), {}
    while len(fixed) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        part = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if part[i] > cap * sizes[i]]
        if not over:
            return [fixed.get(i, part.get(i)) for i in range(len(sizes))]
        fixed.update({i: cap * float(sizes[i]) for i in over})
    return [fixed[i] for i in range(len(sizes))]


def test_shares():
    r = np.random.default_rng(0)
    for _ in range(200):
        n = r.integers(1, 9)
        sizes, w = r.integers(0, 2000, n) ** r.integers(1, 3, n), np.array([1 + i % 3 for i in range(n)], float)
        assert np.allclose(B.shares(sizes, w, sizes.sum(), 3), brute_targets(sizes.tolist(), w.tolist()))


def test_fit_counts():
    r, exact = np.random.default_rng(1), 0
    for _ in range(300):
        n = r.integers(1, 40)
        lengths = np.unique(r.integers(0, 60, n))
        stock = r.integers(1, 9, len(lengths))
        whole = int((lengths * stock).sum())
        budget = int(r.integers(0, whole + 5))
        take = B.fit_counts(lengths, stock, budget)
        got = int((take * lengths).sum())
        assert (take >= 0).all() and (take <= stock).all()
        assert budget > whole or abs(budget - got) <= 30  # half the longest document
        exact += got == min(budget, whole)
    assert exact > 200
    for lengths, stock, budget, want in (([1000], [1], 900, 1000), ([1000], [1], 400, 0), ([7, 10], [3, 1], 18, 17), ([0, 5], [9, 1], 4, 5)):
        assert (B.fit_counts(np.array(lengths), np.array(stock), budget) * lengths).sum() == want
    big = np.arange(1, 4000)
    take = B.fit_counts(big, np.ones(len(big), int), 3_000_000)
    assert (take * big).sum() == 3_000_000 and 0.3 < take[:2000].mean() / take[2000:].mean() < 3  # all lengths alike


ROWS = [(i, "w " * (1 + i % 13), f"s{i % 4}", "t") for i in range(400)] + [(1000, None, None, None), (1001, "", "s0", "t"), (1002, "  a", "é", "t"),
        (1003, "long " * 30000, "s1", "t"), (7, "w w", "s1", "t"), (7, "w w", "s1", "t"), (None, "one two three", None, "t"), (1004, "", "empty", "t")]


def test_documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, target string")
    got = [tuple(r) for r in B.mix_sources(df, seed=5).select("doc_id", "source", "size", "source_size", "target", "taken").collect()]
    assert len(got) == len(ROWS)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r[0]), r[2]) for r in got) == sorted((str(i), words(t)) for i, t, _, _ in ROWS)
    order = sorted({s for _, _, s, _ in ROWS}, key=lambda s: (s is None, s or ""))
    sizes = [sum(words(t) for _, t, x, _ in ROWS if x == s) for s in order]
    for s, size, target in zip(order, sizes, brute_targets(sizes, [1 + i % 3 for i in range(len(order))])):
        own = [r for r in got if r[1] == s]
        assert {(r[3], round(r[4], 6)) for r in own} == {(size, round(target, 6))}
        assert all(r[5] == 0 if r[2] == 0 else r[5] % r[2] == 0 and r[5] <= 3 * r[2] for r in own)
        assert abs(sum(r[5] for r in own) - target) <= (15001 if s == "s1" else 4)
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in B.mix_sources(df.repartition(5), seed=5).select(
        "doc_id", "source", "size", "source_size", "target", "taken").collect())
    assert B.mix_sources(df.limit(0)).count() == 0
    mix = B.mixed(df, seed=5).groupBy("doc_id").count().collect()
    want = {}
    for r in got:
        if r[5]:
            want[r[0]] = want.get(r[0], 0) + r[5] // r[2]
    assert {r.doc_id: r["count"] for r in mix} == want


def test_one_id_and_text_in_two_sources(spark):
    rows = [(i, f"{'w ' * 6}{i}", s, s.lower()) for s in "AB" for i in range(20)] + [(99, "z " * 40, "A", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    plan = {(r.doc_id, r.source): r.taken for r in B.mix_sources(df, seed=3).collect()}
    mix = B.mixed(df, seed=3)
    assert mix.columns == df.columns
    got = {(r.doc_id, r.source): r["sum(n)"] for r in mix.withColumn("n", F.size(F.split(F.trim("text"), " "))).groupBy("doc_id", "source").sum("n").collect()}
    assert got == {k: v for k, v in plan.items() if v}
    assert {(r.source, r.lang) for r in mix.select("source", "lang").distinct().collect()} == {("A", "a"), ("B", "b")}
    again = B.mixed(df.repartition(3, "lang"), seed=3)
    assert mix.exceptAll(again).count() == again.exceptAll(mix).count() == 0


def test_clashing_names_and_many_rows_without_an_id(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("a b "), F.col("id")).alias("text"), F.lit("s").alias("source"),
                                  F.col("id").alias("a.b"), F.lit(1).alias("Size"), F.lit(2).alias("TAKEN"))
    got = B.mix_sources(df, buckets=64)
    assert got.columns == ["doc_id", "source", "a.b", "size", "source_size", "target", "taken"]
    assert got.count() == 3000 and {r["size"] for r in got.select("size").distinct().collect()} == {3}
    from capstream.llm.ranks import text_key, uniform
    place = F.floor(uniform(F.xxhash64(F.lit(0), text_key("doc_id"), F.col("text"))) * 64)
    assert df.groupBy(place.alias("p")).count().agg(F.max("count")).collect()[0][0] < 3000 / 20
