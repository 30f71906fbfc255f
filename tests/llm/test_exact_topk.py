import numpy as np
import pytest

from capstream.llm import exact_topk


def brute(rows, k, every, scale=1024):
    import math
    good = {}
    width = 0
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        width = max(width, len(v))
        good[(i, tuple(math.floor(scale * float(x)) for x in v))] = 1
    vec = [(i, v + (0,) * (width - len(v))) for i, v in good]
    vec = list(dict.fromkeys(vec))
    out = []
    for i, v in vec:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vec if j != i)[:k]
            out += [(i, r + 1, j, -sc) for r, (sc, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=10, every=100, **kw):
    df = spark.createDataFrame([(i, v, 0.5, "z") for i, v in rows], "vec_id long, embedding array<double>, score double, key string")
    return sorted(map(tuple, exact_topk.exact_top_k(df, k, every, **kw).collect()))


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [9.0, 9.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, []),
            (7, [float("inf"), 0.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0]), (-100, [-3.0, 0.25]), (10, [0.5]), (100, [0.0, -0.0]), (11, [-0.0, 0.0])]
    assert run(spark, rows, k=3) == brute(rows, 3, 100)
    assert run(spark, rows[2:6]) == []
    assert run(spark, []) == []
    assert run(spark, [(200, [2.0])]) == []


@pytest.mark.parametrize("width", [1, 2, 3, 16, 64])
def test_stages_lose_nothing(width):
    r = np.random.default_rng(width)
    x = np.floor(300 * r.normal(size=(3000, width)) * r.exponential(size=(3000, 1))).astype(np.int64)
    rot, q = exact_topk.rotation(x), x[:50]
    want = [sorted((-int(s), j) for j, s in enumerate(x @ v))[:6] for v in q]
    block = exact_topk.Block(x, np.arange(3000), rot)
    a, b, s = block.search(q, exact_topk.first_thresholds(q, x[:500], rot, 6), 6)
    assert [sorted((-s[k], b[k]) for k in np.flatnonzero(a == i)) for i in range(50)] == want
    assert block.stages == sorted(set(block.stages)) and 1 <= block.stages[0] <= block.stages[-1] <= max(1, width - 1)


def test_few_pairs_of_the_given_table_are_scored():
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()
    x = np.floor(1024 * np.array([r["embedding"] for r in t], np.float64)).astype(np.int64)
    q, rot = x[[r["vec_id"] % 100 == 0 for r in t]], exact_topk.rotation(x)
    block = exact_topk.Block(x, np.arange(len(x)), rot)
    a, b, s = block.search(q, exact_topk.first_thresholds(q, x[:200], rot, 11), 11)
    want = -np.sort(-(q @ x.T), axis=1)[:, :11]
    assert [sorted(-s[a == i]) for i in range(len(q))] == (-want).tolist()
    assert block.scored < 0.2 * len(q) * len(x)


@pytest.mark.parametrize("kind", ["unit", "skewed", "copies"])
def test_random(spark, kind, monkeypatch):
    monkeypatch.setattr(exact_topk, "ROW_BLOCK", 300)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 20)
    r = np.random.default_rng(5)
    x = r.normal(size=(1500, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "skewed":
        x *= r.exponential(size=(1500, 1)) * np.linspace(3, 0.01, 12)
    if kind == "copies":
        x[: 700] = x[0]
        x[700:1100] = np.round(x[700:1100] * 4) / 4
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows, k=10, every=50) == brute(rows, 10, 50)


def test_long_scores():
    q, x = np.full((1, 4), 2**40), np.array([[2**40] * 4])
    assert exact_topk.exact_scores(q, x)[0] == 2**63 - 1
    assert exact_topk.exact_scores(q, -x)[0] == -2**63
