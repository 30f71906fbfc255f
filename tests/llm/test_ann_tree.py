import numpy as np
import pytest

from capstream.llm import ann_tree


def brute(x, ids, k, every):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for i, v in zip(ids, u):
        if i % every == 0:
            s = np.round(u @ v, 12)
            out[i] = sorted((-c, j) for c, j in zip(s, ids) if j != i)[:k]
    return out


def run(spark, rows, k=5, every=50):
    df = spark.createDataFrame([(i, v, 1.0, "z") for i, v in rows], "vec_id long, embedding array<double>, score double, key string")
    return ann_tree.nearest(df, k, every).collect()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (None, [1.0, 0.0]), (8, [1.0]), (9, []), (-50, [-1.0, 0.0]), (11, [1e-300, 1e-300]), (12, [1e300, 1e300])]
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 12)) for r in run(spark, rows)}
    h = round(0.5 ** 0.5, 12)
    assert [got[0, i] for i in (1, 2)] == [(1, 1.0), (8, 1.0)]
    assert {got[0, i] for i in (3, 4, 5)} == {(2, h), (11, h), (12, h)}  # parallel vectors: equal but for rounding
    assert {got[-50, i] for i in (1, 2, 3)} == {(2, -h), (11, -h), (12, -h)}
    assert [got[-50, i] for i in (4, 5)] == [(0, -1.0), (1, -1.0)]
    assert len(got) == 10
    assert run(spark, []) == [] and run(spark, rows[4:9]) == [] and run(spark, [(50, [1.0])]) == []


@pytest.mark.parametrize("kind", ["random", "clustered", "copies"])
def test_recall(spark, kind, monkeypatch):
    monkeypatch.setattr(ann_tree, "ROW_CHUNK", 100)
    monkeypatch.setattr(ann_tree, "QUERY_BLOCK", 20)
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 16))
    if kind == "clustered":
        x = r.normal(size=(20, 16))[r.integers(20, size=3000)] * 2 + 0.3 * x
    if kind == "copies":
        x[::3] = x[0]
    want = brute(x, range(3000), 5, 50)
    got = {}
    for q in run(spark, [(i, v.tolist()) for i, v in enumerate(x)]):
        got.setdefault(q.query_id, []).append((q["rank"], q.vec_id, q.score))
    hits = total = 0
    for q, best in want.items():
        own = sorted(got[q])
        assert [p[0] for p in own] == [1, 2, 3, 4, 5]
        u = x[[p[1] for p in own]]
        assert np.allclose([p[2] for p in own], u @ x[q] / np.linalg.norm(u, axis=1) / np.linalg.norm(x[q]), rtol=0, atol=1e-12)
        if best[-1][0] == -1:  # enough copies: the list is certain, with its ties
            assert [p[1] for p in own] == [j for _, j in best]
        hits += len({p[1] for p in own} & {j for _, j in best})
        total += len(best)
    assert hits / total >= 0.9
