import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capstream.llm import quality_gam as G
from capstream.llm.textvec import hashes, slices, words


def slow(text):
    b = (text or "").encode()
    w = b.split()
    lines = [x for x in b.replace(b"\n", b"\n\0").split(b"\0") if x]
    n, each, size = len(w), max(1, len(w)), max(1, len(b))
    count = lambda f: sum(map(f, b))
    upper, letter = count(lambda c: 65 <= c <= 90), count(lambda c: chr(c).isalpha() and c < 128)
    punct = set(range(33, 127)) - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123))
    sym = punct - set(b".,;:!?'\"-()|")
    is_up = lambda x: len(x) > 1 and 65 <= x[0] <= 90 and 65 <= x[max(0, len(x) - 1 - (x[-1] in punct))] <= 90
    return [np.log1p(len(text or "")), np.log1p(n), sum(map(len, w)) / each, upper / max(1, letter), count(lambda c: 48 <= c <= 57) / size,
            count(lambda c: c in punct) / size, count(lambda c: c in sym) / size, b.count(b"|") / each, b.count(b"!") / each, b.count(b".") / each,
            count(lambda c: c >= 0xC0) / size, len(lines) / each, sum(len(x) > 14 for x in w) / each, sum(len(x) < 3 for x in w) / each,
            sum(x[-1] in sym for x in w) / each, sum(map(is_up, w)) / each, 1 - len(set(w)) / n if n else 0,
            1 - len(set(lines)) / len(lines) if lines else 0, b.count(b",") / each, sum(any(48 <= c <= 57 for c in x) for x in w) / each]


TEXTS = ["", " ", "\n", "One two.\nOne two.\nThree", None, "É ü 日本 語", "A!! BB!! a|b | c### d%%%", "x" * 3000, "1 2a 3\n\n\n", "a\n", "\na", "END. Of"]


@pytest.mark.parametrize("at_once", [1, 1 << 20])
def test_measures(at_once):
    got = [G.measure(d, s) for _, _, d, s in slices(pa.array(TEXTS), at_once)]
    assert np.allclose(np.concatenate(got), [slow(t) for t in TEXTS], atol=1e-5)


def test_words_and_hashes():
    for _, _, d, s in slices(pa.array(TEXTS), 1 << 20):
        begin, end, row = words(d, s)
        got = [(int(r), bytes(d[a:b])) for a, b, r in zip(begin, end, row)]
        assert got == [(i, w) for i, t in enumerate(TEXTS) for w in (t or "").encode().split()]
        h = hashes(d, begin, end)
        assert len({x for _, x in got}) == len(set(h.tolist())) == len(set(zip([x for _, x in got], h.tolist())))


def test_gam_learns_interaction():
    r = np.random.default_rng(0)
    x = r.random((6000, len(G.MEASURES))).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no measure tells alone
    m = G.Gam(x[:4000], y[:4000])
    assert (0, 1) in m.pairs and ((m.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.9
    assert np.allclose(G.Gam(x[:10], np.ones(10)).score(x[:3]), 10.5 / 11) and G.Gam(x[:0], y[:0]).score(x[:1])[0] == 0.5


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    m = G.fit(docs, labels)
    got = G.score(docs, m, ["doc_id"], "doc_id long").join(labels, "doc_id").where(G.held_out()).toPandas()
    assert len(got) > 50 and ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.95
    assert (got[got.quality == 1].score >= 0.3).mean() > 0.98


def test_edges(spark):
    rows = [(1, t, "x", 2.0) for t in TEXTS] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    m = G.fit(df, none)
    assert {r.score for r in G.score(df, m, ["doc_id"], "doc_id long").collect()} == {0.5}
    assert G.score(df.limit(0), m, ["doc_id"], "doc_id long").count() == 0
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7), (77, 0)], "doc_id long, quality int")
    m = G.fit(df, labels)
    assert G.score(df, m, ["doc_id"], "doc_id long").where(F.col("score").between(0, 1)).count() == len(rows)


def slow_score(m, x):
    from bisect import bisect_right
    from math import exp
    bins = [bisect_right(e.tolist(), v) for e, v in zip(m.edges, x)]
    part = [b * G.PAIR_BINS // len(t) for b, t in zip(bins, m.tables)]
    s = m.base + sum(t[b] for t, b in zip(m.tables, bins)) + sum(t[part[i], part[j]] for (i, j), t in zip(m.pairs, m.pair_tables))
    return 1 / (1 + exp(-s))


def test_score_is_the_sum_of_table_entries():
    r = np.random.default_rng(2)
    x = np.round(r.random((900, len(G.MEASURES))), 2).astype(np.float32)
    m = G.Gam(x, (x[:, 2] + x[:, 3] * x[:, 4] > 0.8).astype(float))
    assert len(m.pairs) == len(m.pair_tables) > 0
    assert np.allclose(m.score(x[:200]), [slow_score(m, v) for v in x[:200]])


def test_query_scores_every_document(spark, sf):
    from capstream.llm import queries
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    m = G.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op6(spark, sf).collect()}
    assert got.keys() == texts.keys() and all(r.predicted == (r.score >= 0.3) for r in got.values())
    some = sorted(texts)[::7]
    want = m.score(np.array([slow(texts[i]) for i in some], np.float32))
    assert np.mean(np.isclose([got[i].score for i in some], want, atol=1e-6)) > 0.98  # a measure may round across a bin's edge
