import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstream.llm import fim, queries

TEXTS = [None, "", "a", "ab cd", "  ", "é", "日本 語x", "a<P>b", "x <S", "<M> y", "<", "<<P", "word " * 50000, "é1áb\n\n\tZ9", "P><S>", "🙂🙂 ok", "abc" * 40000, "<P"]


def expected(doc_id, text, seed=1):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_ranks(levels):
    rng = np.random.default_rng(levels)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 2**levels, size).astype(np.uint8)
        w, at = fim.WaveletMatrix(symbols, levels), np.arange(size + 1)
        for c in range(2**levels):
            assert (w.rank(c, at) == np.concatenate([[0], np.cumsum(symbols == c)])).all()


def test_every_cut_is_the_token_boundary():
    text = "ab c  é1xy"
    data = np.frombuffer(text.encode(), np.uint8)
    cutter = fim.Cutter(data, np.array([0, len(data)]))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    assert cutter.n.tolist() == [len(units)]
    for k in range(len(units) + 1):
        assert cutter.cut(np.array([k]))[0] == len("".join(units[:k]).encode())


def test_equals_brute_force_and_restores(spark):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("ab <>PSMé\n1") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "no id at all", 0), (3, "ab cd", 1), (3, "other text", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    made = fim.transform(df, seed=5).withColumn("back", fim.restored())
    got = sorted(map(str, (tuple(r) for r in made.collect())))
    assert got == sorted(str((i, *expected(i, t, 5), t or "")) for i, t, _ in rows)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}


def test_percentages(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    assert {r.form for r in fim.transform(df, fim_percent=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(df, fim_percent=100, spm_percent=100).collect()} == {"spm"}
    assert fim.transform(df.limit(0)).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        n, form, p, m, out = expected(i, text)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest() and r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
