import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from capstream.llm import simhash
from capstream.llm.components import components


def brute_fp(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, distance=4):
    label = list(range(len(ids)))
    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                label[root(i)] = root(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [low.get(root(i)) for i in range(len(ids))]


def test_bounds():
    r = np.random.default_rng(1)
    x, y = (r.integers(0, 2**64, 2000, dtype=np.uint64) for _ in range(2))
    cx, cy = simhash._counts(x), simhash._counts(y)
    slow = [sum(abs((int(a) >> 2 * k & 3) - (int(b) >> 2 * k & 3)) for k in range(32)) for a, b in zip(cx, cy)]
    assert (simhash.manhattan(cx, cy) == slow).all()
    assert (simhash.manhattan(cx, cy) <= np.bitwise_count(x ^ y)).all()


@pytest.mark.parametrize("n", [40, 900])
def test_links_keep_components(spark, n):
    r = random.Random(n)
    fps = {r.getrandbits(64) for _ in range(n // 3)}
    centre = r.getrandbits(64)
    while len(fps) < n:  # chains and a dense ball
        base = r.choice([centre, r.choice(sorted(fps))])
        fps.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    fps = sorted(fps)
    want = brute_components(fps, fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {np.int64(x.node).view(np.uint64).item(): x.label for x in components(simhash.links(df)).collect()}
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(got.get(f, f"single {f}"))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_documents(spark, sf):
    edge = [(None, None), (None, "one two"), (-5, ""), (7, "one TWO"), (7, "one two"), (9, "É é  a\tb\x0bc"), (10, "a b c d"), (11, "x " * 30000)]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = edge + [(r.doc_id + 100, r.text) for r in docs]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, fingerprint string")
    fps = [brute_fp(t) for _, t in rows]
    want = sorted(((str(i), f"{f:016x}", str(c)) for (i, _), f, c in zip(rows, fps, brute_components([i for i, _ in rows], fps))))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == want
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_fingerprints_are_dealt_out_before_they_multiply(spark, capsys):
    distinct = spark.range(1000).select(F.xxhash64("id").alias("fp")).distinct()
    simhash.links(distinct).explain("formatted")
    p = capsys.readouterr().out
    assert "REPARTITION_BY_NUM" in p and p.count("Exchange") > 4
