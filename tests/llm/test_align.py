import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from capstream.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "The quick brown fox", "  two  spaces ", "x\ny z", "é日本 語🙂", "▁", "a▁b c", "a\0b c", "<|endoftext|> <s> <0x41> it's", "tab\t x \n", "a b　 c",
         "word " * 3000 + "end", "nospace" * 3000, "un­soft ﻿x \x01", "1234567890 3.14,15", "b\n\n c", "The quick brown fox"]


def brute(texts):
    """Groups, links and counts of every text, straight from the two libraries."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    names, byte = {i: p for p, i in tok.get_vocab(True).items()}, align._byte_of()
    docs, counts = [], Counter()
    for text in texts:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        pieces = [sp.id_to_piece(i) for i in b]
        ba = [bytes(byte[c] for c in names[i]) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            docs.append(([], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        common = set(ea) & set(eb)
        groups, ga, gb, ib = [], [], [], 0
        for i, e in zip(a, ea):
            ga.append(str(i))
            if e in common:
                while eb[ib] != e:
                    gb.append(str(b[ib]))
                    ib += 1
                gb.append(str(b[ib]))
                ib += 1
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        links, j = [], 0
        for i, s, e in zip(b, [0, *eb], eb):
            while ea[j] <= s:
                j += 1
            k = j
            while k < len(ea) and ea[k] - len(ba[k]) < e:
                links.append((a[k], i))
                k += 1
        counts.update(links)
        docs.append((a, b, groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [(len(a), len(b), len(g), len(x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", sum(counts[p] == highest[p[1]] for p in x),
             sum(counts[p] for p in x)) for a, b, g, x in docs], [";".join(g) for _, _, g, _ in docs]


def told(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum)


def test_shared_cuts():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(1, 60, rng.integers(1, 40)))
        b = np.unique(rng.integers(1, 60, rng.integers(1, 40)))
        cuts = sorted(rng.integers(0, len(b) + 1, 2).tolist())
        low, high = np.array([0, cuts[0], cuts[1]]), np.array([*cuts, len(b)])
        assert (align.shared_cuts(a, b, low, high) == np.isin(b, a)).all()


@pytest.mark.parametrize("at_once, remembered", [(1 << 20, 400_000), (50, 400_000), (1 << 20, 2), (50, 0)])
def test_equals_brute_force(spark, monkeypatch, at_once, remembered):
    rng = random.Random(5)
    words = ["the", "of", "tionier", "Straße", "naïve", "日本語", "x1", "…", "don't", "été,", "(a)", "ab\ncd", "zz▁z", "https://a.b/c?d=e"]
    texts = TEXTS + [" ".join(rng.choice(words[:-2] if i % 9 else words) for _ in range(rng.randrange(1, 40))) for i in range(150)]
    monkeypatch.setattr(align, "AT_ONCE", at_once)
    monkeypatch.setattr(align, "REMEMBERED", remembered)
    monkeypatch.setattr(align, "JOINED", 100)
    aligner = align.Aligner(A, B)
    target = align.to_arrow_schema(align.StructType.fromDDL(align.PARTS))
    import pyarrow as pa
    got = []
    for i, j, data, starts in align.slices(pa.array(texts), at_once):
        strings, refs, offsets = aligner.slice(pa.array(texts).slice(i, j - i).fill_null(""), data, starts)
        rows = list(align._chunk(pa.array(range(i, j)), strings, refs, offsets, 0, True, target))
        got += rows[0].to_pylist()
    want, groups = brute(texts)
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in got] == [w[:5] for w in want]
    assert [r["groups"] for r in got] == groups


def test_corpus_counts(spark):
    rng = random.Random(6)
    texts = TEXTS + [" ".join(rng.choice(["the", "of", "tionier", "Straße", "naïve", "日本", "x▁"]) for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_a int").repartition(5)
    got = {r.doc_id: r for r in align.aligned(df, A, B, groups=True).collect()}
    want, groups = brute(texts)
    assert len(got) == len(texts) and [told(got[i]) for i in range(len(texts))] == want
    assert [got[i].groups for i in range(len(texts))] == groups
    assert sum(1 for w in want if w[0] == 0) >= 5


def test_edge_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (1, None), (1, "b")]
    got = align.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert sorted((str(r.doc_id), r.n_a, r.count_sum) for r in got) == [("1", 0, 0), ("1", 1, 3), ("None", 2, 5), ("None", 2, 5)]
    assert align.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_query(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op13(spark, sf).collect()}
    want, _ = brute([t for _, t in docs])
    assert [told(got[i]) for i, _ in docs] == want
