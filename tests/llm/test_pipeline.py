"""Each stage against a brute-force version on its own input."""

import collections

import pytest

import corpus_pipeline as C
from capstream.llm import pii_crf
from tests.llm.test_simhash import brute_components, brute_fp

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) rows of every stage."""
    sf = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, f in C.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        f(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect(), after.columns
        docs = after
    return out


def test_shape(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "personal_data", "mixture", "tokens"]
    assert all(c == COLUMNS for n, (_, _, c) in stages.items() if n != "tokens") and C.ORACLE_SQL is None


def test_quality_only_drops(stages, spark):
    before, after, _ = stages["quality"]
    assert set(after) < set(before)
    quality = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert all(r.doc_id in kept for r in before if quality.get(r.doc_id) == 1)
    junk = [r.doc_id for r in before if quality.get(r.doc_id) == 0]
    assert sum(i in kept for i in junk) <= len(junk) // 4  # some thirty labels teach it here


def test_one_of_each_group(stages):
    before, after, _ = stages["near_duplicates"]
    ids = [r.doc_id for r in before]
    want = set(brute_components(ids, [brute_fp(r.text) for r in before]))
    assert sorted(after) == sorted(r for r in before if r.doc_id in want) and len(after) < len(before)


def test_personal_data_is_gone(stages):
    before, after, _ = stages["personal_data"]
    new = {r.doc_id: r for r in after}
    assert len(new) == len(before)
    for r in before:
        spans = pii_crf.pattern_spans(r.text or "")
        assert not pii_crf.pattern_spans(new[r.doc_id].text or "")
        if spans:
            assert all(r.text[a:b] not in new[r.doc_id].text for a, _, b in spans)
        elif new[r.doc_id].text == r.text:
            assert new[r.doc_id] == r
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)


def test_mixture_meets_targets(stages):
    before, after, _ = stages["mixture"]
    rows = collections.Counter(after)
    assert set(rows) <= set(before) and max(rows.values()) <= 3
    words = lambda rs: sum(len((r.text or "").split()) for r in rs)  # noqa: E731  (no other white space in these texts)
    sources = sorted({r.source for r in before})
    size = [words(r for r in before if r.source == s) for s in sources]
    from tests.llm.test_budget_mix import brute_targets
    for s, target in zip(sources, brute_targets(size, [1 + i % 3 for i in range(len(size))])):
        got = words(r for r in after if r.source == s)
        longest = max(words([r]) for r in before if r.source == s)
        assert abs(got - target) <= longest / 2 + 1, (s, got, target)


def test_tokens(stages):
    import hashlib

    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after, _ = stages["tokens"]
    want = collections.Counter((r.doc_id, tuple(sp.encode(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in before)
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in after) == want


def test_clashing_columns_come_through(spark):
    from capstream.llm import budget_mix, simhash
    df = spark.createDataFrame([(1, "a b c", "s", "x", "y"), (2, "d e f g h", "s", "z", "w")], "doc_id long, text string, source string, _key string, fp string")
    assert sorted(simhash.one_of_each(df).collect()) == sorted(df.collect())
    assert set(budget_mix.mixed(df).collect()) <= set(df.collect()) and budget_mix.mixed(df).columns == df.columns


def test_empty_and_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "good words here, and some more of them.", "en", "a", 5),
            (2, "good words here, and some more of them.", "en", "a", 5), (3, "x " * 20000, "en", "a", None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, kind)
        for name, f in C.STAGES:
            path = str(tmp_path / f"{name}{len(data)}")
            f(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() >= (1 if data else 0)
