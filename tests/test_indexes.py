"""Word and label indexes: equal to full scans, and they read only what was asked for."""

import glob
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from capstream.operators import labelindex as LI
from capstream.operators import textindex as TI


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    words = ["alpha", "Beta", "gamma-delta", "ÉTÉ", "x1", "日本", "_under_"]
    rows = [(i * 3 - 100, "every " + " ".join(rng.choice(words) for _ in range(rng.randrange(4)))) for i in range(900)] + [(None, "every alpha"), (7, None), (8, ""), (-100, "alpha again")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    path = TI.build_text_index(texts, str(tmp_path_factory.mktemp("index")), buckets=8, block=128)
    return TI.TextIndex(spark, path)


@pytest.mark.parametrize("terms", [["every"], ["Alpha"], ["beta", "alpha"], ["every", "gamma", "x1"], ["été"], ["nowhere"], ["alpha", "nowhere"], ["under"], ["alpha", "ALPHA"]])
@pytest.mark.parametrize("any_of", [False, True])
def test_search_equals_the_scan(index, texts, terms, any_of):
    want = {r.doc_id for r in TI.scan_words(texts.where("doc_id is not null"), terms, any_of=any_of).collect()}
    got = [r.id for r in index.ids(terms, any_of).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.doc_id for r in index.search(texts, terms, any_of=any_of).collect()} == want


@pytest.mark.parametrize("terms", [["a"], ["LPH", "et"], ["gamma-delta"], ["ry al"], ["x1", "y"], ["_under"], ["-"], ["nowhere"], ["éT", "every a"], []])
def test_text_search_equals_the_scan(index, texts, terms):
    from capstream.operators.serving import search
    want = sorted(r.doc_id for r in search(texts.where("doc_id is not null"), "text", terms).collect())
    assert sorted(r.doc_id for r in index.search_text(texts.where("doc_id is not null"), terms).collect()) == want


def test_directory(index):
    d = {r.term: (r.rows, r.blocks) for r in index.directory().collect()}
    assert d["every"][0] == 900 and d["every"][1] == len(range(-128, 2600, 128)) and "nowhere" not in d
    assert [r.rows for r in index.directory(["EVERY"]).collect()] == [900]
    with pytest.raises(ValueError):
        index.ids([])


def test_only_the_words_folders_are_read_and_lists_are_delta_coded(index, capsys):
    index.ids(["every", "x1"]).explain("formatted")
    p = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[[^\n]*bucket[^\n]* IN ", p) and re.search(r"PushedFilters: \[[^\n]*In\(term", p)
    total, read = 0, 0
    asked = {r.bucket for r in index._of("postings", ["every", "x1"]).select("bucket").distinct().collect()}
    for f in glob.glob(f"{index.path}/postings/bucket=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        size = sum(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups))
        total += size
        read += size * (int(re.search(r"bucket=(\d+)", f)[1]) in asked)
        assert any("DELTA_BINARY_PACKED" in meta.row_group(0).column(j).encodings for j in range(meta.num_columns))
    assert 0 < read < total


def test_empty_table(spark, tmp_path):
    path = TI.build_text_index(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "i"), buckets=2)
    assert TI.TextIndex(spark, path).ids(["a"]).collect() == TI.TextIndex(spark, path).directory().collect() == []


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        labels = {k: rng.choice(vs) for k, vs in (("env", ["prod", "dev", "test"]), ("host", [f"h{j}" for j in range(9)]), ("zone", ["a", None])) if rng.random() < 0.8}
        rows += [(f"s{i:03}", {k: v for k, v in labels.items() if v}, n, float(n)) for n in range(3)]
    rows += [(None, {"env": "prod"}, 0, 1.0), ("bare", None, 0, 1.0)]
    return spark.createDataFrame(rows, "series string, labels map<string,string>, ts int, value double").repartition(4).cache()


@pytest.fixture(scope="module")
def labels(spark, samples, tmp_path_factory):
    return LI.LabelIndex(spark, LI.build_label_index(samples, str(tmp_path_factory.mktemp("labels"))))


@pytest.mark.parametrize("matchers", [[], [("env", "=", "prod")], [("env", "!=", "prod")], [("env", "=~", "prod|d.*"), ("host", "!~", "h[0-4]")],
                                      [("zone", "=", "a"), ("env", "!=", "dev"), ("host", "=~", "h.")], [("nolabel", "=", "x")], [("nolabel", "!=", "x")], [("env", "=~", "")]])
def test_selection_equals_the_scan(labels, samples, matchers, tmp_path):
    want = {(r.series, r.ts) for r in samples.where(LI.matches(F.col("labels"), matchers)).collect()}
    chosen = [r.series for r in labels.series(matchers).collect()]
    assert len(chosen) == len(set(chosen)) and set(chosen) == {s for s, _ in want}
    path = str(tmp_path / "samples")
    labels.write_samples(samples, path)
    assert {(r.series, r.ts) for r in labels.read_samples(path, matchers).collect()} == want


def test_words_of_the_asked_labels_alone(labels, capsys):
    labels.numbers([("env", "=", "prod")]).explain("formatted")
    p = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[[^\n]*label", p) and "partial_bit_or" in p
    assert [r.series_no for r in labels.series([]).orderBy("series_no").collect()] == list(range(402))
    with pytest.raises(ValueError):
        labels.numbers([("env", "==", "x")])
