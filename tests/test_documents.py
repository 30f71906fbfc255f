"""Parsed documents: the answers of json_at, one parse, hot paths as columns."""

import re

from pyspark.sql import functions as F

from capstream.operators import documents as D
from capstream.operators import serving as V

TEXTS = ['{"a": {"b": [1, 2, 3], "e": {}}, "s": "x \\"q\\"", "f": 1.5, "t": true, "n": null, "i": 7, "big": 12345678901234567890}', "[1, [2], {}]", '"text"', "5", "null",
         "not json", "", None, '{"a": []}', '{"a": "é", "x.y": 1}']
PATHS = ["$", "a", "$.a.b", ".a.e", "s", "f", "t", "n", "i", "$[1]", "missing.deep", "big"]


def test_answers_are_those_of_the_text(spark):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "id int, text string, j string")
    docs = D.parsed(df, "j")
    assert docs.columns == ["id", "text", "doc"]
    cols = []
    for i, p in enumerate(PATHS):
        for op in ("type", "objlen", "arrlen"):
            cols += [V.json_at("text", p, op).alias(f"t{i}{op}"), D.variant_at("doc", p, op).alias(f"v{i}{op}")]
        cols += [F.sort_array(V.json_at("text", p, "objkeys")).alias(f"t{i}keys"), D.variant_at("doc", p, "objkeys").alias(f"v{i}keys")]
        if p not in ("$", "a", ".a.e"):
            cols += [V.json_at("text", p).alias(f"t{i}get"), D.variant_at("doc", p).alias(f"v{i}get")]
    for r in docs.select("id", "text", *cols).collect():
        d = r.asDict()
        for k in d:
            if k.startswith("t") and k != "text":
                valid = r.text is not None and r.text not in ("not json", "")
                assert d[k] == d["v" + k[1:]] or not valid, (r.text, PATHS[int(re.match(r"t(\d+)", k)[1])], k, d[k], d["v" + k[1:]])
                assert valid or d["v" + k[1:]] is None


def test_one_parse_for_many_paths(spark, capsys):
    df = spark.createDataFrame([(1, '{"a": 1}')], "id int, j string")
    D.parsed(df, "j").where(D.variant_at("doc", "a") == "1").select(*[D.variant_at("doc", p, "type").alias(f"c{i}") for i, p in enumerate(PATHS)]).explain("formatted")
    p = capsys.readouterr().out
    assert len(re.findall(r"parse_json\(", p)) <= 1


def test_hot_paths_are_columns(spark, tmp_path, capsys):
    df = spark.createDataFrame([(i, f'{{"k": {i}, "s": {{"t": "x{i}"}}}}') for i in range(20)] + [(99, '{"k": "text"}'), (100, None)], "id int, j string")
    hot = {"k": ("$.k", "bigint")}
    D.write_documents(df, str(tmp_path / "d"), "j", hot)
    docs = D.Documents(spark, str(tmp_path / "d"), hot)
    assert docs.df.agg(F.sum(docs.value("k", "bigint"))).collect()[0][0] == sum(range(20))
    assert {r[0] for r in docs.df.select(docs.value("s.t")).collect()} == {f"x{i}" for i in range(20)} | {None}
    docs.df.where(docs.value("$.k", "bigint") > 3).select("id").explain("formatted")
    p = capsys.readouterr().out
    assert "GreaterThan(k,3)" in p and "doc" not in re.search(r"ReadSchema: (.*)", p)[1]
    assert [r.id for r in docs.df.where(docs.value("k") == "text").collect()] == [99]
