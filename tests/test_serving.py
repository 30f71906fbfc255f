"""Key/value reads, panel transformations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from capstream.operators import panel as P
from capstream.operators import serving as V


def test_zrange_index_score_and_negative(spark):
    z = spark.createDataFrame([("k", f"m{i}", float(i % 3)) for i in range(6)], "key string, member string, score double")
    order = [r.member for r in V.zrange(z, 0, -1).orderBy("rank").collect()]
    assert order == ["m0", "m3", "m1", "m4", "m2", "m5"]
    assert [r.member for r in V.zrange(z, 1, 2).orderBy("rank").collect()] == ["m3", "m1"]
    tail = V.zrange(z, -2, -1).orderBy("rank").collect()
    assert [(r.member, r.rank) for r in tail] == [("m2", 4), ("m5", 5)]
    assert {r.member for r in V.zrange(z, 1.0, 1.0, by="score").collect()} == {"m1", "m4"}
    assert [r.member for r in V.zrange(z, 0, 0, reverse=True).collect()] == ["m5"]


def test_hash_reads(spark):
    h = spark.createDataFrame([("Mysql:A", {"Count": "2", "Sum": "30"}), ("Mysql:B", {"Count": "1"})],
                              "hash_key string, fields map<string,string>")
    assert V.hash_get(h, "Sum", "Mysql:A").first().value == "30"
    assert {(r.hash_key, r.n_fields) for r in V.hash_len(h).collect()} == {("Mysql:A", 2), ("Mysql:B", 1)}
    assert sorted((r.field, r.value) for r in V.hash_getall(h, "Mysql:A").collect()) == [("Count", "2"), ("Sum", "30")]
    assert V.hash_mget(h, ["Count", "Sum"], "Mysql:B").first().Sum is None


def test_sets_lists_latest(spark):
    s = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3)], "key string, member long")
    assert {r.key: r.n_members for r in V.set_card(s).collect()} == {"a": 2, "b": 1}
    assert {r.key: r.n_entries for r in V.list_len(s).collect()} == {"a": 3, "b": 1}
    t = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0, 1), ("a", dt.datetime(2024, 1, 1), 2.0, 2)],
                              "key string, ts timestamp_ntz, value double, id long")
    assert V.latest_per_key(t, ("key",), "ts", "value", "id").first().value == 2.0


def test_json_at(spark):
    j = spark.createDataFrame([('{"a": {"b": [1, 2, 3]}, "s": "x", "f": 1.5, "t": true, "n": null}',)], "j string")
    r = j.select(V.json_at("j", "$.a.b", "arrlen").alias("al"), V.json_at("j", ".a", "objlen").alias("ol"),
                 V.json_at("j", "s", "type").alias("st"), V.json_at("j", "$.f", "type").alias("ft"),
                 V.json_at("j", "$.t", "type").alias("tt"), V.json_at("j", "$.a", "type").alias("at"),
                 V.json_at("j", "$.a.b", "type").alias("bt"), V.json_at("j", "$.s").alias("sv"),
                 F.array_join(V.json_at("j", "$", "objkeys"), ",").alias("keys")).first()
    assert (r.al, r.ol, r.st, r.ft, r.tt, r.at, r.bt, r.sv) == (3, 1, "string", "number", "boolean", "object", "array", "x")
    assert r.keys == "a,s,f,t,n"


def test_search_paging_and_match_labels(spark):
    docs = spark.createDataFrame([(i, f"Alpha beta {'gamma' if i % 2 else ''}", i % 4) for i in range(10)],
                                 "id long, text string, n long")
    p1 = [r.id for r in V.search(docs, "text", ["ALPHA", "gamma"], "n", True, 0, 2, ["id"], id_col="id").collect()]
    p2 = [r.id for r in V.search(docs, "text", ["ALPHA", "gamma"], "n", True, 2, 2, ["id"], id_col="id").collect()]
    assert p1 == [3, 7] and p2 == [1, 5]
    lab = spark.createDataFrame([("s1", {"env": "p", "t": "x"}), ("s2", {"env": "d"}), ("s3", {"t": "y"})],
                                "series string, labels map<string,string>")
    assert {r.series for r in V.list_series(V.match_labels(lab, not_equals={"env": "d"}, present=("t",))).collect()} \
        == {"s1", "s3"}
    assert {r.series for r in V.match_labels(lab, any_of={"env": ["p", "d"]}, absent=("t",)).collect()} == {"s2"}


def test_values_list_and_run_sql(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y long")
    assert sorted(r.value for r in V.values_list(df).collect()) == ["1", "2", "a", "b"]
    out = V.run_sql(spark, "SELECT x FROM {t_vals} WHERE y > :lim", {"lim": 1}, views={"t_vals": df}).collect()
    assert [r.x for r in out] == ["b"]


def test_panel(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0), 1.0), ("a", dt.datetime(2024, 1, 1, 1), None),
                                ("a", dt.datetime(2024, 1, 1, 2), 3.0)], "k string, ts timestamp_ntz, v double")
    assert P.panel_calc(df, "lastNotNull", "v", "ts", ("k",)).first().lastNotNull == 3.0
    assert P.panel_calc(df, "mean", "v", keys=("k",)).first().mean == 2.0
    nulls = spark.createDataFrame([("n", dt.datetime(2024, 1, 1), None)], "k string, ts timestamp_ntz, v double")
    for calc, want in (("lastNotNull", 3.0), ("firstNotNull", 1.0)):
        got = {r.k: r[1] for r in P.panel_calc(df.unionByName(nulls), calc, "v", "ts", ("k",)).collect()}
        assert got == {"a": want, "n": None}
    o = P.organize(df, exclude=["ts"], rename={"v": "value"}, order=["value"])
    assert o.columns == ["value", "k"]
    assert P.keep_fields(o, ["k"]).columns == ["k"]


def test_rank_within_matches_row_number_with_a_hot_key(spark):
    from pyspark.sql import Window
    hot = spark.range(30_000).select(F.lit("hot").alias("key"), (F.col("id") % 997).cast("double").alias("score"),
                                      F.col("id").cast("string").alias("member"))
    cold = spark.range(500).select((F.col("id") % 7).cast("string").alias("key"), F.col("id").cast("double").alias("score"),
                                   F.col("id").cast("string").alias("member"))
    df = hot.unionByName(cold)
    order = [F.col("score").asc(), F.col("member").asc()]
    got = V.rank_within(df, "key", [("score", True), ("member", True)], points=15).select("key", "member", "rank")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)) - 1) \
        .select("key", "member", "rank")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _one_hot_key(spark, n=60_000):
    """One key; 60 % of its rows share one score; members share long prefixes; some NULLs."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit("hot").alias("key"), F.when(i % 10 < 6, 5.0).when(i % 1000 != 999, (i * 7919 % 104729).cast("double")).alias("score"),
        F.when(i % 5000 != 1, F.concat(F.lit("user:"), F.lpad(i.cast("string"), 9, "0"))).alias("member"))


def test_a_hot_key_with_ties_is_cut_into_small_slices(spark):
    from capstream.operators.ranking import with_slices
    df = _one_hot_key(spark)
    for order in ([("score", True), ("member", True)], [("score", False), ("member", False)]):
        largest = with_slices(df, order).groupBy("key", "_slice").count().agg(F.max("count")).first()[0]
        assert largest <= 60_000 / 20  # the tied score alone holds 36,000 rows


@pytest.mark.parametrize("text", ["concat('https://www.example.com/shop/article?id=', lpad(id * 7919 % 20011, 9, '0'))", "concat(repeat('0', 21), lpad(20000 - id, 5, '0'))",
                                  "repeat('aaaaaah', 1 + id % 5)", "concat('a', repeat(char(0), id % 4))", "'the same'", "concat(repeat('x', 2000), id % 7)"])
def test_ranks_by_text_then_other_columns(spark, text):
    from pyspark.sql import Window

    from capstream.operators.ranking import with_slices
    df = spark.range(0, 20_000, 1, 2).select(F.lit("k").alias("k"), F.expr(text).alias("t"), (F.lit(1 << 60) - F.col("id")).alias("id"), F.encode(F.col("id").cast("string"), "UTF-8").alias("b"))
    for order in ([("t", False), ("id", True)], [("t", True), ("b", True)]):
        by = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
        want = df.select("id", (F.row_number().over(Window.partitionBy("k").orderBy(*by)) - 1).alias("rank"))
        want = {r.id: r["rank"] for r in want.collect()}
        for first in (None, 3):
            got = {r.id: r["rank"] for r in V.rank_within(df, "k", order, first=first).select("id", "rank").collect()}
            assert got == {i: n for i, n in want.items() if first is None or n < first}, (order, first)
        assert with_slices(df, order).groupBy("_slice").count().agg(F.max("count")).first()[0] < 20_000 / 20, order


def test_the_number_of_points_follows_the_rows():
    from capstream.operators.ranking import MOST_POINTS, SLICE_ROWS, n_points
    assert n_points(0) == n_points(1000) < n_points(1000 * SLICE_ROWS) == 1000 and n_points(10**13) == MOST_POINTS


def test_ranks_without_keys_and_of_other_types(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("id"), F.array(F.lit(1), F.col("id")).alias("a"))
    assert [(r.id, r["rank"]) for r in V.rank_within(df, (), [("id", True)]).orderBy("rank").collect()] == [(i, i) for i in range(500)]
    assert [r.id for r in V.rank_within(df, (), [("id", True)], first=4).orderBy("rank").collect()] == [0, 1, 2, 3]
    assert [r.a[1] for r in V.rank_within(df, (), [("a", False)]).orderBy("rank").limit(3).collect()] == [499, 498, 497]
    same = spark.range(300).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    assert sorted(r["rank"] for r in V.rank_within(same, "k", [("v", True)]).collect()) == list(range(300))


def test_ranks_and_top_n_of_a_hot_key(spark):
    from pyspark.sql import Window
    df = _one_hot_key(spark)
    for up in (True, False):
        order = [F.col(c).asc() if up else F.col(c).desc() for c in ("score", "member")]
        # rows equal in the whole order may swap ranks: compare the values at each rank
        want = df.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)) - 1).select("score", "member", "rank")
        for first in (None, 1, 50_000):
            got = V.rank_within(df, "key", [("score", up), ("member", up)], first=first, points=63).select("score", "member", "rank")
            w = want if first is None else want.where(F.col("rank") < first)
            assert got.exceptAll(w).count() == 0 and w.exceptAll(got).count() == 0


def test_rank_without_slices_or_rows(spark):
    df = spark.createDataFrame([("a", b"x"), ("a", b"y"), (None, b"z")], "key string, v binary")
    got = {(r.key, bytes(r.v)): r["rank"] for r in V.rank_within(df, "key", [("v", False)]).collect()}
    assert got == {("a", b"y"): 0, ("a", b"x"): 1, (None, b"z"): 0}
    assert V.rank_within(df.limit(0), "key", [("key", True)], size="n").collect() == []


def test_range_entries_unbounded_per_key_is_sorted(spark):
    df = spark.createDataFrame([("k", dt.datetime(2024, 1, 1, h)) for h in (3, 1, 2)], "key string, ts timestamp_ntz")
    assert [r.ts.hour for r in V.range_entries(df, "ts", keys=("key",)).collect()] == [1, 2, 3]
    assert [r.ts.hour for r in V.range_entries(df, "ts", keys=("key",), reverse=True).collect()] == [3, 2, 1]


def test_zrange_keeps_null_keyed_sets(spark):
    z = spark.createDataFrame([(None, "m1", 1.0), (None, "m2", 2.0), (None, "m3", 3.0), ("k", "a", 1.0),
                               ("k", "b", 2.0)], "key string, member string, score double")
    for lo, hi in ((0, 1), (0, -1), (-2, -1)):
        keys = {r.key for r in V.zrange(z, lo, hi).collect()}
        assert keys == {None, "k"}, (lo, hi)
    mixed = sorted((r.key or "", r.member, r.rank) for r in V.zrange(z, 1, -1).collect())
    assert mixed == [("", "m2", 1), ("", "m3", 2), ("k", "b", 1)]
