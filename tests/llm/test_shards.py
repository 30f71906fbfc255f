import pytest
from pyspark.sql import functions as F

from capstream.llm import queries, shards


def test_every_shard_holds_the_mixture(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", "x") for i in range(5000)] + [(None, None, None)] * 3 + [(9, "hot", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, shard string")
    got = shards.interleave_shards(df, 16, seed=1, buckets=64).toPandas()
    assert len(got) == len(rows) and list(got.columns) == ["doc_id", "source", "shard", "slot"]
    size = got.groupby("shard").size()
    assert list(size.index) == list(range(16)) and size.max() - size.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    for _, g in got.groupby("source"):
        if len(g) > 16:
            n = g.groupby("shard").size()
            assert n.max() - n.min() <= 2 and len(n) == 16
    again = shards.interleave_shards(df.repartition(7), 16, seed=1, buckets=64).toPandas()
    key = lambda p: sorted(map(str, p.itertuples(index=False)))
    assert key(got) == key(again)
    other = shards.interleave_shards(df, 16, seed=2, buckets=64).toPandas()
    assert key(got) != key(other)


def test_order_is_fractional_rank(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "a").otherwise("b").alias("source"))
    got = shards.interleave_shards(df, 1, buckets=8).orderBy("slot").toPandas()
    for at in range(0, 300, 30):  # every stretch of the order holds a third of "a"
        assert abs((got.source[at:at + 30] == "a").sum() - 10) <= 1


def test_any_column_is_carried(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.create_map(F.lit("a"), "id").alias("m"), F.array("id").alias("a"))
    got = shards.interleave_shards(df, 4).collect()
    assert sorted(r.m["a"] for r in got) == list(range(40)) and {r.shard for r in got} == {0, 1, 2, 3}


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(i, None) for i in range(n)], "doc_id long, source string")
    got = shards.interleave_shards(df, 16).collect()
    assert len(got) == n and len({r.shard for r in got}) == n and all(r.slot == 0 for r in got)


def test_written_shards(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    shards.write_shards(shards.interleave_shards(df, 4), str(tmp_path / "out"))
    assert {r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()} == {25}


def test_query(spark, sf):
    import zlib
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op1(spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs.items()}
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_clashing_names_and_many_rows_without_an_id(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.col("id").alias("a.b"), F.lit("x").alias("Shard"), F.lit("y").alias("SLOT"))
    got = shards.interleave_shards(df, 16, seed=3, buckets=64)
    assert got.columns == ["doc_id", "source", "a.b", "shard", "slot"]
    rows = got.collect()
    assert sorted(r["a.b"] for r in rows) == list(range(4000)) and len({(r.shard, r.slot) for r in rows}) == 4000
    assert [r["a.b"] for r in sorted(rows, key=lambda r: (r.shard, r.slot))] != sorted(r["a.b"] for r in rows)
