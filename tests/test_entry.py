"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as e


def test_entry_runs_flagship_on_smallest_tables(spark):
    df = e.entry(spark)
    assert df.columns == ["postgres_clerk", "postgres_purchase_count", "postgres_purchase_sum"]
    rows = df.collect()
    assert len(rows) >= 1 and any(r.postgres_clerk is None and r.postgres_purchase_count == 0 for r in rows)


def test_queries_and_oracles_line_up():
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
    # the numbered operators and the pipeline come with the optional subpackage alone
    assert {n for n in q if n.startswith("op") or n == "pipeline"} == set(e.LLM_QUERIES)


def test_cluster_conf_fills_only_unset_settings(spark):
    from capstream.session import CLUSTER_CONF, apply_cluster_conf
    given = spark.sparkContext.getConf()
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        apply_cluster_conf(spark, {key: "64m"})
        assert spark.conf.get(key) == (before if given.contains(key) else "64m")
    finally:
        spark.conf.set(key, before)
    assert "spark.sql.shuffle.partitions" not in CLUSTER_CONF  # streaming state is sized per job
