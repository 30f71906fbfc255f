"""Exactly-once dump, against a stand-in for the database: task retries and driver crashes."""

import re

import pytest

from capstream.streaming import dump


class Crash(Exception):
    pass


class Tables:
    """Holds tables of row tuples and knows the three kinds of statement the sink sends."""

    def __init__(self):
        self.tables, self.crash, self.twice, self.partitions = {}, None, False, 0

    def write(self, df, name, mode):
        rows = [tuple(r) for r in df.collect()]
        self.partitions = df.rdd.getNumPartitions()
        if mode == "overwrite":
            self.tables[name] = (df.columns, [])
        self.tables.setdefault(name, (df.columns, []))[1].extend(rows)
        if self.twice and name.endswith("_staging"):  # a task committed its rows, was reported lost and ran again
            self.tables[name][1].extend(rows[:2])

    def execute(self, spark, sql, params):
        if self.crash == "before":
            raise Crash
        if m := re.match(r"DROP TABLE (\w+)", sql):
            del self.tables[m[1]]
            return
        target, staging = re.match(r"INSERT INTO (\w+) .* FROM (\w+)\) s", sql).groups()
        assert "SELECT DISTINCT" in sql and "NOT EXISTS" in sql and params[0] == params[1]
        if all(r[-1] != params[0] for r in self.tables[target][1]):
            self.tables[target][1].extend([(*r[:-1], params[0]) for r in sorted(set(self.tables[staging][1]), key=str)])
        if self.crash == "after":
            raise Crash


def sink(db, run="r", **kw):
    return dump.JdbcPublish("jdbc:x", "dumped", {}, run=run, execute=db.execute, table_exists=lambda s, n: n in db.tables, write=db.write, **kw)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(5, "a"), (5, "a"), (7, None)], "purchase long, clerk string").repartition(2)


def test_repeated_rows_stay_and_repeated_tasks_do_not(batch):
    db = Tables()
    db.twice = True
    body = sink(db, num_partitions=3)
    body(batch, 0)
    body(batch, 0)  # the epoch comes again
    body(batch, 1)
    body(batch.limit(0), 2)
    want = [(5, "a"), (5, "a"), (7, None)]
    for epoch in (0, 1):
        assert sorted((r[:2] for r in db.tables["dumped"][1] if r[2] == f"r:{epoch}"), key=str) == want
    assert len(db.tables["dumped"][1]) == 6 and set(db.tables) == {"dumped"} and db.partitions <= 3


@pytest.mark.parametrize("crash", ["before", "after"])
def test_driver_crash_around_publishing(batch, crash):
    db = Tables()
    db.crash = crash
    with pytest.raises(Crash):
        sink(db)(batch, 4)
    db.crash = None
    sink(db)(batch, 4)  # a new driver repeats the epoch
    assert sorted((r[0] for r in db.tables["dumped"][1])) == [5, 5, 7]
    sink(db, run="another")(batch, 4)  # a recreated checkpoint is another run
    assert len(db.tables["dumped"][1]) == 6


def test_rows_by_their_own_position(spark):
    db = Tables()
    rows = spark.createDataFrame([("t", 0, 1, "x"), ("t", 0, 1, "x"), ("t", 1, 1, "x")], "topic string, partition int, offset long, clerk string")
    sink(db, identity=("topic", "partition", "offset"))(rows, 0)
    assert db.tables["dumped"] == (["clerk", "_batch_key"], [("x", "r:0"), ("x", "r:0")])
    with pytest.raises(ValueError):
        dump.JdbcPublish("jdbc:x", "t", {})


def test_the_parse_keeps_the_sources_partitions(spark, sf, capsys):
    from capstream.functions.parse import parse_events
    from capstream.plans import standins as S
    from capstream.streaming import sinks
    events = parse_events(S.source_messages(spark, sf, "mysql").repartition(40), "mysql")
    sinks.JdbcAppend("jdbc:x", "t", {}, num_partitions=2, write=lambda df: df.explain())(events, 0)
    p = capsys.readouterr().out
    assert "Coalesce" not in p and p.index("RoundRobinPartitioning(2)") < p.index("from_json")
