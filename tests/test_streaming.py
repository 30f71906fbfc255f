"""Streams equal batch; restart from a checkpoint; sinks; lifecycle."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from capstream.functions.parse import parse_events
from capstream.functions.shape import HASH_PREFIX
from capstream.operators.aggregate import clerk_totals
from capstream.plans import standins as S
from capstream.sources.source import MYSQL, POSTGRES
from capstream.sources.kafka import cdc_source, kafka_options, write_replay
from capstream.streaming import sinks
from capstream.streaming.runner import progress_summary, run, shared_job


def _replay(spark, sf, prefix, files=4):
    path = tempfile.mkdtemp(prefix="replay-") + "/msgs"
    write_replay(S.source_messages(spark, sf, prefix), path, files)
    src, _ = S.SOURCES[prefix]
    return src.with_(kind="files", path=path, max_files_per_trigger=1)


def _batch_totals(spark, sf, prefix):
    ev = parse_events(S.source_messages(spark, sf, prefix), prefix)
    return {r[0]: tuple(r[1:]) for r in clerk_totals(ev, prefix, ("count", "sum")).collect()}


def test_stream_update_equals_batch(spark, sf):
    src = _replay(spark, sf, "mysql")
    assert len([f for f in os.listdir(src.path) if f.endswith(".parquet")]) == 4
    writer = sinks.TableHashWriter(tempfile.mkdtemp() + "/hash")
    totals = clerk_totals(parse_events(cdc_source(spark, src), "mysql"), "mysql", ("count", "sum"))
    q = sinks.sink_keyed_upsert(totals, writer, "mysql", tempfile.mkdtemp() + "/ck", trigger="available_now")
    run(spark, [q])
    assert progress_summary(q)["batches"] >= 4  # state carried over several batches
    got = {r.hash_key: (int(r.fields["Count"]), int(r.fields["Sum"])) for r in writer.read(spark).collect()}
    want = {f"Mysql:{k}": v for k, v in _batch_totals(spark, sf, "mysql").items() if k is not None}
    assert got == want


def test_restart_from_checkpoint(spark, sf):
    src = _replay(spark, sf, "postgres")
    ck = tempfile.mkdtemp() + "/ck"
    out = tempfile.mkdtemp() + "/out"
    def start(s):
        totals = clerk_totals(parse_events(cdc_source(spark, s), "postgres"), "postgres", ("count", "sum"))
        return sinks.sink_snapshot(totals, out, ck, trigger="available_now")
    # first run sees only the first file
    files = sorted(f for f in os.listdir(src.path) if f.endswith(".parquet"))
    first = tempfile.mkdtemp() + "/part"
    os.makedirs(first)
    os.link(os.path.join(src.path, files[0]), os.path.join(first, files[0]))
    run(spark, [start(src.with_(path=first))])
    partial = sinks.read_snapshot(spark, out).agg(F.sum("postgres_purchase_count")).first()[0]
    # the rest arrive later, the query restarts on the same checkpoint
    for f in files[1:]:
        os.link(os.path.join(src.path, f), os.path.join(first, f))
    run(spark, [start(src.with_(path=first))])
    got = {r[0]: tuple(r[1:]) for r in sinks.read_snapshot(spark, out).collect()}
    assert got == _batch_totals(spark, sf, "postgres")
    assert len(sinks.VersionedFolder(out).complete(spark)) <= 2  # older versions are gone
    assert partial < sum(v[0] for v in got.values())


def test_jdbc_append_idempotent_replay(spark):
    calls, written = [], []
    tables = set()

    def write(df):
        tables.add("dumped")
        written.append(sorted(tuple(r) for r in df.collect()))

    body = sinks.JdbcAppend("jdbc:test", "dumped", {"user": "u"}, idempotent=True, run="run-a",
                            execute=lambda s, sql, params: calls.append((sql, params)),
                            table_exists=lambda s: "dumped" in tables, write=write)
    batch = spark.createDataFrame([(1, "A"), (2, "B")], "postgres_purchase long, postgres_clerk string")
    body(batch, 7)  # first batch: the table does not exist yet, nothing to delete
    body(batch, 7)  # replay of the same epoch
    assert calls == [("DELETE FROM dumped WHERE _batch_key = ?", ("run-a:7",))]
    assert written[0] == [(1, "A", "run-a:7"), (2, "B", "run-a:7")] == written[1]
    # a recreated checkpoint (new run id, epochs restart at 0) never touches run-a's rows
    other = sinks.JdbcAppend("jdbc:test", "dumped", {}, idempotent=True, run="run-b",
                             execute=lambda s, sql, params: calls.append((sql, params)),
                             table_exists=lambda s: True, write=lambda df: None)
    other(batch, 7)
    assert calls[-1] == ("DELETE FROM dumped WHERE _batch_key = ?", ("run-b:7",))
    # only the first batch after a start, or one that comes again, can have rows to delete
    other(batch, 8)
    other(batch, 9)
    assert len(calls) == 2
    other(batch, 9)
    assert calls[-1] == ("DELETE FROM dumped WHERE _batch_key = ?", ("run-b:9",))


def test_hash_store_survives_replays_and_a_new_checkpoint(spark):
    path = tempfile.mkdtemp() + "/hash"
    def batch(**kv):
        return spark.createDataFrame([(k, {"Count": v}) for k, v in kv.items()], "hash_key string, fields map<string,string>")
    def now():
        return {r.hash_key: r.fields["Count"] for r in sinks.TableHashWriter(path).read(spark).collect()}
    old = sinks.TableHashWriter(path)
    old.write_batch(batch(a="50", b="7"), 7)
    old.write_batch(batch(a="50", b="7"), 7)  # the epoch comes again
    assert now() == {"a": "50", "b": "7"}
    new = sinks.TableHashWriter(path, compact_every=3)  # a recreated checkpoint begins at epoch 0
    new.write_batch(batch(a="99"), 0)
    assert now() == {"a": "99", "b": "7"}
    new.write_batch(batch(c="1"), 1)  # third folder: compacted
    assert now() == {"a": "99", "b": "7", "c": "1"}
    listed = sinks.VersionedFolder(path).complete(spark)  # a reader that has listed the folders now
    for epoch in (2, 3):
        new.write_batch(batch(a="100"), epoch)
        assert now() == {"a": "100", "b": "7", "c": "1"}
    assert set(listed) <= set(sinks.VersionedFolder(path).complete(spark))
    new.write_batch(batch(a="101"), 4)  # the second compaction deletes what the first replaced
    kept = sinks.VersionedFolder(path).complete(spark)
    assert now() == {"a": "101", "b": "7", "c": "1"} and kept[0] == listed[-1] and len(kept) == 5


def test_replayed_epochs_do_not_duplicate_rows(spark):
    path = tempfile.mkdtemp() + "/rows"
    write, df = sinks.append_sink(path), spark.range(3)
    for epoch in (0, 1, 1):
        write(df, epoch)
    assert spark.read.parquet(path).drop("epoch").count() == 6
    path = tempfile.mkdtemp() + "/runs"
    for run_id in ("first", "second"):  # a recreated checkpoint
        ck = tempfile.mkdtemp()
        with open(f"{ck}/metadata", "w") as f:
            f.write('{"id": "%s"}' % run_id)
        sinks.append_sink(path, ck)(df, 0)
    assert spark.read.parquet(path).groupBy("run").count().count() == 2 and spark.read.parquet(path).count() == 6


def test_snapshot_readers_see_only_complete_versions(spark):
    path = tempfile.mkdtemp() + "/snap"
    f = sinks.VersionedFolder(path)
    f.write(spark.range(2), 0)
    spark.range(9).write.parquet(f.folder(f.begin(spark), 1))
    os.remove(f.folder(f.begin(spark), 1) + "/_SUCCESS")  # a writer died before its commit
    assert sinks.read_snapshot(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, path + "-none")


def test_jdbc_run_id_comes_from_the_checkpoint(spark, sf):
    from capstream.streaming.sinks import checkpoint_run_id
    src = _replay(spark, sf, "postgres", files=2)
    ck = tempfile.mkdtemp() + "/ck"
    q = sinks.sink_files(parse_events(cdc_source(spark, src), "postgres"), tempfile.mkdtemp() + "/o", ck,
                         trigger="available_now")
    run(spark, [q])
    assert checkpoint_run_id(spark, ck) == q.id


def test_kafka_options_and_missing_broker():
    opts = kafka_options(POSTGRES.with_(bootstrap_servers="kafka:9092", fail_on_data_loss=False))
    assert opts == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "postgrestopic.public.customer",
                    "failOnDataLoss": "false"}
    with pytest.raises(ValueError):
        kafka_options(MYSQL)
    assert sinks.kafka_sink_options("notification-mysql", "k:1") == {
        "kafka.bootstrap.servers": "k:1", "topic": "notification-mysql"}


def test_trigger_kwargs():
    assert sinks.trigger_kwargs(None) == {}
    assert sinks.trigger_kwargs("available_now") == {"availableNow": True}
    assert sinks.trigger_kwargs("45 seconds") == {"processingTime": "45 seconds"}


def test_fan_out_writes_every_sink_once_per_batch(spark, sf):
    src = _replay(spark, sf, "postgres", files=3)
    ev_out, tot_out = tempfile.mkdtemp() + "/ev", tempfile.mkdtemp() + "/tot"
    writer = sinks.TableHashWriter(tot_out)
    qs = shared_job(spark, [src.with_(options={})], tempfile.mkdtemp(),
                    event_sinks={"postgres": [lambda b, e: b.write.mode("append").parquet(ev_out)]},
                    total_sinks={"postgres": [lambda b, e: writer.write_batch(
                        sinks.hash_rows_for(b, "postgres"), e)]},
                    trigger="available_now")
    run(spark, qs)
    n_events = S.source_messages(spark, sf, "postgres").count()
    assert spark.read.parquet(ev_out).count() == n_events
    got = {r.hash_key: int(r.fields["Count"]) for r in writer.read(spark).collect()}
    want = {f"Postgresql:{k}": v[0] for k, v in _batch_totals(spark, sf, "postgres").items() if k is not None}
    assert got == want


def test_run_raises_first_failure(spark):
    df = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    def boom(b, e):
        raise ValueError("sink failed")
    bad = df.writeStream.foreachBatch(boom).start()
    good = df.writeStream.format("noop").start()
    with pytest.raises(Exception):
        run(spark, [good, bad], timeout_s=60)
    assert not good.isActive and not bad.isActive


def test_console_sink_and_rocksdb_state(spark, sf):
    from capstream.streaming.runner import use_rocksdb
    src = _replay(spark, sf, "postgres", files=3)
    prev = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    use_rocksdb(spark)
    try:
        totals = clerk_totals(parse_events(cdc_source(spark, src), "postgres"), "postgres", ("count",))
        q = sinks.sink_console(totals, "complete", "available_now", checkpoint=tempfile.mkdtemp() + "/ck")
        run(spark, [q])
        summary = progress_summary(q)
        assert summary["batches"] >= 3 and summary["state_rows"] == len(_batch_totals(spark, sf, "postgres"))
    finally:
        if prev:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", prev)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_jobs_wire_sources_to_sinks(spark, sf):
    from capstream.streaming.runner import console_job, hash_store_job
    srcs = [_replay(spark, sf, "postgres", files=2), _replay(spark, sf, "mysql", files=2)]
    root = tempfile.mkdtemp()
    writers = {p: sinks.TableHashWriter(f"{root}/store-{p}") for p in ("postgres", "mysql")}
    qs = hash_store_job(spark, srcs, writers.__getitem__, root + "/ck", trigger="available_now")
    qs += console_job(spark, srcs, root + "/ck", trigger_totals="available_now", trigger_events="available_now")
    assert len(qs) == 6
    run(spark, qs)
    for p in ("postgres", "mysql"):
        got = {r.hash_key: int(r.fields["Sum"]) for r in writers[p].read(spark).collect()}
        want = {f"{HASH_PREFIX[p]}{k}": v[1] for k, v in _batch_totals(spark, sf, p).items() if k is not None}
        assert got == want


def test_sinks_require_checkpoints(spark):
    df = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        sinks.sink_kafka(df, "t", "k:1", checkpoint="")
    with pytest.raises(ValueError):
        sinks.sink_keyed_upsert(df, sinks.TableHashWriter("/nonexistent"), "mysql", checkpoint="")
    with pytest.raises(ValueError):
        sinks.sink_jdbc(df, "jdbc:x", "t", {}, checkpoint="")
    with pytest.raises(ValueError):
        sinks.JdbcAppend("jdbc:x", "t", {}, idempotent=True)


def test_jdbc_snapshot_options():
    from capstream.sources.jdbc import jdbc_snapshot

    class Reader:
        def jdbc(self, url, table, **kw):
            self.call = (url, table, kw)
            return "df"

    class FakeSpark:
        read = Reader()

    out = jdbc_snapshot(FakeSpark(), "jdbc:x", "customer", {"user": "u"}, num_partitions=16,
                        lower_bound=1, upper_bound=1000)
    url, table, kw = FakeSpark.read.call
    assert out == "df" and (url, table) == ("jdbc:x", "customer")
    assert kw["column"] == "id" and kw["numPartitions"] == 16 and (kw["lowerBound"], kw["upperBound"]) == (1, 1000)
    assert kw["properties"]["fetchsize"] == "10000" and kw["properties"]["user"] == "u"


def test_command_line_hash_job_on_replay_folders(spark, sf):
    from capstream.__main__ import build_sources, parse_args, start
    pg, my = _replay(spark, sf, "postgres", files=2), _replay(spark, sf, "mysql", files=2)
    store, ck = tempfile.mkdtemp() + "/store", tempfile.mkdtemp() + "/ck"
    a = parse_args(["hash", "--source-kind", "files", "--path", f"postgres={pg.path}", "--path", f"mysql={my.path}",
                    "--store-path", store, "--checkpoint", ck, "--trigger", "available_now"])
    assert [s.name for s in build_sources(a)] == ["postgres", "mysql"]
    run(spark, start(spark, a))
    got = {r.hash_key: int(r.fields["Count"]) for r in sinks.TableHashWriter(f"{store}/mysql").read(spark).collect()}
    want = {f"Mysql:{k}": v[0] for k, v in _batch_totals(spark, sf, "mysql").items() if k is not None}
    assert got == want


def test_command_line_kafka_options():
    from capstream.__main__ import build_sources, parse_args
    a = parse_args(["notify", "--bootstrap", "kafka:9092", "--sources", "mysql", "--tolerate-data-loss",
                    "--checkpoint", "/ck"])
    (s,) = build_sources(a)
    assert kafka_options(s) == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "mysqltopic.mariadb.customer",
                                "failOnDataLoss": "false"}
    a = parse_args(["notify", "--bootstrap", "k:1", "--sources", "mysql", "--max-offsets-per-trigger", "1000", "--min-partitions", "64"])
    opts = kafka_options(build_sources(a)[0])
    assert (opts["maxOffsetsPerTrigger"], opts["minPartitions"], opts["failOnDataLoss"]) == ("1000", "64", "true")


def test_missing_kafka_connector_is_reported_clearly(spark):
    src = POSTGRES.with_(bootstrap_servers="localhost:1")
    try:
        df = cdc_source(spark, src)
    except RuntimeError as e:
        assert "spark-sql-kafka" in str(e)
    else:  # connector present: the source resolves (nothing is started)
        assert "value" in df.columns


def test_state_partitions_apply_to_started_queries_only(spark, sf):
    from capstream.streaming.runner import state_partitions_for
    before = spark.conf.get("spark.sql.shuffle.partitions")
    src = _replay(spark, sf, "postgres", files=2)
    with state_partitions_for(spark, 3):
        totals = clerk_totals(parse_events(cdc_source(spark, src), "postgres"), "postgres", ("count",))
        q = sinks.sink_snapshot(totals, tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ck", "available_now")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    run(spark, [q])
    ops = q.lastProgress["stateOperators"]
    assert ops and ops[0]["numStateStoreInstances"] == 3


def test_replay_files_keep_little_of_the_schema_block(spark, sf, tmp_path):
    import pathlib

    from capstream.plans import standins as S
    from capstream.sources.kafka import write_replay
    messages = S.source_messages(spark, sf, "postgres")
    for rows in (None, messages.count()):
        path = write_replay(messages, str(tmp_path / f"replay-{rows}"), 4, rows=rows)
        back = spark.read.parquet(path)
        assert back.exceptAll(messages).isEmpty() and back.count() == messages.count()
        assert sum(p.stat().st_size for p in pathlib.Path(path).glob("*.parquet")) < 150 * messages.count()
