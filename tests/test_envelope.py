"""Parsing the change envelope: golden message and the semantics table."""

import json

from pyspark.sql import functions as F

from capstream.functions.parse import (envelope_meta, parse_envelope, parse_events, reparse_before,
                                       schema_fields)
from capstream.functions.shape import hash_rows_for, notification_for
from capstream.operators.aggregate import clerk_totals
from capstream.sources.source import POSTGRES
from capstream.plans.envelopes import schema_block, to_envelope

# One full change message of the captured customer table.
GOLDEN_AFTER = {"id": 2, "name": "User5179", "age": 55, "email": "user4206@example.com",
                "purchase": 59362811, "timestamp": 1737461631000000, "store": "S1",
                "clerk": "Clerk A1"}
GOLDEN_SOURCE = {"version": "3.0.0.Final", "connector": "postgresql", "name": "postgrestopic",
                 "ts_ms": 1737449052126, "snapshot": "true", "db": "postgres",
                 "sequence": "[null,\"23181864\"]", "ts_us": 1737449052126918,
                 "ts_ns": 1737449052126918000, "schema": "public", "table": "customer",
                 "txId": 746, "lsn": 23181864, "xmin": None}


def message(after=GOLDEN_AFTER, op="r", before=None, source=GOLDEN_SOURCE):
    payload = {"before": before, "after": after, "source": source, "transaction": None, "op": op,
               "ts_ms": 1737449052430, "ts_us": 1737449052430080, "ts_ns": 1737449052430080050}
    return '{"schema":' + schema_block(POSTGRES) + ',"payload":' + json.dumps(payload) + "}"


def kafka_rows(spark, texts):
    return spark.createDataFrame([(None if t is None else bytearray(t.encode()),) for t in texts],
                                 "value binary")


def test_golden_message(spark):
    ev = parse_events(kafka_rows(spark, [message()]), "postgres").collect()
    assert [tuple(r) for r in ev] == [(59362811, "Clerk A1", "S1", "User5179")]
    meta = envelope_meta(parse_envelope(kafka_rows(spark, [message()]))).first()
    assert meta.op == "r" and meta.lsn == 23181864 and meta.tx_id == 746 and meta.snapshot == "true"
    assert meta.before is None


def test_schema_fields_listed(spark):
    f = schema_fields(parse_envelope(kafka_rows(spark, [message()])))
    rows = {(r.parent_field, r.field): r for r in f.collect()}
    assert rows[("after", "timestamp")].logical_name == "io.debezium.time.MicroTimestamp"
    assert rows[("source", "snapshot")].allowed == "true,last,false,incremental"
    assert rows[("after", "id")].optional == "false" and rows[("after", "id")].default_value == "0"
    assert rows[("op", None)].parent_type == "string"


def _totals(spark, texts, metrics=("count", "sum")):
    ev = parse_events(kafka_rows(spark, texts), "postgres")
    return {r[0]: tuple(r[1:]) for r in clerk_totals(ev, "postgres", metrics).collect()}


def test_s1_every_op_counts_updates_twice(spark):
    a = dict(GOLDEN_AFTER)
    t = _totals(spark, [message(op="c"), message(op="r"), message(op="u", before=a)])
    assert t == {"Clerk A1": (3, 3 * 59362811)}


def test_s2_s3_delete_tombstone_junk_form_null_group(spark):
    t = _totals(spark, [message(after=None, op="d", before=GOLDEN_AFTER), None, "not json", message()])
    assert t[None] == (0, None)
    assert t["Clerk A1"] == (1, 59362811)


def test_s4_s5_wrong_type_nulls_one_field(spark):
    bad = dict(GOLDEN_AFTER, purchase="str")
    ev = parse_events(kafka_rows(spark, [message(after=bad)]), "postgres").first()
    assert ev.postgres_purchase is None and ev.postgres_clerk == "Clerk A1"
    t = _totals(spark, [message(after=bad)])
    assert t == {"Clerk A1": (0, None)}


def test_update_keeps_before_as_text(spark):
    old = dict(GOLDEN_AFTER, purchase=10)
    meta = envelope_meta(parse_envelope(kafka_rows(spark, [message(op="u", before=old)])))
    r = meta.select("before", reparse_before("before").getField("purchase").alias("p")).first()
    assert r.before.startswith("{") and r.p == 10


def test_s6_notification_drops_null_members(spark):
    ev = parse_events(kafka_rows(spark, [message(after=None, op="d"), message()]), "postgres")
    n = {r.key: json.loads(r.value) for r in
         notification_for(clerk_totals(ev, "postgres", ("count", "sum")), "postgres").collect()}
    assert n[None] == {"postgres_purchase_count": 0}
    assert n["Clerk A1"] == {"postgres_clerk": "Clerk A1", "postgres_purchase_count": 1,
                                   "postgres_purchase_sum": 59362811}


def test_s7_sums_are_bigint(spark):
    big = dict(GOLDEN_AFTER, purchase=100_000_000)
    t = _totals(spark, [message(after=big)] * 50)
    assert t["Clerk A1"] == (50, 5_000_000_000)


def test_s8_hash_rows_null_key(spark):
    ev = parse_events(kafka_rows(spark, [message(after=None, op="d"), message()]), "mysql")
    totals = clerk_totals(ev, "mysql", ("count", "sum"))
    default = {r.hash_key: r.fields for r in hash_rows_for(totals, "mysql").collect()}
    assert default == {"Mysql:Clerk A1": {"Count": "1", "Sum": "59362811"}}
    compat = {r.hash_key: r.fields for r in hash_rows_for(totals, "mysql", null_key="None").collect()}
    assert compat["Mysql:None"] == {"Count": "0", "Sum": "None"}


def test_to_envelope_roundtrip(spark):
    rows = spark.createDataFrame(
        [(1, "n1", 20, "e", 100, 1_000_000, "S1", "A1", "c"), (2, "n2", 30, "e", 200, 2_000_000, "S2", "A2", "d"),
         (3, "n3", 40, "e", 300, 3_000_000, "S1", "A1", "u")],
        "id long, name string, age long, email string, purchase long, timestamp long, store string, "
        "clerk string, op string")
    msgs = to_envelope(rows, POSTGRES)
    assert msgs.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    p = parse_envelope(msgs)
    got = {r.op: (r.after_clerk, r.before_id) for r in p.select(
        F.col("data.payload.op").alias("op"), F.col("data.payload.after.clerk").alias("after_clerk"),
        reparse_before(F.col("data.payload.before")).getField("id").alias("before_id")).collect()}
    assert got == {"c": ("A1", None), "d": (None, 2), "u": ("A1", 3)}
    assert {r.topic for r in msgs.select("topic").collect()} == {"postgrestopic.public.customer"}


def test_event_time_units(spark):
    from capstream.functions.parse import event_time
    df = spark.createDataFrame([(1737461631000000,)], "t long")
    r = df.select(event_time("t", "micros", ntz=True).alias("a"),
                  event_time(F.col("t") / 1000, "millis", ntz=True).alias("b")).first()
    assert str(r.a) == "2025-01-21 12:13:51" and r.a == r.b


def test_after_image_then_project_equals_one_step_parse(spark):
    from capstream.functions.parse import after_image, project_event
    rows = kafka_rows(spark, [message(), message(after=None, op="d"), "junk"])
    two = project_event(after_image(parse_envelope(rows)), "postgres").collect()
    one = parse_events(rows, "postgres").collect()
    assert sorted(map(tuple, two), key=str) == sorted(map(tuple, one), key=str)


def test_hash_writer_pipelines_per_partition(spark):
    from capstream.streaming.sinks import HashWriter

    class FakePipe:
        calls = []

        def hset(self, k, mapping):
            FakePipe.calls.append((k, mapping))

        def execute(self):
            pass

    class FakeClient:
        def pipeline(self, transaction=False):
            return FakePipe()

    w = HashWriter()
    w.client = lambda: FakeClient()
    rows = [{"hash_key": "Mysql:A", "fields": {"Count": "1", "Sum": None}}, {"hash_key": "Mysql:B", "fields": {}}]
    w.partition_writer()(iter(rows))
    assert FakePipe.calls == [("Mysql:A", {"Count": "1"})]


def test_event_time_accepts_fractional_seconds(spark):
    from capstream.functions.parse import event_time
    r = spark.createDataFrame([(1.5,), (1.001,)], "s double").select(
        event_time("s", "seconds", ntz=True).alias("t")).collect()
    assert [str(x.t) for x in r] == ["1970-01-01 00:00:01.500000", "1970-01-01 00:00:01.001000"]
