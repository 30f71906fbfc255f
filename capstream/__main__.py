"""Run the change-stream jobs from the command line (or as a spark-submit main program).

    python -m capstream console  --bootstrap kafka:9092
    python -m capstream notify   --bootstrap kafka:9092 --checkpoint s3://bucket/ck
    python -m capstream hash     --bootstrap kafka:9092 --checkpoint s3://bucket/ck --redis-host redis
    python -m capstream jdbc     --bootstrap kafka:9092 --checkpoint s3://bucket/ck \\
                                 --jdbc-url jdbc:postgresql://db:5432/dump --jdbc-user u --jdbc-password-env PGPASS
    python -m capstream hash     --source-kind files --path postgres=/data/replay/pg --path mysql=/data/replay/my \\
                                 --store-path /data/hash --checkpoint /data/ck --trigger available_now

Each job starts one query per source (two for ``console``) and waits on all of
them; the first failure stops the rest. ``--sources`` picks which captured
databases to read (default both). Credentials are read from environment
variables, never from the command line.
"""

from __future__ import annotations

import argparse
import os
import sys

from capstream.sources.source import MYSQL, POSTGRES, CdcSource
from capstream.streaming import runner, sinks

KNOWN = {"postgres": POSTGRES, "mysql": MYSQL}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="capstream", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=["console", "notify", "hash", "jdbc"])
    p.add_argument("--sources", default="postgres,mysql")
    p.add_argument("--source-kind", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--path", action="append", default=[], help="name=folder of a replay source (files kind)")
    p.add_argument("--starting-offsets")
    p.add_argument("--tolerate-data-loss", action="store_true", help="failOnDataLoss=false")
    p.add_argument("--max-offsets-per-trigger", type=int, help="most messages of a topic in one micro-batch")
    p.add_argument("--min-partitions", type=int, help="tasks to split a topic's offsets over, at least")
    p.add_argument("--max-files-per-trigger", type=int, help="most replay files in one micro-batch")
    p.add_argument("--checkpoint", help="checkpoint root (default: spark.checkpoint.dir)")
    p.add_argument("--trigger", help="'available_now', 'once' or an interval such as '30 seconds'")
    p.add_argument("--mode", default="complete", help="output mode of the notification job")
    p.add_argument("--redis-host")
    p.add_argument("--redis-port", type=int, default=6379)
    p.add_argument("--store-path", help="keep the hash store as a table here instead of Redis")
    p.add_argument("--null-key", help="text for a NULL clerk in hash keys (default: skip)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="environment variable holding the JDBC password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--not-idempotent", action="store_true", help="plain appends (replays can duplicate rows)")
    p.add_argument("--rocksdb", action="store_true",
                   help="force the RocksDB state store (already the default unless the deployment sets a provider)")
    p.add_argument("--state-partitions", type=int, default=16,
                   help="state stores per aggregate (fixed at the first start of a checkpoint)")
    return p.parse_args(argv)


def build_sources(a: argparse.Namespace) -> list[CdcSource]:
    paths = dict(kv.split("=", 1) for kv in a.path)
    out = []
    for name in [s.strip() for s in a.sources.split(",") if s.strip()]:
        base = KNOWN[name]
        if a.source_kind == "kafka":
            out.append(base.with_(kind="kafka", bootstrap_servers=a.bootstrap, starting_offsets=a.starting_offsets,
                                  fail_on_data_loss=not a.tolerate_data_loss,
                                  max_offsets_per_trigger=a.max_offsets_per_trigger, min_partitions=a.min_partitions))
        else:
            out.append(base.with_(kind="files", path=paths[name], max_files_per_trigger=a.max_files_per_trigger))
    return out


def _trigger(a: argparse.Namespace, default: str | None) -> str | None:
    return a.trigger if a.trigger else default


def start(spark, a: argparse.Namespace) -> list:
    from capstream.session import shared_root
    srcs = build_sources(a)
    ck = a.checkpoint or f"{shared_root(spark)}/capstream-jobs"
    if a.rocksdb:
        runner.use_rocksdb(spark)
    sp = a.state_partitions
    if a.job == "console":
        return runner.console_job(spark, srcs, ck, trigger_totals=_trigger(a, runner.TRIGGER_TOTALS),
                                  trigger_events=_trigger(a, runner.TRIGGER_EVENTS), state_partitions=sp)
    if a.job == "notify":
        return runner.notification_job(spark, srcs, a.bootstrap, ck, mode=a.mode, trigger=_trigger(a, None),
                                       state_partitions=sp)
    if a.job == "hash":
        if a.store_path:
            def writer_for(name: str):
                return sinks.TableHashWriter(f"{a.store_path.rstrip('/')}/{name}")
        else:
            def writer_for(name: str):
                return sinks.RedisHashWriter(a.redis_host, a.redis_port)
        return runner.hash_store_job(spark, srcs, writer_for, ck, trigger=_trigger(a, runner.TRIGGER_STORES),
                                     null_key=a.null_key, state_partitions=sp)
    props = {"user": a.jdbc_user or ""}
    if a.jdbc_password_env:
        props["password"] = os.environ.get(a.jdbc_password_env, "")
    if a.jdbc_driver:
        props["driver"] = a.jdbc_driver
    return runner.jdbc_dump_job(spark, srcs, a.jdbc_url, props, ck, trigger=_trigger(a, runner.TRIGGER_STORES),
                                idempotent=not a.not_idempotent)


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession
    a = parse_args(sys.argv[1:] if argv is None else argv)
    from capstream.session import apply_cluster_conf
    spark = SparkSession.builder.appName(f"capstream-{a.job}").getOrCreate()
    apply_cluster_conf(spark)
    runner.run(spark, start(spark, a))
    return 0


if __name__ == "__main__":
    sys.exit(main())
