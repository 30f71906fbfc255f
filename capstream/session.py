"""Session helpers: building a session for tests/bench and finding shared storage.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by
whoever runs the cluster). A machine-local folder is created only when that
setting is absent, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings we run with on a large cluster. ``apply_cluster_conf`` sets the ones
# the deployment has not set. AQE coalesces shuffle partitions to ~128 MB
# (parallelismFirst off so the advisory size wins), splits skewed join
# partitions; RocksDB keeps streaming state off-heap. Streaming queries do not
# use AQE: their state partition count is set per job (runner, state_partitions).
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",  # batch: start high, coalesce
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def apply_cluster_conf(spark: SparkSession, conf: dict[str, str] = CLUSTER_CONF) -> None:
    """Set each runtime SQL setting of ``conf`` that the deployment left unset."""
    given = spark.sparkContext.getConf()
    for k, v in conf.items():
        if not given.contains(k):
            spark.conf.set(k, v)


def build_session(master: str = "local[*]", app: str = "capstream", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``, else the folder given to
    ``setCheckpointDir`` (without the per-context suffix Spark adds). Only on
    a local master with neither set (tests, local runs) a local folder is
    made once per context; on a cluster that is an error, since executors
    could not read each other's local files.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root and current:
        root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _LOCAL_ROOTS.setdefault(id(sc), tempfile.mkdtemp(prefix="capstream-"))
    if not current:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root (never reused between runs)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder the caller made under the shared root."""
    root = shared_root(spark)
    if not path.startswith(root + "/"):
        raise ValueError(f"{path} is not under {root}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
