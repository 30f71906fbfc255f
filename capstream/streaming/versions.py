"""A folder of batches: one sub-folder per run and epoch, each written whole.

``run`` counts the starts of writers on the folder (one more than any run found
there), ``epoch`` is the micro-batch. A replayed epoch overwrites its own
folder or lands in a later run, so (run, epoch) orders everything written, also
after a checkpoint was recreated and epochs began at 0 again. Readers take only
folders that the writer's commit marked as complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedFolder:
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self._run: int | None = None

    def _fs(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, spark: SparkSession, path: str) -> list[str]:
        p, fs = self._fs(spark, path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def complete(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(run, epoch) of every complete folder, ascending (folder names only are read)."""
        out = []
        for run in self._names(spark, self.path):
            if run.startswith("run="):
                for epoch in self._names(spark, f"{self.path}/{run}"):
                    if epoch.startswith("epoch=") and "_SUCCESS" in self._names(spark, f"{self.path}/{run}/{epoch}"):
                        out.append((int(run[4:]), int(epoch[6:])))
        return sorted(out)

    def folder(self, run: int, epoch: int) -> str:
        return f"{self.path}/run={run}/epoch={epoch}"

    def begin(self, spark: SparkSession) -> int:
        """This writer's run: one more than any on the folder when it first writes."""
        if self._run is None:
            runs = [int(n[4:]) for n in self._names(spark, self.path) if n.startswith("run=")]
            self._run = max(runs, default=0) + 1
        return self._run

    def write(self, rows: DataFrame, epoch_id: int) -> None:
        spark = rows.sparkSession
        path = self.folder(self.begin(spark), epoch_id)
        rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
        if "_SUCCESS" not in self._names(spark, path):
            raise RuntimeError(f"{path}: the committer marks no complete folders, so nothing here could ever be read")

    def read(self, spark: SparkSession, versions: list[tuple[int, int]] | None = None) -> DataFrame:
        """Rows of the complete folders with their ``run`` and ``epoch``."""
        found = self.complete(spark) if versions is None else versions
        if not found:
            raise FileNotFoundError(f"nothing complete under {self.path}")
        return spark.read.option("basePath", self.path).parquet(*[self.folder(*v) for v in found])

    def newest(self, spark: SparkSession) -> DataFrame:
        """Rows of the newest complete folder alone."""
        return self.read(spark, self.complete(spark)[-1:]).drop("run", "epoch")

    def delete(self, spark: SparkSession, versions: list[tuple[int, int]]) -> None:
        for v in versions:
            p, fs = self._fs(spark, self.folder(*v))
            fs.delete(p, True)
