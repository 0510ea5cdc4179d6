"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where that is unset, in a
    local session as in tests, a temporary folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not set_dir.isDefined():
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wayfare-"))
            set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_dir.get()
    return root.rstrip("/")


_RUNS: list[Scratch] = []


def _clean() -> None:
    """Remove the tables of this process when it ends; results that are still wanted have been written elsewhere by then."""
    for run in _RUNS:
        with contextlib.suppress(Exception):  # the JVM may be gone
            run.drop("")
    _RUNS.clear()


class Scratch:
    """Intermediate tables of one operator run.

    They last as long as the application, since results may still read them.

    Written Parquet cuts lineage, survives lost executors and is evaluated
    once however often it is read.  ``drop`` removes a table that nothing
    reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._hadoop = spark._jsc.hadoopConfiguration()
        if not _RUNS:
            atexit.register(_clean)
        _RUNS.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.get(name, df.schema)

    def get(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self._hadoop).delete(path, True)
