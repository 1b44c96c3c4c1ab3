"""Intermediate tables in the shared folder that the cluster names.

An intermediate result that several later steps read is written once as Parquet.
That cuts its lineage, survives the loss of any executor, and gives Spark the
table's true size, so the planner's own check decides what to broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a folder of its own;
    on a cluster a machine-local folder would not be seen by the other machines.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="recordlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Workspace:
    """Tables of one run, each written below the shared folder, or in a folder that stays."""

    def __init__(self, spark: SparkSession, purpose: str, folder: str | None = None) -> None:
        self.spark = spark
        own = f"recordlens/{purpose}-{uuid.uuid4().hex}"
        self.folder = f"{shared_folder(spark)}/{own}" if folder is None else folder.rstrip("/")
        self.names: set[str] = set()

    def _place(self, name: str) -> tuple[Any, Any]:
        """A table's path and the file system it lies in."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def holds(self, name: str) -> bool:
        """Whether a table of that name has been written whole, by whatever run."""
        path, files = self._place(f"{name}/_SUCCESS")
        return files.exists(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_and_observe(
        self, df: DataFrame, name: str, **measures: Column
    ) -> tuple[DataFrame, dict[str, Any]]:
        """As ``keep``, with aggregates of the rows taken in the job that writes them."""
        seen = Observation()
        columns = [m.alias(n) for n, m in measures.items()]
        kept = self.keep(df.observe(seen, *columns), name)
        try:
            return kept, seen.get
        except Py4JJavaError:
            # From a table that it knows to be empty Spark removes the observation, too.
            return kept, kept.agg(*columns).first().asDict()

    def forget(self, *names: str) -> None:
        """Remove tables that nothing reads any more; those never kept are skipped."""
        for name in self.names.intersection(names):
            path, files = self._place(name)
            files.delete(path, True)
            self.names.remove(name)

    def forget_all_but(self, *names: str) -> None:
        """Remove every table but these."""
        self.forget(*self.names.difference(names))
