"""Tables of one run in the shared checkpoint folder, deleted after use.

``Workspace.store`` cuts lineage by writing a Parquet table and reading it
back; unlike a checkpoint's files these are known by name and go when the run
ends, also in a session that never cleans checkpoints.  ``small`` keeps a
result of bounded size as rows of the driver; a caller checkpoints any other
before the workspace goes.
"""

from __future__ import annotations

import uuid

from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir


class Workspace:
    def __init__(self, spark: SparkSession, name: str = "work"):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.kept: list[RDD] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep(self, rdd: RDD) -> RDD:
        """``rdd``, made from stored tables, in the executors' memory (what does
        not fit, on their disks) until the workspace goes; the first pass fills it."""
        self.kept.append(rdd.persist(StorageLevel.MEMORY_AND_DISK_DESER))
        return rdd

    def delete(self, name: str | None = None) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        for rdd in self.kept:
            rdd.unpersist()
        self.delete()

    def small(self, df: DataFrame, bound: int = 100_000) -> DataFrame:
        """A result of at most ``bound`` rows, as rows of the driver, so that
        the workspace can go; more rows are an error, never cut off."""
        rows = df.limit(bound + 1).collect()
        if len(rows) > bound:
            raise ValueError(f"a result of more than {bound} rows is not small")
        return self.spark.createDataFrame(rows, df.schema)
