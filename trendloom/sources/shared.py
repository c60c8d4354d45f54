"""The folder that driver and executors share, and results stored in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a session of one process may go without, a cluster may not."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write(spark: SparkSession, rows: DataFrameWriter, path: str) -> None:
    """Writes Parquet files.  Spark removes the shuffle files of a plan once the driver has collected it, and only then: else those of all steps stand beside each other."""
    rows.option("compression", "zstd").parquet(path)
    spark._jvm.System.gc()


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Written once and read back, so that several results share it and a lost executor repeats nothing before it."""
    path = path or new_folder(df.sparkSession, "stored")
    write(df.sparkSession, df.write.mode("overwrite"), path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A path of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._store = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._store.exists(self._at)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._store.listStatus(self._at)) if self.exists() else []

    def delete(self) -> None:
        self._store.delete(self._at, True)
