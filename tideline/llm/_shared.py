"""What operators need of the cluster: a shared folder, tables written there, and small Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch sent to a Python worker, so that rows of very long texts don't add up.
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. Where it is unset a session on one machine, as in tests, gets a local one; a cluster gets an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tideline-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


class Scratch:
    """Tables of an operator in the shared folder, as Parquet: written once, and read without any executor's help.

    As a context manager it deletes them at the end, but for those of keep(), which what the operator returns still
    reads: they go when the driver's process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.kept = spark, f"{shared_folder(spark).rstrip('/')}/tideline-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/work/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing will read again."""
        for t in tables:
            delete(self.spark, self.paths.pop(id(t)))

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/kept/{uuid.uuid4().hex}"
        fs, where = _path(self.spark, self.folder)
        fs.deleteOnExit(where)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        delete(self.spark, f"{self.folder}/work")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed now and written to the shared folder: later reads don't depend on any executor."""
    return Scratch(df.sparkSession).keep(df)


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """df.mapInArrow in batches of at most about BATCH_BYTES."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)
