"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which goes when the driver's process ends. Where that is unset a session on one machine, as in tests, gets a local one; a cluster gets an error."""
    base, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not base:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file:{tempfile.mkdtemp(prefix='tideline-')}"
    folder = f"{base.rstrip('/')}/tideline-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The same rows, computed now, once, and read from the shared folder: what reads them needs no executor's help."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
