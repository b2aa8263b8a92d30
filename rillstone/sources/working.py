"""Working tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where the session names none and driver and executors are one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="rillstone-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def _place(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder, files = _place(spark, path)
    files.deleteOnExit(folder)  # when the driver ends, whatever it held here is of no more use
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rillstone_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that keep() wrote and that nothing reads any more."""
    path = getattr(df, "_rillstone_path", None)
    if path:
        folder, files = _place(df.sparkSession, path)
        files.delete(folder, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished work.

    Its event queues hold on to the last query, so one that shuffles nothing comes after it; then unreachable
    shuffles are found by the collectors of both sides.
    """
    spark.sql("select 1").collect()
    gc.collect()
    spark._jvm.System.gc()
