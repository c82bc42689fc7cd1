"""Written stages: tables that a run keeps in a folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; without it a temporary one, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return tempfile.mkdtemp(prefix="stages-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written below ``path`` and read back: whatever uses it afterwards reads files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        system.delete(folder, True)
