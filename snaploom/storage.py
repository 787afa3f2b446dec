"""Intermediate tables in the folder that all executors share.

The folder is the one named by ``spark.checkpoint.dir``. Only a local session
may do without that setting; it then gets a folder of its own, once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a fresh temporary one for local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="snaploom-"))
    return spark.conf.get("spark.checkpoint.dir")


def run_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/snaploom/{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_snaploom_run_dir", None) != path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        spark.sparkContext._snaploom_run_dir = path
    return path


def new_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: its lineage ends there."""
    path = path or new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._snaploom_path = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame | None) -> None:
    """Deletes the files of a table made by ``saved`` that nothing reads any more."""
    path = getattr(df, "_snaploom_path", None)
    if path is not None:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
