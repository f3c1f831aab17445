"""The folder that driver and executors share, and files there that are replaced in one step."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, read from the session; where it is unset and Spark runs in one process, a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="relspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def replace_file(spark: SparkSession, name: str, text: str, fresh: str) -> None:
    """Write ``text`` beside ``name`` and put it in its place by one rename that overwrites: readers see the old or the new."""
    jvm = spark._jvm
    path, fs = _path(spark, name)
    beside = jvm.org.apache.hadoop.fs.Path(f"{name}.{fresh}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, path, options)
