"""What the operators of this package share: tables, the shared folder, text helpers for Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[str] = []

#: Rows of ``documents``; every pipeline stage but the last returns these columns.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor folder, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="relspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back, so lost executors cost one task at most."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            folder = name.split("/")[-2]
            for path in [p for p in _written if p.endswith(f"/{folder}")]:
                _written.remove(path)
                _delete(df.sparkSession, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written() -> int:
    """How many tables :func:`materialize` has left so far; a mark for :func:`release`."""
    return len(_written)


def release(docs: DataFrame, mark: int) -> None:
    """Delete tables written since ``mark`` that ``docs`` does not read: for steps whose results have been written whole."""
    read = {name.split("/")[-2] for name in docs.inputFiles()}
    for path in [p for p in _written[mark:] if p.rsplit("/", 1)[-1] not in read]:
        _written.remove(path)
        _delete(docs.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Delete what :func:`materialize` has written in this process; call it when no result needs it any more."""
    while _written:
        _delete(spark, _written.pop())


def parts(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """True for the fold kept from learning: crc32 of the id as text, remainder 0 by 5 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 20):
    """Zero-copy runs of rows whose texts hold about ``size`` bytes, so that work arrays stay small however long texts are."""
    lengths = [len(t) if t is not None else 0 for t in batch.column(column).to_pylist()]
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)
