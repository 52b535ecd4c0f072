"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.session import ensure_checkpoint_dir

#: A word, as all contracts here state it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the checkpoint folder and read it back: later plans start
    from the files, so a lost executor repeats none of the work before them."""
    path = shared_folder(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def remove_written(df: DataFrame) -> None:
    """Remove the files of a frame that ``written`` gave, once what reads it is written."""
    files = df.inputFiles()
    if files:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, size: int = 1 << 20) -> AbstractContextManager[None]:
    """Jobs that run inside hand texts to Python in batches of so many bytes: a batch of
    long texts is bounded before a worker holds it."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs that run inside remove their shuffle files when they end. Else files stay until
    the driver's collector finds the plan unused, and a query of many jobs piles them up."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def text_of(name: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(name), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def source_partitions(spark: SparkSession, rows_per_task: int, rows: int) -> int:
    """Partitions for a narrow shuffle of so many rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task builds from one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
