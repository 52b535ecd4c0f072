"""Joins and rankings that stay balanced when one key holds much of the data."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.session import ensure_checkpoint_dir

_SPREAD = "_spread"


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join a possibly skewed left side to a right side with few rows per key.

    AQE splits a skewed join partition only where both inputs are plain shuffle
    stages. An aggregated right side is already partitioned by the key, gets no
    shuffle, and would switch that off. Joining on one more column derived from the
    keys makes Spark shuffle both sides, so a hot key is split over many tasks; a
    right side measured below the broadcast threshold is still broadcast instead.
    """
    spread = F.pmod(F.xxhash64(*keys), F.lit(1 << 20))
    left = left.withColumn(_SPREAD, spread)
    right = right.withColumn(_SPREAD, spread)
    if not null_safe:
        return left.join(right, [*keys, _SPREAD], how).drop(_SPREAD)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, _SPREAD]})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in [*keys, _SPREAD]]
    joined = left.join(renamed, reduce(and_, same), how)
    return joined.drop(_SPREAD, *(f"_right_{k}" for k in [*keys, _SPREAD]))


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as a table next to the checkpoints and read it back.

    Used where a result feeds several branches: it is computed once, later stages
    read only the columns they need, and a lost executor repeats no upstream work.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_stored(df: DataFrame) -> None:
    """Remove the files of a frame that ``stored`` gave, once what reads it is written."""
    files = df.inputFiles()
    if files:
        remove_folder(df.sparkSession, files[0].rpartition("/")[0])


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs that run inside remove their shuffle files when they end, not only when the
    driver's collector finds the plan unused."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def open_files(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Jobs that run inside write up to so many folders from a task without sorting its
    rows by folder, so that they keep the order they have."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))


#: Measured bytes of keys up to which a side is broadcast.
BROADCAST_BYTES = 64 << 20


def few_join(left: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a stored side that is usually small, null keys matching each other. Where its
    measured size allows, it is broadcast and the left rows stay where they are; beyond,
    both sides shuffle and a hot key can be split."""
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys])
    measured = few.agg(F.sum(size + 16 * len(few.columns))).first()[0] or 0
    if measured > BROADCAST_BYTES:
        return lookup_join(left, few, keys, how, null_safe=True)
    renamed = few.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(F.broadcast(renamed), same, how).drop(*(f"_right_{k}" for k in keys))


def sorted_positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add each row's 0-based position in the global order.

    A window without partitions would sort everything in one task. Here rows are
    range-partitioned and sorted in place; a position is the offset of the row's
    partition plus its index inside it. The placed rows are stored, because the
    offsets and the rows must see one and the same partitioning even if an executor
    is lost. The offsets table has one row per partition, hence the broadcast.
    ``order`` must tell all rows apart.
    """
    placed = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_slot", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    index = F.col("_slot") - F.shiftleft("_part", 33)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + index)
        .drop("_part", "_slot", "_offset")
    )


def rank_within(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """1-based row number inside each group without collecting a group in a task."""
    placed = sorted_positions(df, [F.col(group).asc(), *order], "_position")
    starts = placed.groupBy(group).agg(F.min("_position").alias("_start"))
    return (
        lookup_join(placed, starts, [group], null_safe=True)
        .withColumn(name, (F.col("_position") - F.col("_start") + 1).cast("bigint"))
        .drop("_position", "_start")
    )


def dense_rank_within(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Dense rank by descending value inside each group.

    Equal values are reduced to one row first, so the ranked set is the distinct
    values; the ranks are then looked up by (group, value).
    """
    values = df.select(group, value).distinct()
    ranks = rank_within(values, group, [F.col(value).desc()], name)
    return lookup_join(df, ranks, [group, value], null_safe=True)


def top_per_key(df: DataFrame, key: str | list[str], order: Sequence[Column], k: int, name: str) -> DataFrame:
    """First k rows per key. Spark trims each map partition to k rows per key
    before the shuffle (window group limit), so hot keys send only k rows per task."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
