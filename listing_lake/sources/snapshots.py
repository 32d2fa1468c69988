"""Snapshot writers.

A plain Parquet table cannot be overwritten while it is read, so every write goes to a folder of its
own and the caller switches to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_lake.session import fresh_path


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write the full content to ``path`` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, path: str, counters: Mapping[str, Column], mode: str = "overwrite", by: str | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` and return the table with what was counted while its rows were written, without another pass.

    ``counters`` are aggregates without DISTINCT; ``total_filas`` is always counted.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("total_filas"), *[c.alias(n) for n, c in counters.items()])
    writer = watched.hint("rebalance", by).write.partitionBy(by) if by else watched.write
    writer.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Write one folder per value of ``by``, so that filters on it skip the other folders.

    The rebalance gives each value a few well-filled files however many rows it holds: adaptive
    execution splits a large value over several tasks and packs small ones together.
    """
    by = [by] if isinstance(by, str) else list(by)
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Add ``df`` to the table at ``path``, partitioned by ``by`` when given; returns the whole table."""
    if by is not None:
        return write_partitioned(df, path, by, mode="append")
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_sizes(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``by, path, length`` of each file of a partitioned table, from its listing; contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        .select(F.col(by).cast("string").alias(by), "path", "length")
    )


def compact_small(spark: SparkSession, path: str, schema: T.StructType, by: str, target_bytes: int = 128 << 20, small_files: int = 8) -> list[str]:
    """Rewrite the partitions in which small files have piled up; returns their values of ``by``.

    A file is small below half of ``target_bytes``.  A partition with fewer than ``small_files`` of them stays
    as it is, whatever its large files.  Others are rewritten to as few files as their bytes need, first
    into a folder of its own and from there over the partition.
    """
    small = file_sizes(spark, path, by).filter(F.col("length") < target_bytes // 2)
    crowded = small.groupBy(by).agg(F.count(F.lit(1)).alias("files")).filter(F.col("files") >= small_files)
    values = sorted((r[by] for r in crowded.collect()), key=lambda x: (x is None, x))  # a row per partition at most
    if not values:
        return []
    mine = F.col(by).cast("string").isin([x for x in values if x is not None])
    rows = spark.read.schema(schema).parquet(path).filter(mine | F.col(by).isNull() if None in values else mine)
    staged = write_snapshot(rows, fresh_path(spark, "compacting"))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory, None)
    spark.conf.set(advisory, str(target_bytes))
    try:
        writer = staged.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(by).parquet(path)
    finally:
        spark.conf.unset(advisory) if before is None else spark.conf.set(advisory, before)
    return values


def compact(df: DataFrame, path: str, by: str) -> DataFrame:
    """Rewrite into files of adjacent ``by`` ranges, as many as adaptive execution finds the bytes to need.

    Narrow key ranges per file let a lookup on ``by`` skip files by their min/max statistics.
    """
    df.repartitionByRange(by).sortWithinPartitions(by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
