"""Layers in hash buckets: an increment reads and writes only the buckets its keys fall into.

The bucket of a row is a folder of the table, so a filter on it skips the other folders, and overwriting
by folder leaves them as they are.  What is to be written is made in a folder of its own first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_lake.operators.increments import pending
from listing_lake.operators.merge import merge_update, merge_upsert
from listing_lake.session import fresh_path
from listing_lake.sources.snapshots import write_snapshot

BUCKET = "_cubo"


class Layer:
    """A table at ``path`` whose rows lie in ``buckets`` folders by the hash of their ``keys``.

    Number and keys must stay the same for the life of the table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 1024):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.schema = T.StructType([f for f in schema if f.name != BUCKET])

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets; no rows before the first write."""
        whole = T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])
        try:
            rows = self.spark.read.schema(whole).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], whole)
        return rows if only is None else rows.filter(F.col(BUCKET).isin([int(b) for b in only]))

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that ``rows`` fall into: at most ``buckets`` numbers."""
        return sorted(r[BUCKET] for r in self.placed(rows.select(*self.keys)).select(BUCKET).distinct().collect())

    def insert_new(self, source: DataFrame) -> list[int]:
        """Add the rows with a new key, each key once, as files next to the old ones; returns the buckets looked at."""
        source = self._landed(source)
        touched = self.touched(source)
        fresh = pending(self.placed(source), self.read(touched).select(*self.keys), self.keys)
        fresh.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(self.path)
        return touched

    def upsert(self, source: DataFrame, update: Sequence[str] | None = None) -> list[int]:
        """Insert new keys and overwrite the ``update`` columns of known ones; returns the buckets rewritten."""
        source = self._landed(source)
        touched = self.touched(source)
        old = self.read(touched).drop(BUCKET)
        self._replace(self.placed(merge_upsert(old, source, self.keys, update)))
        return touched

    def update(self, source: DataFrame, columns: Sequence[str]) -> list[int]:
        """Overwrite ``columns`` of known keys; returns the buckets rewritten."""
        source = self._landed(source)
        touched = self.touched(source)
        self._replace(self.placed(merge_update(self.read(touched).drop(BUCKET), source, self.keys, columns)))
        return touched

    def _landed(self, source: DataFrame) -> DataFrame:
        return write_snapshot(source, fresh_path(self.spark, "increment"))

    def _replace(self, rows: DataFrame) -> None:
        """Buckets that ``rows`` hold get these rows in place of what they have."""
        staged = write_snapshot(rows, fresh_path(self.spark, "staged"))
        (
            staged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET).parquet(self.path)
        )
