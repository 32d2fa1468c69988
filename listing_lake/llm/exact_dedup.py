"""Exact de-duplication as a stateful stream.

Documents arrive as a stream of fingerprints.  The stream's state, on disk and without expiry, holds
for each digest how many documents had it, the largest id among them and where that document's content
lies.  A digest met again is a hit; the full bytes of all hits are then compared, and documents that
share a digest but not their bytes are separated.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.llm.tables import FILE, ROW, located, packed, unpacked, written
from listing_lake.session import fresh_path

#: Files of fingerprints that one micro-batch takes at most; each is what one task made of its share of the texts.
BATCH_FILES = 4096

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no space is reserved ahead, which would be megabytes for each of many small stores
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def body(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 4) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, the digest, and its place.

    Equal texts form a group; a null text is empty.  The row with the largest id stays, a null id being
    the smallest; of rows repeated with the same id and text the last by place stays, and only that one
    has ``kept``.  Other columns of ``docs`` are ignored.  An empty table gives an empty result.
    The fingerprints arrive in at least ``batches`` micro-batches, more where one would have more than
    :data:`BATCH_FILES` files.
    """
    return _classes(located(docs.select("doc_id", "text")), digest, batches)


def _classes(placed: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 4) -> DataFrame:
    spark = placed.sparkSession
    prints = written(placed.select("doc_id", digest(body()).alias("digest"), FILE, ROW), "fingerprints")
    if len(prints.inputFiles()) < batches:
        prints = written(prints.repartition(batches, FILE, ROW), "fingerprints")
    known = _stream(spark, prints, batches)
    mixed = written(_mixed(placed, known, digest), "mixed-digests")
    whole = prints.join(known, "digest")
    if not mixed.isEmpty():
        whole = _separated(placed, whole, mixed, digest)
    newest = F.struct("doc_id", FILE, ROW).eqNullSafe(F.col("newest"))
    return whole.select(
        "doc_id", F.col("newest.doc_id").alias("keep_id"), "group_size", newest.alias("kept"), "digest", FILE, ROW
    )


def _stream(spark: SparkSession, prints: DataFrame, batches: int) -> DataFrame:
    """Digest, group size and newest member, after all fingerprints have passed through the state."""
    source, updates, progress = prints.inputFiles(), fresh_path(spark, "updates"), fresh_path(spark, "state")
    schema = "digest string, group_size long, newest struct<doc_id: long, _llm_file: long, _llm_row: long>"
    if not source:
        return spark.createDataFrame([], schema)
    stream = (
        spark.readStream.schema(prints.schema).option("maxFilesPerTrigger", max(1, min(len(source) // batches, BATCH_FILES)))
        .parquet(source[0].rsplit("/", 1)[0])
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", FILE, ROW)).alias("newest"))
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    with _settings(spark, _STATE):
        (
            stream.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", progress)
            .trigger(availableNow=True).start().awaitTermination()
        )
    seen = spark.read.schema(schema).parquet(updates)
    # a digest is updated at most once in a micro-batch, each time with a larger size
    return seen.groupBy("digest").agg(F.max(F.struct("group_size", "newest")).alias("last")).select("digest", "last.*")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _mixed(placed: DataFrame, known: DataFrame, digest: Callable) -> DataFrame:
    """Digests that stand for more than one text.

    Grouping by the whole text compares all bytes of the hits, in each task before the exchange, so a
    hot text is moved once per task.
    """
    hits = known.filter("group_size > 1").select("digest")
    texts = placed.select(digest(body()).alias("digest"), body().alias("bytes")).distinct()
    return texts.join(hits, "digest", "left_semi").groupBy("digest").count().filter("count > 1").select("digest")


def _separated(placed: DataFrame, whole: DataFrame, mixed: DataFrame, digest: Callable) -> DataFrame:
    """``whole`` with the documents of mixed digests grouped by their bytes."""
    texts = placed.select("doc_id", FILE, ROW, digest(body()).alias("digest"), body().alias("bytes")).join(mixed, "digest", "left_semi")
    groups = texts.groupBy("bytes").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", FILE, ROW)).alias("newest"))
    apart = texts.join(groups, "bytes").select(*whole.columns)
    return whole.join(mixed, "digest", "left_anti").unionByName(apart)


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`classes` keeps, with all their columns, whatever their names."""
    placed = packed(docs, "doc_id", "text")
    kept = _classes(placed.select("doc_id", "text", FILE, ROW), **options).filter("kept").select(FILE, ROW)
    return unpacked(placed.join(kept, [FILE, ROW], "left_semi"))
