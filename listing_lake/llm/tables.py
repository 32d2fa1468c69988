"""Reading tables, naming rows and cutting lineage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.session import fresh_path

#: The columns :func:`located` adds: together they name one row of one file.
FILE, ROW = "_llm_file", "_llm_row"
#: The column of whole rows.
WHOLE = "_llm_whole"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there and it is computed once."""
    return stored(df, label)[0]


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """:func:`written` and the folder of the table."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def erase(df: DataFrame, path: str) -> None:
    """Free the space of a stored table that nothing reads any more: it becomes an empty one."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def located(df: DataFrame) -> DataFrame:
    """``df`` with the file and the position in it that each row was read from.

    Both stay the same when a scan is repeated or split otherwise, so they name a row even where ids
    are missing or repeated.  Scans (with projections and filters over them) are named directly; a
    frame without file columns is written first.  Write frames made by joins before passing them.
    Select the columns that are needed first: one named like the two added would make them ambiguous.
    """
    return _with_places(df, F.col("*"))


def packed(df: DataFrame, *used: str) -> DataFrame:
    """The columns ``used``, each whole row as :data:`WHOLE`, and the place of :func:`located`.

    Whatever the names of the other columns, they cannot clash with an operator's own.
    """
    return _with_places(df, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(WHOLE), *used)


def unpacked(df: DataFrame) -> DataFrame:
    """The whole rows that :func:`packed` put aside."""
    return df.select(f"{WHOLE}.*")


def _with_places(df: DataFrame, *columns) -> DataFrame:
    places = F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)
    try:
        return df.select(*columns, *places)
    except AnalysisException:
        return written(df, "located").select(*columns, *places)
