"""Table maintenance as pure functions: target and source in, new target out.

Plain Parquet tables have no MERGE, UPDATE or DELETE, so a verb returns the new content and
``sources.snapshots`` writes it to a fresh folder.  A key that a merge source holds twice fails the job,
as it would in a MERGE, and so does a source row whose key is missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.operators.increments import pending

_HIT = "__hit"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _hit(keys: list[str]) -> Column:
    """True for each source row; fails the job where the row's key is missing or occurs again.

    The count uses the partitioning by key that the merge's join needs anyway.
    """
    again = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    return (
        F.when(_missing(keys), _refusal(keys, "source row without a key:"))
        .when(again, _refusal(keys, "several source rows for key"))
        .otherwise(True)
    )


def _missing(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _refusal(keys: list[str], what: str) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit(what), *keys)).cast("boolean")


def append_by_name(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Create or append: columns are matched by name, a column one side lacks is NULL there."""
    return source if target is None else target.unionByName(source, allowMissingColumns=True)


def merge_insert_only(target: DataFrame | None, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Insert the source rows with a new key; existing rows stay as they are.

    A source row without a key fails the job: it would match nothing and be inserted in every run.
    """
    keys = _keys(keys)
    named = source.filter(F.when(_missing(keys), _refusal(keys, "source row without a key:")).otherwise(True))
    return append_by_name(target, pending(named, target, keys))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys and overwrite the ``update`` columns (all but the keys by default) of known ones.

    Whether a row matched decides, not whether the new value is present: a NULL overwrites too.
    """
    keys = _keys(keys)
    update = [c for c in source.columns if c not in keys] if update is None else list(update)
    new = source.select(
        *keys, *[F.col(c).alias(f"__s_{c}") for c in source.columns if c not in keys], _hit(keys).alias(_HIT)
    )
    old = target.withColumn("__old", F.lit(True))
    joined = old.join(new, keys, "full_outer")
    columns = [F.col(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        if c in update:
            columns.append(F.when(F.col(_HIT), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
        elif c in source.columns:
            columns.append(F.when(F.col("__old"), F.col(c)).otherwise(F.col(f"__s_{c}")).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns).select(*target.columns)


def merge_update(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of matched rows only; source rows without a match are dropped.

    The source may be as long as the target, so it is never broadcast.
    """
    keys = _keys(keys)
    new = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in columns], _hit(keys).alias(_HIT))
    joined = target.join(new.hint("merge"), keys, "left")
    return joined.select(
        *[
            F.when(F.col(_HIT), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows where ``condition`` is true; all changes see the old values."""
    return df.withColumns({c: F.when(condition, value).otherwise(F.col(c)) for c, value in changes.items()})


def replace_rows(target: DataFrame, condition: Column, rows: DataFrame) -> DataFrame:
    """Delete the rows where ``condition`` is true and add ``rows``."""
    return target.filter(~F.coalesce(condition, F.lit(False))).unionByName(rows)


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are absent, as NULLs of the given type."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in have})


def backfill(old: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``new`` plus the rows of ``old`` whose key it lacks; running it again changes nothing."""
    return new.unionByName(pending(old, new, keys), allowMissingColumns=True)


def append_log(log: DataFrame | None, outcomes: DataFrame, at: Column) -> DataFrame:
    """Add one row per attempt to the append-only log, all with the time ``at``."""
    rows = ensure_columns(outcomes, {"motivo": "string"}).select(
        "id_aviso", "resultado", "motivo", at.cast("timestamp").alias("fecha_intento")
    )
    return append_by_name(log, rows)


def stamp(df: DataFrame, source: str, run_id: str, loaded: str | None = None, at: Column | None = None) -> DataFrame:
    """Lineage columns shared by all rows of a run, and the load time when ``loaded`` names a column."""
    marked = df.withColumns({"_sistema_origen": F.lit(source), "_id_corrida": F.lit(run_id)})
    return marked if loaded is None else marked.withColumn(loaded, F.current_timestamp() if at is None else at)
