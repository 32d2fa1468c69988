"""Joins against lookup relations, safe for large lookups and for hot keys.

A lookup is broadcast only after its row count has been checked.  Beyond the limit the join is a
shuffle join in which the heavy keys of the probing side are split: the rows of a heavy key are
spread over several partitions and only the lookup rows of that key are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest lookup that is ever broadcast, in rows and in bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
#: A key is heavy when it holds more than HEAVY_ROWS rows and more than 1 / HEAVY_PARTS of all rows.
#: Fewer than HEAVY_PARTS keys can do so, which bounds the heavy-key table whatever the data; up to
#: HEAVY_PARTS * HEAVY_ROWS rows (2 * 10^10) the first bound alone decides.
HEAVY_PARTS = 100_000
#: Keys below this many rows are never split.
HEAVY_ROWS = 200_000
#: Partitions over which rows with a missing key are spread.
NULL_PARTS = 256

_SALT = "__salt"
_PARTS = "__parts"


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; measures no further than the row limit.

    The bytes are those of the rows written as JSON, nested columns included.
    """
    if max_rows <= 0:
        return False
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])))
    found = df.limit(max_rows + 1).select(size.alias("size")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    return found["n"] <= max_rows and (found["size"] or 0) <= max_bytes


def heavy_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = HEAVY_ROWS, parts: int = HEAVY_PARTS
) -> DataFrame:
    """Keys that hold too many rows for one task: ``keys`` plus the number of splits ``__parts``.

    A key qualifies above ``max(min_rows, total / parts)`` rows, so there are fewer than ``parts``.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    limit = counts.agg(
        F.greatest(F.lit(min_rows).cast("double"), F.sum("__n") / F.lit(float(parts))).alias("__limit")
    )
    return (
        counts.crossJoin(F.broadcast(limit))  # one row on the right
        .filter(F.col("__n") > F.col("__limit"))
        .select(*keys, F.ceil(F.col("__n") / F.col("__limit")).cast("int").alias(_PARTS))
    )


def _any_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def split_heavy(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[str] | None = None,
    min_rows: int = HEAVY_ROWS, counted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add ``__salt`` to both sides so that ``keys + __salt`` has no heavy key on the left.

    ``spread`` names the left columns whose hash picks the split (all columns by default).  Rows
    with a missing key match nothing, so they are spread without touching the right side.  The keys
    are counted on ``counted`` when it is given: the same rows at an earlier, cheaper step.
    """
    source = left if counted is None else counted
    heavy = heavy_keys(source.select(*keys).filter(~_any_null(keys)), keys, min_rows)
    digest = F.xxhash64(*[F.col(c) for c in (spread or left.columns)])
    salted_left = (
        left.join(F.broadcast(heavy), list(keys), "left")  # fewer than HEAVY_PARTS rows
        .withColumn(
            _SALT,
            F.when(_any_null(keys), F.pmod(digest, F.lit(NULL_PARTS)))
            .otherwise(F.pmod(digest, F.coalesce(F.col(_PARTS), F.lit(1))))
            .cast("int"),
        )
        .drop(_PARTS)
    )
    salted_right = (
        right.join(F.broadcast(heavy), list(keys), "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)))
        .drop(_PARTS)
    )
    return salted_left, salted_right


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
    spread: Sequence[str] | None = None, min_rows: int = HEAVY_ROWS, counted: DataFrame | None = None, large: bool = False,
) -> DataFrame:
    """Shuffle join on ``keys`` that splits the heavy keys of ``left``.

    Valid for ``inner``, ``left``, ``left_semi`` and ``left_anti``: each left row meets every right
    row of its key exactly once.  Where ``right`` comes from a written table the planner judges it by the
    size of its files, a fraction of its rows', and may broadcast it at any size; ``large`` rules that out.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"join type {how!r} does not keep each left row in one split")
    salted_left, salted_right = split_heavy(left, right, keys, spread, min_rows, counted)
    if large:
        salted_right = salted_right.hint("merge")
    return salted_left.join(salted_right, [*keys, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame, lookup: DataFrame, keys: str | Sequence[str], how: str = "left",
    max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
    spread: Sequence[str] | None = None, counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` with ``lookup`` on equally named ``keys``.

    The lookup is broadcast when its measured size is within ``max_rows`` and ``max_bytes``, which leaves
    the left side where it is; otherwise :func:`skew_join` does the work, with ``spread`` and ``counted``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fits_broadcast(lookup, max_rows, max_bytes):
        return left.join(F.broadcast(lookup), keys, how)
    return skew_join(left, lookup, keys, how, spread, counted=counted, large=True)


def lookup_or_default(
    left: DataFrame, lookup: DataFrame, key: str, value: str, default: Column | int | float | str,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``value`` from the dictionary ``lookup``; keys it does not hold get ``default``."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    joined = lookup_join(left, lookup.select(key, value), key, "left", max_rows)
    return joined.withColumn(value, F.coalesce(F.col(value), fallback))


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach a one-row relation to every row.

    ``scalars`` must come from a global aggregate, which is what makes it one row.
    """
    return df.crossJoin(F.broadcast(scalars))
