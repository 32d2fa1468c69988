"""Exact order statistics by radix selection.

Equal values are first folded into one weighted row.  Where a group has more distinct values than one
task is to order, its ranks are looked for by digits: a pass counts the rows below each value of the
next digits of the number that orders like the value, within the bracket that holds the rank, for all
groups at once, and keeps that digit's bracket.  It ends when a bracket has few enough rows to order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.session import fresh_path
from listing_lake.sources.snapshots import write_snapshot

#: Rows that a task orders at once.
BUDGET = 1 << 20
#: Bits that one pass resolves: a bracket has so many powers of two of cells.
PASS_BITS = 12

RankOf = Callable[[Column], Column]


def order_key(value: Column) -> Column:
    """Whole number that orders as the DOUBLE ``value`` does: sign, exponent and fraction as its 64 bits hold them.

    Powers of two are exact, so nothing is rounded.  NULL for NULL and for a number that is none.
    """
    size = F.abs(value)
    two = F.lit(2.0)
    guess = F.floor(F.log2(size)).cast("int")
    # the logarithm may be rounded over the next power
    exponent = guess + F.when(F.pow(two, guess + 1) <= size, 1).when(F.pow(two, guess) > size, -1).otherwise(0)
    fraction = ((size / F.pow(two, exponent) - 1) * F.lit(2.0**52)).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == F.lit(float("inf")), F.lit(0x7FF << 52).cast("long"))
        .when(size < F.lit(2.0**-1022), (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise((exponent + 1023).cast("long") * F.lit(1 << 52) + fraction)
    )
    return F.when(~F.isnan(value), F.when(value < 0, -bits).otherwise(bits))


def rank_select(
    df: DataFrame, group: Sequence[str], value: str, ranks: Mapping[str, RankOf],
    weight: str | None = None, budget: int = BUDGET,
) -> DataFrame:
    """Pick values by rank within each group.

    ``ranks`` maps an output column to a function from the group's row count to a 1-based rank.
    Missing values are ignored; a group without values yields no row.  The output has the group
    columns, ``n_values`` and one DOUBLE column per rank.  No task orders more than ``budget`` rows of a
    group, or counts more than ``2 ** PASS_BITS`` cells of a bracket.
    """
    group = list(group)
    if not group:
        return rank_select(df.withColumn("__all", F.lit(0)), ["__all"], value, ranks, weight, budget).drop("__all")

    weighed = df.select(
        *group,
        # adding zero folds -0.0 into 0.0, which the grouping below would do anyway
        (F.col(value).cast("double") + F.lit(0.0)).alias("__v"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("__w"),
    ).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    folded = _written(weighed.groupBy(*group, "__v").agg(F.sum("__w").alias("__w")), "weighted")
    sizes = folded.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows"), F.sum("__w").alias("n_values"))
    large = sizes.filter(F.col("__rows") > budget)
    if large.isEmpty():
        picked = _ordered(folded, group, ranks)
    else:
        large = _written(large.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "n_values"), "large")
        same = _same_group(group)
        few = folded.join(large, same, "left_anti")
        picked = _ordered(few, group, ranks).unionByName(_selected(folded, large, group, ranks, budget))
    return picked.groupBy(*group).agg(
        F.first("n_values").alias("n_values"),
        *[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in ranks],
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    return write_snapshot(df, fresh_path(df.sparkSession, label))


def _same_group(group: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return same


def _asked(ranks: Mapping[str, RankOf], n: Column) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), rank(n).cast("long").alias("rank")) for name, rank in ranks.items()])


def _ordered(folded: DataFrame, group: Sequence[str], ranks: Mapping[str, RankOf]) -> DataFrame:
    """``group, __name, __v, n_values`` of groups that are small enough to order."""
    in_order = Window.partitionBy(*group).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = folded.withColumns({"__upto": F.sum("__w").over(in_order), "n_values": F.sum("__w").over(Window.partitionBy(*group))})
    here = F.filter(
        _asked(ranks, F.col("n_values")), lambda r: (r["rank"] > F.col("__upto") - F.col("__w")) & (r["rank"] <= F.col("__upto"))
    )
    return counted.withColumn("__r", F.explode(here)).select(*group, F.col("__r.name").alias("__name"), "__v", "n_values")


def _selected(folded: DataFrame, large: DataFrame, group: Sequence[str], ranks: Mapping[str, RankOf], budget: int) -> DataFrame:
    """The same for the groups of ``large``, digit by digit."""
    mine = [f"__g{i}" for i in range(len(group))]
    rows = folded.join(large.select(*mine), _same_group(group)).select(*mine, "__v", "__w", order_key(F.col("__v")).alias("__k"))
    rows = _written(rows, "ordered")
    # a bracket: the rank __t within the rows whose key without its low bits is __cell
    brackets = large.withColumn("__r", F.explode(_asked(ranks, F.col("n_values")))).select(
        *mine, F.col("__r.name").alias("__name"), "n_values", F.col("__r.rank").alias("__t"), F.lit(0).cast("long").alias("__cell")
    )
    shift, done = 64, []
    upto = F.sum("__cw").over(Window.partitionBy(*mine, "__name").orderBy("__next").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    while True:
        finer = max(0, shift - PASS_BITS)
        cells = _inside(rows, brackets, mine, shift).groupBy(*mine, "__name", "n_values", "__t", F.shiftright("__k", finer).alias("__next")).agg(
            F.sum("__w").alias("__cw"), F.count(F.lit(1)).alias("__rows")
        )
        found = cells.withColumn("__upto", upto).filter((F.col("__t") > F.col("__upto") - F.col("__cw")) & (F.col("__t") <= F.col("__upto")))
        found = _written(
            found.select(*mine, "__name", "n_values", (F.col("__t") - F.col("__upto") + F.col("__cw")).alias("__t"), F.col("__next").alias("__cell"), "__rows"),
            "brackets",
        )
        shift = finer
        done.append((found.filter(F.col("__rows") <= budget).drop("__rows"), shift))
        brackets = found.filter(F.col("__rows") > budget).drop("__rows")
        if not shift or brackets.isEmpty():
            break
    in_order = Window.partitionBy(*mine, "__name").orderBy("__k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = None
    for found, at in done:
        last = _inside(rows, found, mine, at).withColumn("__upto", F.sum("__w").over(in_order))
        last = last.filter((F.col("__t") > F.col("__upto") - F.col("__w")) & (F.col("__t") <= F.col("__upto")))
        picked = last if picked is None else picked.unionByName(last)
    return picked.select(*[F.col(m).alias(g) for m, g in zip(mine, group)], "__name", "__v", "n_values")


def _inside(rows: DataFrame, brackets: DataFrame, mine: Sequence[str], shift: int) -> DataFrame:
    """Rows with each bracket they lie in; brackets are few, so their size decides how they are sent."""
    renamed = brackets.withColumnsRenamed({m: f"__b{m}" for m in mine})
    same = F.lit(True) if shift == 64 else F.shiftright("__k", shift) == F.col("__cell")
    for m in mine:
        same = same & F.col(m).eqNullSafe(F.col(f"__b{m}"))
    return rows.join(renamed, same).drop(*[f"__b{m}" for m in mine])


def _lower_middle(n: Column) -> Column:
    return F.ceil(n / F.lit(2.0))


def lower_median(
    df: DataFrame, group: Sequence[str], value: str, output: str, weight: str | None = None,
    budget: int = BUDGET,
) -> DataFrame:
    """Median that is an element of the data: the lower of the two middles for an even count."""
    return rank_select(df, group, value, {output: _lower_middle}, weight, budget).drop("n_values")


def quantiles(
    df: DataFrame, group: Sequence[str], value: str, points: Mapping[str, float], weight: str | None = None,
    lower_middle: str | None = None, budget: int = BUDGET,
) -> DataFrame:
    """Linearly interpolated quantiles, one output column per entry of ``points``.

    ``lower_middle`` also asks for the lower median, under that name, from the same pass.
    """

    def position(n: Column, p: float) -> Column:
        return (n - F.lit(1)) * F.lit(float(p))

    ranks: dict[str, RankOf] = {}
    for name, p in points.items():
        ranks[f"{name}__lo"] = lambda n, p=p: F.floor(position(n, p)) + F.lit(1)
        ranks[f"{name}__hi"] = lambda n, p=p: F.ceil(position(n, p)) + F.lit(1)
    if lower_middle is not None:
        ranks[lower_middle] = _lower_middle
    picked = rank_select(df, group, value, ranks, weight, budget)
    columns = [F.col(g) for g in group]
    for name, p in points.items():
        at = position(F.col("n_values"), p)
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        columns.append((low + (high - low) * (at - F.floor(at))).alias(name))
    if lower_middle is not None:
        columns.append(F.col(lower_middle))
    return picked.select(*columns)


def median(df: DataFrame, group: Sequence[str], value: str, output: str, weight: str | None = None) -> DataFrame:
    """Interpolated median: the mean of the two middles for an even count."""
    return quantiles(df, group, value, {output: 0.5}, weight)


def iqr_fence(df: DataFrame, value: str, k: float = 3.0) -> DataFrame:
    """One row ``lower_fence, upper_fence``: the quartiles widened by ``k`` interquartile ranges.

    Wrapped in a global aggregate so that an empty input still gives one row (of NULLs).
    """
    q = quantiles(df, [], value, {"q1": 0.25, "q3": 0.75}).agg(F.max("q1").alias("q1"), F.max("q3").alias("q3"))
    spread = F.col("q3") - F.col("q1")
    return q.select(
        (F.col("q1") - F.lit(float(k)) * spread).alias("lower_fence"),
        (F.col("q3") + F.lit(float(k)) * spread).alias("upper_fence"),
    )


def iqr_flag(df: DataFrame, value: str, flag: str, k: float = 3.0) -> DataFrame:
    """Add boolean ``flag``: the value is present and inside the inclusive interquartile fence."""
    fenced = df.crossJoin(F.broadcast(iqr_fence(df, value, k)))  # one row
    inside = F.col(value).isNotNull() & F.col(value).between(F.col("lower_fence"), F.col("upper_fence"))
    return fenced.withColumn(flag, F.coalesce(inside, F.lit(False))).drop("lower_fence", "upper_fence")
