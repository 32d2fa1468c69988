"""Publication state of each listing from its ordered visit outcomes.

Outcomes apply in order until the listing leaves the active state:

* ``ok`` sets the observed state and the failure counter to 0,
* ``error`` adds 1 to the counter; above the limit the listing becomes unavailable,
* ``no_encontrado`` makes it unavailable at once,
* ``captcha`` changes nothing.

A listing may own a large part of all outcomes, so its history is not brought together.  The rows
are cut into ordered segments by range partitioning, each segment is reduced to one summary that
does not depend on what came before, and the few summaries of a listing are then folded in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.functions.pages import ACTIVE, CAPTCHA, ERROR, NOT_FOUND, OK, UNAVAILABLE

#: The counter value above which a listing becomes unavailable.
MAX_FAILURES = 5

_SUMMARY = (
    "struct<part:int,hard:struct<ts:timestamp,seq:bigint,state:string>,"
    "lead:array<struct<ts:timestamp,seq:bigint>>,reset:boolean,tail:bigint,last:timestamp>"
)


def captcha_prefix(outcomes: DataFrame, run: str = "run", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Outcomes before the first captcha of their run; a run stops there."""
    stop = (
        outcomes.filter(F.col("resultado") == CAPTCHA)
        .groupBy(run)
        .agg(F.min(F.struct(ts, seq)).alias("__stop"))
    )
    return (
        outcomes.join(stop, run, "left")  # no size is counted ahead: adaptive execution sees the shuffled sizes
        .filter(F.col("__stop").isNull() | (F.struct(ts, seq) < F.col("__stop")))
        .drop("__stop")
    )


def segment_summaries(
    outcomes: DataFrame, key: str = "id", max_failures: int = MAX_FAILURES, segments: int | None = None
) -> DataFrame:
    """One summary per listing and segment.

    ``hard``  first event that ends the activity whatever the counter was before the segment
    ``lead``  the first ``max_failures + 1`` errors before any reset, at most that many
    ``reset`` whether the counter was reset inside, ``tail`` errors since then (or in all)
    ``last``  time of the last applied outcome
    """
    if "estado" not in outcomes.columns:
        outcomes = outcomes.withColumn("estado", F.lit(None).cast("string"))
    observed = F.when(F.col("resultado") == OK, F.coalesce("estado", F.lit(ACTIVE))).when(
        F.col("resultado") == NOT_FOUND, F.lit(UNAVAILABLE)
    )
    events = outcomes.filter(F.col("resultado") != CAPTCHA).select(
        key,
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("seq").cast("long").alias("seq"),
        (F.col("resultado") == ERROR).cast("int").alias("__error"),
        observed.alias("__state"),
    )
    by = [key, "ts", "seq"]
    cut = events.repartitionByRange(segments, *by) if segments else events.repartitionByRange(*by)
    cut = cut.withColumn("__part", F.spark_partition_id())
    in_order = (
        Window.partitionBy(key, "__part").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_run = (
        Window.partitionBy(key, "__part", "__resets")
        .orderBy("ts", "seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = cut.withColumn(
        "__resets", F.sum(F.when(F.col("__state").isNotNull(), 1).otherwise(0)).over(in_order)
    ).withColumn("__run", F.sum("__error").over(in_run))
    leaves = F.col("__state").isNotNull() & (F.col("__state") != ACTIVE)
    exhausted = (F.col("__error") == 1) & (F.col("__resets") > 0) & (F.col("__run") == max_failures + 1)
    leading = (F.col("__error") == 1) & (F.col("__resets") == 0) & (F.col("__run") <= max_failures + 1)
    return counted.groupBy(key, "__part").agg(
        F.min(
            F.when(
                leaves | exhausted,
                F.struct("ts", "seq", F.coalesce("__state", F.lit(UNAVAILABLE)).alias("state")),
            )
        ).alias("hard"),
        F.array_sort(F.collect_list(F.when(leading, F.struct("ts", "seq")))).alias("lead"),
        (F.max("__resets") > 0).alias("reset"),
        F.max_by("__run", F.struct("ts", "seq")).alias("tail"),
        F.max("ts").alias("last"),
    )


def _apply(acc: Column, segment: Column, max_failures: int) -> Column:
    """State after one more segment."""
    left = F.lit(max_failures + 1) - acc["failures"]
    lead = F.try_element_at(segment["lead"], left.cast("int"))
    by_lead = F.when(
        lead.isNotNull(), F.struct(lead["ts"].alias("ts"), lead["seq"].alias("seq"), F.lit(UNAVAILABLE).alias("state"))
    )
    end = F.least(segment["hard"], by_lead)
    stays = F.struct(
        acc["state"].alias("state"),
        F.when(segment["reset"], segment["tail"]).otherwise(acc["failures"] + segment["tail"]).alias("failures"),
        segment["last"].alias("checked"),
    )
    leaves = F.struct(end["state"].alias("state"), F.lit(0).cast("long").alias("failures"), end["ts"].alias("checked"))
    return (
        F.when(acc["state"] != ACTIVE, acc).when(end.isNotNull(), leaves).otherwise(stays)
    )


def fold_states(
    outcomes: DataFrame, key: str = "id", initial: DataFrame | None = None, max_failures: int = MAX_FAILURES,
    segments: int | None = None,
) -> DataFrame:
    """``key, estado_publicacion, intentos_fallidos, fecha_chequeo`` after all outcomes.

    ``initial`` holds earlier states in the same layout; listings without one start active with no
    failures.  Listings of ``initial`` without outcomes are kept.
    """
    summaries = segment_summaries(outcomes, key, max_failures, segments)
    # one entry per range partition a listing spans: bounded by the number of partitions
    history = summaries.groupBy(key).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("__part").alias("part"), "hard", "lead", "reset", "tail", "last"))
        ).cast(f"array<{_SUMMARY}>").alias("__segments")
    )
    if initial is None:
        before = history.select(
            key, "__segments", F.lit(ACTIVE).alias("__s"), F.lit(0).cast("long").alias("__f"),
            F.lit(None).cast("timestamp").alias("__c"),
        )
    else:
        before = history.join(initial, key, "full_outer").select(
            key, "__segments",
            F.coalesce("estado_publicacion", F.lit(ACTIVE)).alias("__s"),
            F.coalesce("intentos_fallidos", F.lit(0)).cast("long").alias("__f"),
            F.col("fecha_chequeo").alias("__c"),
        )
    start = F.struct(F.col("__s").alias("state"), F.col("__f").alias("failures"), F.col("__c").alias("checked"))
    folded = F.aggregate(
        F.coalesce("__segments", F.array().cast(f"array<{_SUMMARY}>")), start, lambda acc, s: _apply(acc, s, max_failures)
    )
    return before.withColumn("__end", folded).select(
        key,
        F.col("__end.state").alias("estado_publicacion"),
        F.col("__end.failures").cast("int").alias("intentos_fallidos"),
        F.col("__end.checked").alias("fecha_chequeo"),
    )
