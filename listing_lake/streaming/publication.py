"""Publication states as a keyed event-time stream.

Each listing has its own state on disk: what its outcomes up to the watermark add up to, and the
outcomes after it, which may still be joined by others that happened before them.  A micro-batch reads
and writes the states of the listings it brings outcomes for, and no others.

The rule for late outcomes: outcomes apply in the order in which they happened, whenever they arrive,
as long as they are at most ``lateness`` older than the newest outcome of the batches before.  One that
is older does not count; the progress of the stream reports how many (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from listing_lake.functions.pages import ACTIVE, CAPTCHA, ERROR, OK, UNAVAILABLE
from listing_lake.operators.state import MAX_FAILURES
from listing_lake.streaming.micro_batches import BATCH, STATES

#: Settings of the state store while a stream starts; a running stream keeps them.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_OUTCOME = ("ts", "seq", "resultado", "estado")


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` in force inside the block, what was there before after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fold(state: tuple, outcomes: list[tuple], max_failures: int) -> tuple:
    """``(state, failures, checked)`` after outcomes ``(ts, seq, resultado, estado)`` in order."""
    published, failures, checked = state
    for ts, _, result, observed in outcomes:
        if published != ACTIVE:
            break
        checked = ts
        failures = failures + 1 if result == ERROR else 0
        if result == OK:
            published = observed or ACTIVE
        elif result != ERROR or failures > max_failures:
            published = UNAVAILABLE
        if published != ACTIVE:
            failures = 0
    return published, failures, checked


class PublicationStates(StatefulProcessor):
    """State of one listing: ``settled`` up to the watermark, and the outcomes ``waiting`` behind it."""

    def __init__(self, key: str, max_failures: int):
        self.key, self.max_failures = key, max_failures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.settled = handle.getValueState("settled", "state string, failures int, checked timestamp")
        self.waiting = handle.getListState("waiting", "ts timestamp, seq long, resultado string, estado string")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        checked = None if pd.isna(row["fecha_chequeo"]) else row["fecha_chequeo"].to_pydatetime()
        failures = 0 if pd.isna(row["intentos_fallidos"]) else int(row["intentos_fallidos"])
        self.settled.update((row["estado_publicacion"] or ACTIVE, failures, checked))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # each read or write of a state is a message to the executor, so only those that matter are sent
        stored = self.settled.get()
        stored = tuple(stored) if stored is not None else None
        settled, waiting, outcomes = stored or (ACTIVE, 0, None), 0, []
        if settled[0] == ACTIVE:  # else nothing waits and nothing that comes can change it
            outcomes = [tuple(r) for r in self.waiting.get()]
            waiting = len(outcomes)
            for chunk in rows:
                outcomes += [
                    (ts.to_pydatetime(), int(seq), result if isinstance(result, str) else None, estado if isinstance(estado, str) else None)
                    for ts, seq, result, estado in zip(*[chunk[c].tolist() for c in _OUTCOME]) if result != CAPTCHA
                ]
            outcomes.sort(key=lambda o: o[:2])
        mark = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms").to_pydatetime()
        done = sum(o[0] <= mark for o in outcomes)
        settled = fold(settled, outcomes[:done], self.max_failures)
        if settled[0] != ACTIVE:  # nothing that comes can change it
            done = len(outcomes)
        if settled != stored:
            self.settled.update(settled)
        if outcomes[done:]:
            if done or len(outcomes) > waiting:
                self.waiting.put(outcomes[done:])
        elif waiting:
            self.waiting.clear()
        state, failures, checked = fold(settled, outcomes[done:], self.max_failures)
        yield pd.DataFrame(
            {self.key: [key[0]], "estado_publicacion": [state], "intentos_fallidos": pd.array([failures], "int32"), "fecha_chequeo": [pd.Timestamp(checked) if checked else pd.NaT]}
        )

    def close(self) -> None:
        pass


def follow_states(
    stream: DataFrame, target: str, checkpoint: str, key: str = "id", lateness: str = "1 day",
    initial: DataFrame | None = None, max_failures: int = MAX_FAILURES,
) -> StreamingQuery:
    """Write the state of each listing that a micro-batch touches to ``target``, a folder per batch.

    ``stream`` has ``key, ts, seq, resultado`` and may have ``estado``; ``initial`` holds states in the
    layout of the output, each listing once.  A batch that is run again replaces its own folder.
    """
    spark = stream.sparkSession
    if "estado" not in stream.columns:
        stream = stream.withColumn("estado", F.lit(None).cast("string"))
    output = T.StructType([stream.schema[key], *STATES])
    outcomes = stream.select(key, F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("long").alias("seq"), "resultado", "estado")
    begin = None if initial is None else initial.select(key, *STATES.names).groupBy(key)
    states = outcomes.withWatermark("ts", lateness).groupBy(key).transformWithStateInPandas(
        PublicationStates(key, max_failures), output, "Update", "EventTime", initialState=begin
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    with session_settings(spark, STATE_STORE):
        return (
            states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def current_states(spark: SparkSession, target: str, key: T.StructField) -> DataFrame:
    """The newest state of every listing that the stream has touched."""
    schema = T.StructType([key, *STATES, T.StructField(BATCH, T.LongType())])
    newest = F.max_by(F.struct(*STATES.names), BATCH).alias("__s")
    return spark.read.schema(schema).parquet(target).groupBy(key.name).agg(newest).select(key.name, "__s.*")


def with_current_states(gold: DataFrame, states: DataFrame, key: str = "id_aviso") -> DataFrame:
    """``gold`` with the publication state, its failures and the time of the check as the stream has them.

    Listings that no outcome has touched keep what they have.
    """
    new = states.select(key, *[F.col(c).alias(f"__s_{c}") for c in STATES.names], F.lit(True).alias("__seen"))
    joined = gold.join(new, key, "left")
    columns = {}
    for field in STATES:
        old = F.col(field.name) if field.name in gold.columns else F.lit(None).cast(field.dataType)
        columns[field.name] = F.when(F.col("__seen"), F.col(f"__s_{field.name}")).otherwise(old)
    return joined.withColumns(columns).drop("__seen", *[f"__s_{c}" for c in STATES.names])
