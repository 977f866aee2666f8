"""Operator commands as a stream with one state per zone.

The state is a table too: `command_state` reads it from a checkpoint, as
operator observations for `zone_state` or as the start of another stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from zoneflow.operators.commands import OUTCOME, USABLE, fold_batches, prepare, refusals

STATE = "zone"
ZONE_STATE = T.StructType([
    T.StructField("occupancy", T.IntegerType()), T.StructField("capacity", T.IntegerType()), T.StructField("observed_at", T.TimestampType()),
])


class ZoneCommands(StatefulProcessor):
    """Occupancy of one zone; within a micro-batch commands apply in time order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(STATE, ZONE_STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        seen = row["observed_at"]
        self.state.update((int(row["occupancy"]), int(row["capacity"]), None if pd.isna(seen) else pd.Timestamp(seen).to_pydatetime()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        occupancy = self.state.get()[0] if self.state.exists() else None
        out = fold_batches(rows, occupancy)
        last = out.iloc[-1]
        self.state.update((int(last["occupancy"]), int(last["capacity"]), pd.Timestamp(last["observed_at"]).to_pydatetime()))
        yield out

    def close(self) -> None:
        pass


def apply_observations_stream(commands: DataFrame, zones: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Outcome of each command, against occupancy kept across micro-batches; unknown zones and actions are answered too.

    A zone is one key here because a command's effect depends on all before
    it; `maxFilesPerTrigger` or `maxOffsetsPerTrigger` bounds a micro-batch.
    `start` (zone_id, occupancy and perhaps observed_at) is what a new stream
    begins with, a zone snapshot or the state of another stream; other zones
    begin with the occupancy in `zones`. It is used in the first batch of a
    checkpoint alone.
    """
    ready = prepare(commands, zones)
    keyed = ready.where(USABLE).withColumn("set_to", F.col("set_to").cast("double")).groupBy("zone_id")
    initial = None
    if start is not None:
        seen = F.col("observed_at") if "observed_at" in start.columns else F.lit(None)
        known = start.select("zone_id", F.col("occupancy").cast("int").alias("_held"), seen.cast("timestamp").alias("observed_at"))
        dim = zones.select("zone_id", F.col("capacity").cast("int").alias("capacity")).where("capacity > 0")
        clipped = F.greatest(F.lit(0), F.least(F.coalesce("_held", F.lit(0)), F.col("capacity")))
        # One row a zone: the newest, where `start` has several.
        newest = known.groupBy("zone_id").agg(F.max_by("_held", F.coalesce("observed_at", F.timestamp_seconds(F.lit(0)))).alias("_held"), F.max("observed_at").alias("observed_at"))
        initial = newest.join(dim, "zone_id").select("zone_id", clipped.alias("occupancy"), "capacity", "observed_at").groupBy("zone_id")
    folded = keyed.transformWithStateInPandas(
        ZoneCommands(), outputStructType=OUTCOME, outputMode="append", timeMode="none", initialState=initial,
    )
    return folded.unionByName(refusals(ready))


def command_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(zone_id, occupancy, capacity, timestamp) of every zone, from the checkpoint of a command stream that runs or ran."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return state.select("key.zone_id", "value.occupancy", "value.capacity", F.col("value.observed_at").alias("timestamp"))
