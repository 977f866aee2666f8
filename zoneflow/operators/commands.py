"""Operator commands folded into zone occupancy.

A command that would leave [0, capacity] is rejected, so results depend on
order and no window sum gives them. A stretch of commands is a function from
the occupancy before it to the one after: over some interval of starts it adds
a constant, and after an accepted SET it is one. Stretches of all zones are
replayed side by side, a command of each at a time, from assumed starts, and
each also yields the interval of starts that its answers hold for. A stretch
whose true start lies outside its interval is replayed. Zones that span tasks
are tabulated first, and the tables chained.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.scalar import clip
from zoneflow.operators.ordered import CHUNK, range_chunks
from zoneflow.session import write_table

# Accepted actions, bounds of one command.
ACTIONS = ("ENTRY", "EXIT", "SET")
MAX_AMOUNT = 100
# Commands that one task replays in order.
CHUNK_ROWS = 500_000
# States that are tabulated side by side: lanes times occupancies.
TABLE_CELLS = 1 << 22
USABLE = "zone_capacity > 0 AND shift IS NOT NULL"

OUTCOME = T.StructType([
    T.StructField("command_id", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("observed_at", T.TimestampType()),
    T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("occupancy", T.IntegerType()),
    T.StructField("capacity", T.IntegerType()),
])


def prepare(commands: DataFrame, zones: DataFrame) -> DataFrame:
    """Normalized commands with the zone's capacity and starting occupancy.

    `shift` is the signed change and `set_to` the target of a SET; both are null
    for a command no state can accept.
    """
    action = F.upper(F.trim(F.coalesce("action", F.lit("SET"))))
    count = F.coalesce(F.when(F.col("amount") != 0, F.col("amount")), F.lit(1))
    amount = F.greatest(F.lit(1), F.least(F.lit(MAX_AMOUNT), count))
    start = F.col("occupancy") if "occupancy" in zones.columns else F.lit(0)
    dim = zones.select("zone_id", F.col("capacity").alias("zone_capacity"), clip(start.cast("int"), 0, F.col("capacity")).alias("zone_start"))
    tidy = commands.select(
        "command_id", F.upper(F.trim("zone_id")).alias("zone_id"), "observed_at", action.alias("action"),
        F.when(action == "ENTRY", amount).when(action == "EXIT", -amount).when(action == "SET", 0).alias("shift"),
        F.when(action == "SET", F.col("occupancy")).alias("set_to"),
    )
    return tidy.join(dim, "zone_id", "left")


class Lanes:
    """Commands in order, cut into lanes of about equal length that never span two zones; one column each."""

    def __init__(self, zone: np.ndarray, shift: np.ndarray, target: np.ndarray, capacity: np.ndarray, length: int | None = None):
        n = len(zone)
        length = length or max(1, math.isqrt(n))
        first = np.r_[True, zone[1:] != zone[:-1]] if n else np.zeros(0, bool)
        inside = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
        opens = inside % length == 0
        self.lane, self.step = np.cumsum(opens) - 1, inside % length
        #: Whether a lane goes on from the one before it.
        self.follows = (inside[opens] > 0)
        self.zone, self.capacity = zone[opens], capacity[opens]
        shape = (int(self.step.max(initial=-1)) + 1, int(opens.sum()))
        self.shift, self.target, self.used = np.zeros(shape, np.int64), np.full(shape, -1, np.int64), np.zeros(shape, bool)
        at = (self.step, self.lane)
        known = ~np.isnan(target)
        # A target that no zone can take is a command without effect.
        self.shift[at], self.target[at], self.used[at] = np.where(known, 0, shift), np.where(known, np.where(known, target, 0).astype(np.int64), -1), True
        self.sets = np.zeros(shape, bool)
        self.sets[at] = known

    def run(self, lanes: np.ndarray, starts: np.ndarray):
        """States and acceptance after every command, from the given starts, and the interval of changes of the start they hold for.

        `moves` tells where a change of the start shows in the state: up to the first accepted SET.
        """
        state, capacity = starts.astype(np.int64), self.capacity[lanes]
        low, high, moving = -state, capacity - state, np.ones(len(lanes), bool)
        states, accepted, moves = [], [], []
        for j in range(len(self.shift)):
            used, sets, target, wanted = self.used[j, lanes], self.sets[j, lanes], self.target[j, lanes], state + self.shift[j, lanes]
            wanted = np.where(sets, target, wanted)
            ok = used & (wanted >= 0) & (wanted <= capacity)
            free = used & moving & ~sets
            low = np.where(free & ok, np.maximum(low, -wanted), np.where(free & (wanted > capacity), np.maximum(low, capacity - wanted + 1), low))
            high = np.where(free & ok, np.minimum(high, capacity - wanted), np.where(free & (wanted < 0), np.minimum(high, -wanted - 1), high))
            state = np.where(ok, wanted, state)
            moving = moving & ~(sets & ok)
            states.append(state)
            accepted.append(ok)
            moves.append(moving)
        return np.array(states), np.array(accepted), np.array(moves), low, high

    def replay(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occupancy after every command, and whether it was accepted; `starts` has the occupancy before each zone's first lane."""
        lanes = np.arange(len(self.zone))
        assumed = starts[np.maximum.accumulate(np.where(self.follows, 0, lanes))] if len(lanes) else starts
        states, accepted, moves, low, high = self.run(lanes, assumed)
        change = np.zeros(len(lanes), np.int64)
        while len(lanes):
            again, guess, end = [], [], 0
            ends, moved = states[-1], moves[-1]
            for i in range(len(self.zone)):
                start = end if self.follows[i] else starts[i]
                change[i] = start - assumed[i]
                if not low[i] <= change[i] <= high[i]:
                    again.append(i)
                    guess.append(start)
                # Past a lane that must run again this is a guess, which the next round checks.
                end = min(self.capacity[i], max(0, ends[i] + change[i] * moved[i]))
            if not again:
                break
            rows = np.array(again)
            assumed[rows] = guess
            states[:, rows], accepted[:, rows], moves[:, rows], low[rows], high[rows] = self.run(rows, assumed[rows])
        at = (self.step, self.lane)
        return (states + change * moves)[at] if len(lanes) else np.zeros(0, np.int64), accepted[at] if len(lanes) else np.zeros(0, bool)


def tabulate(shift: np.ndarray, target: np.ndarray, capacity: int) -> np.ndarray:
    """Occupancy after all commands of one zone for every occupancy before them; lanes side by side, then chained."""
    n, wide = len(shift), max(1, TABLE_CELLS // (capacity + 1))
    lanes = Lanes(np.zeros(n, np.int64), shift, target, np.full(n, capacity), -(-n // max(1, min(wide, math.isqrt(n)))))
    after = np.tile(np.arange(capacity + 1), (len(lanes.zone), 1))
    for j in range(len(lanes.shift)):
        wanted = np.where(lanes.sets[j][:, None], lanes.target[j][:, None], after + lanes.shift[j][:, None])
        after = np.where((wanted >= 0) & (wanted <= capacity), wanted, after)
    table = np.arange(capacity + 1)
    for own in after:
        table = own[table]
    return table


_ORDER = ("zone_id", "observed_at", "command_id")


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in _ORDER], null_placement="at_start"))


def _numbers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    target = table.column("set_to").cast(pa.float64()).to_numpy()
    return table.column("shift").to_numpy(), target, table.column("zone_capacity").to_numpy()


def _table(table: pa.Table) -> pa.Table:
    shift, target, capacity = _numbers(_sorted(table))
    return pa.table({
        "zone_id": table.column("zone_id")[:1], CHUNK: table.column(CHUNK)[:1],
        "zone_start": table.column("zone_start")[:1], "_after": pa.array([tabulate(shift, target, int(capacity[0])).tolist()], pa.list_(pa.int32())),
    })


def _replay(table: pa.Table) -> pa.Table:
    """Outcome of the commands of a chunk, of all its zones at once, from each zone's `_start`."""
    table = _sorted(table)
    shift, target, capacity = _numbers(table)
    zone = table.column("zone_id").combine_chunks().dictionary_encode().indices.to_numpy()
    lanes = Lanes(zone, shift, target, capacity)
    starts = table.column("_start").to_numpy()[np.nonzero(lanes.step == 0)[0]].astype(np.int64)
    occupancy, accepted = lanes.replay(starts)
    status = pa.DictionaryArray.from_arrays(pa.array(accepted.astype(np.int32)), pa.array(["OUT_OF_RANGE", "ACCEPTED"])).cast(pa.string())
    return pa.Table.from_arrays([
        *[table.column(c) for c in ("command_id", "zone_id", "observed_at", "action")], status,
        pa.array(occupancy, pa.int32()), pa.array(capacity, pa.int32())], names=OUTCOME.fieldNames())


def refusals(ready: DataFrame) -> DataFrame:
    """Outcome of prepared commands that no state can accept."""
    return ready.where(f"NOT coalesce({USABLE}, false)").select(
        "command_id", "zone_id", "observed_at", "action",
        F.when(F.coalesce(F.col("zone_capacity"), F.lit(0)) <= 0, "UNKNOWN_ZONE").otherwise("UNKNOWN_ACTION").alias("status"),
        F.lit(None).cast("int").alias("occupancy"), F.col("zone_capacity").alias("capacity"),
    )


def apply_observations(commands: DataFrame, zones: DataFrame) -> DataFrame:
    """Outcome of every command, in time order per zone, with the occupancy after it."""
    ready = prepare(commands, zones)
    chunks = range_chunks(ready.where(USABLE), ["zone_id", "observed_at", "command_id"], "commands", CHUNK_ROWS)
    group = ["zone_id", CHUNK]
    wide = chunks.groupBy("zone_id").agg(F.min(CHUNK).alias("_low"), F.max(CHUNK).alias("_high")).where("_low < _high").select("zone_id")
    begun = chunks.withColumn("_start", F.col("zone_start"))
    if not wide.isEmpty():
        begun = chunks.join(_starts(chunks.join(wide, "zone_id", "left_semi")), group, "left").withColumn("_start", F.coalesce("_start", "zone_start"))
    done = begun.groupBy(CHUNK).applyInArrow(_replay, OUTCOME)
    return done.unionByName(refusals(ready))


def _starts(chunks: DataFrame) -> DataFrame:
    """Occupancy before each chunk of zones that have several."""
    tables = write_table(
        chunks.groupBy("zone_id", CHUNK).applyInArrow(_table, f"zone_id string, {CHUNK} int, zone_start int, _after array<int>"), "transfer")
    # At most one table per chunk of the zone; walked in order from the first state.
    walk = (
        tables.groupBy("zone_id")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(CHUNK), F.col("_after")))).alias("l"), F.first("zone_start").alias("zone_start"))
    )
    walked = F.aggregate(
        "l",
        F.array(F.struct(F.lit(-1).alias("chunk"), F.col("zone_start").alias("start"), F.col("zone_start").alias("end"))),
        lambda acc, t: F.concat(acc, F.array(F.struct(
            t[CHUNK].alias("chunk"), F.element_at(acc, -1)["end"].alias("start"),
            t["_after"][F.element_at(acc, -1)["end"]].alias("end"),
        ))),
    )
    return walk.select("zone_id", F.explode(walked).alias("w")).select(
        "zone_id", F.col("w.chunk").alias(CHUNK), F.col("w.start").alias("_start"))


def final_state(outcomes: DataFrame) -> DataFrame:
    """Commands accepted and refused per zone, and the last occupancy."""
    last = F.struct("observed_at", "command_id")
    return outcomes.where("status IN ('ACCEPTED', 'OUT_OF_RANGE')").groupBy("zone_id").agg(
        F.count_if(F.col("status") == "ACCEPTED").alias("accepted"),
        F.count_if(F.col("status") != "ACCEPTED").alias("rejected"),
        F.max_by("occupancy", last).alias("occupancy"), F.max("observed_at").alias("observed_at"),
    )


def fold_batches(batches: Iterator[pd.DataFrame], occupancy: int | None) -> pd.DataFrame:
    """Outcome of one zone's commands in one micro-batch, for keyed streaming state."""
    rows = pd.concat(list(batches))
    table = pa.Table.from_pandas(rows, preserve_index=False)
    start = int(rows["zone_start"].iloc[0]) if occupancy is None else occupancy
    return _replay(table.append_column("_start", pa.array(np.full(len(rows), start)))).to_pandas()
