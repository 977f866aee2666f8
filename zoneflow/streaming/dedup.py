"""Duplicate suppression across a stream."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

BUCKETS = 256
BLOOM_BITS = 1 << 16
BLOOM_HASHES = 6
# Share of new events that may be taken for copies.
BLOOM_RATE = 1e-3


def dedup_stream(events: DataFrame, watermark: str = "5 minutes", mode: str = "exact", **bloom: float) -> DataFrame:
    """Drop events whose id was seen before; rows later than the watermark are dropped too.

    `exact` keeps ids for as long as the watermark lets a copy in. `bloom`
    keeps two bit arrays per id bucket instead. An array that holds as many ids
    as the rate allows becomes the older one and a new one begins, so the state
    never grows, at most twice the rate of new events is lost at any volume,
    and copies are found at least one full array back.
    """
    events = events.withWatermark("timestamp", watermark)
    if mode == "exact":
        return events.dropDuplicatesWithinWatermark(["event_id"])
    if mode == "bloom":
        return _bloom_stream(events, **bloom)
    raise ValueError("mode must be 'exact' or 'bloom'")


def _bloom_stream(
    events: DataFrame, buckets: int = BUCKETS, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, rate: float = BLOOM_RATE,
) -> DataFrame:
    # Ids are hashed to buckets, so a busy zone does not make a busy bucket. Positions come from two hashes of the id.
    one, two = F.xxhash64("event_id"), F.xxhash64("event_id", F.lit("step"))
    spots = F.array(*[F.pmod(F.pmod(one, F.lit(m)) + i * F.pmod(two, F.lit(m)), F.lit(m)).cast("int") for i in range(k)])
    keyed = events.withColumns({"_bucket": F.pmod(F.xxhash64("event_id", F.lit("bucket")), F.lit(buckets)).cast("int"), "_spots": spots})
    return keyed.groupBy("_bucket").transformWithStateInPandas(
        BloomBucket(m, k, rate, events.columns), outputStructType=events.schema, outputMode="append",
        timeMode="EventTime", eventTimeColumnName="timestamp",
    )


def capacity(m: int, k: int, rate: float) -> int:
    """Ids after which m bits and k positions reach the false-positive rate."""
    return max(1, int(-m / k * math.log(1 - rate ** (1 / k))))


class Generations:
    """Two bit arrays, the newer one filling up."""

    def __init__(self, m: int, k: int, rate: float, new: bytes = b"", old: bytes = b"", count: int = 0):
        self.m, self.room, self.count = m, capacity(m, k, rate), count
        self.new, self.old = (self._bits(x) for x in (new, old))

    def _bits(self, raw: bytes) -> np.ndarray:
        size = -(-self.m // 8) * 8
        return np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool) if raw else np.zeros(size, bool)

    def add(self, spots: np.ndarray) -> np.ndarray:
        """Add distinct ids by their positions; whether each was new."""
        fresh = []
        while len(spots):
            if self.count >= self.room:
                self.old, self.new, self.count = self.new, np.zeros_like(self.new), 0
            part, spots = spots[:self.room - self.count], spots[self.room - self.count:]
            isnew = ~(self.new[part].all(1) | self.old[part].all(1))
            self.new[part[isnew]] = True
            self.count += int(isnew.sum())
            fresh.append(isnew)
        return np.concatenate(fresh) if fresh else np.zeros(0, bool)

    def packed(self) -> tuple[bytes, bytes, int]:
        return np.packbits(self.new).tobytes(), np.packbits(self.old).tobytes(), self.count


class BloomBucket(StatefulProcessor):
    """The bit arrays of one bucket of ids as keyed state."""

    def __init__(self, m: int, k: int, rate: float, columns: list[str]):
        self.sizes, self.columns = (m, k, rate), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("arrays", T.StructType([
            T.StructField("new", T.BinaryType()), T.StructField("old", T.BinaryType()), T.StructField("count", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrays = Generations(*self.sizes, *(self.state.get() if self.state.exists() else ()))
        for pdf in rows:
            first = pdf[~pdf["event_id"].duplicated()]
            if len(first):
                # Computed columns reach the processor in place but without their names.
                yield first.loc[arrays.add(np.array(first.iloc[:, -1].tolist())), self.columns]
        self.state.update(arrays.packed())

    def close(self) -> None:
        pass
