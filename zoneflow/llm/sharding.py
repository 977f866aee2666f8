"""Contiguous shards with the smallest possible largest size, over atomic groups of equal texts.

Groups are ordered by the SHA-256 of their text, an order that no source, id or
size can bend. Their running sizes are stored once; whether a capacity suffices
is decided greedily by looking up, shard by shard, the last group that still
fits. Each round of the search tries several capacities in the same lookups.
The cuts for the capacity found keep the other shards near each other.
Everything is DataFrame operations; the driver sees a handful of sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.session import write_table

# Prefixes of the hash that cut the order into ranges of about equal size.
PREFIX = 3
# Capacities that one round of the search tries.
TRIED = 24
# Rows of one group that are numbered together.
PART_ROWS = 500


def running_groups(rows: DataFrame) -> DataFrame:
    """Groups with the bytes and rows up to and including each, in hash order.

    Hash prefixes divide the order evenly, so no window sees more than its
    4096th part; the prefixes' own totals are the only unpartitioned frame.
    """
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    keyed = groups.withColumn("prefix", F.substring("digest", 1, PREFIX))
    inside = Window.partitionBy("prefix").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("prefix").agg(F.sum("bytes").alias("b"), F.sum("n").alias("r")).select(
        "prefix", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r"))
    summed = keyed.withColumns({"end": F.sum("bytes").over(inside), "end_rows": F.sum("n").over(inside)})
    return summed.join(totals, "prefix").select(
        "digest", "bytes", "n", (F.col("end") + F.col("b")).alias("end"), (F.col("end_rows") + F.col("r")).alias("end_rows"))


def _cuts(groups: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity, where the greedy shards end."""
    ends = [[0] for _ in capacities]
    for _ in range(shards):
        goals = [own[-1] + c for own, c in zip(ends, capacities, strict=True)]
        low = min(own[-1] for own in ends)
        found = groups.where(F.col("end").between(low, max(goals))).agg(
            *[F.max(F.when(F.col("end") <= goal, F.col("end"))).alias(f"c{i}") for i, goal in enumerate(goals)]).first()
        for own, end in zip(ends, found, strict=True):
            own.append(max(own[-1], end or 0))
    return ends


def smallest_capacity(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity with which `shards` contiguous shards hold all groups, and where they end."""
    total, largest = groups.agg(F.max("end"), F.max("bytes")).first()
    if not total:
        return 0, [0] * (shards + 1)
    low = max(largest, -(-total // shards))
    # A greedy shard leaves less than the largest group free, so this capacity always suffices.
    high = -(-total // shards) + largest
    best = None
    while best is None or low < high:
        step = max(1, -(-(high - low) // TRIED))
        tried = sorted({*range(low, high, step), high})
        ends = _cuts(groups, tried, shards)
        at = next(i for i, own in enumerate(ends) if own[-1] == total)
        best, high = ends[at], tried[at]
        low = tried[at - 1] + 1 if at else high
    return high, best


def _level(rest: int, shards: int, heavy: list[int]) -> float:
    """What a shard would hold if the heavy groups had shards of their own and all others were equal."""
    alone = sorted(heavy, reverse=True)
    left, k = rest, shards
    for size in alone:
        if k <= 1 or size <= left / k:
            break
        left, k = left - size, k - 1
    return left / k


def even_cuts(groups: DataFrame, shards: int, capacity: int) -> list[int]:
    """Where the shards end, from 0 on, so that none exceeds `capacity` and their sizes are near each other.

    With a capacity that one large group forces, the greedy cut fills as few
    shards as it can. Here each shard takes what comes nearest to an equal part
    of the rest, large groups set apart, of all ends that leave a rest which
    the other shards can hold; the largest shard stays the smallest possible.
    """
    total = groups.agg(F.max("end")).first()[0] or 0
    # The first `shards` largest groups: only they can be larger than an equal part.
    large = [(r["end"], r["bytes"]) for r in groups.orderBy(F.desc("bytes"), "end").select("end", "bytes").limit(shards).collect()]
    latest = [total]
    for _ in range(shards - 1):
        goal = latest[-1] - capacity
        found = 0 if goal <= 0 else groups.where(F.col("end") >= goal).agg(F.min("end")).first()[0]
        latest.append(min(latest[-1], found))
    ends = [0]
    for k in range(shards, 1, -1):
        at = ends[-1]
        goal = at + _level(total - at, k, [size for end, size in large if end > at])
        low, high, far = groups.where(F.col("end").between(at, at + capacity)).agg(
            F.max(F.when(F.col("end") <= goal, F.col("end"))), F.min(F.when(F.col("end") > goal, F.col("end"))), F.max("end")).first()
        fit = [e for e in (low, high, far) if e is not None and e > at and e >= latest[k - 1]]
        ends.append(min(fit, key=lambda e: (abs(e - goal), e), default=at))
    return [*ends, total]


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row.

    The size is the text's UTF-8 bytes plus one, a null text counts as empty.
    Rows with equal texts share a shard; slots run from 0 in hash order, then by
    id. Repeated rows get slots of their own; null ids come first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("digest"))
    stored = write_table(rows, "rows")
    groups = write_table(running_groups(stored), "groups")
    capacity, _ = smallest_capacity(groups, shards)
    ends = even_cuts(groups, shards, capacity)
    inner = sorted({e for e in ends if e})
    starts = {r.end: r.end_rows for r in groups.where(F.col("end").isin(inner)).select("end", "end_rows").collect()} if inner else {}
    bounds = [(end, starts[end]) for end in inner[:-1]]
    shard, first = F.lit(0), F.lit(0).cast("long")
    for i, (end, before) in enumerate(bounds, 1):
        beyond = F.col("end") > end
        shard, first = F.when(beyond, i).otherwise(shard), F.when(beyond, before).otherwise(first)
    placed = groups.select("digest", "n", shard.cast("int").alias("shard"), (F.col("end_rows") - F.col("n") - first).alias("base"))

    # A group of very many rows is numbered part by part, on top of the parts before.
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / PART_ROWS))
    members = stored.join(placed, "digest").withColumn("part", part)
    parts = members.where(F.col("n") > PART_ROWS).groupBy("digest", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("digest", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("digest", "part").orderBy("doc_id")
    numbered = members.join(offsets, ["digest", "part"], "left").withColumn(
        "slot", F.col("base") + F.coalesce("offset", F.lit(0)) + F.row_number().over(inside) - 1)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
