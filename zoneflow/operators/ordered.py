"""Order-dependent operators that never hold one key in one task.

A window over a hot zone would sort all its rows in a single task. Here the
rows of a key are cut into consecutive pieces, by time cells or by ranges of a
total order, as many as their number needs. Each piece is summed on its own
and starts from the total of the pieces before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.session import write_table

CHUNK = "_chunk"
# Rows of one key and hour that one task may sort: tunes the plan, never the result.
HOT_ROWS = 5_000_000


def _join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a group's columns to its rows; a null key is a group too."""
    renamed = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    return rows.join(renamed, same).drop(*[f"_g_{k}" for k in keys])


def range_chunks(
    df: DataFrame, keys: Sequence[str | Column], name: str = "chunks", rows_per_chunk: int | None = None,
) -> DataFrame:
    """`df` cut into consecutive ranges of `keys`, numbered in `_chunk`.

    The session says how many; where a task must hold a chunk, `rows_per_chunk`
    makes their number follow the rows.

    Range bounds come from a sample, so a second evaluation would move them.
    The chunks are stored before anything reads their numbers.
    """
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [] if rows_per_chunk is None else [max(few, -(-df.count() // rows_per_chunk))]
    ranged = df.repartitionByRange(*wanted, *keys).withColumn(CHUNK, F.spark_partition_id())
    return write_table(ranged, name)


def _piecewise(rows: DataFrame, parts: DataFrame, by: Sequence[str], piece: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Running sum inside each piece, on top of the sum of the key's earlier pieces.

    `parts` has the sum of every piece as `_part`. Earlier sums enter as one
    extra row per piece that sorts first: one shuffle, and no join.
    """
    before = Window.partitionBy(*by).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    seeds = parts.select(*by, piece, F.coalesce(F.sum("_part").over(before), F.lit(0)).alias(value))
    both = rows.withColumn("_own", F.lit(1)).unionByName(
        seeds.withColumn("_own", F.lit(0)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*by, piece).orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(out, F.sum(value).over(inside)).where("_own = 1").drop("_own")


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Inclusive running sum of `value` within `by` along the total order `order`."""
    chunks = range_chunks(df, [*by, *order], "running_sum")
    parts = chunks.groupBy(*by, CHUNK).agg(F.sum(value).alias("_part"))
    return _piecewise(chunks, parts, by, CHUNK, order, value, out).drop(CHUNK)


def running_sum_in_time(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str,
    unit: str = "hour", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`running_sum` for an order that begins with a time: the pieces are hours.

    Rows are shuffled once and none is stored. Only hours of a key with more
    than `hot_rows` rows are cut further, by ranges.
    """
    rows = df.withColumn("_cell", F.date_trunc(unit, F.col(order[0])))
    keys = [*by, "_cell"]
    cells = write_table(rows.groupBy(*keys).agg(F.sum(value).alias("_part"), F.count("*").alias("_n")), "cells")
    hot = cells.where(F.col("_n") > hot_rows)
    if hot.isEmpty():
        return _piecewise(rows, cells.drop("_n"), by, "_cell", order, value, out).drop("_cell")

    marked = _join_groups(rows, cells.select(*keys, (F.col("_n") > hot_rows).alias("_hot")), keys)
    cold = _piecewise(marked.where("NOT _hot").drop("_hot"), cells.drop("_n"), by, "_cell", order, value, out)
    # Inside a hot hour by ranges, then on top of the hours before it.
    inner = running_sum(marked.where("_hot").drop("_hot"), keys, order, value, out)
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = cells.select(*keys, "_n", F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_carry"))
    lifted = _join_groups(inner, carry.where(F.col("_n") > hot_rows).drop("_n"), keys)
    return cold.unionByName(lifted.withColumn(out, F.col(out) + F.col("_carry")).drop("_carry")).drop("_cell")


def dense_index(df: DataFrame, order: Sequence[str | Column], out: str = "row_index") -> DataFrame:
    """Number rows 1..n along the total order `order` without a one-task sort."""
    chunks = range_chunks(df, order, "dense_index")
    # One row per chunk: the only frame that is not partitioned.
    before = Window.partitionBy(F.lit(0)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunks.groupBy(CHUNK).agg(F.count("*").alias("_n"))
        .select(CHUNK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(CHUNK).orderBy(*order)
    return (
        chunks.join(offsets, CHUNK)
        .withColumn(out, F.col("_offset") + F.row_number().over(inside))
        .drop("_offset", CHUNK)
    )


def ranked_values(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their count `n`, the rank `upto` of their last copy and the group's `total`.

    Repeated values meet before the shuffle, and no buffer grows with the data.
    """
    freq = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    chunks = range_chunks(freq, [*by, value], "ranked_values")
    parts = chunks.groupBy(*by, CHUNK).agg(F.sum("n").alias("_part"))
    ranked = _piecewise(chunks, parts, by, CHUNK, [value], "n", "upto").drop(CHUNK)
    return _join_groups(ranked, parts.groupBy(*by).agg(F.sum("_part").alias("total")), by)


def value_at(rank: Column, value: str) -> Column:
    """Aggregate over `ranked_values`: the value at a zero-based rank."""
    hit = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
    return F.max(F.when(hit, F.col(value)))


def quantile(value: str, p: float) -> Column:
    """Aggregate over `ranked_values`: quantile interpolated between neighbours."""
    pos = F.lit(p) * (F.col("total") - 1)
    low, high = (value_at(r, value).cast("double") for r in (F.floor(pos), F.ceil(pos)))
    return low + (high - low) * F.max(pos - F.floor(pos))


def upper_median(value: str) -> Column:
    """Aggregate over `ranked_values`: middle element, the upper one of an even count."""
    return value_at(F.floor(F.col("total") / 2), value)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per group, one output column per entry of `probs`."""
    ranked = ranked_values(df, by, value)
    return ranked.groupBy(*by).agg(*[quantile(value, p).alias(name) for name, p in probs.items()])
