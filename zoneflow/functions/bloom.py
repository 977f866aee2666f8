"""Bloom filter over ids, built and probed with Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64
# Probing by lookup ships the whole filter to each task: 2^26 bits are 8 MB.
MAX_LOOKUP_BITS = 1 << 26


def position(ids: Column, i: Column, m: int) -> Column:
    """Bit position i of an id: sha256(`id:i`) as a 256-bit number modulo m; null for a null id."""
    if not 0 < m < 1 << 31:
        raise ValueError("m must be between 1 and 2^31 - 1")
    digest = F.sha2(F.concat(ids.cast("string"), F.lit(":"), i.cast("string")), 256)
    # Fifteen hex digits fit a bigint; reduced and weighted groups stay below m * m.
    total = F.lit(0).cast("bigint")
    for start in range(1, 65, 15):
        width = min(15, 65 - start)
        group = F.conv(F.substring(digest, start, width), 16, 10).cast("bigint") % m
        total = total + group * F.lit(pow(16, 65 - start - width, m)).cast("bigint") % m
    return total % m


def positions(ids: Column, m: int, k: int) -> Column:
    return F.array(*[position(ids, F.lit(i), m) for i in range(k)])


def bloom_build(ids: DataFrame, column: str, m: int, k: int) -> DataFrame:
    """Set bits as (word, bits): at most m/64 rows, however many ids there are; null ids set none."""
    turns = ids.where(F.col(column).isNotNull()).select(column, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i"))
    spots = turns.select(position(F.col(column), F.col("i"), m).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % WORD).cast("int"))
    return spots.groupBy((F.col("p") / WORD).cast("bigint").alias("word")).agg(F.bit_or(bit).alias("bits"))


def bloom_contains(ids: DataFrame, column: str, bloom: DataFrame, m: int, k: int, out: str = "maybe_seen") -> DataFrame:
    """Add a flag: False is certain, True may be a false positive, a null id has null.

    A small filter is a constant array that every row looks into; a larger one
    is joined word by word.
    """
    if m <= MAX_LOOKUP_BITS:
        words = ids.sparkSession.range((m + WORD - 1) // WORD).withColumnRenamed("id", "word")
        dense = words.join(bloom, "word", "left").agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))),
                lambda w: w["bits"],
            ).alias("w")
        ).scalar()
        # The filter stays a constant of these expressions and never enters a row.
        # Summed rather than and-ed: each position is then computed once, in a
        # method of its own that the JVM can compile.
        def bit(i: int) -> Column:
            p = position(F.col(column), F.lit(i), m)
            word = F.element_at(dense, (F.floor(p / WORD) + 1).cast("int"))
            return F.getbit(word, (p % WORD).cast("int")).cast("int")

        found = reduce(Column.__add__, [bit(i) for i in range(k)]) == k
        return ids.withColumn(out, found)
    distinct = ids.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_p", F.explode(positions(F.col(column), m, k)))
    probes = distinct.withColumn("word", (F.col("_p") / WORD).cast("bigint")).join(bloom, "word", "left")
    hit = F.coalesce(F.getbit("bits", (F.col("_p") % WORD).cast("int")) == 1, F.lit(False))
    flags = probes.groupBy(column).agg(F.min(hit).alias(out))
    return ids.join(flags, column, "left")


def bloom_add_if_new(
    arrivals: DataFrame, column: str, order: str, m: int, k: int, held: DataFrame | None = None, out: str = "accepted",
) -> DataFrame:
    """Add a flag to every arrival: whether a filter that takes in new ids only, one after the other along `order`, adds it.

    An id that is taken for a copy changes no bit, and one that is not sets all
    of its bits. So a bit is set by the first arrival that has it among its
    positions, be that one accepted or not, and an arrival is accepted exactly
    if it is the first of some bit: one minimum per bit, reduced within each
    task, replaces the sequence. The minima are at most `m` rows; each is one
    accepted arrival.

    `held` is a filter from `bloom_build` that the arrivals meet; `bloom_build`
    over the accepted ids, together with `held`, is the filter after them. A
    null id has a null flag and sets nothing. `order` must tell arrivals apart;
    where it is null, the flag is null too.
    """
    usable = F.col(column).isNotNull() & F.col(order).isNotNull()
    turns = arrivals.where(usable).select(column, order, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"))
    firsts = turns.select(F.col(order).alias("_first"), position(F.col(column), F.col("_i"), m).alias("_p")).groupBy("_p").agg(F.min("_first").alias("_first"))
    if held is not None:
        taken = F.coalesce(F.getbit("bits", (F.col("_p") % WORD).cast("int")) == 1, F.lit(False))
        spots = firsts.withColumn("_word", (F.col("_p") / WORD).cast("bigint"))
        firsts = spots.join(held, F.col("_word") == F.col("word"), "left").where(~taken)
    setters = firsts.select("_first").distinct().withColumn("_set", F.lit(True))
    flagged = arrivals.join(setters, F.col(order) == F.col("_first"), "left")
    return flagged.withColumn(out, F.when(usable, F.coalesce("_set", F.lit(False)))).drop("_first", "_set")


def merge_blooms(one: DataFrame, two: DataFrame) -> DataFrame:
    """Filter of the ids of two filters with the same m and k."""
    return one.unionByName(two).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def false_positive_rate(n: Column, m: int, k: int) -> Column:
    return F.pow(1 - F.exp(-k * n / F.lit(float(m))), F.lit(k))


def bloom_stats(n: Column, m: int, k: int) -> dict[str, Column]:
    """Expected fill after n ids: bits set, saturation and false positives in percent, memory."""
    filled = 1 - F.exp(-k * n / F.lit(float(m)))
    bits = F.floor(m * filled).cast("bigint")
    return {
        "bits_set": bits,
        "saturation_pct": F.round(bits / m * 100, 2),
        "false_positive_pct": F.round(false_positive_rate(n, m, k) * 100, 6),
        "memory_kb": F.lit(m // 8 // 1024),
    }
