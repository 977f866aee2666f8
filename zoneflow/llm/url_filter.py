"""Judge page addresses by rules on host and path and by a list of canonical addresses.

The list is probed by a blocked Bloom filter first: an address sets one bit in
each of the four words of a single block, so a probe reads one block. Only what
passes goes on to an exact hash join with the list, which removes the false
positives. The filter has a fixed top size; a longer list lets more rows
through to the join and changes no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4
# Blocks of the filter at most: 32768 blocks of 256 bits are 1 MiB.
MOST_BLOCKS = 1 << 15

Rule = tuple[str, str, str]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Address without scheme, fragment, tracking parameters and a last slash; null without a host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)(=|$)")))
    stem = F.regexp_replace(path(url), "/+$", "")
    return F.when(host(url) != "", F.concat(host(url), stem, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def rule_of(host_col: Column, path_col: Column, rules: list[Rule], what: int) -> Column:
    """Text (`what` 0) or verdict (1) of the longest rule that fits; null if none does."""
    chain = F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host_col == rule_host) | host_col.endswith("." + rule_host)) & path_col.startswith(rule_path)
        chain = F.when(fits, F.lit((rule_host + rule_path, verdict)[what])).otherwise(chain)
    return chain


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    """The bit that an address sets in word `word` of its block."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(63).cast("int"))


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> Column:
    """The filter as one array of longs, four per block, as a scalar subquery."""
    marks = listed.select(
        _block(F.col(key), blocks).alias("b"), F.posexplode(F.array(*[_bit(F.col(key), w) for w in range(WORDS)])).alias("w", "mark"))
    words = marks.groupBy((F.col("b") * WORDS + F.col("w")).alias("word")).agg(F.bit_or("mark").alias("mark"))
    every = listed.sparkSession.range(blocks * WORDS).withColumnRenamed("id", "word").join(words, "word", "left")
    cells = F.array_sort(F.collect_list(F.struct("word", F.coalesce("mark", F.lit(0).cast("long")).alias("mark"))))
    return every.agg(F.transform(cells, lambda c: c["mark"]).alias("filter")).scalar()


def maybe_listed(key: Column, filter_: Column, blocks: int) -> Column:
    probe = F.lit(True)
    for w in range(WORDS):
        word = F.element_at(filter_, (_block(key, blocks) * WORDS + (w + 1)).cast("int"))
        probe = probe & (word.bitwiseAND(_bit(key, w)) != 0)
    return F.coalesce(probe, F.lit(False))


def judge_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row.

    The longest rule that fits decides; else an address whose canonical form is
    in `listed` (column `address`) is blocked and any other allowed. A null url
    or one without `://` has an empty host and path and is allowed. Repeated
    rows and null ids are kept; the list may repeat addresses or hold nulls.
    """
    url = F.col(url_col)
    known = listed.where("address is not null").select("address").distinct()
    rows = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("address"))
    ruled = rows.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules, 0), "ruling": rule_of(F.col("host"), F.col("path"), rules, 1)})
    # Sixteen bits for each address, up to the top size.
    blocks = min(MOST_BLOCKS, max(1, -(-known.count() // 16)))
    probed = ruled.withColumn("maybe", maybe_listed(F.col("address"), blocked_bloom(known, "address", blocks), blocks))
    passed = probed.where("maybe").join(known.withColumn("hit", F.lit(True)), "address", "left")
    both = passed.unionByName(probed.where("not maybe").withColumn("hit", F.lit(None).cast("boolean")))
    verdict = F.coalesce("ruling", F.when(F.coalesce("hit", F.lit(False)), "block").otherwise("allow"))
    return both.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def repeated_addresses(pages: DataFrame, url_col: str = "url", least: int = 2) -> DataFrame:
    """Canonical addresses of at least `least` rows, as a list for `judge_urls`: one page under many names."""
    return (
        pages.select(canonical(F.col(url_col)).alias("address")).where("address is not null")
        .groupBy("address").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("address")
    )
