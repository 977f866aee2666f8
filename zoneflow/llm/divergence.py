"""How the sources of a language differ from it and from each other in their words.

Every kept term has a smoothed share of its group's occurrences and one of its
language's. Both follow from two counts, so terms are grouped into cells by
(group count, language count): a divergence is evaluated once a cell, cells
are ranked with their multiplicities, cells of equal value are merged, and only
the cells that reach the wanted ranks are expanded into terms. Sources are
compared pairwise in the same way, by cells of two group counts.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.text import raw_texts, to_arrow
from zoneflow.session import write_table

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Distinct terms of all groups that a task counts before it hands them on.
COUNTED = 400_000
_COUNTS = "lang string, source string, term string, n long, d long"
# Fixed numbers of the audit: the scale of a share, and what is added to every count.
SCALE, SMOOTH = 1_000_000_000, 2


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents of each term of each group, summed within a task.

    A group's row may come from several tasks. Null texts, languages and sources are ''.
    """
    wanted = to_arrow(_COUNTS)

    def flush(groups):
        rows = [(lang, source, term, n, own[1][term]) for (lang, source), own in groups.items() for term, n in own[0].items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary()).cast(f.type) if pa.types.is_string(f.type) else pa.array(c, f.type)
             for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    def run(batches):
        groups, held = defaultdict(lambda: (Counter(), Counter())), 0
        for batch in batches:
            for lang, source, raw in zip(*(raw_texts(batch.column(c)) for c in ("lang", "source", "text")), strict=True):
                own, (n, d) = Counter((raw or b"").translate(_LETTERS).split()), groups[lang or b"", source or b""]
                held -= len(n)
                n.update(own)
                d.update(own.keys())
                held += len(n)
                if held >= COUNTED:
                    yield flush(groups)
                    groups.clear()
                    held = 0
        yield flush(groups)

    columns = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    return docs.select(*columns).mapInArrow(run, _COUNTS)


def _share(count: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exact for any long."""
    return (f"(1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + {SMOOTH})) "
            f"div (cast({total} as decimal(20,0)) + {SMOOTH} * cast({terms} as decimal(17,0))))")


def _divergence(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


class Audit:
    """Stored counts of one corpus: kept terms with their sources, cells of counts, and totals by group."""

    def __init__(self, docs: DataFrame, least_documents: int):
        spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # One shuffle serves both groupings: a term's rows of all sources meet in one partition.
        merged = (
            term_counts(docs).repartition(spread, "lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
            .groupBy("lang", "term").agg(
                F.sort_array(F.collect_list(F.struct("source", "n"))).alias("by"), F.sum("n").alias("total"), F.sum("d").alias("d"))
            .where(F.col("d") >= least_documents).drop("d"))
        self.kept = write_table(merged, "kept")
        self.cells = write_table(
            self.terms().groupBy("lang", "source", "n", "total").agg(F.count("*").alias("m")), "cells")
        groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        sizes = self.cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("size"))
        langs = self.kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_size"))
        self.groups = write_table(
            groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
            .na.fill(0, ["size", "v", "lang_size"]), "groups")

    def terms(self) -> DataFrame:
        """(lang, source, term, n, total) of every kept term that occurs in the group."""
        return self.kept.select("lang", "term", "total", F.explode("by").alias("x")).select(
            "lang", "x.source", "term", "x.n", "total")


def term_part(audit: Audit, ranks: int) -> DataFrame:
    """The `ranks` terms of each group whose share most exceeds that of the language."""
    by = Window.partitionBy("lang", "source")
    rated = (
        audit.cells.join(audit.groups, ["lang", "source"])
        .withColumn("p", F.expr(_share("n", "size", "v"))).withColumn("q", F.expr(_share("total", "lang_size", "v")))
        .where("p > q").withColumn("value", F.expr(_divergence("p", "q")))
        .select("lang", "source", "n", "total", "m", "value"))
    # Equal values are one step of the ranking; at most `ranks` steps reach the report, and of them those that begin within it.
    steps = (
        rated.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
        .withColumn("step", F.row_number().over(by.orderBy(F.desc("value")))).where(F.col("step") <= ranks)
        .withColumn("before", F.sum("m").over(by.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce("before", F.lit(0)) < ranks).select("lang", "source", "value"))
    reached = rated.join(steps, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value")
    return (
        audit.terms().join(reached, ["lang", "source", "n", "total"])
        .withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "term"))).where(F.col("rank") <= ranks)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def pair_part(audit: Audit) -> DataFrame:
    """Every other source of a group's language by the sum of divergences over all kept terms.

    For two sources the sum over all terms is written as
    V f(0,0) + sum over the terms of a of f(n,0) - f(0,0) + the same for b
    + sum over the terms of both of f(n,k) - f(n,0) - f(0,k) + f(0,0),
    so only terms that both hold ever meet, and they as cells of equal counts.
    """
    groups = audit.groups.select("lang", "source", "size", "v")
    one, two = ([F.col("source").alias(s), F.col("size").alias(f"{s}_size")] for s in "ab")
    pairs = write_table(groups.select("lang", "v", *one).join(groups.select("lang", *two), "lang").where("a < b"), "pairs")

    # Terms with the same counts in the same sources are one row.
    alike = audit.kept.groupBy("lang", "by").agg(F.count("*").alias("m"))
    both = (
        alike.select("lang", "by", "m", F.posexplode("by").alias("at", "x"))
        .select("lang", "m", "x", F.explode(F.expr("slice(by, at + 2, size(by))")).alias("y"))
        .groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
        .agg(F.sum("m").alias("m")))
    own = audit.cells.groupBy("lang", "source", "n").agg(F.sum("m").alias("m"))

    def f(a: str, b: str) -> str:
        return _divergence(_share(a, "a_size", "v"), _share(b, "b_size", "v"))

    zero = f("0", "0")
    parts = [
        pairs.select("lang", "a", "b", F.expr(f"case when v = 0 then 0 else v * ({zero}) end").alias("value")),
        pairs.join(own.withColumnRenamed("source", "a"), ["lang", "a"]).select("lang", "a", "b", F.expr(f"m * (({f('n', '0')}) - ({zero}))").alias("value")),
        pairs.join(own.withColumnRenamed("source", "b"), ["lang", "b"]).select("lang", "a", "b", F.expr(f"m * (({f('0', 'n')}) - ({zero}))").alias("value")),
        pairs.join(both, ["lang", "a", "b"]).select(
            "lang", "a", "b", F.expr(f"m * (({f('na', 'nb')}) - ({f('na', '0')}) - ({f('0', 'nb')}) + ({zero}))").alias("value")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    summed = write_table(rows.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "divergences")
    mirrored = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        summed.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return mirrored.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def source_divergence(docs: DataFrame, least_documents: int = 10, ranks: int = 10) -> DataFrame:
    """lang, source, part, item, value and rank of the audit of every (lang, source) group.

    A language keeps the terms found in at least `least_documents` of its
    documents. Part `pair` ranks all other sources of the language, part `term`
    the `ranks` kept terms that stand out most in the group. Null texts,
    languages and sources are ''; a group without terms has pairs but no terms,
    and pairs of a language without kept terms have the value 0. Equal values
    rank by the UTF-8 order of their items. Repeated rows are documents of
    their own; ids and other columns are not read; no rows give no rows.
    """
    audit = Audit(docs, least_documents)
    return pair_part(audit).unionByName(term_part(audit, ranks))
