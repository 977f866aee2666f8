"""Homomorphic multiset hash of documents: the sum of wide vectors hashed from paragraphs, modulo 2^16.

Every paragraph hashes to a vector of 256 entries of plus or minus one; a
document's fingerprint is their sum. The order of paragraphs does not matter,
equal multisets give equal sums, and inserting or deleting a paragraph adds or
subtracts its vector. As the vectors of different paragraphs are nearly
orthogonal, the cosine of two fingerprints estimates how much of their
paragraphs two documents share.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.text import mix64, to_arrow

LANES = 256
# Paragraphs longer than this many characters are cut after words that their own hash selects.
LONG = 160
# Documents per range of ids, and ranges at most.
RANGE_ROWS = 4096
MOST_RANGES = 20_000
_LOWEST = -(1 << 63)


def paragraphs(text: str) -> list[str]:
    """Pieces of the lines of a text: a line is cut after sentence ends, a long piece after words chosen by their hash."""
    out = []
    for line in text.replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n").split("\n"):
        line = line.strip()
        if len(line) <= LONG:
            if line:
                out.append(line)
            continue
        run = []
        for word in line.split(" "):
            run.append(word)
            if xxhash.xxh32_intdigest(word) % 8 == 0:
                out.append(" ".join(run))
                run = []
        if run:
            out.append(" ".join(run))
    return out


def vector_sum(parts: list[str]) -> np.ndarray:
    """Sum of the vectors of some paragraphs modulo 2^16, as signed lanes."""
    if not parts:
        return np.zeros(LANES, np.int16)
    h = np.fromiter((xxhash.xxh3_64_intdigest(p) for p in parts), np.uint64, len(parts))
    seeds = np.arange(1, LANES // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.unpackbits(mix64(h[:, None] + seeds).view(np.uint8), axis=1)
    return (2 * bits.sum(0, dtype=np.int64) - len(parts)).astype(np.int16)


def fingerprint(text: str) -> np.ndarray:
    return vector_sum(paragraphs(text))


def changed(print_: np.ndarray, inserted: list[str] = (), deleted: list[str] = ()) -> np.ndarray:
    """The fingerprint after paragraphs were inserted and deleted, without the rest of the document."""
    return print_ + vector_sum(list(inserted)) - vector_sum(list(deleted))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two fingerprints within 0 and 1; equal ones, two empty ones among them, are at 1."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a.astype(np.float64), b.astype(np.float64)
    size = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / size)) if size else 0.0


def as_text(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype("<i2").tobytes()).decode()


def _ranges(ids: DataFrame) -> tuple[list[int], dict[int, list[int]]]:
    """Bounds that cut the ids into ranges, and for the top id of each range the range above that needs it as a neighbour."""
    count = ids.count()
    if not count:
        return [], {}
    parts = min(MOST_RANGES, -(-count // RANGE_ROWS))
    probs = [i / parts for i in range(1, parts)]
    bounds = sorted({int(b) for b in ids.approxQuantile("k", probs, 0.25 / parts)}) if probs else []
    number = _range_of(bounds)
    tops = sorted((r.p, r.top) for r in ids.groupBy(number("k").alias("p")).agg(F.max("k").alias("top")).collect())
    needed: dict[int, list[int]] = {}
    for i, (p, _) in enumerate(tops):
        needed.setdefault(tops[i - 1][1], []).append(p)
    return bounds, needed


def _range_of(bounds: list[int]):
    cuts = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def number(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), side="right").astype(np.int32))

    return number


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows (p, ghost, doc_id, text) in partitions sorted by descending id, each range followed by the row that comes next.

    The only shuffle of texts. Rows with equal ids are ordered by text; null
    ids come last.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_LOWEST)).alias("k"))
    bounds, needed = _ranges(docs.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("k")))
    cuts = np.array(bounds, np.int64)

    @F.pandas_udf("array<int>")
    def places(k: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, k.to_numpy(), side="right").tolist()
        return pd.Series([[p, *needed.get(key, ())] for p, key in zip(own, k.tolist(), strict=True)])

    rows = keyed.withColumn("at", places("k")).select("doc_id", "text", "k", F.posexplode("at").alias("ghost", "p"))
    return rows.repartition("p").sortWithinPartitions(
        "p", F.col("ghost") > 0, F.desc("k"), F.desc_nulls_last("doc_id"), "text").select("p", "ghost", "doc_id", "text")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, with their likeness.

    The edited text is the text with its last third replaced by the beginning
    of the next row's text in descending order of doc_id; after the last row
    comes the first. Null texts are empty; rows that repeat an id follow each
    other ordered by text, null ids come last, a single row is its own next.
    Other columns are ignored.
    """
    wanted = to_arrow(_OUT)

    def run(batches):
        place, open_ = None, None
        for batch in batches:
            out = [[] for _ in wanted]
            columns = [batch.column(n).to_pylist() for n in ("p", "ghost", "doc_id", "text")]
            for p, ghost, doc, text in zip(*columns, strict=True):
                if p != place:
                    place, open_ = p, None
                elif open_ is None:
                    continue
                print_ = fingerprint(text)
                if open_ is not None:
                    own, n, before, old = open_[0], len(open_[1]), open_[1], open_[2]
                    edited = before[:n - n // 3] + text[:n // 3]
                    new = fingerprint(edited)
                    row = (own, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(old), as_text(new), likeness(old, new), likeness(old, print_))
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
                # After the row beyond the range nothing of it is left.
                open_ = None if ghost else (doc, text, print_)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, wanted, strict=True)], schema=wanted)

    return beside_next(docs.select("doc_id", "text")).mapInArrow(run, _OUT)
