"""Text search over a table by an index of trigrams.

A row can only match a pattern if it holds every trigram of the texts that the
pattern cannot do without. The index lists by trigram, sorted, which rows of a
run of rows hold it, a row by the 32-bit hash of its key, so a search reads the
few row groups of its trigrams and meets their lists run by run; the pattern
then decides among the rows found. A pattern that demands no trigram reads all
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.cleaning import search_rows
from zoneflow.session import scratch, write_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters that stand for something else in a pattern.
_SPECIAL = frozenset("\\^$.|?*+()[]{}")


# Bytes of text that one run of rows holds at most, unless it is a single row.
RUN_BYTES = 1 << 22
INDEX = "gram int, run long, keys array<int>"


def _low(text: Column) -> Column:
    """A text with A-Z in lower case, as patterns ignore it."""
    return F.translate(text.cast("string"), _UPPER, _LOWER)


def _hashed(key: str) -> Column:
    """32-bit hash of a key; keys that share one only make a search look at more rows."""
    return F.hash(key)


def text_grams(text: str) -> list[int]:
    """Different trigrams of a text: three bytes of its UTF-8, as a number."""
    raw = text.encode()
    return sorted({int.from_bytes(raw[i:i + 3]) for i in range(len(raw) - 2)})


def _ends(column: pa.Array) -> np.ndarray:
    """Where the texts of a column begin and end among its bytes."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def _postings(texts: list[pa.Array]) -> np.ndarray:
    """Different (trigram, row) of columns of texts, sorted, as trigram times 2^32 plus row."""
    found = []
    for column in texts:
        ends = _ends(column)
        sizes = np.maximum(np.diff(ends) - 2, 0)
        total = int(sizes.sum())
        if not total:
            continue
        raw = np.frombuffer(column.buffers()[2], np.uint8)
        rows = np.repeat(np.arange(len(column)), sizes)
        at = np.arange(total) + np.repeat(ends[:-1] - (np.cumsum(sizes) - sizes), sizes)
        grams = raw[at].astype(np.int64) << 16 | raw[at + 1].astype(np.int64) << 8 | raw[at + 2]
        found.append(grams << 32 | rows)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `RUN_BYTES` of text."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns[1:]:
        sizes += np.diff(_ends(column))
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // RUN_BYTES)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def search_index(df: DataFrame, key: str) -> DataFrame:
    """(gram, run, keys) of every trigram of every column's text, stored in the order of the trigrams.

    `keys` are the hashed keys of those rows of a run that hold the trigram. A
    trigram's runs span as many files as they need. Null keys are indexed too.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(INDEX))

    def index(batches):
        # Runs of a task are numbered apart from those of any other.
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            if not whole.num_rows:
                continue
            for batch in _runs(whole):
                postings = _postings(batch.columns[1:])
                grams = postings >> 32
                starts = np.flatnonzero(np.diff(grams, prepend=-1))
                keys = batch.column(0).to_numpy()[postings & 0xFFFFFFFF]
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(postings)), pa.int32()), pa.array(keys, pa.int32()))
                runs = pa.array(np.full(len(starts), number), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(grams[starts], pa.int32()), runs, lists.cast(wanted[2].type)], schema=wanted)
                number += 1

    rows = df.select(_hashed(key).alias("_key"), *[F.coalesce(_low(F.col(c)), F.lit("")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    # Stored as it comes, so that the bounds of the order are drawn from a table and not from the texts again.
    with scratch(df.sparkSession):
        found = write_table(rows.mapInArrow(index, INDEX), "postings")
        return write_table(found.repartitionByRange("gram", "run").sortWithinPartitions("gram", "run"), "trigrams", keep=True)


def demanded(pattern: str, regex: bool = True) -> list[str]:
    """Texts that every match holds; those inside groups, and any of a pattern with alternatives or flags, are not relied on."""
    if not regex:
        return [pattern]
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return []
    runs, run, depth, i = [], "", 0, 0

    def close(keep: str) -> None:
        nonlocal run
        runs.append(keep)
        run = ""

    while i < len(pattern):
        c = pattern[i]
        if c == "[":
            # A class is one unknown character; its first character is never its end.
            close(run)
            i += 2 if pattern[i + 1:i + 2] != "^" else 3
            while i < len(pattern) and pattern[i] != "]":
                # Classes within classes, and escapes in them, are left to the pattern itself.
                if pattern[i] in "[\\":
                    return []
                i += 1
        elif c == "\\":
            follows = pattern[i + 1:i + 2]
            if not follows or follows.isalnum():
                # A class of characters, a reference or a code of one: nothing after it is relied on either.
                close(run)
                return [r for r in runs if r]
            run += follows if not depth else ""
            i += 1
        elif c in "?*{":
            close(run[:-1])
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return []
        elif c == "(":
            close(run)
            depth += 1
        elif c == ")":
            close("")
            depth -= 1
        elif c in _SPECIAL:
            close(run)
        elif not depth:
            run += c
        i += 1
    close(run)
    return [r for r in runs if r]


def search_indexed(df: DataFrame, index: DataFrame, key: str, pattern: str, regex: bool = True) -> DataFrame:
    """The rows of `search_rows`, among those whose key the index has under every trigram of the texts that the pattern demands."""
    low = [t.translate(str.maketrans(_UPPER, _LOWER)) for t in demanded(pattern, regex)]
    grams = sorted({g for t in low for g in text_grams(t)})
    if not grams:
        return search_rows(df, pattern, regex)
    met = index.where(F.col("gram").isin(grams)).groupBy("run").agg(F.collect_list("keys").alias("lists")).where(F.size("lists") == len(grams))
    both = F.aggregate(F.slice("lists", 2, len(grams)), F.col("lists")[0], F.array_intersect)
    keys = met.select(F.explode(both).alias("_key")).distinct()
    return search_rows(df.join(keys, _hashed(key) == F.col("_key"), "left_semi"), pattern, regex)
