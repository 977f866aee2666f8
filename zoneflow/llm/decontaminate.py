"""Find benchmark passages in documents by a broadcast set of word windows, and remove them.

The windows are compared as sequences of word numbers of the benchmark's own
vocabulary: a rolling hash proposes a position, the words themselves decide.
The benchmark is stored in pieces, and pieces form blocks of a checked size. One
block at a time passes the driver and travels to the tasks, so neither grows
with the benchmark. A benchmark of one block is found in a narrow pipeline; of
more, each block's hits are stored, and its broadcast goes, before the next.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zoneflow.llm.text import free_prefix, map_batches, mix64, raw_texts, same_columns, to_array, to_arrow
from zoneflow.session import write_table

# Benchmark words, long ones counted by eight bytes, that one pass over the documents carries to every task.
BLOCK_WORDS = 1_000_000
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(raw: bytes | None) -> list[bytes]:
    """Runs of digits, letters a-z and characters beyond ASCII, after A-Z are lower-cased."""
    return raw.translate(_KEEP).split() if raw else []


class Windows:
    """All windows of some benchmark items, by their length."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.ids: dict[bytes, int] = {}
        found: dict[int, dict[bytes, set[str]]] = {}
        for item, raw in items:
            own = words(raw)
            numbers = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in own], np.int64)
            size = min(width, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(numbers[i:i + size].tobytes(), set()).add(item)
        self.found = found
        self.hashes = {
            size: np.sort(self._roll(np.concatenate([np.frombuffer(w, np.int64) for w in own]), size)[::size])
            for size, own in found.items()}

    @staticmethod
    def _roll(numbers: np.ndarray, size: int) -> np.ndarray:
        n, h = len(numbers) - size + 1, mix64(numbers.astype(np.uint64) + _STEP)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = total * _STEP + h[k:n + k]
        return total

    def hits(self, own: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items with a window among these words, and the word ranges the windows cover."""
        items, ranges = set(), []
        numbers = np.fromiter(map(self.ids.get, own, repeat(0)), np.int64, len(own))
        gaps = np.concatenate([np.zeros(1, np.int64), np.cumsum(numbers == 0)])
        for size, known in self.found.items():
            if len(own) < size:
                continue
            at = np.flatnonzero(gaps[size:] == gaps[:-size])
            if not len(at):
                continue
            rolled, hashes = self._roll(numbers, size)[at], self.hashes[size]
            place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for i in at[hashes[place] == rolled].tolist():
                owners = known.get(numbers[i:i + size].tobytes())
                if owners:
                    items |= owners
                    ranges.append((i, i + size))
        return items, ranges


@dataclass
class _Benchmark:
    """Stored pieces of the items, and the first and last bucket of each block."""

    pieces: DataFrame
    blocks: list[tuple[int, int]]
    width: int

    def block(self, number: int) -> list[tuple[str, bytes]]:
        rows = self.pieces.where(F.col("bucket").between(*self.blocks[number])) if len(self.blocks) > 1 else self.pieces
        return [(r.item, bytes(r.piece)) for r in rows.select("item", "piece").collect()]


def _stored(benchmark: DataFrame, width: int, item_col: str, text_col: str, block_words: int) -> _Benchmark:
    """Pieces overlap by one word less than a window, so each window of an item lies in exactly one.

    Pieces are dealt to buckets by hash, some sixteen to a block's worth of
    words, and neighbouring buckets join up to `block_words`. The driver sees the
    size of each bucket before it takes one.
    """
    step = max(1, block_words // 8)

    def cut(batch):
        out = {"item": [], "piece": [], "size": []}
        for item, raw in zip(batch.column("item").to_pylist(), raw_texts(batch.column("text")), strict=True):
            own = words(raw)
            for at in range(0, max(len(own) - width, 0) + 1, step) if own else ():
                part = own[at:at + step + width - 1]
                out["item"].append(item)
                out["piece"].append(b" ".join(part))
                out["size"].append(max(len(part), len(out["piece"][-1]) // 8))
        return out

    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).dropna()
    pieces = write_table(map_batches(items, cut, "item string, piece binary, size long").dropDuplicates(["item", "piece"]), "benchmark")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    if total <= block_words:
        return _Benchmark(pieces, [(0, 0)], width)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("item", "piece"), F.lit(16 * total // block_words)))
    blocks, room = [], 0
    for bucket, size in sorted(pieces.groupBy("bucket").agg(F.sum("size")).collect()):
        if size > room:
            blocks.append((bucket, bucket))
            room = block_words
        blocks[-1], room = (blocks[-1][0], bucket), room - size
    return _Benchmark(pieces, blocks, width)


def _marked(docs: DataFrame, shared, width: int, text_col: str, mark: str, hits_only: bool) -> DataFrame:
    """Rows with a block's items and word ranges; with `hits_only`, those rows that have some."""
    schema = T.StructType([*docs.schema.fields, T.StructField(f"{mark}items", T.ArrayType(T.StringType())),
                           T.StructField(f"{mark}ranges", T.ArrayType(T.IntegerType()))])
    names, wanted = docs.columns, to_arrow_schema(schema)
    built = []

    def run(batches):
        if not built:
            built.append(Windows(shared.value, width))
        for batch in batches:
            found = [built[0].hits(words(raw)) for raw in raw_texts(batch.column(text_col))]
            new = [sorted(items) for items, _ranges in found], [[x for pair in ranges for x in pair] for _items, ranges in found]
            columns = [*(batch.column(n) for n in names), *new]
            out = pa.RecordBatch.from_arrays([to_array(c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)
            yield out.filter(pa.array([bool(ranges) for ranges in new[1]], pa.bool_())) if hits_only else out

    return docs.mapInArrow(run, schema)


def _scan(docs: DataFrame, known: _Benchmark, text_col: str, mark: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    if len(known.blocks) == 1:
        return _marked(docs, context.broadcast(known.block(0)), known.width, text_col, mark, False)
    row, items, ranges = f"{mark}row", f"{mark}items", f"{mark}ranges"
    numbered = write_table(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    parts = []
    for number in range(len(known.blocks)):
        shared = context.broadcast(known.block(number))
        hits = _marked(numbered.select(row, text_col), shared, known.width, text_col, mark, True).drop(text_col)
        parts.append(write_table(hits, "hits"))
        shared.destroy()
    hits = reduce(DataFrame.unionAll, parts).groupBy(row).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items),
        F.flatten(F.collect_list(ranges)).alias(ranges))
    return numbered.join(hits, row, "left").drop(row).withColumns({
        items: F.coalesce(items, F.array().cast("array<string>")), ranges: F.coalesce(ranges, F.array().cast("array<int>"))})


def scan_windows(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", item_col: str = "item_id",
                 benchmark_text: str = "text", block_words: int = BLOCK_WORDS, mark: str = "_") -> DataFrame:
    """`docs` with the columns `items` (sorted ids of the items met) and `ranges` (flat word starts and ends).

    A window is `width` consecutive item words, or all words of a shorter item.
    Null texts have no words; items with a null id or text are ignored; items
    that repeat count once, and so do rows of one item. Every row of `docs` stays,
    in any number of copies and with all its columns; the new names begin with
    `mark`, which no column may begin with. A very long text is one row of a task.
    """
    return _scan(docs, _stored(benchmark, width, item_col, benchmark_text, block_words), text_col, mark)


def _covered(ranges: list[int], n: int) -> np.ndarray:
    """Mask of the words inside any range."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, ranges[::2], 1)
    np.add.at(change, ranges[1::2], -1)
    return np.cumsum(change[:-1]) > 0


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, **names: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row.

    Null and empty texts have no words and no hits; other columns of `docs` play no part.
    """
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    wanted = to_arrow(schema)
    found = scan_windows(docs.select("doc_id", "text"), benchmark, width, **names)

    def run(batches):
        for batch in batches:
            n_words, n_hit, n_items, digests = [], [], [], []
            rows = zip(raw_texts(batch.column("text")), batch.column("_items").to_pylist(), batch.column("_ranges").to_pylist(), strict=True)
            for raw, items, ranges in rows:
                n = len(words(raw))
                n_words.append(n)
                n_hit.append(int(_covered(ranges, n).sum()) if ranges else 0)
                n_items.append(len(items))
                digests.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            out = [batch.column("doc_id"), n_words, n_hit, n_items, digests, [h > 0 for h in n_hit]]
            yield pa.RecordBatch.from_arrays([to_array(x, f.type) for x, f in zip(out, wanted, strict=True)], schema=wanted)

    return found.mapInArrow(run, schema)


def _without(raw: bytes, ranges: list[int]) -> bytes:
    spans = [m.span() for m in WORD.finditer(raw.translate(_KEEP))]
    keep, at, parts = _covered(ranges, len(spans)), 0, []
    for (start, end), hit in zip(spans, keep.tolist(), strict=True):
        if hit:
            parts.append(raw[at:start])
            at = end
    return b"".join([*parts, raw[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, drop_share: float = 0.5,
                  block_words: int = BLOCK_WORDS, rounds: int = 3) -> DataFrame:
    """Rows of `docs` with the hit words cut out of `text`; rows with a larger share of hit words than `drop_share` go.

    Clean rows stay as they are, nulls, copies and columns of any name included.
    A cut may bring words together that form another window, so hit documents
    are scanned again `rounds` times; one that still has a hit after that goes too.
    """
    names, wanted = same_columns(docs)
    known = _stored(benchmark, width, "item_id", "text", block_words)
    if len(known.blocks) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(known.block(0))
        return docs.mapInArrow(_cleaner(names, wanted, shared, width, drop_share, rounds), docs.schema)
    mark, done, hit = free_prefix(names), [], docs
    is_hit = F.size(f"{mark}ranges") > 0
    for step in range(rounds + 1):
        if step:
            hit = hit.mapInArrow(_cutter(names, wanted, f"{mark}ranges", drop_share), docs.schema)
        found = write_table(_scan(hit, known, "text", mark), "scanned")
        done.append(found.where(~is_hit).select(*[f"`{n}`" for n in names]))
        hit = found.where(is_hit)
        if hit.isEmpty():
            break
    return reduce(DataFrame.unionAll, done)


def _cut(raw: bytes, ranges: list[int], drop_share: float) -> bytes | None:
    """The text without its hit words, None where they are too large a share."""
    n = len(words(raw))
    return None if _covered(ranges, n).sum() > drop_share * n else _without(raw, ranges)


def _replaced(batch: pa.RecordBatch, names: list[str], wanted: pa.Schema, texts: list, keep: list[bool]) -> pa.RecordBatch:
    out = [to_array(texts if n == "text" else batch.column(n), wanted.field(n).type) for n in names]
    return pa.RecordBatch.from_arrays(out, schema=wanted).filter(pa.array(keep, pa.bool_()))


def _cutter(names: list[str], wanted: pa.Schema, ranges_col: str, drop_share: float):
    def run(batches):
        for batch in batches:
            cut = [_cut(raw, ranges, drop_share)
                   for raw, ranges in zip(raw_texts(batch.column("text")), batch.column(ranges_col).to_pylist(), strict=True)]
            texts = [None if raw is None else raw.decode() for raw in cut]
            yield _replaced(batch, names, wanted, texts, [raw is not None for raw in cut])

    return run


def _cleaner(names: list[str], wanted: pa.Schema, shared, width: int, drop_share: float, rounds: int):
    """Scan, cut and scan again, a text at a time, where one block holds the whole benchmark."""
    built = []

    def clean(raw: bytes | None) -> tuple[bytes | None, bool]:
        for step in range(rounds + 1):
            _items, ranges = built[0].hits(words(raw))
            if not ranges:
                return raw, True
            raw = _cut(raw, [x for pair in ranges for x in pair], drop_share) if step < rounds else None
            if raw is None:
                break
        return None, False

    def run(batches):
        if not built:
            built.append(Windows(shared.value, width))
        for batch in batches:
            cleaned = [clean(raw) for raw in raw_texts(batch.column("text"))]
            texts = [None if raw is None else raw.decode() for raw, _keep in cleaned]
            yield _replaced(batch, names, wanted, texts, [keep for _raw, keep in cleaned])

    return run
