"""Toxicity by two class-conditional Kneser-Ney bigram models.

Both models are counted over every labelled training row, and every count is
kept. A class's bigram probability backs off to the bigram counts of both
classes together, these to the class's continuation counts, and those to the
continuation counts of both classes, so a rare expression is smoothed by what
the classes share. A document's score compares its two log-likelihoods, each
divided by the number of words, over the whole text and over its strongest
windows of several widths.

Texts become runs: a task numbers the words of some hundred thousand
consecutive tokens once, and from there on a document is a list of small
numbers. The counts are hash-partitioned tables that grow with the corpus. A
run asks each partition once for all the distinct words and bigrams it holds,
in one packed block, and gets their counts back in one; nothing is sent per
word or per document, and no task holds the model.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.decontaminate import words
from zoneflow.llm.text import Memo, free_prefix, held_out, mix64, raw_texts, to_arrow
from zoneflow.llm.url_filter import blocked_bloom, maybe_listed
from zoneflow.session import scratch, write_table

# Words and documents of a run, at most; a longer document is a run of its own.
RUN_WORDS = 1 << 20
RUN_DOCS = 1 << 17
# Training words whose bigrams one partition of the counts holds, about.
PART_WORDS = 1 << 19
# Words of bigram partitions that a task holds before it hands on their counts.
HELD_WORDS = 1 << 20
# Bits that tell bigrams of a partition apart: an unknown bigram is taken for a known one once in 130,000 times.
PRINT_BITS = 36
# Parts of the runs that are scored one after the other, each with its own shuffle; bounds the disk, not the work.
SLICES = 4
WINDOWS = (1, 2, 4, 8)
# Most frequent words of a run that each class of frequency ends with.
CLASSES = (1 << 8, 1 << 12, 1 << 16)
# Labelled rows per class that the score is calibrated on, in expectation.
CALIBRATION_ROWS = 5000
# Blocks of the filter that keeps most kept rows out of the last shuffle.
BLOCKS = 1 << 14
# Stands before the first word of a text.
START = 0x1E3779B9
_U = np.uint64
_RUN = "run long, ids array<long>, digests binary, sizes binary, words binary, places binary"
_TRAINING = f"{_RUN}, folds array<int>, chances array<long>"
_RUN_KIND = pa.schema([("run", pa.int64()), ("ids", pa.list_(pa.field("element", pa.int64()))), *((c, pa.binary()) for c in ("digests", "sizes", "words", "places"))])
# Of a word: contexts it follows (class 0, 1, both), its occurrences as a context by class, words that follow it (0, 1, both).
STATS = ("f0", "f1", "fb", "h0", "h1", "t0", "t1", "tb")
# Different bigrams of class 0, 1 and both; those that occur once and twice.
MARKS = ("types0", "types1", "typesb", "once0", "once1", "onceb", "twice0", "twice1", "twiceb")


def _hashes() -> Memo:
    """Number of 32 bits for each word; words that share one count as one."""
    return Memo(lambda word: xxhash.xxh3_64_intdigest(word) >> 32)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte plane by byte plane."""
    own = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(own.reshape(-1).view(np.uint8).reshape(-1, own.itemsize).T).tobytes(), 3)


def unpack(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_rows(values: np.ndarray) -> bytes:
    """Rows of whole numbers, column by column."""
    return pack(values.T)


def unpack_rows(raw: bytes, kind, width: int) -> np.ndarray:
    return unpack(raw, kind).reshape(width, -1).T


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(_U), prepend=_U(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, _U), dtype=_U)


@dataclass
class Run:
    """Consecutive documents: ids, words of each, the different words, and each token's place among them."""

    ids: list
    sizes: np.ndarray
    words: np.ndarray
    places: np.ndarray
    digests: bytes = b""

    @classmethod
    def of(cls, ids: list, texts: list[np.ndarray], digests: bytes = b"") -> Run:
        tokens = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        own, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, which compress well; words of one class of frequency are sorted, as their differences do.
        rank = np.empty(len(own), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(own))
        order = np.lexsort((own, np.searchsorted(CLASSES, rank, "right")))
        rank = np.empty(len(own), np.uint32)
        rank[order] = np.arange(len(own), dtype=np.uint32)
        return cls(ids, np.array([len(t) for t in texts], np.int64), own[order], rank[inverse.reshape(-1)], digests)

    @classmethod
    def read(cls, batch) -> Iterator[tuple[int, Run]]:
        for run, ids, digests, sizes, own, places in zip(*(batch.column(c).to_pylist() for c in ("run", "ids", "digests", "sizes", "words", "places")), strict=True):
            yield run, cls(ids, unpack(sizes, np.int64), np.cumsum(unpack(own, np.uint32), dtype=np.uint32), unpack(places, np.uint32), digests)

    def row(self, run: int) -> pa.RecordBatch:
        columns = [[run], [self.ids], [self.digests], [pack(self.sizes)], [pack(np.diff(self.words, prepend=np.uint32(0)))], [pack(self.places)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUN_KIND, strict=True)], schema=_RUN_KIND)

    def only(self, rows: list[int], ids: list) -> Run:
        """Some of the documents, under new ids."""
        ends = np.cumsum(self.sizes)
        return Run.of(ids, [self.words[self.places[ends[i] - self.sizes[i]:ends[i]]] for i in rows])

    def bigrams(self) -> np.ndarray:
        """Of every token the number of the word before it and its own, in one."""
        tokens = self.words[self.places].astype(_U)
        before = np.concatenate([np.zeros(1, _U), tokens[:-1]])[:len(tokens)]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = START
        return before << _U(32) | tokens


def tokenised(docs: DataFrame, digests: bool = False) -> DataFrame:
    """Stored runs of (doc_id, text) rows in input order; `digests` keeps the MD5 of each text beside its id."""
    def run(batches):
        from pyspark import TaskContext

        number, state = TaskContext.get().partitionId() << 32, _hashes()
        ids, texts, marks, held = [], [], [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch.column("text")), strict=True):
                own = words(raw)
                ids.append(doc_id)
                texts.append(np.fromiter(map(state.__getitem__, own), np.uint32, len(own)))
                if digests:
                    marks.append(hashlib.md5(raw or b"", usedforsecurity=False).digest())
                held += len(own)
                if held >= RUN_WORDS or len(ids) >= RUN_DOCS:
                    yield Run.of(ids, texts, b"".join(marks)).row(number)
                    number, ids, texts, marks, held = number + 1, [], [], [], 0
        if ids:
            yield Run.of(ids, texts, b"".join(marks)).row(number)

    return write_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _RUN), "runs")


def training_runs(runs: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Stored runs of the training documents alone, with labels as ids, folds and a number drawn from each id; and the number of their words.

    Ids meet their labels without their texts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col(label) == 1).cast("int").alias("label")).distinct()
    schema = "run long, place int, doc_id long, fold int, n long, chance long"
    wanted = to_arrow(schema)

    def run(batches):
        for batch in batches:
            for number, own in Run.read(batch):
                rows = [(number, at, i, zlib.crc32(str(i).encode()) % 5, int(n), xxhash.xxh3_64_intdigest(str(i)) >> 34)
                        for at, (i, n) in enumerate(zip(own.ids, own.sizes, strict=True)) if i is not None]
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    met = runs.mapInArrow(run, schema).where("fold > 0").join(known, "doc_id")
    by_run = write_table(met.groupBy("run").agg(F.collect_list(F.struct("place", "label", "fold", "chance")).alias("trained"), F.sum("n").alias("n")), "labelled")
    total = by_run.agg(F.sum("n")).first()[0] or 0
    out_kind = to_arrow(_TRAINING)

    def keep(batches):
        for batch in batches:
            for (number, own), trained in zip(Run.read(batch), batch.column("trained").to_pylist(), strict=True):
                mine = own.only([t["place"] for t in trained], [t["label"] for t in trained]).row(number)
                more = [pa.array([[t[c] for t in trained]], out_kind.field(f).type) for f, c in (("folds", "fold"), ("chances", "chance"))]
                yield pa.RecordBatch.from_arrays([*mine.columns, *more], schema=out_kind)

    return write_table(runs.join(by_run.select("run", "trained"), "run").mapInArrow(keep, _TRAINING), "training"), total


def _parts(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = mix64(keys.astype(_U))
    return (mixed >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _prints(keys: np.ndarray, bits: int) -> np.ndarray:
    """Partition and fingerprint of each bigram in one number."""
    return mix64(keys) >> _U(64 - PRINT_BITS - bits)


def _slices(parts: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """The stretch of each number in sorted `parts`."""
    edges = np.searchsorted(parts, np.arange(count + 1))
    for p in np.unique(parts).tolist():
        yield p, slice(edges[p], edges[p + 1])


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with the sums of their rows of counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
    return keys[first], np.add.reduceat(counts, first, axis=0)


_PAIRS = "part int, keys binary, counts binary, " + ", ".join(f"{m}_{v} long" for v in "ab" for m in MARKS)


def count_bigrams(training: DataFrame, bits: int) -> DataFrame:
    """One stored row a partition: its bigrams with their occurrences in folds 1 to 3 by class, then in fold 4, and its marks.

    Marks of variant a count folds 1 to 3, those of b all four.
    """
    schema = "part int, keys binary, counts binary"
    partial_kind = to_arrow(schema)

    def emit(held):
        keys, kinds = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, group = np.unique(keys, return_inverse=True)
        counts = np.bincount(4 * group.reshape(-1) + kinds, minlength=4 * len(keys)).reshape(-1, 4).astype(np.uint32)
        order = np.argsort(parts := _parts(keys, bits), kind="stable")
        keys, counts, parts = keys[order], counts[order], parts[order]
        rows = [(p, pack_sorted(keys[s]), pack_rows(counts[s])) for p, s in _slices(parts, 1 << bits)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 3, partial_kind, strict=True)], schema=partial_kind)

    def count(batches):
        held = []
        for batch in batches:
            for (_, own), folds in zip(Run.read(batch), batch.column("folds").to_pylist(), strict=True):
                held.append((own.bigrams(), np.repeat(np.array(own.ids, np.int64) + 2 * (np.array(folds) == 4), own.sizes)))
                # A run has few training documents: several are counted at once.
                if sum(len(k) for k, _ in held) >= RUN_WORDS:
                    yield emit(held)
                    held = []
        if held:
            yield emit(held)

    wanted = to_arrow(_PAIRS)

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = _merged(np.concatenate([unpack_sorted(k) for k in table.column("keys").to_pylist()]),
                               np.concatenate([unpack_rows(c, np.uint32, 4) for c in table.column("counts").to_pylist()]).astype(np.int64))
        marks = []
        for n in (counts[:, :2], counts[:, :2] + counts[:, 2:]):
            kinds = (n[:, 0], n[:, 1], n.sum(1))
            marks += [int(hit.sum()) for test in (lambda x: x > 0, lambda x: x == 1, lambda x: x == 2) for hit in map(test, kinds)]
        row = [table.column("part")[0].as_py(), pack_sorted(keys), pack_rows(counts), *marks]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, wanted, strict=True)], schema=wanted)

    return write_table(training.mapInArrow(count, schema).groupBy("part").applyInArrow(merge, _PAIRS), "pairs")


def printed(pairs: DataFrame, bits: int) -> DataFrame:
    """The stored bigrams by their prints, which take less than half the room of their words."""
    schema, low = "part int, prints binary, counts binary", _U((1 << PRINT_BITS) - 1)
    wanted = to_arrow(schema)

    def run(batches):
        for batch in batches:
            for part, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts")), strict=True):
                prints, counts = _merged(_prints(unpack_sorted(keys), bits) & low, unpack_rows(counts, np.int64, 4))
                columns = ([part], [pack_sorted(prints)], [pack_rows(counts)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    return write_table(pairs.select("part", "keys", "counts").mapInArrow(run, schema), "prints", keep=True)


def _word_stats(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different words of some bigrams with what these add to the STATS of variants a and b."""
    variants = (counts[:, :2], counts[:, :2] + counts[:, 2:])
    types = [np.c_[n > 0, n.sum(1) > 0].astype(np.uint32) for n in variants]
    after, follows = _merged(keys & _U(0xFFFFFFFF), np.concatenate(types, axis=1))
    before, opens = _merged(keys >> _U(32), np.concatenate([x for n, t in zip(variants, types, strict=True) for x in (n.astype(np.uint32), t)], axis=1))
    own = np.union1d(after, before)
    out, width, half = np.zeros((len(own), 2 * len(STATS)), np.uint32), len(STATS), len(MARKS) // 3
    a, b = np.searchsorted(own, after), np.searchsorted(own, before)
    for v in (0, 1):
        out[a, v * width:v * width + half] = follows[:, v * half:(v + 1) * half]
        out[b, v * width + half:(v + 1) * width] = opens[:, v * (width - half):(v + 1) * (width - half)]
    return own, out


def count_words(pairs: DataFrame, bits: int) -> DataFrame:
    """One stored row a partition: its words with STATS of variant a, then of b, and how many words follow anything in each class."""
    schema = "part int, words binary, stats binary"
    row_kind, width = to_arrow(schema), 2 * len(STATS)

    def emit(held):
        own, stats = _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))
        order = np.argsort(parts := _parts(own, bits), kind="stable")
        own, stats, parts = own[order], stats[order].astype(np.uint32), parts[order]
        rows = [(p, pack_sorted(own[s]), pack_rows(stats[s])) for p, s in _slices(parts, 1 << bits)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 3, row_kind, strict=True)], schema=row_kind)

    def split(batches):
        held = []
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                held.append(_word_stats(unpack_sorted(keys), unpack_rows(counts, np.int64, 4)))
                if sum(len(w) for w, _ in held) > HELD_WORDS:
                    yield emit(held)
                    held = []
        if held:
            yield emit(held)

    packed = schema + ", " + ", ".join(f"{m}_{v} long" for v in "ab" for m in ("v0", "v1", "vb"))
    wanted = to_arrow(packed)

    def gather(table: pa.Table) -> pa.Table:
        own, stats = _merged(np.concatenate([unpack_sorted(w) for w in table.column("words").to_pylist()]),
                             np.concatenate([unpack_rows(s, np.uint32, width) for s in table.column("stats").to_pylist()]).astype(np.int64))
        known = [int((stats[:, v * len(STATS) + f] > 0).sum()) for v in (0, 1) for f in range(3)]
        row = [table.column("part")[0].as_py(), pack_sorted(own), pack_rows(stats), *known]
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, wanted, strict=True)], schema=wanted)

    return write_table(pairs.select("keys", "counts").mapInArrow(split, schema).groupBy("part").applyInArrow(gather, packed), "words", keep=True)


@dataclass
class Totals:
    """What one variant of the model knows about all its bigrams."""

    types: list[int]
    discounts: list[float]
    known: list[int]


@dataclass
class Model:
    """Stored counts in 2^bits partitions, and the totals of variants a (folds 1 to 3) and b (all)."""

    prints: DataFrame
    words: DataFrame
    bits: int
    totals: dict[str, Totals] = field(default_factory=dict)

    def usable(self, variant: str) -> bool:
        return all(self.totals[variant].types[:2])


def train(training: DataFrame, total: int) -> Model:
    """Counts of all training documents; the number of partitions follows the number of their words."""
    bits = max(0, int(np.ceil(np.log2(max(1, total / PART_WORDS)))))
    pairs = count_bigrams(training, bits)
    own = count_words(pairs, bits)
    model = Model(printed(pairs, bits), own, bits)
    marks = pairs.agg(*[F.coalesce(F.sum(f"{m}_{v}"), F.lit(0)).alias(f"{m}_{v}") for v in "ab" for m in MARKS]).first()
    known = own.agg(*[F.coalesce(F.sum(f"{m}_{v}"), F.lit(0)).alias(f"{m}_{v}") for v in "ab" for m in ("v0", "v1", "vb")]).first()
    for v in "ab":
        once, twice = ([marks[f"{k}{c}_{v}"] for c in "01b"] for k in ("once", "twice"))
        model.totals[v] = Totals(
            [marks[f"types{c}_{v}"] for c in "01b"],
            [min(0.95, max(0.1, a / max(1, a + 2 * b))) for a, b in zip(once, twice, strict=True)],
            [known[f"v{c}_{v}"] for c in "01b"])
    return model


def _word_order(own: Run, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a run asks for its words, and their partitions in it."""
    parts = _parts(own.words, bits)
    order = np.lexsort((own.words, parts))
    return order, parts[order]


def _started(own: Run) -> Run:
    """The run with the start among its words."""
    if START in own.words:
        return own
    return Run(own.ids, own.sizes, np.append(own.words, np.uint32(START)), own.places, own.digests)


_ASKED = "part int, run long, words binary, prints binary"


def requests(runs: DataFrame, bits: int) -> DataFrame:
    """What each run asks of each partition: its words and bigrams there, one packed row."""
    wanted, low = to_arrow(_ASKED), _U((1 << PRINT_BITS) - 1)

    def run(batches):
        for batch in batches:
            for number, own in Run.read(batch):
                # The start of a text is a context like a word; every run asks for it.
                own = _started(own)
                prints = np.unique(_prints(own.bigrams(), bits))
                order, parts = _word_order(own, bits)
                of_words = dict(_slices(parts, 1 << bits))
                of_prints = dict(_slices((prints >> _U(PRINT_BITS)).astype(np.int64), 1 << bits))
                none = slice(0, 0)
                rows = [(p, number, pack_sorted(own.words[order[of_words.get(p, none)]]), pack_sorted(prints[of_prints.get(p, none)] & low))
                        for p in sorted(of_words.keys() | of_prints.keys())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, wanted, strict=True)], schema=wanted)

    return runs.mapInArrow(run, _ASKED)


def _looked_up(own: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rows of `values` of the keys among the sorted `own`, zeros for all others."""
    if not len(own):
        return np.zeros((len(keys), values.shape[1]), np.int64)
    at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
    return np.where((own[at] == keys)[:, None], values[at], 0)


_ANSWER = "run long, part int, stats binary, counts binary"


def answers(asked: DataFrame, model: Model, variant: str) -> DataFrame:
    """Counts of every word and bigram that was asked for, in the order asked."""
    wanted = to_arrow(_ANSWER)
    first = 0 if variant == "a" else len(STATS)
    stored = model.prints.select("part", F.lit(0).alias("kind"), F.col("prints").alias("keys"), F.col("counts").alias("values")).unionByName(
        model.words.select("part", F.lit(1).alias("kind"), F.col("words").alias("keys"), F.col("stats").alias("values")))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return wanted.empty_table()
        prints, counts = np.zeros(0, _U), np.zeros((0, 2), np.int64)
        own, stats = np.zeros(0, _U), np.zeros((0, len(STATS)), np.int64)
        for kind, keys, values in zip(*(right.column(c).to_pylist() for c in ("kind", "keys", "values")), strict=True):
            if kind:
                own, stats = unpack_sorted(keys), unpack_rows(values, np.int64, 2 * len(STATS))[:, first:first + len(STATS)]
            else:
                n = unpack_rows(values, np.int64, 4)
                prints, counts = unpack_sorted(keys), n[:, :2] if variant == "a" else n[:, :2] + n[:, 2:]
        rows = [(run, part, pack_rows(_looked_up(own, stats, unpack_sorted(w))), pack_rows(_looked_up(prints, counts, unpack_sorted(p))))
                for part, run, w, p in zip(*(left.column(c).to_pylist() for c in ("part", "run", "words", "prints")), strict=True)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), wanted, strict=True)], schema=wanted)

    return asked.groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(answer, _ANSWER)


def ratios(totals: Totals, stats: np.ndarray, before: np.ndarray, after: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio of class 1 to 0 of every word alone, and of every bigram.

    `stats` are rows of words, `before` and `after` the rows of each bigram's
    two words, `counts` its occurrences by class.
    """
    s = {n: stats[:, i].astype(np.float64) for i, n in enumerate(STATS)}
    d, both, hb = totals.discounts, counts.sum(1), s["h0"] + s["h1"]
    shared = (s["fb"] + 1) / (totals.types[2] + totals.known[2] + 1)

    def backed(n, discount, head, types, low):
        """Discounted counts on top of the lower level; nothing but that level where a context was never seen."""
        known = head > 0
        weight = np.where(known, discount * types / np.maximum(head, 1), 1.0)[before]
        return np.maximum(n - discount, 0) / np.maximum(head, 1)[before] + weight * low

    alone, pair = [], []
    for c in (0, 1):
        one = (np.maximum(s[f"f{c}"] - d[c], 0) + d[c] * totals.known[c] * shared) / totals.types[c]
        alone.append(one)
        pool = backed(both, d[2], hb, s["tb"], one[after])
        pair.append(backed(counts[:, c], d[c], s[f"h{c}"], s[f"t{c}"], pool))
    return np.log(alone[1] / alone[0]), np.log(pair[1] / pair[0])


def features(own: Run, alone: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Of every document the mean ratio of its bigrams, and the strongest window of each width of its words and of its bigrams."""
    out = np.zeros((len(own.sizes), 1 + 2 * len(WINDOWS)))
    full = np.nonzero(own.sizes)[0]
    if not len(full):
        return out
    ends = np.cumsum(own.sizes)
    starts, last = (ends - own.sizes)[full], np.repeat(ends[full], own.sizes[full])
    at, column = np.arange(len(own.places)), 1
    for x in (alone, pair):
        sums = np.concatenate([np.zeros(1), np.cumsum(x)])
        mean = (sums[ends[full]] - sums[starts]) / own.sizes[full]
        out[full, 0] = mean
        for k in WINDOWS:
            window = np.where(at + k <= last, (sums[np.minimum(at + k, len(x))] - sums[:-1]) / k, -np.inf)
            most = np.maximum.reduceat(window, starts)
            out[full, column] = np.where(own.sizes[full] < k, mean, most)
            column += 1
    return out


_FEATURES = "ids array<long>, digests binary, features binary"


def run_features(runs: DataFrame, model: Model, variant: str, slices: int = SLICES) -> DataFrame:
    """ids, digests and features of the documents of every run, stored.

    A part of the runs is scored at a time, so that what they ask and get never lies on disk as a whole.
    """
    part = F.pmod(F.xxhash64("run"), F.lit(slices))
    done = [write_table(_slice_features(runs.where(part == i), model, variant), "features") for i in range(slices)]
    return reduce(DataFrame.unionByName, done)


def _slice_features(runs: DataFrame, model: Model, variant: str) -> DataFrame:
    bits, totals, wanted = model.bits, model.totals[variant], to_arrow(_FEATURES)
    found = answers(requests(runs, bits), model, variant)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return wanted.empty_table()
        _, own = next(Run.read(left))
        asked = _started(own)
        # The prints of all tokens are sorted once; `inverse` leads back to the tokens.
        prints, inverse = np.unique(_prints(own.bigrams(), bits), return_inverse=True)
        order, parts = _word_order(asked, bits)
        stats, counts = np.zeros((len(asked.words), len(STATS)), np.int64), np.zeros((len(prints), 2), np.int64)
        of_words = dict(_slices(parts, 1 << bits))
        of_prints = dict(_slices((prints >> _U(PRINT_BITS)).astype(np.int64), 1 << bits))
        for part, s, c in zip(*(right.column(n).to_pylist() for n in ("part", "stats", "counts")), strict=True):
            if part in of_words:
                stats[order[of_words[part]]] = unpack_rows(s, np.int64, len(STATS))
            if part in of_prints:
                counts[of_prints[part]] = unpack_rows(c, np.int64, 2)
        after = own.places.astype(np.int64)
        before = np.concatenate([np.zeros(1, np.int64), after[:-1]])[:len(after)]
        before[(np.cumsum(own.sizes) - own.sizes)[own.sizes > 0]] = int(np.nonzero(asked.words == START)[0][0])
        alone, pair = ratios(totals, stats, before, after, counts[inverse.reshape(-1)])
        x = features(own, alone[after], pair)
        row = [own.ids, own.digests, x.tobytes()]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, wanted, strict=True)], schema=wanted)

    return runs.groupBy("run").cogroup(found.groupBy("run")).applyInArrow(score, _FEATURES)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 200, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (bias last), mean and scale of a logistic regression by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + ridge * np.eye(len(w)), z.T @ (p - y) / len(z) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def calibrate(training: DataFrame, model: Model, calibration_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Weights of the features, from a bounded sample of fold 4 scored by the models of folds 1 to 3; None without both classes."""
    if not model.usable("a"):
        return None
    rows = training.select(F.explode(F.arrays_zip("ids", "folds")).alias("t")).where("t.folds = 4")
    counts = rows.agg(F.count_if(F.col("t.ids") == 0), F.count_if(F.col("t.ids") == 1)).first()
    # A share of each class by the hash of its ids: about `calibration_rows` rows, and no task gathers them.
    shares = [int((1 << 30) * min(1.0, calibration_rows / max(1, n))) for n in counts]

    def sample(batches):
        for batch in batches:
            for (number, own), folds, chances in zip(Run.read(batch), batch.column("folds").to_pylist(), batch.column("chances").to_pylist(), strict=True):
                mine = [i for i, (label, fold, chance) in enumerate(zip(own.ids, folds, chances, strict=True)) if fold == 4 and chance < shares[label]]
                if mine:
                    yield own.only(mine, [own.ids[i] for i in mine]).row(number)

    sampled = write_table(training.mapInArrow(sample, _RUN), "calibration")
    # The sample is bounded and needs no slices.
    held = run_features(sampled, model, "a", 1).select("ids", "features").collect()
    y = np.array([i for r in held for i in r["ids"]], float)
    if len(set(y.tolist())) < 2:
        return None
    return fit_logistic(np.concatenate([np.frombuffer(r["features"]).reshape(len(r["ids"]), -1) for r in held]), y)


def score_runs(runs: DataFrame, labels: DataFrame, label: str, schema: str, out: Callable, calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """Rows that `out(ids, digests, scores)` gives for each run's documents, as lists by column of `schema`.

    Weights come from models of folds 1 to 3; the models that score are counted
    on folds 1 to 4. Without rows of both classes the score is the share of
    ones, or 0.
    """
    with scratch(runs.sparkSession):
        training, total = training_runs(runs, labels, label)
        model = train(training, total)
        fitted = calibrate(training, model, calibration_rows)
        share = 0.0
        if fitted is None:
            share = training.select(F.explode("ids").alias("label")).agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.0
    wanted = to_arrow(schema)

    def rows(batches):
        for batch in batches:
            for ids, digests, raw in zip(*(batch.column(c).to_pylist() for c in ("ids", "digests", "features")), strict=True):
                scores = np.full(len(ids), share)
                if fitted is not None:
                    weights, mean, scale = fitted
                    z = ((np.frombuffer(raw).reshape(len(ids), -1) - mean) / scale) @ weights[:-1] + weights[-1]
                    scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                columns = out(ids, digests, scores)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in wanted], schema=wanted)

    if fitted is None or not model.usable("b"):
        fitted = None
        found = runs.select("ids", "digests", F.lit(b"").alias("features"))
    else:
        found = run_features(runs, model, "b")
    return found.mapInArrow(rows, schema)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    Only labels of rows that are not held out are learned; label, language,
    source and id are never inputs of a score. Null and empty texts get the
    score of ratios of one. Labels with nulls are ignored; repeated rows and
    null ids (never held out) are scored like any other; other columns are not
    read.
    """
    def out(ids, digests, scores):
        return {"doc_id": ids, "score": scores}

    scored = score_runs(tokenised(docs), labels, label, "doc_id long, score double", out, calibration_rows)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of `docs` below the threshold, with all their columns.

    The score depends on the text alone, so rejected texts are told by their
    digest. A filter of these keeps most other rows out of the join.
    """
    def out(ids, digests, scores):
        return {"digest": [digests[16 * i:16 * i + 16] for i in np.nonzero(scores >= threshold)[0]]}

    with scratch(docs.sparkSession):
        rejected = write_table(score_runs(tokenised(docs, digests=True), labels, "toxic", "digest binary", out).distinct(), "rejected", keep=True)
    mark = free_prefix(docs.columns)
    own = docs.withColumn(mark, F.unhex(F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))))
    likely = maybe_listed(F.col(mark), blocked_bloom(rejected, "digest", BLOCKS), BLOCKS)
    met = own.where(likely).join(rejected.withColumnRenamed("digest", f"{mark}r"), F.col(mark) == F.col(f"{mark}r"), "left_anti")
    return own.where(~likely).unionByName(met).select(*docs.columns)
