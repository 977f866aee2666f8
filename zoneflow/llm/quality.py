"""Quality by random-indexing word vectors and a two-layer network with calibrated probabilities.

Every word has a fixed sparse vector of ones and minus ones that its own hash
draws. A frequent word's context vector is the sum of the fixed vectors of the words
around it; a document is the mean of its words' context vectors and of the
vectors of its words' shapes, which words never seen before have as well. A small network reads the pooled vector, and one temperature, fitted on
rows the network has not seen, makes its probabilities honest.

All labelled rows that are not held out take part. Runs of them train copies of
the network side by side, whose weights are averaged after some epochs.
"""

from __future__ import annotations

import copy
import math
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.text import Memo, held_out, map_batches, raw_texts, signed, to_arrow
from zoneflow.session import write_table

# Labelled rows that train one copy of the network, about; all copies together see every row.
RUN_ROWS = 16_384
# Epochs of the training, and those between two averages of the copies' weights.
EPOCHS = 40
EPOCHS_APART = 4
# One row in so many fits the temperature.
ASIDE = 10
# Temperatures that are tried.
TEMPERATURES = np.geomspace(0.25, 8, 60)
# Least share of the labelled rows' words that a word with a context vector needs: at most 1 / share words have one.
WORD_SHARE = 5e-5
SIZE = 64
NONZERO = 8
REACH = 2
BLOCK = 64
# Words whose neighbours are added up at once.
STRETCH = 1 << 15
SHAPES = 4096
# Words whose fixed vectors a task remembers; one text may add more.
REMEMBERED = 50_000
_RUNS = re.compile(rb"a+|A+|0+|(.)\1+")
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


def sparse_vector(key: bytes) -> np.ndarray:
    """The fixed vector of a word: `NONZERO` entries of plus or minus one, drawn by its hash."""
    h, v = xxhash.xxh3_128_intdigest(key), np.zeros(SIZE, np.float32)
    for i in range(NONZERO):
        bits = h >> (14 * i)
        v[bits % SIZE] += 1 if bits >> 13 & 1 else -1
    return v


def shape(word: bytes) -> bytes:
    """Letters by case, digits and signs of a word, runs cut to one; long words keep their last twelve signs."""
    return _RUNS.sub(lambda m: m[0][:1], word.translate(_SHAPE))[-12:]


def shape_bucket(word: bytes) -> int:
    """Bucket of a word's shape; the buckets' vectors are fixed."""
    return xxhash.xxh32_intdigest(shape(word)) % SHAPES


@lru_cache(1)
def shape_vectors() -> np.ndarray:
    return np.array([sparse_vector(b"%d" % i) for i in range(SHAPES)])


class Vectors:
    """Context vectors of the frequent words, and the pooling of a document."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words)
        self.context = np.zeros((len(words), SIZE), np.float32)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word by its hash, -1 for one without a context vector."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def pooled(self, raw: bytes | None, memo: Memo, shapes: Memo) -> np.ndarray:
        out = np.zeros(2 * SIZE + 4, np.float32)
        own = raw.split() if raw else []
        n = len(own)
        if not n:
            return out
        hashes = _hashes(own, memo)
        ids = self.numbers(hashes)
        known = ids[ids >= 0]
        if len(known):
            out[:SIZE] = self.context[known].mean(0)
        counts = np.bincount(np.fromiter(map(shapes.__getitem__, own), np.int64, n), minlength=SHAPES)
        met = np.flatnonzero(counts)
        out[SIZE:2 * SIZE] = counts[met] @ shape_vectors()[met] / n
        repeated = (hashes[1:] == hashes[:-1]).mean() if n > 1 else 0.0
        out[2 * SIZE:] = len(known) / n, repeated, len(np.unique(hashes)) / n, np.log1p(n) / 10
        return out


def _hashes(own: list[bytes], memo: Memo) -> np.ndarray:
    return signed(np.fromiter(map(memo.__getitem__, own), np.uint64, len(own)))


def _memos() -> tuple[Memo, Memo]:
    return Memo(xxhash.xxh3_64_intdigest), Memo(shape_bucket)


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of all labelled rows that are not held out; the texts are sorted by id at any size, as labels grow with them."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label).alias("label")).distinct()
    return docs.where(~held_out()).select("doc_id", "text").join(known.hint("merge"), "doc_id")


def sparse_vectors(words: list[bytes]) -> np.ndarray:
    """`sparse_vector` of every word, a row each."""
    high, low = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").astype(np.uint64).reshape(-1, 2).T
    out, rows = np.zeros((len(words), SIZE), np.int8), np.arange(len(words))
    for i in range(NONZERO):
        at = 14 * i
        bits = low >> np.uint64(at) | high << np.uint64(64 - at) if 0 < at < 64 else low if not at else high >> np.uint64(at - 64)
        out[rows, (bits & np.uint64(0x1FFF)).astype(np.int64) % SIZE] += np.where(bits >> np.uint64(13) & np.uint64(1), 1, -1).astype(np.int8)
    return out


class Coded(dict):
    """Numbers words as they come; keeps each one's fixed vector and the number of its context vector. Number 0 is no word."""

    def __init__(self, vectors: Vectors):
        super().__init__()
        self._vectors, self._new = vectors, []
        self._fixed, self._ids = np.zeros((1, SIZE), np.int8), np.full(1, -1)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) + 1
        self._new.append(word)
        return code

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        if self._new:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self._new), np.uint64, len(self._new))
            self._fixed = np.concatenate([self._fixed, sparse_vectors(self._new)])
            self._ids = np.concatenate([self._ids, self._vectors.numbers(signed(hashes))])
            self._new = []
        return self._fixed, self._ids

    def add(self, parts: list[np.ndarray], sums: np.ndarray) -> None:
        """Add the fixed vectors around each word of the texts to the sum of the word; blanks part the texts."""
        fixed, numbers = self._tables()
        blank = np.zeros(REACH, np.int64)
        codes = np.concatenate([blank, *(x for part in parts for x in (part, blank))])
        for at in range(REACH, len(codes) - REACH, STRETCH):
            end = min(at + STRETCH, len(codes) - REACH)
            ids = numbers[codes[at:end]]
            order = np.argsort(ids, kind="stable")
            order = order[np.searchsorted(ids[order], 0):]
            if not len(order):
                continue
            # Entries are at most 8, so those of 4 neighbours fit a byte.
            rows = fixed[codes[at - REACH:end + REACH]]
            near = sum(rows[REACH + k:REACH + k + end - at] for k in range(-REACH, REACH + 1) if k)
            own = ids[order]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            sums[own[starts]] += np.add.reduceat(near[order], starts, axis=0, dtype=np.int32)


def word_vectors(texts: DataFrame, share: float = WORD_SHARE) -> Vectors:
    """Context vectors of the frequent words of `texts`, summed by blocks of words."""
    wanted = to_arrow("word long, n long")

    def count(batches):
        counts, memo = {}, Memo(xxhash.xxh3_64_intdigest)
        for batch in batches:
            for raw in raw_texts(batch.column("text")):
                for w in (raw or b"").split():
                    counts[w] = counts.get(w, 0) + 1
            keys = signed(np.fromiter(map(memo.__getitem__, counts), np.uint64, len(counts)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(counts.values()), pa.int64())], schema=wanted)
            counts = {}

    counted = write_table(texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    total = counted.agg(F.sum("n")).first()[0] or 0
    vectors = Vectors(counted.where(F.col("n") >= max(2.0, share * total)).toPandas()["word"].to_numpy(np.int64))
    if not len(vectors.words):
        return vectors
    shared = texts.sparkSession.sparkContext.broadcast(vectors)
    block_schema = to_arrow("block int, sums binary")

    def accumulate(batches):
        coded = Coded(shared.value)
        sums = np.zeros((len(shared.value.words), SIZE), np.int64)
        for batch in batches:
            parts = []
            for raw in raw_texts(batch.column("text")):
                found = (raw or b"").split()
                if not found:
                    continue
                parts.append(np.fromiter(map(coded.__getitem__, found), np.int64, len(found)))
                if len(coded) >= REMEMBERED:
                    coded.add(parts, sums)
                    coded, parts = Coded(shared.value), []
            coded.add(parts, sums)
        for b in range(0, len(sums), BLOCK):
            part = sums[b:b + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK], pa.int32()), pa.array([part.tobytes()])], schema=block_schema)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist())
        return pa.table([table.column("block")[:1], pa.array([total.tobytes()], pa.binary())], schema=block_schema)

    parts = texts.select("text").mapInArrow(accumulate, "block int, sums binary").groupBy("block").applyInArrow(add, "block int, sums binary")
    for row in parts.collect():
        at = row.block * BLOCK
        own = np.frombuffer(row.sums, np.int64).reshape(-1, SIZE)
        vectors.context[at:at + len(own)] = own
    size = np.linalg.norm(vectors.context, axis=1, keepdims=True)
    vectors.context /= np.maximum(size, 1e-9)
    return vectors


class Network:
    """Two layers: rectified hidden units, one output; probabilities are divided by a temperature."""

    def __init__(self, size: int, hidden: int = 32, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.w = [draw.normal(0, np.sqrt(2 / size), (size, hidden)), np.zeros(hidden), draw.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
        self.mean, self.scale, self.temperature = np.zeros(size), np.ones(size), 1.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        return h, h @ self.w[2] + self.w[3][0]

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int, seed: list[int], batch: int = 128, rate: float = 3e-3, decay: float = 1e-3) -> Network:
        """Adam on all rows, from the present weights."""
        draw = np.random.default_rng(seed)
        z, used = (x - self.mean) / self.scale, np.arange(len(x))
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(rounds):
            draw.shuffle(used)
            for i in range(0, len(used), batch):
                xb, yb = z[used[i:i + batch]], y[used[i:i + batch]]
                h, out = self._forward(xb)
                d = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - yb) / len(xb)
                back = np.outer(d, self.w[2]) * (h > 0)
                grads = [xb.T @ back + decay * self.w[0], back.sum(0), h.T @ d + decay * self.w[2], np.array([d.sum()])]
                t += 1
                for j, g in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    self.w[j] = self.w[j] - rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def with_weights(self, flat: np.ndarray) -> Network:
        """The same network with other weights, given one after the other."""
        other, at = copy.copy(self), 0
        other.w = []
        for w in self.w:
            other.w.append(flat[at:at + w.size].reshape(w.shape))
            at += w.size
        return other

    def losses(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Sum of the rows' losses at each temperature."""
        out = self._forward((x - self.mean) / self.scale)[1]
        wrong = np.where(y == 1, -out, out)
        return np.array([np.logaddexp(0, wrong / k).sum() for k in TEMPERATURES])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = self._forward((x - self.mean) / self.scale)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _pool(shared, raws: list[bytes | None]) -> np.ndarray:
    memo, shapes = _memos()
    return np.array([shared.pooled(r, memo, shapes) for r in raws], np.float32).reshape(len(raws), 2 * SIZE + 4)


def _summed(rows: DataFrame, fn: Callable, run_rows: int) -> np.ndarray | None:
    """Sum of the vectors that `fn` gives for every run of rows, by (part, x, y); None without rows.

    A run has the rows of one part, which lie together, and is cut above
    twice `run_rows`: no task holds more at once.
    """
    wanted = to_arrow("v array<double>")

    def run(batches):
        part, xs, ys, held = None, [], [], 0

        def summed():
            v = fn(part, np.concatenate(xs).astype(np.float64), np.concatenate(ys))
            return pa.RecordBatch.from_arrays([pa.array([v], wanted[0].type)], schema=wanted)

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column("part").to_numpy()
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(len(parts), -1)
            y = batch.column("label").to_numpy().astype(np.float64)
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and (parts[a] != part or held >= 2 * run_rows):
                    yield summed()
                    xs, ys, held = [], [], 0
                part = int(parts[a])
                xs.append(x[a:b])
                ys.append(y[a:b])
                held += b - a
        if held:
            yield summed()

    found = rows.select("part", "x", "label").mapInArrow(run, "v array<double>").select(F.posexplode("v"))
    total = found.groupBy("pos").agg(F.sum("col").alias("s")).toPandas()
    return total.sort_values("pos")["s"].to_numpy() if len(total) else None


def fit_network(rows: DataFrame, size: int, run_rows: int = RUN_ROWS) -> Network:
    """Network fitted on the rows (doc_id, label, x) of both classes, in runs of about `run_rows` rows.

    Every run trains a copy of the network for some epochs, the copies are
    averaged by their rows, and the next epochs start from the average; one run
    alone needs no average. Each row is in one run. A tenth of the ids fits the
    temperature instead.
    """
    parts = max(1, math.ceil(rows.count() / run_rows))
    dealt = rows.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"),
        (F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(ASIDE)) == 0).alias("aside"), "label", "x")
    # The order within a part does not depend on how the rows came.
    stored = write_table(dealt.repartition(parts, "part").sortWithinPartitions("part", F.xxhash64("x"), "x", "label"), "runs")
    used, aside = stored.where("not aside"), stored.where("aside")
    if used.isEmpty():
        used = aside
    network = Network(size)
    sums = _summed(used, lambda _, x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(x)]]), run_rows)
    network.mean = sums[:size] / sums[-1]
    network.scale = np.sqrt(np.maximum(sums[size:2 * size] / sums[-1] - network.mean ** 2, 0)) + 1e-3
    apart = EPOCHS if parts == 1 else EPOCHS_APART
    for epoch in range(0, EPOCHS, apart):
        def trained(part, x, y, start=network, epoch=epoch):
            w = copy.copy(start)
            w.w = list(start.w)
            w.train(x, y, apart, [2, part, epoch])
            return np.concatenate([len(x) * np.concatenate([v.ravel() for v in w.w]), [len(x)]])

        sums = _summed(used, trained, run_rows)
        network = network.with_weights(sums[:-1] / sums[-1])
    loss = _summed(aside, lambda _, x, y, fitted=network: fitted.losses(x, y), run_rows)
    if loss is not None:
        network.temperature = float(TEMPERATURES[int(np.argmin(loss))])
    return network


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, run_rows: int = RUN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    Vectors and network are fitted on all labelled rows that are not held out,
    the network in runs of about `run_rows` rows; label, language, source and
    id are never inputs of a score. Null and empty texts have the zero vector.
    Without labels of both classes the score is the share of ones, or 0.
    Repeated rows and null ids (never held out) are scored like any other.
    """
    known = write_table(labelled_rows(docs, labels, label), "labelled")
    classes = {r["one"]: r["n"] for r in known.groupBy((F.col("label") == 1).alias("one")).agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        share = 1.0 if True in classes else 0.0
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(share).alias("score"), F.lit(int(share >= threshold)).alias("predicted"))
    vectors = word_vectors(known)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vectors)

    def pool(batch):
        return {"doc_id": batch.column("doc_id"), "label": [int(v == 1) for v in batch.column("label").to_pylist()],
                "x": [r.tobytes() for r in _pool(shared.value, raw_texts(batch.column("text")))]}

    pooled = write_table(map_batches(known.select("doc_id", "label", "text"), pool, "doc_id long, label int, x binary"), "pooled")
    network = context.broadcast(fit_network(pooled, 2 * SIZE + 4, run_rows))

    def run(batch):
        scores = network.value.probabilities(_pool(shared.value, raw_texts(batch.column("text"))))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return map_batches(docs.select("doc_id", held_out().alias("held_out"), "text"), run, "doc_id long, held_out boolean, score double, predicted int")
