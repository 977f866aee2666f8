"""Exact top-k search by inner product with segment statistics at several resolutions.

A vector is cut into segments; of each its mean and standard deviation are
kept, for few long segments up to many short ones. Per segment of length L the
distance of two vectors is at least L ((m - m')^2 + (s - s')^2). As a score is
half of both squared lengths less the squared distance, this bounds it from
above by the sum of L (m m' + s s'). A candidate is compared level by level,
coarse to fine, and only survivors of all levels have their exact score
computed, on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.text import to_arrow
from zoneflow.session import write_table

# Segments of the levels, coarse to fine.
LEVELS = (1, 4, 16)
# Bytes of a stored block of vectors, and of the queries that one pass sends to every task.
BLOCK_BYTES = 1 << 20
GROUP_BYTES = 1 << 24
# Queries that are compared with a block at once.
CHUNK = 1024
_LONG = 1 << 63
_BLOCK = "block long, queries int, ids binary, vectors binary"
_FOUND = "block long, place int, query_id long, vec_id long, score long"


def quantised(column: pa.Array, ids: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors floor(scale * x) of the rows that take part, as floats (all of them whole numbers), zeros after their end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = np.asarray(pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    good = np.asarray(pc.and_(pc.is_valid(column), pc.is_valid(ids)))
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(scale * flat)
    good[row[~np.isfinite(flat)]] = False
    out = np.zeros((len(lengths), dim))
    out[row, place] = flat
    return np.asarray(pc.fill_null(ids, 0), np.int64)[good], out[good]


def _pack(own: np.ndarray) -> bytes:
    """Vectors in the narrowest kind of number that holds them."""
    most = np.abs(own).max(initial=0.0)
    return own.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64).tobytes()


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[len(vectors) // (len(ids) * dim)]
    return ids, np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)


def vector_blocks(vectors: DataFrame, every: int, dim: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """Stored blocks of quantised vectors: rows of a task in input order, at most BLOCK_BYTES each."""
    wanted = to_arrow(_BLOCK)
    most = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, own = quantised(batch.column(1), batch.column(0), dim, scale)
            for at in range(0, len(ids), most):
                part = ids[at:at + most]
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([int((part % every == 0).sum())], pa.int32()),
                    pa.array([part.tobytes()], pa.binary()), pa.array([_pack(own[at:at + most])], pa.binary())], schema=wanted)
                number += 1

    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    # Blocks of any input layout are dealt evenly over the tasks of the search.
    return write_table(rows.mapInArrow(run, _BLOCK).repartition("block"), "blocks")


class Vectors:
    """Some vectors with their segment statistics; the factor of the length makes a bound a plain product."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, levels: tuple[int, ...] = LEVELS):
        self.ids, self.own = ids, own
        self.length = np.sqrt((own * own).sum(1))
        self.most = np.abs(own).max(initial=0.0)
        self.levels = []
        for count in levels:
            edges = np.unique(np.linspace(0, own.shape[1], count + 1).astype(int))
            size = np.diff(edges)
            mean = np.add.reduceat(own, edges[:-1], axis=1) / size
            gap = own - np.repeat(mean, size, axis=1)
            spread = np.sqrt(np.add.reduceat(gap * gap, edges[:-1], axis=1) / size)
            self.levels.append(np.concatenate([mean, spread], axis=1) * np.sqrt(np.concatenate([size, size])))
        # Floats of half the size are enough for bounds and for exact scores of small numbers.
        small = self.length.max(initial=0.0) < 1e15
        self.bounds = [x.astype(np.float32) for x in self.levels] if small else self.levels

    def take(self, rows) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.own, out.length, out.most = self.ids[rows], self.own[rows], self.length[rows], self.most
        out.levels, out.bounds = [x[rows] for x in self.levels], [x[rows] for x in self.bounds]
        return out


def exact(a: Vectors, b: Vectors, rows: np.ndarray | None = None, cols: np.ndarray | None = None) -> np.ndarray:
    """Exact scores of the pairs (rows, cols), or of all, in a kind of number that holds every partial sum."""
    most = a.own.shape[1] * a.most * b.most
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object

    def numbers(x):
        return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape) if kind is object else x.astype(kind)

    if rows is None:
        return numbers(a.own) @ numbers(b.own).T
    if kind is object:
        return np.array([sum(int(v) * int(w) for v, w in zip(a.own[i], b.own[j], strict=True)) for i, j in zip(rows, cols, strict=True)], object)
    out, x, y = np.empty(len(rows), kind), numbers(a.own), numbers(b.own)
    for at in range(0, len(rows), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", x[rows[part]], y[cols[part]])
    return out


def survivors(a: Vectors, b: Vectors, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose score may reach the row's least one, by all levels from coarse to fine."""
    rows, cols = np.arange(len(a.ids)), np.arange(len(b.ids))
    alive = np.ones((len(rows), len(cols)), bool)
    for x, y in zip(a.bounds, b.bounds, strict=True):
        with np.errstate(over="ignore", invalid="ignore"):
            # Rounding moves a bound by far less than this share of the vectors' lengths.
            slack = np.outer(a.length[rows], b.length[cols]).astype(x.dtype) * x.dtype.type(2.0 ** -15)
            alive &= ~(x[rows] @ y[cols].T + slack < least[rows, None])
        near, far = alive.any(1), alive.any(0)
        rows, cols, alive = rows[near], cols[far], alive[near][:, far]
        if not alive.size:
            break
    i, j = np.nonzero(alive)
    return rows[i], cols[j]


class Best:
    """The best `k` so far of every query; equal scores go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.row, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.full(queries, -np.inf)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if scores.dtype == object:
            scores = np.array([max(-_LONG, min(_LONG - 1, s)) for s in scores], np.int64)
        # Rows that nothing was found for keep what they have.
        touched = np.isin(self.row, rows)
        row, id_, score = (np.concatenate([x[touched], y]) for x, y in ((self.row, rows), (self.id, ids), (self.score, scores.astype(np.int64))))
        # Descending: the complement of a long has no overflow.
        order = np.lexsort((id_, ~score, row))
        row, id_, score = row[order], id_[order], score[order]
        first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        place = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        keep = place < self.k
        full = place == self.k - 1
        # One step down, as a float may be above the long it stands for.
        self.least[row[full]] = np.nextafter(score[full].astype(np.float64), -np.inf)
        self.row, self.id, self.score = (np.concatenate([x[~touched], y[keep]]) for x, y in ((self.row, row), (self.id, id_), (self.score, score)))


def compare(queries: Vectors, origin: np.ndarray, place: np.ndarray, block: int, candidates: Vectors, best: Best, k: int) -> None:
    """Add to `best` what one block holds for the queries; a query's own row is none of its candidates."""
    for at in range(0, len(queries.ids), CHUNK):
        rows = np.arange(at, min(len(queries.ids), at + CHUNK))
        own = queries.take(rows)
        self_at = np.where(origin[rows] == block, place[rows], -1)
        if np.isneginf(best.least[rows]).any() and len(candidates.ids) > 2 * k + 1:
            # The candidates with the highest bounds give a first least score.
            bound = own.bounds[-1] @ candidates.bounds[-1].T
            bound[self_at >= 0, self_at[self_at >= 0]] = -np.inf
            cols = np.argpartition(bound, -2 * k, axis=1)[:, -2 * k:]
            i, j = np.repeat(np.arange(len(rows)), 2 * k), cols.ravel()
            fine = j != self_at[i]
            seeds = Best(len(rows), k)
            seeds.add(i[fine], candidates.ids[j[fine]], exact(own, candidates, i[fine], j[fine]))
            least = np.maximum(best.least[rows], seeds.least)
        else:
            least = best.least[rows]
        i, j = survivors(own, candidates, least)
        fine = j != self_at[i]
        i, j = i[fine], j[fine]
        if len(i) > len(rows) * len(candidates.ids) // 16:
            scores = exact(own, candidates)[i, j]
        else:
            scores = exact(own, candidates, i, j)
        fine = np.array([not s < t for s, t in zip(scores, least[i], strict=True)], bool) if scores.dtype == object else ~(scores < least[i])
        if fine.any():
            best.add(rows[i[fine]], candidates.ids[j[fine]], scores[fine])


def _query_blocks(blocks: DataFrame, every: int, dim: int) -> DataFrame:
    """The queries of each block that has any, with their places in it."""
    schema = "block long, places binary, ids binary, vectors binary, bytes long"
    wanted = to_arrow(schema)

    def run(batches):
        for batch in batches:
            for block, ids, vectors in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "vectors")), strict=True):
                ids, own = _unpack(ids, vectors, dim)
                at = np.nonzero(ids % every == 0)[0]
                columns = [[block], [at.tobytes()], [ids[at].tobytes()], [_pack(own[at])], [own[at].nbytes]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    return write_table(blocks.where("queries > 0").drop("queries").mapInArrow(run, schema), "queries")


def _pass(blocks: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """Best `k` of every query of one group of at most GROUP_BYTES, over all blocks, each read once."""
    context = blocks.sparkSession.sparkContext
    held = context.broadcast([tuple(r) for r in queries.select("block", "places", "ids", "vectors").collect()])
    wanted = to_arrow(_FOUND)

    def run(batches):
        places = [np.frombuffer(p, np.int64) for _, p, _, _ in held.value]
        origin = np.concatenate([np.full(len(p), b) for (b, *_), p in zip(held.value, places, strict=True)])
        place = np.concatenate(places)
        ids, own = (np.concatenate(x) for x in zip(*(_unpack(i, v, dim) for _, _, i, v in held.value), strict=True))
        asked, best = Vectors(ids, own), Best(len(ids), k)
        for batch in batches:
            for block, ids, vectors in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "vectors")), strict=True):
                compare(asked, origin, place, block, Vectors(*_unpack(ids, vectors, dim)), best, k)
        columns = (origin[best.row], place[best.row], asked.ids[best.row], best.id, best.score)
        yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    found = blocks.select("block", "ids", "vectors").mapInArrow(run, _FOUND)
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id"))
    out = write_table(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "found")
    held.destroy()
    return out


def exact_top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the `k` best of every query: a row whose id is divisible by `every`.

    Components become floor(scale * x); the score is their integer inner
    product, exact, and kept within a long. Equal scores rank by the smaller
    id; fewer rows than `k` give all. Rows with a null id or vector, or with a
    null or non-finite component, take no part. A shorter vector counts as
    followed by zeros. Rows that repeat an id are queries and candidates of
    their own, and a query's own row is never its candidate. Other columns are
    not read; an empty table gives no rows.

    Each pass sends the queries of one group, whose size is measured first, to
    all tasks, and reads every block once.
    """
    rows = vectors.select(id_column, vector_column)
    dim = max(1, rows.agg(F.max(F.size(vector_column))).first()[0] or 1)
    blocks = vector_blocks(rows, every, dim, scale, id_column, vector_column)
    queries = _query_blocks(blocks, every, dim)
    total = queries.agg(F.sum("bytes")).first()[0] or 0
    groups = -(-2 * total // GROUP_BYTES)
    while groups:
        # A hash deals the blocks; a group above its bound is dealt anew. One block alone is below it.
        group = F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")
        if queries.groupBy(group).agg(F.sum("bytes").alias("b")).where(F.col("b") > max(GROUP_BYTES, BLOCK_BYTES, 8 * dim)).isEmpty():
            break
        groups *= 2
    out = blocks.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for g in range(groups):
        own = queries.where(group == g)
        if not own.isEmpty():
            out = out.unionByName(_pass(blocks, own, dim, k))
    return out
