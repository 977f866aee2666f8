"""Second-order boosted trees with an L2 term, from gradient histograms that Spark sums.

A level of a tree is one job: tasks sum the gradients of their rows by node,
feature and bin, a shuffle adds the sums, and the best split of each node comes
back to the driver. What travels depends on nodes, features and bins, never on
the number of rows. Predictions are stored after every few trees, so a row
passes only the trees since then, and a lost executor costs no more than that.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.session import scratch, write_table

BINS = 256
# A split must gain more than this.
LEAST_GAIN = 1e-6
_BINNED = "row long, target double, bins binary, prediction double"


class Tree:
    """Binary tree in heap order: node i has the children 2i + 1 (bin at most the cut) and 2i + 2; feature -1 is a leaf."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth, self.feature, self.cut = depth, np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.value, self.gain = np.zeros(size), np.zeros(size)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Node each row of bin numbers ends in."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            feature = self.feature[at]
            right = bins[rows, np.maximum(feature, 0)] > self.cut[at]
            at = np.where(feature >= 0, 2 * at + 1 + right, at)
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.places(bins)]


@dataclass
class Boosted:
    """A fitted model; `edges` holds the upper bound of each feature's bins but the last."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def transform(self, df: DataFrame, name: str = "xgboost_prediction") -> DataFrame:
        """`df` with the prediction as `name`; null and NaN features count as 0."""
        edges, base, trees = self.edges, self.base, self.trees

        @F.pandas_udf("double")
        def predict(columns: pd.DataFrame) -> pd.Series:
            bins = _bin(columns.to_numpy(np.float64, na_value=0.0), edges)
            return pd.Series(base + sum((tree.predict(bins) for tree in trees), np.zeros(len(bins))))

        return df.withColumn(name, predict(F.struct(*[_number(c).alias(f"f{i}") for i, c in enumerate(self.features)])))

    def importance(self) -> dict[str, float]:
        """Mean gain of each feature's splits, as shares that sum to 1; all 0 where nothing was split."""
        total, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(n, tree.feature[inner], 1)
        mean = total / np.maximum(n, 1)
        return dict(zip(self.features, (mean / (mean.sum() or 1.0)).tolist(), strict=True))


def _number(name: str):
    value = F.col(f"`{name}`").cast("double")
    return F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value)


def _bin(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def quantile_edges(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Bounds that put about equally many rows into each bin; equal bounds are one."""
    shares = [k / bins for k in range(1, bins)]
    numbers = train.select(*[_number(c).alias(f"f{i}") for i, c in enumerate(features)])
    return [np.unique(q) for q in numbers.approxQuantile(numbers.columns, shares, 0.1 / bins)]


def _binned(train: DataFrame, features: Sequence[str], target: str, edges: list[np.ndarray], base: float) -> DataFrame:
    """Rows with a hash of their content, the target, a byte per feature and the first prediction."""
    numbers = [_number(c).alias(f"f{i}") for i, c in enumerate(features)]
    rows = train.select(F.col(f"`{target}`").cast("double").alias("target"), *numbers)
    rows = rows.where(F.col("target").isNotNull() & ~F.isnan("target"))
    rows = rows.select(F.xxhash64("target", *rows.columns[1:]).alias("row"), *rows.columns)

    def run(batches):
        for batch in batches:
            columns = [batch.column(i + 2).to_numpy(zero_copy_only=False) for i in range(len(edges))]
            packed = _bin(np.stack(columns, axis=1), edges)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in packed], pa.binary()),
                 pa.array(np.full(len(packed), base))], ["row", "target", "bins", "prediction"])

    return rows.mapInArrow(run, _BINNED)


def _unpack(batch: pa.RecordBatch, width: int, since: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Bin numbers and current predictions of a batch."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    prediction = batch.column("prediction").to_numpy(zero_copy_only=False).copy()
    for tree in since:
        prediction += tree.predict(bins)
    return bins, prediction


def _advance(rows: DataFrame, width: int, since: list[Tree]) -> DataFrame:
    """Rows whose stored predictions include the trees `since`."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                _bins, prediction = _unpack(batch, width, since)
                yield batch.set_column(3, "prediction", pa.array(prediction))

    return rows.mapInArrow(run, _BINNED)


def _histograms(rows: DataFrame, width: int, since: list[Tree], tree: Tree, frontier: list[int], columns: list[int]) -> DataFrame:
    """Sums of gradients and counts by node, feature and bin: one row each from a task, then one each."""

    def run(batches):
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[frontier] = np.arange(len(frontier))
        size = len(frontier) * BINS
        g, n = np.zeros((len(columns), size)), np.zeros((len(columns), size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, prediction = _unpack(batch, width, since)
            at = slot[tree.places(bins)]
            open_ = at >= 0
            gradient = (prediction - batch.column("target").to_numpy(zero_copy_only=False))[open_]
            for i, c in enumerate(columns):
                cell = at[open_] * BINS + bins[open_, c]
                g[i] += np.bincount(cell, gradient, size)
                n[i] += np.bincount(cell, minlength=size)
        which, cell = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(frontier, np.int32)[cell // BINS]), pa.array(np.array(columns, np.int32)[which]),
             pa.array((cell % BINS).astype(np.int32)), pa.array(g[which, cell]), pa.array(n[which, cell])],
            ["node", "feature", "bin", "g", "n"])

    sums = rows.mapInArrow(run, "node int, feature int, bin int, g double, n long").repartition("node", "feature")
    return sums.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))


def best_splits(sums: DataFrame, l2: float, least_rows: float) -> DataFrame:
    """Best split per node with its gain and both sides' sums; null `feature` where none is allowed.

    Of equal gains the first feature's lowest bin wins.
    """
    side, whole = Window.partitionBy("node", "feature").orderBy("bin"), Window.partitionBy("node", "feature")
    rows = sums.select(
        "node", "feature", "bin", F.sum("g").over(side).alias("left_g"), F.sum("n").over(side).alias("left_n"),
        F.sum("g").over(whole).alias("all_g"), F.sum("n").over(whole).alias("all_n"))

    def score(g, n):
        return g * g / (n + F.lit(float(l2)))

    right_g, right_n = F.col("all_g") - F.col("left_g"), F.col("all_n") - F.col("left_n")
    gain = (score(F.col("left_g"), F.col("left_n")) + score(right_g, right_n) - score(F.col("all_g"), F.col("all_n"))) / 2
    allowed = (F.col("left_n") >= least_rows) & (right_n >= F.greatest(F.lit(1.0), F.lit(float(least_rows))))
    rows = rows.withColumn("gain", F.when(allowed & (gain > LEAST_GAIN), gain))
    order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    best = rows.groupBy("node").agg(
        F.max_by(F.struct("feature", "bin", "gain", "left_g", "left_n"), F.when(F.col("gain").isNotNull(), order)).alias("best"),
        F.max_by("all_g", -F.col("feature")).alias("all_g"), F.max("all_n").alias("all_n"))
    return best.select("node", "best.*", "all_g", "all_n")


def _grow(sums_of: Callable[[Tree, list[int]], DataFrame], depth: int, step: float, l2: float, least_rows: float) -> Tree:
    """One tree, level by level; at most a row per open node reaches the driver."""
    tree, frontier = Tree(depth), [0]

    def settle(node: int, g: float, n: int) -> None:
        tree.value[node] = -step * g / (n + l2) if n + l2 else 0.0

    for _ in range(depth):
        found = best_splits(sums_of(tree, frontier), l2, least_rows).collect()
        frontier = []
        for r in sorted(found, key=lambda r: r.node):
            settle(r.node, r.all_g, r.all_n)
            if r.feature is None:
                continue
            tree.feature[r.node], tree.cut[r.node], tree.gain[r.node] = r.feature, r.bin, r.gain
            left, right = 2 * r.node + 1, 2 * r.node + 2
            settle(left, r.left_g, r.left_n)
            settle(right, r.all_g - r.left_g, r.all_n - r.left_n)
            frontier += [left, right]
        if not frontier:
            break
    return tree


def fit_boosted_l2(
    train: DataFrame, features: Sequence[str], target: str, rounds: int = 350, depth: int = 7, step: float = 0.05,
    l2: float = 1.0, least_rows: float = 1.0, row_share: float = 0.9, column_share: float = 0.9, seed: int = 42,
    edges: list[np.ndarray] | None = None, store_every: int = 10,
) -> Boosted:
    """Squared-error boosting; a leaf holds -step * sum of gradients / (rows + l2).

    Every tree takes `column_share` of the features and the rows whose content
    hashes into `row_share`, so equal rows are taken or left together. Rows with
    a null or NaN target are left out, such features count as 0. Without rows
    the model predicts 0. `edges` replaces the quantile bounds, at most 255 a
    feature.
    """
    spark, features = train.sparkSession, list(features)
    edges = quantile_edges(train, features) if edges is None else [np.asarray(e, np.float64) for e in edges]
    if any(len(e) >= BINS for e in edges):
        raise ValueError(f"at most {BINS - 1} bounds a feature")
    wanted = F.col(f"`{target}`").cast("double")
    base = train.where(~F.isnan(wanted)).agg(F.avg(wanted)).first()[0]
    model, width = Boosted(features, edges, base or 0.0, []), len(features)
    if base is None or not features:
        return model
    drawn = random.Random(seed)
    with scratch(spark):
        rows, since = write_table(_binned(train, features, target, edges, model.base), "boosting"), []
        for i in range(rounds):
            columns = sorted(drawn.sample(range(width), max(1, int(column_share * width))))
            picked = F.pmod(F.xxhash64("row", F.lit(seed), F.lit(i)), F.lit(1_000_000)) < int(row_share * 1_000_000)
            taken = rows if row_share >= 1 else rows.where(picked)
            model.trees.append(_grow(
                lambda tree, frontier, taken=taken, since=tuple(since), columns=columns: _histograms(
                    taken, width, list(since), tree, frontier, columns), depth, step, l2, least_rows))
            since.append(model.trees[-1])
            if len(since) == store_every and i + 1 < rounds:
                rows, since = write_table(_advance(rows, width, since), "boosting"), []
    return model
