"""Forests over feature arrays: cross-validated scores and predictions, without a model in the driver or in one task.

Features are cut at MAX_BINS - 1 quantiles. A forest's trees grow together, in two parts. While a node has more than LOCAL rows,
its best split comes from counts of (tree, node, feature, bin) that tasks make over their rows and Spark adds up; the driver holds
these few upper splits only (one for some LOCAL rows and tree). Then all rows go, as bins, to a group for each lower node of each tree, which
grows the rest of the tree in numpy and gives the share of positives in the leaf of each of its rows. A row's probability is the
mean of these shares over the trees, as in Spark's own forests; no tree is kept. Rows of weight 0 (out of the bag, or of
another fold) go along and are only scored.

Bootstrap weights (Poisson) and the features that a node may split by (the root of their number) follow from hashes of the seed, the
tree and the row or node, so where the upper part ends changes no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantarium.operators.stats import auroc, folds
from quantarium.session import Scratch, ship_package

#: Fixed values of the published models, but for the depth: trees have at most 30 levels.
TREES, DEPTH, FOLDS, SEED = 100, 30, 4, 42
MAX_BINS = 32
#: Rows (by weight) of a node that one task grows by itself, and trees whose rows move at once.
LOCAL, TREES_AT_ONCE = 20_000, 25
_U = np.uint64


@dataclass(frozen=True)
class Forest:
    trees: int
    depth: int
    seed: int


@dataclass(frozen=True)
class Model:
    """What a forest learns from; its trees grow where rows are scored."""

    forest: Forest
    rows: DataFrame


def _forest(trees: int, depth: int, seed: int) -> Forest:
    return Forest(trees, depth, seed)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _weights(seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """Poisson(1) draws of rows by their hashes."""
    with np.errstate(over="ignore"):
        u = (_mix(_mix(ids.astype(np.int64).view(_U) + _U(seed)) + _U(tree + 1)) >> _U(11)).astype(np.float64) / (1 << 53)
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(below, u, "right").astype(np.int64)


def _candidates(seed: int, tree: np.ndarray, node: np.ndarray, features: int) -> np.ndarray:
    """The features that each (tree, node) may split by, ascending."""
    with np.errstate(over="ignore"):
        own = _mix(_mix(node.astype(np.int64).view(_U) + _U(seed)) ^ _mix(tree.astype(np.int64).view(_U) + _U(77)))
        drawn = _mix(own[:, None] + np.arange(1, features + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, : math.ceil(math.sqrt(features))], axis=1)


def _histogram(bins: np.ndarray, at: np.ndarray, candidates: np.ndarray, weight: np.ndarray, bin: np.ndarray) -> np.ndarray:
    """Weights by (node, candidate, bin, class); at: each row's node, by its place among the candidates."""
    n, k = candidates.shape
    value = np.take_along_axis(bins, candidates[at], axis=1).astype(np.int64)
    cell = (((at[:, None] * k + np.arange(k)) * MAX_BINS + value) * 2 + bin[:, None]).reshape(-1)
    return np.bincount(cell, np.repeat(weight, k), n * k * MAX_BINS * 2).reshape(n, k, MAX_BINS, 2)


def _splits(counts: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """feature (-1: a leaf) and the last bin of the left side of each node's best split, by Gini; ties go to the first feature, then bin."""
    left = counts.cumsum(axis=2)
    total = left[:, :1, -1:, :]
    right = total - left
    n, m = left.sum(axis=3), right.sum(axis=3)
    with np.errstate(invalid="ignore", divide="ignore"):
        pure = (left**2).sum(axis=3) / n + (right**2).sum(axis=3) / m
        base = ((total**2).sum(axis=3) / total.sum(axis=3))[:, 0, 0]
    pure = np.where((n > 0) & (m > 0), pure, -1.0).reshape(len(counts), -1)
    best = pure.argmax(axis=1)
    good = pure[np.arange(len(best)), best] > base * (1 + 1e-12)
    return np.where(good, candidates[np.arange(len(best)), best // MAX_BINS], -1), best % MAX_BINS


def _grown(bins: np.ndarray, weight: np.ndarray, bin: np.ndarray, seed: int, tree: int, node: int, depth: int) -> np.ndarray:
    """The share of positives in each row's leaf of the subtree under node (numbered as in a heap, the root 1), of depth levels more."""
    share = np.zeros(len(bin))
    where, rows, level = np.full(len(bin), node, np.int64), np.arange(len(bin)), 0
    while len(rows):
        own, at = np.unique(where[rows], return_inverse=True)
        n = np.bincount(at, weight[rows], len(own))
        ones = np.bincount(at, weight[rows] * bin[rows], len(own))
        share[rows] = (ones / np.maximum(n, 1))[at]
        open_ = (ones > 0) & (ones < n)
        if level >= depth or not open_.any():
            break
        number = np.cumsum(open_) - 1
        rows, at = rows[open_[at]], number[at[open_[at]]]
        own = own[open_]
        feature, last = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        # nodes by the thousand, so that counts stay small
        order = np.argsort(at, kind="stable")
        edge = np.searchsorted(at[order], np.arange(0, len(own) + 1000, 1000))
        for i, first in enumerate(range(0, len(own), 1000)):
            part, some = order[edge[i] : edge[i + 1]], own[first : first + 1000]
            candidates = _candidates(seed, np.full(len(some), tree), some, bins.shape[1])
            counts = _histogram(bins[rows[part]], at[part] - first, candidates, weight[rows[part]], bin[rows[part]])
            feature[first : first + 1000], last[first : first + 1000] = _splits(counts, candidates)
        goes = feature[at] >= 0
        rows, at = rows[goes], at[goes]
        where[rows] = where[rows] * 2 + (bins[rows, feature[at]] > last[at])
        level += 1
    return share


def _placed(bins: np.ndarray, tree: int, upper: dict) -> np.ndarray:
    """Each row's node at the end of the upper splits of a tree."""
    node = np.ones(len(bins), np.int64)
    rows = np.arange(len(bins))
    splits = upper.get(tree, {})
    while len(rows):
        own, at = np.unique(node[rows], return_inverse=True)
        feature, last = np.array([splits.get(int(x), (-1, 0)) for x in own], np.int64).T
        goes = feature[at] >= 0
        rows, at = rows[goes], at[goes]
        node[rows] = node[rows] * 2 + (bins[rows, feature[at]] > last[at])
    return node


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint8) for x in column.to_pylist()]).reshape(len(column), -1)


def _upper(rows: DataFrame, forest: Forest, local: int) -> dict:
    """tree -> node -> (feature, last bin) of the splits of nodes of more than `local` rows; rows: (id, weight, bin, bins)."""
    upper: dict = {}
    for level in range(forest.depth):
        shared = rows.sparkSession.sparkContext.broadcast(upper)

        def sizes(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, there, bin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                bins = _matrix(batch.column(3))
                for tree in range(forest.trees):
                    weight = _weights(forest.seed, tree, ids) * there
                    node = _placed(bins, tree, shared.value)
                    now = node >> level == 1
                    own, at = np.unique(node[now], return_inverse=True)
                    n, ones = np.bincount(at, weight[now], len(own)), np.bincount(at, weight[now] * bin[now], len(own))
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(own), pa.int32()), pa.array(own), pa.array(n.astype(np.int64)), pa.array(ones.astype(np.int64))], ["tree", "node", "n", "ones"])

        known = rows.mapInArrow(sizes, "tree int, node long, n long, ones long").groupBy("tree", "node").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
        large = known.where(F.col("n") > local).where("ones > 0 AND ones < n").select("tree", "node").collect()  # one for some `local` rows and tree
        if not large:
            return upper
        wanted: dict = {}
        for r in large:
            wanted.setdefault(r["tree"], []).append(r["node"])
        asked = rows.sparkSession.sparkContext.broadcast(wanted)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, there, bin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                bins = _matrix(batch.column(3))
                for tree, nodes in asked.value.items():
                    own = np.sort(np.array(nodes))
                    node = _placed(bins, tree, shared.value)
                    now = np.flatnonzero(np.isin(node, own))
                    candidates = _candidates(forest.seed, np.full(len(own), tree), own, bins.shape[1])
                    counts = _histogram(bins[now], np.searchsorted(own, node[now]), candidates, (_weights(forest.seed, tree, ids) * there)[now], bin[now].astype(np.int64))
                    cells = np.flatnonzero(counts)
                    i, cell = np.divmod(cells, counts[0].size)
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(cells), pa.int32()), pa.array(own[i]), pa.array(cell), pa.array(counts.reshape(-1)[cells].astype(np.int64))], ["tree", "node", "cell", "n"])

        counted = rows.mapInArrow(count, "tree int, node long, cell long, n long").groupBy("tree", "node", "cell").agg(F.sum("n").alias("n"))

        def best(table: pa.Table) -> pa.Table:
            tree, node = (table[c].to_numpy()[:1] for c in ("tree", "node"))
            candidates = _candidates(forest.seed, tree, node, features)
            counts = np.zeros((1, candidates.shape[1], MAX_BINS, 2))
            counts.reshape(-1)[table["cell"].to_numpy()] = table["n"].to_numpy()
            feature, last = _splits(counts, candidates)
            return pa.table({"tree": tree, "node": node, "feature": feature, "last": last})

        features = len(rows.select("bins").first()["bins"])
        found = counted.groupBy("tree", "node").applyInArrow(best, "tree int, node long, feature long, last long").where("feature >= 0").collect()
        if not found:
            return upper
        for r in found:
            upper.setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["last"])
    return upper


def _scored(rows: DataFrame, forest: Forest, scratch: Scratch, name: str, local: int) -> DataFrame:
    """(id, prob) of all rows; rows: (id, weight, bin, bins), of which those of weight 1 are learnt from."""
    upper = _upper(rows, forest, local)
    shared = rows.sparkSession.sparkContext.broadcast(upper)
    sums = None
    for start in range(0, forest.trees, TREES_AT_ONCE):
        trees = range(start, min(start + TREES_AT_ONCE, forest.trees))

        def deal(batches: Iterator[pa.RecordBatch], trees: range = trees) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, there = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                bins = _matrix(batch.column(3))
                for tree in trees:
                    weight = _weights(forest.seed, tree, ids) * there
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(ids), pa.int32()), pa.array(_placed(bins, tree, shared.value)), batch.column(0), pa.array(weight.astype(np.int16)), batch.column(2), batch.column(3)], ["tree", "node", "id", "weight", "bin", "bins"])

        def grow(table: pa.Table) -> pa.Table:
            tree, node = table["tree"][0].as_py(), table["node"][0].as_py()
            weight, bin = (table[c].to_numpy().astype(np.int64) for c in ("weight", "bin"))
            share = _grown(_matrix(table["bins"].combine_chunks()), weight, bin, forest.seed, tree, node, forest.depth - (node.bit_length() - 1))
            return pa.table({"id": table["id"], "share": share})

        dealt = rows.mapInArrow(deal, "tree int, node long, id long, weight short, bin int, bins binary")
        own = dealt.groupBy("tree", "node").applyInArrow(grow, "id long, share double").groupBy("id").agg(F.sum("share").alias("share"))
        own = scratch.keep(own, f"{name}-{start}")
        scratch.drop()  # a part's rows as they moved
        sums = own if sums is None else sums.unionByName(own)
    return sums.groupBy("id").agg((F.sum("share") / forest.trees).alias("prob"))


def _binned(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(row, a struct of all columns, id, bin, features), and (id, bin, bins), a byte a feature."""
    wide = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.monotonically_increasing_id().alias("id"), F.col("bin").cast("int").alias("bin"), F.col("features").cast("array<double>").alias("features"))
    wide = scratch.keep(wide, "rows")
    shares = [i / MAX_BINS for i in range(1, MAX_BINS)]
    cuts = wide.select(F.posexplode("features").alias("feature", "value")).groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("cuts")).collect()  # MAX_BINS numbers a feature
    cuts = [np.unique(r["cuts"]) for r in sorted(cuts, key=lambda r: r["feature"])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            bins = np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in bins], pa.binary())], ["id", "bin", "bins"])

    return wide, wide.select("id", "bin", "features").mapInArrow(cut, "id long, bin int, bins binary")


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Model:
    """rows: features (array), bin (0 or 1)."""
    return Model(_forest(trees, depth, seed), rows)


def predict(model: Model, rows: DataFrame, local: int = LOCAL) -> DataFrame:
    """The rows and prob, the forest's probability of bin 1. The model's own rows, or others with the same columns."""
    ship_package(rows.sparkSession)
    scratch = Scratch(rows.sparkSession, "forest")
    learnt = model.rows.withColumn("_weight", F.lit(1))
    every = learnt.withColumn("_asked", F.lit(True)) if rows is model.rows else learnt.withColumn("_asked", F.lit(False)).unionByName(rows.withColumn("_weight", F.lit(0)).withColumn("_asked", F.lit(True)))
    wide, bins = _binned(every, scratch)
    told = bins.join(wide.select("id", F.col("row._weight").alias("weight")), "id")
    told = scratch.keep(told.select("id", "weight", F.coalesce("bin", F.lit(0)).alias("bin"), "bins").repartition(max(2, rows.sparkSession.sparkContext.defaultParallelism)), "bins")
    prob = _scored(told, model.forest, scratch, "shares", local)
    return wide.where("row._asked").join(prob, "id").select("row.*", "prob").drop("_weight", "_asked")


def cross_validated(rows: DataFrame, member: str, n: int = FOLDS, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> DataFrame:
    """fold, auroc of a stratified cross-validation; rows: member, features, bin."""
    dealt = Scratch(rows.sparkSession, "dealt").keep(folds(rows, [], member, n, seed), "rows")  # every fold reads it twice
    out = None
    for k in range(n):
        scored = predict(fit(dealt.where(F.col("fold") != k), trees, depth, seed), dealt.where(F.col("fold") == k))
        own = auroc(scored.select("fold", F.col("prob").alias("score"), "bin"), ["fold"])
        out = own if out is None else out.unionByName(own)
    return out


def summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("auroc").alias("mean"), F.stddev_pop("auroc").alias("sd"))
