"""How many clusters of like fingerprints a group holds, by a tree of mergeable clustering features.

A fingerprint is an array of longs, 64 bits each. A clustering feature is (number of members, sums of their bits); features merge by
addition, and their mean pairwise Tanimoto similarity follows from the sums. The tree is built from the top, by Spark: a node of more than
LEAF distinct fingerprints takes its first BRANCHES ones (in the order of a hash) as pivots and deals its fingerprints to the nearest, so a
group of any size is split over nodes, and equal fingerprints are one entry from the start. Leaves are tasks: each entry in turn joins the
feature with the nearest majority fingerprint if the merged feature's mean similarity stays at or above the threshold, or begins one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantarium.session import Scratch, ship_package

THRESHOLDS = (0.3, 0.6, 0.85)
LEAF = 256
BRANCHES = 16


def fingerprint(values: Column) -> Column:
    """The signs of a vector as a fingerprint: bit i of long j is set where value 64 j + i is above 0."""
    bits = F.transform(values, lambda x: F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(64))
    return F.transform(starts, lambda at: _word(F.slice(bits, at + 1, 64)))


def _word(bits: Column) -> Column:
    """Up to 64 zeros and ones as one long, the first as the lowest bit."""
    return F.aggregate(F.reverse(bits), F.lit(0).cast("long"), lambda w, b: F.shiftleft(w, 1).bitwiseOR(b))


def tanimoto_bits(a: Column, b: Column) -> Column:
    """Shared bits over all bits of two fingerprints; 1 if both are empty."""
    count = lambda x: F.aggregate(x, F.lit(0), lambda s, w: s + F.bit_count(w))
    shared = count(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))
    either = count(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def mean_similarity(n: float, sums: np.ndarray) -> float:
    """Mean pairwise Tanimoto similarity of n fingerprints with these sums of bits: shared over shared and unshared, over all pairs."""
    total, squares = float(sums.sum()), float((sums * sums).sum())
    shared = (squares - total) / 2
    either = shared + n * total - squares
    return shared / either if either else 1.0


def leaf_features(bits: np.ndarray, counts: np.ndarray, threshold: float) -> list[tuple[int, np.ndarray]]:
    """Clustering features of entries (rows of zeros and ones, with their numbers of members) taken in turn."""
    sums, sizes = np.zeros(bits.shape), np.zeros(len(bits))
    major, ones, k = np.zeros(bits.shape), np.zeros(len(bits)), 0
    for row, n in zip(bits.astype(float), counts):
        best = -1
        if k:
            shared = major[:k] @ row
            either = ones[:k] + row.sum() - shared
            best = int(np.argmax(np.where(either > 0, shared / np.maximum(either, 1), 1.0)))
            if mean_similarity(sizes[best] + n, sums[best] + n * row) < threshold:
                best = -1
        if best < 0:
            best, k = k, k + 1
        sums[best] += n * row
        sizes[best] += n
        major[best] = 2 * sums[best] >= sizes[best]
        ones[best] = major[best].sum()
    return [(int(sizes[i]), sums[i].astype(np.int64)) for i in range(k)]


def tree_leaves(rows: DataFrame, keys: list[str], bits: str, scratch: Scratch, leaf: int = LEAF, branches: int = BRANCHES) -> DataFrame:
    """key (a struct of the keys), node, place (hash), bits and n of each distinct fingerprint of a group; nodes hold `leaf` of them at most."""
    key = F.struct(*(F.col(f"`{k}`") for k in keys)).alias("key")
    entries = rows.where(F.col(f"`{bits}`").isNotNull()).groupBy(key, F.col(f"`{bits}`").alias("bits")).agg(F.count("*").alias("n"))
    entries = scratch.keep(entries.select("key", F.lit("").alias("node"), F.xxhash64("bits").alias("place"), "bits", "n"), "entries-0")
    done, turn = [], 0
    while True:
        large = entries.groupBy("key", "node").agg(F.count("*").alias("size")).where(F.col("size") > leaf).select("key", "node")
        large = scratch.keep(large, f"large-{turn}")  # a leaf's entries at least for each, so few
        same = [F.col("a.key").eqNullSafe(F.col("b.key")), F.col("a.node") == F.col("b.node")]
        if large.isEmpty():
            done.append(entries)
            break
        done.append(entries.alias("a").join(large.alias("b"), same, "left_anti"))
        split = entries.alias("a").join(large.alias("b"), same, "left_semi")
        first = F.row_number().over(Window.partitionBy("key", "node").orderBy("place", "bits"))
        pivots = split.withColumn("turn", first).where(F.col("turn") <= branches).groupBy("key", "node").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "bits"))), lambda x: x["bits"]).alias("pivots"))
        # of equally near pivots the hash takes one, so that entries far from all don't stay together
        near = F.transform("pivots", lambda p, i: F.struct(tanimoto_bits(F.col("a.bits"), p).alias("s"), F.xxhash64(F.col("a.place"), i).alias("h"), i.alias("i")))
        dealt = split.alias("a").join(pivots.alias("b"), same).select("a.key", F.concat_ws(",", "a.node", F.array_max(near)["i"].cast("string")).alias("node"), "a.place", "a.bits", "a.n")
        turn += 1
        entries = scratch.keep(dealt, f"entries-{turn}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def features(leaves: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """key, node, threshold, members and sums of bits of each cluster."""
    ship_package(leaves.sparkSession)

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending")])
        words = np.array(table["bits"].to_pylist(), dtype=np.int64)
        order = np.lexsort([*words.T[::-1], table["place"].to_numpy()])
        bits = np.unpackbits(words[order].view(np.uint8), axis=1, bitorder="little")
        counts = table["n"].to_numpy()[order]
        found = [(t, n, sums) for t in thresholds for n, sums in leaf_features(bits, counts, t)]
        of = {"key": pa.chunked_array([pa.concat_arrays([table["key"].chunk(0).slice(0, 1)] * len(found))]), "node": pa.array([table["node"][0].as_py()] * len(found), pa.string())}
        return pa.table(of | {"threshold": [t for t, _, _ in found], "members": [n for _, n, _ in found], "sums": [s for _, _, s in found]})

    kind = leaves.schema["key"].dataType.simpleString()
    return leaves.groupBy("key", "node").applyInArrow(cluster, f"key {kind}, node string, threshold double, members long, sums array<long>")


def cluster_counts(rows: DataFrame, keys: list[str], bits: str, thresholds: tuple[float, ...] = THRESHOLDS, leaf: int = LEAF, branches: int = BRANCHES) -> DataFrame:
    """Of each group its distinct fingerprints, and clusters at each threshold; null where the group has no fingerprint."""
    leaves = tree_leaves(rows, keys, bits, Scratch(rows.sparkSession, "diversity"), leaf, branches)
    found = features(leaves, thresholds)
    named = [F.count_if(F.col("threshold") == t).alias(f"clusters_{t}") for t in thresholds]
    counts = found.groupBy("key").agg(*named).alias("c").join(leaves.groupBy("key").agg(F.count("*").alias("fingerprints")).alias("l"), F.col("c.key").eqNullSafe(F.col("l.key")))
    groups = rows.select(F.struct(*(F.col(f"`{k}`") for k in keys)).alias("key")).distinct().alias("g")
    out = groups.join(counts, F.col("g.key").eqNullSafe(F.col("c.key")), "left")
    return out.select("g.key.*", "fingerprints", *(F.col(f"`clusters_{t}`").alias(f"clusters_{round(100 * t)}") for t in thresholds))
