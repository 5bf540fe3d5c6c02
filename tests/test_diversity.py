from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quantarium.operators import diversity
from quantarium.plans import catalog


def ones(words):
    return {64 * j + i for j, w in enumerate(words) for i in range(64) if (w >> i) & 1}


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def mean(members):
    """Shared over all bits, each summed over the pairs of members."""
    shared = either = 0
    for i, a in enumerate(members):
        for b in members[:i]:
            shared += len(a & b)
            either += len(a | b)
    return shared / either if either else 1.0


def recursive(entries, threshold, leaf, branches, deal):
    """entries: (place, words, set, n) in order."""
    if len(entries) > leaf:
        pivots = entries[:branches]
        parts = [[] for _ in pivots]
        for e in entries:
            parts[max(range(len(pivots)), key=lambda i: (similarity(e[2], pivots[i][2]), deal[e[0], i]))].append(e)
        return sum(recursive(p, threshold, leaf, branches, deal) for p in parts if p)
    clusters = []
    for _, _, bits, n in entries:
        if clusters:
            major = [{b for b in set().union(*c) if 2 * sum(b in m for m in c) >= len(c)} for c in clusters]
            best = max(range(len(clusters)), key=lambda i: (similarity(bits, major[i]), -i))
            if mean(clusters[best] + [bits] * n) >= threshold:
                clusters[best] += [bits] * n
                continue
        clusters.append([bits] * n)
    return len(clusters)


@pytest.fixture(scope="module")
def prints(spark):
    r = random.Random(2)
    rows = []
    centres = [r.getrandbits(64) & r.getrandbits(64) for _ in range(6)]
    for i in range(240):
        w = centres[i % 6] ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
        rows.append(("hot" if i % 4 else None, [w - (1 << 64) if w >> 63 else w, r.randrange(4)]))
    rows += [("hot", rows[1][1])] * 50 + [("empty", [0, 0]), ("none", None)]
    return spark.createDataFrame(rows, "kind string, words array<long>").repartition(4).cache()


@pytest.mark.parametrize("leaf, branches", [(1000, 4), (20, 4), (7, 3)])
def test_counts_restated(spark, prints, leaf, branches):
    distinct = prints.where("words IS NOT NULL").groupBy("kind", "words").agg(F.count("*").alias("n")).withColumn("place", F.xxhash64("words"))
    deal = {(r.place, i): r[f"h{i}"] for r in distinct.select("place", *(F.xxhash64(F.col("place"), F.lit(i)).alias(f"h{i}") for i in range(branches))).collect() for i in range(branches)}
    groups: dict = {}
    for r in distinct.collect():
        groups.setdefault(r.kind, []).append((r.place, r.words, ones(r.words), r.n))
    got = {r.kind: tuple(r)[1:] for r in diversity.cluster_counts(prints, ["kind"], "words", leaf=leaf, branches=branches).collect()}
    assert got.pop("none") == (None,) * 4
    want = {k: (len(v), *(recursive(sorted(v, key=lambda e: (e[0], e[1])), t, leaf, branches, deal) for t in diversity.THRESHOLDS)) for k, v in groups.items()}
    assert got == want


def test_hot_group_is_split(spark, prints):
    from quantarium.session import Scratch

    leaves = diversity.tree_leaves(prints, ["kind"], "words", Scratch(spark, "t"), leaf=20, branches=4)
    sizes = leaves.groupBy("key", "node").agg(F.count("*").alias("n"), F.sum("n").alias("members")).collect()
    assert max(r.n for r in sizes) <= 20 and sum(r.members for r in sizes) == prints.where("words IS NOT NULL").count()
    assert len({r.node for r in sizes if r.key.kind == "hot"}) > 4


def test_features_add_up(spark, prints):
    from quantarium.session import Scratch

    found = diversity.features(diversity.tree_leaves(prints, ["kind"], "words", Scratch(spark, "t"), leaf=20, branches=4)).where("threshold = 0.6").collect()
    total: dict = {}
    for r in found:
        total[r.key.kind] = [a + b for a, b in zip(total.get(r.key.kind, [0] * 128), r.sums)]
    for kind, sums in total.items():
        rows = [ones(r.words) for r in prints.collect() if r.kind == kind and r.words is not None]
        assert sums == [sum(i in x for x in rows) for i in range(128)]


def test_fingerprint_of_signs(spark):
    r = random.Random(4)
    vector = [r.uniform(-1, 1) for _ in range(130)]
    words = spark.createDataFrame([(vector,)], "v array<double>").select(diversity.fingerprint(F.col("v")).alias("w")).first().w
    assert len(words) == 3 and ones(words) == {i for i, v in enumerate(vector) if v > 0}


def test_query_counts(spark, folder):
    out = catalog.QUERIES["diversity_clusters"](spark, folder).toPandas()
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    assert len(out) == table.select("label").distinct().count()
    assert (out.clusters_30 <= out.clusters_85).all() and (out.clusters_85 <= out.fingerprints).all() and (out.clusters_30 >= 1).all()
