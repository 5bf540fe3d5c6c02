from __future__ import annotations

import random

import pytest

from quantarium.operators import linkage
from quantarium.plans import catalog
from quantarium.sources import files, keyed


def one_at_a_time(keys, pairs):
    """Average linkage over the whole matrix, the nearest pair first; then the tree's leaves from the left."""
    near = {frozenset(p): s for p, s in pairs.items()}
    clusters = {k: ([k], 0, k) for k in keys}  # members, number, tree
    number = 0

    def mean(a, b):
        return sum(near.get(frozenset((x, y)), 0.0) for x in clusters[a][0] for y in clusters[b][0]) / (len(clusters[a][0]) * len(clusters[b][0]))

    while len(clusters) > 1:
        names = sorted(clusters)
        a, b = min(((a, b) for i, a in enumerate(names) for b in names[i + 1 :]), key=lambda p: (-mean(*p), *p))
        number += 1
        clusters[a] = (clusters[a][0] + clusters[b][0], number, (clusters[a][1:], clusters.pop(b)[1:]))

    def walk(number, tree):
        if not number:
            return [tree]
        first, second = tree
        if second[0] < first[0]:
            first, second = second, first
        return walk(*first) + walk(*second)

    return walk(*next(iter(clusters.values()))[1:]) if clusters else []


@pytest.mark.parametrize("seed, n, share", [(1, 25, 1.0), (2, 40, 0.3), (3, 12, 0.1), (4, 1, 0), (5, 0, 0)])
def test_leaf_order(spark, seed, n, share):
    r = random.Random(seed)
    pairs = {(a, b): r.random() for a in range(n) for b in range(a + 1, n) if r.random() < share}
    told = [(a, b, s) if r.random() < 0.5 else (b, a, s) for (a, b), s in pairs.items()] + [(1, 1, 1.0), (2, 999, 0.9)]
    got = linkage.leaf_order(spark.createDataFrame(told, "a long, b long, similarity double"), spark.createDataFrame([(k,) for k in [*range(n), None]], "leaf long"))
    assert [x.leaf for x in got.orderBy("place").collect()] == one_at_a_time(range(n), pairs)


def test_leaf_order_of_assays(spark, folder):
    rows = catalog.QUERIES["leaf_order"](spark, folder).collect()
    assert sorted(r.place for r in rows) == list(range(len(rows))) and len({r.leaf for r in rows}) == len(rows) > 0


def test_keyed_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5000).selectExpr("id AS key", "id * 2 AS twice")
    keyed.write_keyed(df, path, "key", buckets=16)
    few = keyed.read_keyed(spark, path, "key", [3, 700, 123_456])
    assert sorted(map(tuple, few.collect())) == [(3, 6), (700, 1400)]
    assert len({r.f for r in few.selectExpr("input_file_name() AS f").collect()}) <= 2
    many = keyed.read_keyed(spark, path, "key", spark.range(0, 6000, 2).toDF("key"))
    assert many.count() == 2500 and keyed.read_keyed(spark, path, "key").count() == 5000
    assert keyed.read_keyed(spark, path, "key", []).count() == 0


def test_lines_add_up(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "x.csv").write_text('a,b\n1,x\n2\n3,y,z\n"4","p, q"\nno,NA\n5,\n')
    got = files.read_lines(spark, str(tmp_path / "x.csv"), T.StructType().add("a", "integer").add("b", "string")).collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (None, None, "2"), (None, None, "3,y,z"), (4, "p, q", None), (None, None, None), (5, None, None)]
