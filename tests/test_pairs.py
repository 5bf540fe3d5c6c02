from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from quantarium.operators import joins, pairs


@pytest.mark.parametrize("kind", ["string", "long"])
def test_counts_of_pairs_in_many_tiles(spark, monkeypatch, kind):
    """Held against all pairs of rows: null and repeated rows, labels that are missing, a member of all sets, tiles of a few pairs."""
    r = random.Random(3)
    name = (lambda k: f"k{k}") if kind == "string" else (lambda k: k - 20)
    rows = [(name(r.randrange(60)), r.randrange(40), r.choice([0, 1, None])) for _ in range(900)] + [(name(k), 99, 1) for k in range(60)] + [(None, 1, 1), (name(1), None, 1)]
    shared, same, told, n = Counter(), Counter(), Counter(), Counter(k for k, _, _ in rows if k is not None)
    for a, x, p in rows:
        for b, y, q in rows:
            if None not in (a, b, x, y) and a < b and x == y:
                shared[a, b] += 1
                same[a, b] += p is not None and p == q
                told[a, b] += None not in (p, q)
    monkeypatch.setattr(pairs, "HELD", 300)
    table = spark.createDataFrame(rows, f"k {kind}, x long, label int").repartition(3)
    got = pairs.common(table, table.groupBy("k").count().toDF("k", "n"), 3, pairs=200).collect()
    assert {(x.key_1, x.key_2): (x.n_1, x.n_2, x.shared, x.same, x.told) for x in got} == {(a, b): (n[a], n[b], c, same[a, b], told[a, b]) for (a, b), c in shared.items() if c >= 3}
    assert len(got) == sum(c >= 3 for c in shared.values())


def test_pairs_take_few_bytes():
    """What is written of a pair: few bytes, where a joined row held two keys, two sizes and a count."""
    codes = np.sort(np.random.default_rng(1).integers(0, 1 << 34, 50_000))
    packed = pairs._packed(codes)
    assert (pairs._unpacked(packed, len(codes)) == codes).all() and len(packed) < 4 * len(codes)
    rows = list(pairs._pairs_of(np.array([0, 3]), np.array([3, 2])))
    assert sorted((a, b) for i, j in rows for a, b in zip(i, j)) == [(0, 1), (0, 2), (1, 2), (3, 4)]


def test_overlaps_join_no_members(spark):
    rows = spark.createDataFrame([(k, x) for k in range(20) for x in range(k, 30)], "k long, x long")
    plan = joins.overlaps(rows, "k", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and plan.count("Join") == 2  # of sets with their rows, and of sizes
