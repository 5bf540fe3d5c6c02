from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantarium.functions import chemistry
from quantarium.operators import profile, stats


def test_quantiles_of_hot_and_small_groups(spark):
    r = random.Random(3)
    rows = [("hot", None, round(r.gauss(0, 50))) for _ in range(3000)] + [(None, "u", r.random()) for _ in range(7)] + [("one", "u", 5.0), ("none", "u", None), ("same", None, 2.0)] + [("same", None, 2.0)] * 40
    rows = [(a, b, None if v is None else float(v)) for a, b, v in rows]
    df = spark.createDataFrame(rows, "a string, `b.c` string, v double").repartition(7)
    shares = {"low": 0, "q1": 0.1, "mid": 0.5, "q3": 0.93, "high": 1}
    got = {(x[0], x[1]): x[2:] for x in profile.quantiles(df, ["a", "b.c"], "v", shares).collect()}
    want: dict = {}
    for a, b, v in rows:
        if v is not None:
            want.setdefault((a, b), []).append(v)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], np.quantile(v, list(shares.values()))) for k, v in want.items())
    assert profile.quantiles(df.limit(0), ["a"], "v", shares).collect() == []
    whole = profile.quantiles(df, [], "v", {"mid": 0.5}).collect()
    assert whole[0].mid == np.median([v for v in (x[2] for x in rows) if v is not None])


@pytest.fixture
def many_tasks(spark):
    """Small ranges stay apart, as large ones do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_cumulative_cuts_a_hot_group(spark, many_tasks):
    df = spark.range(20000).select(F.lit("k").alias("k"), (F.col("id") % 5000).alias("v"))
    out = profile.cumulative(df, ["k"], "v")
    rows = out.orderBy("v").collect()
    assert [(x.v, x.n, x.before, x.total) for x in rows] == [(i, 4, 4 * i, 20000) for i in range(5000)]
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert profile.quantiles(df, ["k"], "v", {"a": 0.3333, "b": 1}).collect()[0][1:] == (np.quantile([i % 5000 for i in range(20000)], 0.3333), 4999)


def test_spearman_by_blocks(spark):
    r = random.Random(8)
    rows = [(k, p, round(r.gauss(0, 1), 1)) for k in "abcdefghij" for p in range(60) if (k, p % 3) != ("c", 1) and (k == "j") <= (p > 50)]
    rows += [("flat", p, 1.0) for p in range(60)] + [("away", 1000, 3.0), ("a", 61, None), (None, 3, 1.0)]
    df = spark.createDataFrame(rows, "key string, place long, value double").repartition(5)
    wide = pd.DataFrame([x for x in rows if x[0] and x[2] is not None], columns=["key", "place", "value"])
    wide["r"] = wide.groupby("key")["value"].rank()
    wide = wide.pivot(index="place", columns="key", values="r")
    want = {}
    for a in wide:
        for b in wide:
            both = wide[[a, b]].dropna() if a < b else ()
            if len(both):
                want[a, b] = both[a].corr(both[b]) if both[a].std() and both[b].std() else None
    for blocks in ((512, 2048), (3, 7)):
        got = {(x.key_1, x.key_2): x.rho for x in stats.spearman(df, *blocks).collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k] is None if v is None or np.isnan(v) else got[k] == pytest.approx(v, abs=1e-12), k
    assert stats.spearman(df.limit(0)).collect() == []


def test_sample_by_many_tasks_is_the_same(spark):
    df = spark.range(500).select(F.when(F.col("id") > 2, F.col("id") % 400).alias("id"), F.lit(1).alias("k"))
    few, many = (sorted((x.id is not None, x.id or 0) for x in stats.sample(df, "id", 130, one_task=t).collect()) for t in (1000, 0))
    assert few == many and len(few) == 130


def test_references_are_bounded(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 1.0]), (2, [0.0, 0.0, 0.0]), (3, None)], "id int, v array<double>")
    refs = df.where("id < 3").select(F.col("id").alias("name"), "v")
    got = {(x.id, x.name): x.similarity for x in chemistry.to_references(df, "v", refs, "name").collect()}
    assert got == {(1, 1): 1.0, (1, 2): 0.0, (2, 1): 0.0, (2, 2): None, (3, 1): None, (3, 2): None}
    assert chemistry.to_references(df, "v", refs.limit(0), "name").count() == 0
    with pytest.raises(Exception, match="more than 1 references"):
        chemistry.to_references(df, "v", refs, "name", most=1).collect()
