from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantarium.operators import components
from quantarium.plans import catalog


def test_moments_and_directions(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 7)) @ r.normal(size=(7, 7)) + 3
    df = spark.createDataFrame([(row.tolist(),) for row in x] + [(None,), ([1.0, None] + [0.0] * 5,)], "v array<double>").repartition(5)
    n, mean, covariance = components.moments(df, "v")
    assert n == 300 and np.allclose(mean, x.mean(axis=0)) and np.allclose(covariance, np.cov(x.T))
    values, directions = components.principal(covariance, 3)
    want, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(values, want[::-1][:3]) and np.allclose(np.abs(directions @ vectors[:, ::-1][:, :3]), np.eye(3), atol=1e-5)
    got = df.where(F.col("v").isNull() | ~F.exists("v", lambda x: x.isNull())).select("v", components.projected(df, "v", mean, directions).alias("p")).collect()
    assert all(r.p is None if r.v is None else np.allclose(r.p, (np.array(r.v) - mean) @ directions.T) for r in got)


def test_moments_edges(spark):
    assert components.moments(spark.createDataFrame([(None,)], "v array<float>"), "v")[0] == 0
    with pytest.raises(ValueError):
        components.moments(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v")
    values, _ = components.principal(components.moments(spark.createDataFrame([([1.0, 2.0],)] * 3, "v array<double>"), "v")[2], 2)
    assert np.allclose(values, 0)


def test_query_shares(spark, folder):
    out = catalog.QUERIES["principal_components"](spark, folder).toPandas()
    x = np.array([r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()])
    want = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose([out.share1[0], out.share2[0]], want[:2] / want.sum()) and len(out) == len(x)
    assert np.allclose([out.pc1.var(), out.pc2.var()], want[:2])


def test_density_by_group_sums_to_one(spark):
    r = np.random.default_rng(6)
    rows = [("a", *map(float, p)) for p in r.normal(size=(400, 2))] + [("one", 0.0, 0.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    out = components.density(df, "x", "y", bins=40, by=["k"]).toPandas()
    a = out[out.k == "a"]
    area = np.ptp([p[1] for p in rows if p[1] is not None]) * np.ptp([p[2] for p in rows]) / 1600
    assert a.n.sum() == 400 and len(a) == 1600 and 0.8 < a.density.sum() * area <= 1.02
    assert out[out.k != "a"].density.isna().all() and out[out.k == "flat"].n.sum() == 2
