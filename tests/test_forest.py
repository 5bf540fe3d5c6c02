from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier

from quantarium.operators import ml


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(1500, 6))
    bin = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + 0.4 * r.normal(size=1500) > 0).astype(int)
    return spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, bin))], "vec_id long, features array<double>, bin int").repartition(3).cache()


def test_where_trees_are_cut_changes_no_result(rows, monkeypatch):
    """Nodes grown by counts of all tasks and nodes grown by one task are the same; no model comes to the driver."""
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("a forest in the driver"))
    model = ml.fit(rows, trees=7, depth=12)
    whole, cut = ({r.vec_id: r.prob for r in ml.predict(model, rows, local).collect()} for local in (10_000, 60))
    assert whole.keys() == cut.keys() and len(whole) == 1500
    assert max(abs(whole[k] - cut[k]) for k in whole) < 1e-12


def test_forest_learns(rows):
    """Held-out areas are those of Spark's own forest, but for chance; single trees grow until leaves are pure or can't be cut."""
    own = ml.summary(ml.cross_validated(rows, "vec_id", 2, trees=30)).first()["mean"]
    dealt = ml.folds(rows, [], "vec_id", 2).withColumn("vector", ml.F.col("features")).cache()
    from pyspark.ml.functions import array_to_vector, vector_to_array

    dealt = dealt.withColumn("vector", array_to_vector("features"))
    other = []
    for k in range(2):
        fitted = RandomForestClassifier(featuresCol="vector", labelCol="bin", numTrees=30, maxDepth=30, featureSubsetStrategy="sqrt", seed=1).fit(dealt.where(ml.F.col("fold") != k))
        scored = fitted.transform(dealt.where(ml.F.col("fold") == k)).withColumn("score", ml.F.get(vector_to_array("probability"), 1))
        other.append(ml.auroc(scored, ["fold"]).first()["auroc"])
    assert own > 0.85 and abs(own - np.mean(other)) < 0.03


def test_one_tree_by_hand():
    """Without weights' chance: a column that tells the classes is split at the first bin that does."""
    bins = np.array([[0, 5], [1, 5], [2, 5], [3, 5]], np.uint8)
    share = ml._grown(np.repeat(bins, 3, axis=0), np.array([1, 1, 0] * 4), np.repeat([0, 0, 1, 1], 3), 1, 0, 1, 30)
    assert set(share[:6]) <= {0.0, 0.5} and set(share[6:]) <= {1.0, 0.5}
    counts = ml._histogram(bins, np.zeros(4, np.int64), np.array([[0, 1]]), np.ones(4), np.array([0, 0, 1, 1]))
    assert [int(x[0]) for x in ml._splits(counts, np.array([[0, 1]]))] == [0, 1]
    assert ml._splits(counts[:, 1:], np.array([[1]]))[0][0] == -1
    w = ml._weights(3, 5, np.arange(20_000))
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05
