from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantarium.operators import datasets, graph, joins, profile, selection, stats
from quantarium.session import Scratch
from quantarium.sources import files
from quantarium.streaming import incremental

ROW = "assay_id int, activity_type string, unit string, direction int, compound_id int, value double, relation string, text_flag int, smiles string"


def rows(spark, *values, direction=-1):
    return spark.createDataFrame([(1, "MIC", None, direction, *v) for v in values], ROW)


def test_censored(spark):
    low = datasets.fix_censored(rows(spark, (1, 2.0, ">", 0, "a"), (2, 50.0, "=", 0, "b"), (3, 1.0, "<", 0, "c")))
    assert sorted((r.compound_id, r.value, r.relation) for r in low.collect()) == [(1, 50, "="), (2, 50, "="), (3, 1, "=")]
    high = datasets.fix_censored(rows(spark, (1, 90.0, "<", 0, "a"), (2, 10.0, "=", 0, "b"), (3, 80.0, ">", 0, "c"), direction=1))
    assert sorted((r.compound_id, r.value) for r in high.collect()) == [(1, 10), (2, 10), (3, 80)]


@pytest.mark.parametrize(("direction", "value"), [(-1, 3), (1, 7)])
def test_most_active(spark, direction, value):
    df = rows(spark, (1, 3.0, "=", 0, "a"), (1, 7.0, "=", 0, "a"), direction=direction)
    assert [r.value for r in datasets.most_active(df).collect()] == [value]


@pytest.mark.parametrize("direction", [-1, 1, None])
def test_compounds_agree_with_rows(spark, direction):
    """One table of compounds gives what rows give: censored on both sides, ties, nulls, both flags."""
    found = [(i % 7 if i % 11 else None, (i * 37 % 5) * 1.5 if i % 4 else None, (None, "=", "<", ">")[i * 7 % 4], (0, 1, -1)[i % 3], "abc"[i * 5 % 3] if i % 6 else None) for i in range(90)]
    df = rows(spark, *found, direction=direction)
    keys = ["assay_id", "activity_type", "unit"]
    table = datasets.compounds(df, [])
    wanted = datasets.most_active(datasets.fix_censored(df.where("value IS NOT NULL AND direction IS NOT NULL")))
    got = datasets.actives(table, [])
    assert sorted(got.select(wanted.columns).collect(), key=repr) == sorted(wanted.collect(), key=repr)
    assert (direction is None) == got.isEmpty()
    wanted = datasets.qualitative(df, keys)
    assert sorted(datasets.flagged(table, keys).select(wanted.columns).collect(), key=repr) == sorted(wanted.collect(), key=repr)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running(spark, n):
    found = [(i * 7919 % 13, i, i % 3) for i in range(n)]
    df = spark.createDataFrame(found, "a int, b int, v long").repartition(5)
    wanted, total = [], 0
    for place, (a, b, v) in enumerate(sorted(found, key=lambda r: (-r[0], r[1])), 1):
        total += v
        wanted.append((a, b, v, place, total))
    assert [tuple(r) for r in profile.running(df, [F.desc("a"), F.col("b")], "v").orderBy("place").collect()] == wanted


def test_qualitative_and_mixed(spark):
    df = rows(spark, (1, None, "=", 1, "a"), (1, None, "=", 0, "a"), (2, None, "=", -1, "b"), (2, None, "=", 0, "b"), (3, None, "=", 0, "c"), (4, None, "=", 1, "d"), (4, None, "=", -1, "d"))
    keys = ["assay_id", "activity_type", "unit"]
    out = datasets.qualitative(df, keys)
    assert sorted((r.compound_id, r.bin) for r in out.collect()) == [(1, 1), (2, 0)]
    assert [r.compound_id for r in datasets.conflicting(df, keys).collect()] == [4]
    schema = "assay_id int, activity_type string, unit string, place int, cutoff double, compound_id int, smiles string, value double, bin int"
    quantitative = spark.createDataFrame([(1, "MIC", None, 1, 5.0, 9, "x", 1.0, 1)], schema)
    both = datasets.mixed(quantitative, out, keys)
    assert sorted((r.compound_id, r.bin, r.value) for r in both.collect()) == [(2, 0, None), (9, 1, 1.0)]


def test_dataset_stats_refuses_repeats(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 0)], "k int, compound_id int, bin int")
    with pytest.raises(Exception, match="repeated"):
        datasets.dataset_stats(df, ["k"]).collect()


def test_nullsafe_and_one_to_one(spark):
    a, b = (spark.createDataFrame(v, f"k int, u string, {c} int") for v, c in (([(1, None, 5), (2, "x", 6)], "a"), ([(1, None, 7), (2, "x", 8)], "b")))
    assert sorted(map(tuple, joins.one_to_one(a, b, ["k", "u"]).select("k", "u", "a", "b").collect()), key=str) == [(1, None, 5, 7), (2, "x", 6, 8)]
    with pytest.raises(Exception, match="no partner"):
        joins.one_to_one(a, b.where("k = 1"), ["k", "u"]).collect()
    with pytest.raises(Exception, match="repeated"):
        joins.one_to_one(a, b.unionByName(b), ["k", "u"]).collect()


def test_overlap(spark):
    m = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 3), ("b", 4), ("b", 5), ("c", 9)], "k string, x int")
    pairs = {(r.key_1, r.key_2): (r.shared, round(r.share, 5)) for r in joins.overlaps(m, "k", "x", zeros=True).collect()}
    assert pairs[("a", "b")] == (2, 0.66667) and pairs[("a", "c")] == (0, 0) and pairs[("a", "a")] == (3, 1) and len(pairs) == 6


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (8, 9), (9, 1), (4, 4)], "u long, v long")
    roots = {r.node: r.root for r in graph.components(edges, Scratch(spark, "t")).collect()}
    assert roots == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 5: 5, 6: 5}
    path = spark.range(60).selectExpr("id AS u", "id + 1 AS v")
    assert {r.root for r in graph.components(path, Scratch(spark, "t")).collect()} == {0}
    assert graph.components(edges.where("u > 99"), Scratch(spark, "t")).count() == 0


def test_select_threshold(spark):
    schema = "k string, place int, cutoff double, score double, is_reference boolean"
    df = spark.createDataFrame([("a", 1, 5.0, 0.95, False), ("a", 2, 10.0, 0.90, True), ("b", 1, 5.0, 0.95, False), ("b", 2, 10.0, 0.80, True), ("c", 1, 5.0, 0.70, False), ("c", 2, 10.0, 0.60, True), ("d", 1, 5.0, 0.9, True)], schema)
    out = {r.k: r.selected_cutoff for r in selection.select_threshold(df, ["k"], selection.Limits()).collect()}
    assert out == {"a": 10, "b": 5}
    assert selection.select_threshold(df, ["k"], selection.Limits(), least_rows=1).count() == 3


def test_hierarchical(spark):
    schema = "assay_id int, activity_type string, unit string, kind string, cutoff double, cpds_qt int, pos_qt int"
    df = spark.createDataFrame([(1, "MIC", "u", "mixed", 1.0, 200, 150), (1, "MIC", "u", "mixed", 2.0, 1500, 60), (2, "MIC", None, "mixed", 1.0, 1500, 60)], schema)
    assert [(r.label, r.cutoff) for r in selection.hierarchical(df, selection.Limits()).collect()] == [("A", 2.0)]


def test_fractional(spark):
    members, at = [], 0
    for assay, n in enumerate((100, 50, 4, 3)):
        members += [("g", assay, at + i) for i in range(n)]
        at += n
    df = spark.createDataFrame(members, "g string, assay int, compound_id int")
    out = {r.assay: r["pass"] for r in selection.fractional(df, ["g"], "assay", 0.05).collect()}
    assert out == {0: 1, 1: 1, 2: 2, 3: 2}


def test_reasons(spark):
    e = spark.createDataFrame([(1, 1, "insufficient_compounds"), (1, 2, "successfully_merged"), (1, 3, "insufficient_positives"), (2, 0, "group_qualified"), (2, 1, "insufficient_positives"), (3, 0, "group_qualified")], "k int, step int, reason string")
    out = {r.k: r.reason for r in selection.resolved_reasons(e, "k").collect()}
    assert out == {1: "successfully_merged", 2: "insufficient_positives", 3: "group_qualified"}


def test_greedy(spark):
    d = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "name string, place int")
    p = spark.createDataFrame([("a", "b", 0.9, 0.9), ("b", "c", 0.9, 0.9), ("a", "c", 0.9, 0.1)], "key_1 string, key_2 string, score double, share double")
    out = selection.greedy_distinct(d, p, selection.Limits())
    assert {r.name: r.kept for r in out.collect()} == {"a": True, "b": False, "c": True}
    assert [(r.name, r.cause) for r in selection.causes(out, p).collect()] == [("b", "c")]


def test_only_one(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    with pytest.raises(Exception, match="several values"):
        df.groupBy("k").agg(profile.only_one("v")).collect()


def test_mode_with_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "aa"), (1, "ab"), (1, " "), (1, None)], "k int, v string")
    assert [r["mode"] for r in profile.mode_with_ties(df, "k", "v").collect()] == ["ab"]


def test_samples(spark):
    df = spark.range(100).selectExpr("id", "cast(id < 3 as int) as bin", "1 as k")
    assert stats.sample(df, "id", 7).collect() == stats.sample(df.repartition(5), "id", 7).collect()
    assert stats.downsampled(df, ["k"], "id").count() == 30
    folds = stats.folds(df, [], "id").groupBy("fold", "bin").count().collect()
    assert max(r["count"] for r in folds if r.bin == 1) == 1
    with pytest.raises(ValueError):
        stats.decoys(df, df.limit(0), "id", 1000, 0, 0.1)
    few = stats.decoys(df, df.where("id < 90"), "id", 1, 2, 0.1).collect()
    assert len(few) == 8 and min(r.id for r in few) >= 90
    ranks = stats.hash_rank(df, ["bin"], "id", 42).orderBy("bin", "_k").collect()
    by_hash = sorted(range(3, 100), key=lambda i: __import__("hashlib").md5(f"{i}#42".encode()).hexdigest())
    assert [r.id for r in ranks if r.bin == 0] == by_hash and [r["_k"] for r in ranks if r.bin == 0] == list(range(1, 98))
    assert stats.capped(df, "id", 50).groupBy("bin").count().where("bin = 1").first()["count"] == 3


def test_auroc(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (1, 0.5, 1), (1, 0.5, 0), (1, 0.1, 0)], "k int, score double, bin int")
    assert stats.auroc(df, ["k"]).first()["auroc"] == 0.875


def test_files(spark, tmp_path):
    import pandas as pd

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "x.csv").write_text("a,b\n1,x\nNA,nan\nbad,y\n")
    assert set(map(tuple, files.read_csv(spark, str(tmp_path / "x.csv"), schema).collect())) == {(1, "x"), (None, None), (None, "y")}
    assert files.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "ids.txt").write_text("a,b\n\nc , a\n")
    assert {r.id for r in files.read_ids(spark, str(tmp_path / "ids.txt"), ",").collect()} == {"a", "b", "c"}
    assert files.read_ids(spark, str(tmp_path / "no.txt")).count() == 0
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        frame = pd.DataFrame({"a": [1, 2], "b": ["x", "y"]})
        frame.to_csv(tmp_path / "m.csv.gz", index=False)
        z.write(tmp_path / "m.csv.gz", "m.csv.gz")
        z.writestr("broken.csv.gz", b"no gzip")
    assert sorted(map(tuple, files.read_archives(spark, str(tmp_path / "z.zip"), schema).collect())) == [("m.csv.gz", 1, "x"), ("m.csv.gz", 2, "y")]
    found = spark.range(1).select(files.nested_values(F.lit('{"x": [{"no": "b, a"}, {"no": "a"}]}'), "no").alias("v")).first()["v"]
    assert found == ["a", "b"]


def test_streaming(spark, tmp_path):
    events = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    events.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = incremental.process_new_files(spark, str(tmp_path / "in"), events.schema, str(tmp_path / "out"), str(tmp_path / "ck"), lambda df: df)
        q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_nested_values_escapes_and_edges(spark):
    rows = [('{"a": {"no.": "x\\"y, z"}, "b": [{"no.": "z"}], "noo": "w"}',), (None,), ("no json",), ('{"no.": 5}',), ('{"no.": " , "}',)]
    out = [r.v for r in spark.createDataFrame(rows, "t string").select(files.nested_values(F.col("t"), "no.").alias("v")).collect()]
    assert out == [['x"y', "z"], [], [], [], []]


def test_answered_keeps_every_row(spark):
    def step(items):
        if 3.0 in items:
            raise OSError
        return [f"{i:.0f}" for i in items]

    rows = [(None,), *((float(i),) for i in range(20)), (5.0,)]
    df = spark.createDataFrame(rows, "id double").repartition(3)
    got = sorted(((r.id, r.answer) for r in incremental.answered(df, "id", step, size=4, tries=2).collect()), key=str)
    assert got == sorted(((i, None if i is None or i == 3 else f"{i:.0f}") for (i,) in rows), key=str)
    assert incremental.answered(df.limit(0), "id", step).collect() == []
    with pytest.raises(ValueError):
        incremental.answered(df.withColumn("answer", F.lit(1)), "id", step)


def test_retried():
    calls = []

    def step(batch):
        calls.append(len(batch))
        if 3 in batch:
            raise OSError
        return batch

    assert incremental.retried(step, [1, 2, 3, 4], size=4, tries=2) == [1, 2, None, 4] and calls[:2] == [4, 4]


def test_registered_forests_are_whole(spark, folder, monkeypatch):
    from quantarium.operators import ml
    from quantarium.plans import catalog

    seen, forest = [], ml._forest
    monkeypatch.setattr(ml, "_forest", lambda trees, depth, seed: seen.append((trees, depth)) or forest(1, 1, seed))
    catalog.rf_cross_validation(spark, folder)
    catalog.rf_score(spark, folder)
    assert seen == [(ml.TREES, ml.DEPTH)] * (ml.FOLDS + 1)


def test_prune_policies(spark):
    pairs = spark.createDataFrame([(1, 2, 0.1), (2, 3, 0.2), (4, 5, 0.3), (6, 7, 0.9)], "key_1 int, key_2 int, agreement double")
    sizes = {1: 5, 2: 9, 3: 1, 4: 2, 5: 2, 6: 1, 7: 1}
    assert graph.prune(pairs, sizes, lambda gone: 0.8, 0.5) == [1, 3, 4]
    assert graph.prune(pairs, sizes, lambda gone: 0.8, 0.5, policy="medoid", agreement={1: 0.9, 2: 0.1, 3: 0.5, 4: 0.6, 5: 0.2}) == [2, 5]
    assert graph.prune(pairs, sizes, lambda gone: None if 3 in gone else 0.8 - 0.1 * (1 in gone), 0.5) == [3, 4]
    assert graph.prune(pairs, sizes, lambda gone: None if not gone else 0.1, 0.5) == [1, 3, 4]  # no score to lose
    assert graph.prune(pairs, sizes, lambda gone: 0.8, 0.5, checks=1) == [1]
    # a pair that lost a member costs no check
    more = pairs.union(spark.createDataFrame([(1, 6, 0.15)], pairs.schema))
    assert graph.prune(more, sizes, lambda gone: 0.8, 0.5, checks=2) == [1, 3]
    with pytest.raises(ValueError):
        graph.prune(pairs, sizes, lambda gone: 0.8, 0.5, policy="other")


def test_prune_pools_is_prune_of_each(spark):
    """Many pools with ties, missing scores and pairs across pools, held against the walk of one pool after the other."""
    import random

    from quantarium.session import Scratch

    r = random.Random(4)
    rows = [(k, k % 5, r.randrange(1, 4)) for k in range(40)]
    pairs = [(a, b, r.choice([0.1, 0.2, 0.3, 0.6]), 5 + a) for a in range(40) for b in range(a + 1, 40) if r.random() < 0.35]
    worth = {k: r.choice([0, 1, 2]) for k, _, _ in rows}
    value = lambda left: None if sum(left) % 13 == 0 else sum(worth[k] for k in left) / len(left)
    members = spark.createDataFrame([*rows, (None, 1, 1)], "key long, group int, size int")
    edges = spark.createDataFrame(pairs, "key_1 long, key_2 long, agreement double, n long").repartition(4)
    calls = []

    def score(trials):
        calls.append(1)
        left = {}
        for x in trials.collect():
            left.setdefault(x.group, []).append(x.key)
        return spark.createDataFrame([(g, value(ks)) for g, ks in left.items() if value(ks) is not None], "group int, score double")

    for policy, checks in (("largest", 200), ("medoid", 3)):
        calls.clear()
        got = graph.prune_pools(edges, graph.ranks(edges, members, policy), score, Scratch(spark, "prune"), 0.5, 0.1, checks).collect()
        assert len(calls) <= checks + 1
        for g in range(5):
            keys = [k for k, h, _ in rows if h == g]
            own = [p for p in pairs if p[0] in keys and p[1] in keys]
            near = {k: [(c, n) for a, b, c, n in own if k in (a, b)] for k in keys}
            mean = {k: sum(c * n for c, n in v) / sum(n for _, n in v) for k, v in near.items() if v}
            gone = graph.prune(spark.createDataFrame(own, edges.schema), {k: s for k, _, s in rows}, lambda x: value([k for k in keys if k not in x]), 0.5, 0.1, checks, policy, mean)
            assert sorted(x.key for x in got if x.group == g and not x.kept) == sorted(gone) and sum(x.group == g for x in got) == len(keys)
    assert graph.prune_pools(edges.limit(0), graph.ranks(edges, members), score, Scratch(spark, "prune"), 0.5).where("kept").count() == 40


def test_database_source(spark, tmp_path):
    """Written to and read from an embedded database; the columns asked for are all that is read."""
    spark._jvm.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    try:
        spark.range(50).selectExpr("id", "id * 2 as twice", "'x' as rest").write.format("jdbc").options(url=url, dbtable="t", driver=driver, createTableColumnTypes="rest varchar(8)").save()
    except Exception as missing:  # a Spark without the embedded database
        pytest.skip(str(missing)[:80])
    df = files.read_database(spark, url, "t", ["id", "twice"], key="id", low=0, high=50, parts=3, driver=driver)
    assert df.columns == ["id", "twice"] and sorted(r.twice for r in df.collect()) == list(range(0, 100, 2)) and df.rdd.getNumPartitions() == 3


def test_json_schema():
    from pyspark.sql import types as T

    s = files.json_schema(T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.BooleanType(), False)])), T.StructField("c", T.ArrayType(T.DoubleType()), False)]))
    assert s == {"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "boolean"}}, "required": ["b"]}, "c": {"type": "array", "items": {"type": "number"}}}, "required": ["c"]}


def test_conformance(spark):
    schema = {"properties": {"a": {"type": "integer"}, "b c": {"type": "number"}, "d": {"type": "array"}}, "required": ["a"]}
    texts = ['{"a": 1, "b c": 2, "d": [1]}', '{"a": 1.5, "b c": 2.25}', '{"a": null, "d": {"x": 1}}', "[1]", "no json", None, '{"a": "1", "b c": true}']
    got = {x.field: (x.kind, x.required, x.present, x.missing, x.mistyped) for x in files.conformance(spark.createDataFrame([(t,) for t in texts], "answer string"), "answer", schema).collect()}
    assert got == {"a": ("integer", True, 3, 4, 2), "b c": ("number", False, 3, 4, 1), "d": ("array", False, 2, 5, 1)}
    assert [x.present for x in files.conformance(spark.createDataFrame([], "answer string"), "answer", schema).collect()] == [0, 0, 0]
