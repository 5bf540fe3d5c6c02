from __future__ import annotations

import os
import random
import time

from quantarium.streaming import latest

SCHEMA = "key long, kind string, at long, id long, value double"


def test_latest_in_batches(spark, tmp_path):
    """Held against a walk over batches: null keys, late rows and one run a batch from the checkpoint of the one before."""
    r = random.Random(8)
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    known: dict = {}
    for batch in range(4):
        rows = [(r.choice([None, 1, 2, 2**60 + 1, 2**60 + 2]), r.choice(["a", None]), r.randrange(40), 100 * batch + i, r.choice([None, 0.5])) for i in range(12)]
        before = dict(known)
        for key, kind, at, id_, value in rows:
            old = known.get((key, kind))
            late = (old[3] if old else 0) + ((key, kind) in before and (at, id_) <= before[key, kind][:2])
            known[key, kind] = (at, id_, value, late) if old is None or (at, id_) > old[:2] else (*old[:3], late)
        df = spark.createDataFrame(rows, SCHEMA)
        df.write.mode("append").parquet(source)
        latest.run_latest(source, df.schema, target, checkpoint, ["key", "kind"], ["at", "id"], ["value"], spark)
        got = {(x.key, x.kind): (x.at, x.id, x.value, x.late_rows) for x in latest.as_of_now(spark, target, ["key", "kind"]).collect()}
        assert got == known
    assert sorted(os.listdir(f"{checkpoint}/latest")) == ["batch=2", "batch=3"]


def test_state_lives_for_a_time(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    for at in (9, 3):
        df = spark.createDataFrame([(1, "a", at, at, 0.0)], SCHEMA)
        df.write.mode("append").parquet(source)
        latest.run_latest(source, df.schema, target, checkpoint, ["key", "kind"], ["at"], ["value"], spark, ttl_ms=1)
        time.sleep(0.05)
    assert [(x.at, x.late_rows) for x in latest.as_of_now(spark, target, ["key", "kind"]).collect()] == [(3, 0)]


def test_no_key_costs_a_call_of_python(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1, 0.0)], SCHEMA)
    state = latest.touched(rows, None, ["key", "kind"], ["at", "id"], ["value"])
    plan = latest.touched(rows, state, ["key", "kind"], ["at", "id"], ["value"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Pandas" not in plan and "InArrow" not in plan
