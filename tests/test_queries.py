from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

from quantarium.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def db(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, folder, db, name):
    df = catalog.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=repr)
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    r = db.execute(catalog.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(row[i]) for i in at) for row in r.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
