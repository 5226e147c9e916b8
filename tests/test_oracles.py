"""Every query of the fund library against its SQL, on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

from fundscape import plans  # noqa: F401
from fundscape.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.4f}"
    if isinstance(v, dt.datetime):
        return str(v.date()) if v.time() == dt.time() else str(v)
    return str(v) if v is not None else None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns, rows = sorted(df.columns), df.collect()
    if name not in ORACLE_SQL:
        assert columns
        return
    cur = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr) == want
