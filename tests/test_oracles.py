"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

from fieldspark.plans.registry import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return str(v)[:19]
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    got = all_queries()[name](spark, SF)
    rows = got.collect()
    if name not in all_oracles():
        assert rows
    else:
        want = con.execute(all_oracles()[name])
        names = [x[0] for x in want.description]
        assert sorted(names) == sorted(got.columns)
        order = sorted(names)
        a = Counter(tuple(plain(r[c]) for c in order) for r in rows)
        b = Counter(tuple(plain(dict(zip(names, r))[c]) for c in order) for r in want.fetchall())
        assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
