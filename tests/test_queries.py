"""Every query that has SQL against that SQL, and shapes and invariants of the others, on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pytest

from chronovox import plans

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(value):
    if value is None or isinstance(value, float) and np.isnan(value):
        return None
    return round(float(value), 4) + 0.0 if isinstance(value, int | float) and not isinstance(value, bool) else str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def close(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-4 + 1e-9 * abs(a)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_equals_sql(spark, con, name):
    want = con.sql(plans.oracle_sql()[name])
    frame = plans.queries()[name](spark, DATA)
    assert sorted(frame.columns) == sorted(want.columns)
    a, b = rows(want.columns, want.fetchall()), rows(frame.columns, frame.collect())
    assert len(a) == len(b)
    assert all(close(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_others_give_rows_without_surprises(spark, name):
    frame = plans.queries()[name](spark, DATA)
    found = frame.collect()
    assert found
    for r in found[:200]:
        assert not any(isinstance(v, float) and not np.isfinite(v) for v in r)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 100
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
