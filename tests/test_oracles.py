"""Registered queries against their SQL on the smallest data."""

from pathlib import Path

import duckdb
import pytest

from folioscope import plans
from verify import canonical

SF = "/root/testdata/sf0.001"
NAMES = sorted(plans.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    got, want = plans.queries()[name](spark, SF).toPandas(), con.execute(plans.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:
        if got[c].dtype.kind in "iuf" and want[c].dtype.kind in "iuf":
            got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    assert canonical(got) == canonical(want)


def test_every_query_is_registered_once():
    names = [k for m in plans.MODULES for k in m.QUERIES]
    assert len(names) == len(set(names))
    assert set(plans.oracle_sql()) <= set(plans.queries())
