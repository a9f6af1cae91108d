"""Every registered query runs over sf0.001 and, where SQL can say it, gives what the SQL gives."""

import decimal
import glob
import os

import duckdb
import pandas as pd
import pytest

from jobweave.plans import registry
from jobweave.plans.read_queries import InvalidParameter, checked_page, job_page, jobs
from jobweave.plans.serving_queries import dashboard, search_jobs

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(DATA + "/*.parquet"):
        c.execute(f"CREATE VIEW \"{os.path.basename(p)[:-8]}\" AS SELECT * FROM read_parquet('{p}')")
    return c


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "∅"
    if isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
        return str(bool(v))
    if isinstance(v, (int, float, decimal.Decimal)) or type(v).__module__ == "numpy":
        return f"{float(v):.9g}"
    return str(v)


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    if sql := registry.oracle_sql().get(name):
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_parameters(spark):
    for page, size in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(InvalidParameter):
            checked_page(page, size)
    j = jobs(spark, DATA)
    with pytest.raises(InvalidParameter):
        job_page(j, sort="salary; drop")
    for bad in ({"limit": 51}, {"offset": -1}, {"sort": "x"}, {"work_modes": []}, {"skills_any": [None]}):
        with pytest.raises(InvalidParameter) as e:
            search_jobs(j, "x", **bad)
        assert e.value.sqlstate == "22023"
    with pytest.raises(InvalidParameter):
        dashboard(j, "2026-02-01", "2026-01-01")
