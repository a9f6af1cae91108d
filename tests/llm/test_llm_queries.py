import os

import duckdb
import pytest

from jobweave.llm import queries
from tests.test_queries import DATA, duck, rows  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):  # noqa: F811
    got = queries.QUERIES[name](spark, DATA).toPandas()
    if sql := queries.ORACLE.get(name):
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
    if name == "p8_round_trip":
        assert len(got) == 0
    assert duckdb is not None
