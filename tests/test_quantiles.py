import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.operators.prefix import bucket_of
from jobweave.operators.quantiles import joined, quantiles
from jobweave.sources.pages import invalid_page_type, scope_decision


def test_against_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1.0, 2.0, 2.0, rng.random() * 100]), 1) for _ in range(500)] + [("alone", 7.0, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, v int")
    got = {r.g: (r.q1, r.mid) for r in quantiles(df, ["g"], F.col("x"), {"q1": 0.25, "mid": 0.5}).collect()}
    of = lambda g: [x for k, x, _ in rows if k == g and x is not None]
    assert set(got) == {"a", "b", None, "alone"}
    for g, (q1, mid) in got.items():
        assert q1 == pytest.approx(np.percentile(of(g), 25)) and mid == pytest.approx(np.percentile(of(g), 50))
    counted = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    assert {r.g: r.mid is None for r in joined(counted, quantiles(df, ["g"], F.col("x"), {"mid": 0.5}), ["g"]).collect()}["none"]
    assert quantiles(df.limit(0), ["g"], F.col("x"), {"mid": 0.5}).collect() == []


@pytest.mark.parametrize("bounds", [[], [1.0], [1.0, 2.0, 5.0], [float(i) for i in range(100)]])
def test_buckets_by_halving(spark, bounds):
    xs = [None, -1.0, 0.0, 1.0, 1.5, 2.0, 4.9, 5.0, 98.5, 99.0, 1e9]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", bucket_of(F.col("x"), bounds).alias("b")).collect()
    assert [r.b for r in got] == [0 if x is None else sum(b < x for b in bounds) for x in xs]


def test_skills_make_a_posting_one_of_it(spark):
    df = spark.createDataFrame([(1, ["Python"]), (2, []), (3, None)], "i int, s array<string>")
    v = scope_decision(F.lit("it_listing_html:page=1"), F.lit(None).cast("string"), F.lit(None).cast("array<string>"), F.lit("Nhân viên"), F.lit("Unclassified"), F.col("s"))
    assert [(r.v.accepted, r.v.reason) for r in df.select("i", v.alias("v")).orderBy("i").collect()] == [(True, None), (False, "insufficient_it_evidence"), (False, "insufficient_it_evidence")]


def test_page_types(spark):
    df = spark.createDataFrame([(1, "https://x/companies/acme"), (2, "https://x/Jobs/Search?page=2"), (3, "https://x/about?u=/companies/"), (4, None)], "i int, u string")
    assert [r.t for r in df.select("i", invalid_page_type(F.col("u")).alias("t")).orderBy("i").collect()] == ["company page", "category/listing page", "duplicate or malformed URL", "duplicate or malformed URL"]
