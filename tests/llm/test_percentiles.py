import math
import random

from pyspark.sql import functions as F

from jobweave.llm.percentiles import merge, percentiles, summarise

P = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def data(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "x", "y", None]), rng.choice("123"), rng.choice([None, 0.0, 5.0, -3.0]) if rng.random() < 0.4 else rng.lognormvariate(5, 3)) for _ in range(2000)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "g string, day string, v double, n int")


def exact(values, p):
    values = sorted(values)
    return values[max(math.ceil(p * len(values) - 1e-9), 1) - 1]


def test_exact_and_merged(spark):
    rows, df = data(spark)
    got = {(r.g, r.fraction): r.value for r in percentiles(summarise(df, [F.col("g")], "v"), ["g"], P).collect()}
    days = [summarise(df.where(F.col("day") == d), [F.col("g")], "v") for d in "123"]
    put = {(r.g, r.fraction): r.value for r in percentiles(merge(days[0].unionByName(days[1]).unionByName(days[2]), ["g"]), ["g"], P).collect()}
    want = {(g, p): exact([v for a, _, v in rows if a == g and v is not None], p) for g in ("x", "y", None) for p in P}
    assert got == want and put == want


def test_rounded_summaries_keep_their_bound(spark):
    rows, df = data(spark)
    small = summarise(df, [F.col("g")], "v", digits=3)
    for r in percentiles(small, ["g"], P, digits=3).collect():
        want = exact([v for a, _, v in rows if a == r.g and v is not None], r.fraction)
        assert abs(r.value - want) <= r.relative_error * abs(want) + 1e-9 and r.relative_error == 0.005


def test_no_values(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert percentiles(summarise(df, [F.col("g")], "v"), ["g"], P).collect() == []
