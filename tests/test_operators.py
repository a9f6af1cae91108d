import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from jobweave.functions import text as tx
from jobweave.operators import duplicates, lookup, parsers, prefix, search, skills


def test_prefix_sums_against_accumulate(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 0.0, 1.0, 2.0]) if rng.random() < 0.2 else rng.uniform(-9, 9), i, rng.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, i int, n int")
    got = {r.i: r.running for r in prefix.prefix_sums(df, ["g"], "x", ["i"], "n", rows_per_bucket=40).collect()}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0.0, r[2]))
        assert [got[r[2]] for r in own] == list(accumulate(r[3] for r in own))
    assert prefix.prefix_sums(df.limit(0), ["g"], "x", ["i"], "n").collect() == []


def test_lookup_join_same_beyond_the_broadcast_bound(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"))
    known = rows.groupBy("k").agg(F.count(F.lit(1)).alias("times")).withColumn("v", F.upper("k")).where("k <> '7'")
    sides = [
        sorted(((r.id, r.k, r.v) for r in lookup.lookup_join(rows, known, ["k"], F.lit(10), ["id"], broadcast_bytes=b).collect()), key=str) for b in (10**6, 1)]
    assert sides[0] == sides[1] and len(sides[0]) == 3000


def test_connected_components(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, *map(str, range(40))]), rng.choice([None, *map(str, range(60))])) for i in range(80)]
    parent = list(range(80))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a, b in rows:
        for j, c, d in rows:
            if (a and a == c) or (b and b == d):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(rows, "id int, a string, b string")
    got = {r.id: r.component for r in duplicates.connected(df, "id", [F.col("a"), F.col("b")]).collect()}
    assert got == {i: root(i) for i in range(80)}
    assert duplicates.connected(df.limit(0), "id", [F.col("a")]).collect() == []


def test_probable_pairs_against_all_pairs(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(9)]
    rows = [(i, rng.choice(["acme", "acme", "zeta", None]), sorted(set(rng.choices(words, k=rng.randint(1, 5)))), rng.choice(["x", "y"]), rng.choice(["full", None]), sorted(set(rng.choices(words, k=2))), rng.choice(["1", "2"])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, company string, title_tokens array<string>, city string, employment string, skills array<string>, salary string")
    first = {}
    for r in rows:
        first.setdefault(str(r[1:]), r)
    distinct = [r for r in first.values() if r[1]]
    jac = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 0
    want = {}
    for x in distinct:
        for y in distinct:
            if x[0] < y[0] and x[1] == y[1]:
                s = 40 * jac(x[2], y[2]) + 25 + 15 * jac(x[5], y[5]) + 10 * (x[3] == y[3]) + 5 * (x[4] is not None and x[4] == y[4]) + 5 * (x[6] == y[6])
                if s >= 80 - 1e-7:
                    want[x[0], y[0]] = s
    got = {(r.left_id, r.right_id): float(r.score) for r in duplicates.probable_pairs(df, 80).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in got)
    with pytest.raises(ValueError):
        duplicates.probable_pairs(df, 60)


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "s string").select(expression(F.col("s")).alias("r")).first().r


@pytest.mark.parametrize("text,want", [("  Kỹ Sư – Dữ_liệu!! ", "ky su du_lieu"), ("Straße", "strasse"), ("\xa0", None), (None, None), ("", None)])
def test_comparison_key(spark, text, want):
    assert one(spark, text, tx.comparison_key) == want


@pytest.mark.parametrize("html,want", [("<p>Gọi 0912 345 678 hoặc a@b.vn</p>", "Gọi [REDACTED_PHONE] hoặc [REDACTED_EMAIL]"), (None, None), ("a &amp; b", "a & b")])
def test_html_to_text(spark, html, want):
    assert one(spark, html, tx.html_to_text) == want


@pytest.mark.parametrize("url,want", [("https://x.vn/viec-lam/tin-a-123?p=9", "123"), ("https://x.vn/12/abc-77/", "77"), ("https://x-5.vn/", None), (None, None)])
def test_job_id(spark, url, want):
    assert one(spark, url, tx.job_id_of) == want


@pytest.mark.parametrize("text,want", [("20-30 triệu VND/tháng gross", (20e6, 30e6, "VND", "month", "gross")), ("Up to 2,000 USD", (None, 2000, "USD", None, None)), ("Thỏa thuận 1000 USD", (None, None, "USD", None, "negotiable")),
                                       ("2000-1000 usd/year net", (1000, 2000, "USD", "year", "net")), (None, (None, None, None, None, None)), ("abc", (None, None, None, None, None)), ("1.500,50 USD / 20 VND", (20, 1500.5, None, None, None))])
def test_salary(spark, text, want):
    r = one(spark, text, parsers.parse_salary)
    assert (r.minimum and float(r.minimum), r.maximum and float(r.maximum), r.currency, r.period, r.salary_type) == want


@pytest.mark.parametrize("text,want", [("2-4 years", (2, 4, "range")), ("5 - 3 years", (None, None, "invalid_range")), ("Chưa có kinh nghiệm", (0, 0, "none")), ("at least 18 months", (1.5, None, "months")), ("3+ years", (3, None, "least")), ("hơn 2,5 năm", (2.5, None, "over")), (None, (None, None, "missing")), ("?", (None, None, "unparsed"))])
def test_experience(spark, text, want):
    r = one(spark, text, parsers.parse_experience)
    assert (None if r.minimum_years is None else float(r.minimum_years), None if r.maximum_years is None else float(r.maximum_years), r.rule) == want


TAXONOMY = ["| Canonical name | Aliases | Category | Note |", "|---|---|---|---|", "| Go | Golang | Lang | x |", "| Python | python3, py | Lang | x |", "| Spring Boot | Spring | Fw | x |", "| English | tiếng Anh | Human | x |"]


@pytest.mark.parametrize("text,want", [("We go home", []), ("Go developer with Python3", ["Go", "Python"]), ("tiếng Anh giao tiếp", ["English"]), ("main.py is here", []), ("Kinh nghiệm Spring  Boot, Spring", ["Spring Boot"]), ("", []), (None, [])])
def test_skills(text, want):
    assert [m["skill"] for m in skills.Matcher(skills.read_taxonomy(TAXONOMY)).match(text)] == want


def test_taxonomy_owner():
    with pytest.raises(ValueError):
        skills.read_taxonomy([*TAXONOMY, "| Rust | golang | Lang | x |"])


@pytest.mark.parametrize("query,hits", [("python", {1, 2}), ("python -senior", {1}), ('"data engineer"', {2}), ("java or python", {1, 2, 3}), ("", {1, 2, 3}), (None, {1, 2, 3}), ("python java", set())])
def test_search(spark, query, hits):
    df = spark.createDataFrame([(1, "Python dev"), (2, "Senior Python data engineer"), (3, "Java engineer data")], "id int, t string").withColumn("a", search.lexemes(F.col("t")))
    assert {r.id for r in df.where(search.matches(query, {"a": "a"})).collect()} == hits
