import random

from pyspark.sql import functions as F

from jobweave.operators import units

FACTORS = [("currency", "VND", 1, 1), ("currency", "USD", 25000, 1), ("currency", "JPY", 170, 1), ("currency", "KRW", 18, 1), ("currency", "SGD", 19000, 1), ("currency", "EUR", 28000, 1), ("currency", "GBP", 33000, 1),
           ("period", "hour", 176, 1), ("period", "day", 22, 1), ("period", "week", 13, 3), ("period", "month", 1, 1), ("period", "year", 1, 12)]
CASES = [
    ("13.5-24.5 mil ₫ mỗi tháng", None, None, 13_500_000, 24_500_000), ("Từ 12 củ", "VND", "month", 12_000_000, None), ("Up to 365K vnd per hour", None, None, None, 365_000 * 176),
    ("USD 1.150 ~ 900/mo", None, None, 900 * 25000, 1150 * 25000), ("32tr5 – 42tr5", "VND", "month", 32_500_000, 42_500_000), ("１２,０００ – １５,６００", "USD", "year", 25_000_000, 32_500_000),
    ("600 US$/mo", "VND", "year", 15_000_000, 15_000_000), ("40만 KRW per month", None, None, 7_200_000, 7_200_000), ("Lương 1,000 đô Sing/tháng + lương tháng 13", None, None, 19_000_000, 19_000_000),
    ("Max 12.000 usd annually", None, None, None, 25_000_000), ("0.18 tỷ/yr", "VND", None, 15_000_000, 15_000_000), ("21'500'000 VND/ tháng (thử việc 85%)", None, None, 21_500_000, 21_500_000),
    ("10,500,000-13,500,000; 12 ngày phép", "vnd ", "Monthly", 10_500_000, 13_500_000), ("1650000 đồng một công", None, None, 36_300_000, 36_300_000), ("$650 to 550 per month", None, None, 13_750_000, 16_250_000),
]
NONE = ["Thỏa thuận", "Lương tháng 13 + thưởng", "Competitive, review 2 times/year", "Attractive package (14 months)", "Lương cơ bản + hoa hồng 5%", "", "  ", "-", None, "x" * 50_000]


def stated(spark, rows):
    df = spark.createDataFrame([(i, *r[:3], "s", "c", "r", "l", "clash") for i, r in enumerate(rows)], "id int, text string, cur string, per string, source string, category string, rank string, level string, low string")
    return units.stated_pay(df, key="id", text="text", currency="cur", period="per", source="source", category="category", rank="rank", level="level")


def test_amounts(spark):
    got = {r.key: (r.min_common, r.max_common) for r in units.to_common_units(stated(spark, CASES), FACTORS, None).collect()}
    assert [got.get(i) for i in range(len(CASES))] == [(c[3], c[4]) for c in CASES]


def test_texts_without_an_amount_and_empty_tables(spark):
    assert stated(spark, [(t, "VND", "month") for t in NONE]).collect() == []
    assert units.to_common_units(stated(spark, []), FACTORS, None).collect() == []


def test_lacking_units_are_predicted_or_reviewed(spark):
    rng = random.Random(1)
    known = []
    for _ in range(1500):
        cur = rng.choice(["VND", "USD"])
        known.append((str(round(rng.uniform(10, 40)) * (1_000_000 if cur == "VND" else 50)), cur, "month"))
    model = units.train_unit_model(stated(spark, known), trees=8, depth=4)
    assert model.accuracy["currency"] > 0.95
    got = {r.key: r for r in units.to_common_units(stated(spark, [("25000000", None, "month"), ("1200", None, "month"), ("25", "USD", None)]), FACTORS, model, sure=0.9).collect()}
    assert got[0].currency == "VND" and got[0].currency_from == "model" and got[0].min_common == 25_000_000
    assert got[1].currency == "USD" and got[2].review and got[2].min_common is None


def test_sample_is_bounded_and_stable(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    one = {r.k for r in units.training_rows(df, "k", "t", 40).collect()}
    assert len(one) == 40 and one == {r.k for r in units.training_rows(df.repartition(7), "k", "t", 40).collect()}
