import random

from pyspark.sql import functions as F

from jobweave.operators import duplicates
from jobweave.plans import registry


def test_long_chains_come_out_whole(spark):
    ids = [i for i in range(400)]
    random.Random(5).shuffle(ids)
    straight = [(1000 + i, f"s{i // 2}", f"s{(i + 1) // 2}") for i in range(400)]
    mixed = [(ids[i], f"m{i // 2}", f"m{(i + 1) // 2}") for i in range(400)]
    df = spark.createDataFrame(straight + mixed, "id int, a string, b string")
    got = {r.id: r.component for r in duplicates.connected(df, "id", [F.col("a"), F.col("b")]).collect()}
    assert got == {**{1000 + i: 1000 for i in range(400)}, **{i: 0 for i in range(400)}}


def test_same_url(spark, tmp_path):
    rows = [(1, "a", "1", "https://x.vn/tin-1", "h1"), (2, "b", "2", "HTTPS://X.vn/tin-1/", "h2"), (3, "c", "3", None, "h3"), (4, "d", "4", None, "h4")]
    spark.createDataFrame(rows, "record_index int, source string, source_job_id string, source_url string, content_hash string").write.parquet(f"{tmp_path}/job_postings_gold_template.parquet")
    got = {r.record_index: r.component for r in registry.queries()["exact_duplicate_components"](spark, str(tmp_path)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
