from pyspark.sql import functions as F

from jobweave.plans import registry


def test_jaccard_of_every_posting(spark, tmp_path):
    rows = [(1, "Sản xuất", "SAN XUAT"), (2, "Giáo dục 4.0", "giao duc 4"), (3, "東京", "東京"), (4, None, "mid"), (5, "", None), (6, "Straße", "strasse")]
    spark.createDataFrame(rows, "record_index int, company_industry string, seniority string").write.parquet(f"{tmp_path}/job_postings_gold_template.parquet")
    got = {r.record_index: r.share for r in registry.queries()["tokenize_jaccard_all"](spark, str(tmp_path)).select("record_index", F.col("share")).collect()}
    assert got == {1: 1.0, 2: 0.75, 3: 1.0, 4: 0.0, 5: 0.0, 6: 1.0}
