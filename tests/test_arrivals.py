from datetime import datetime

from jobweave.plans import registry

BEFORE, SINCE = datetime(2026, 3, 1), datetime(2026, 4, 1)


def test_every_key_by_time_of_arrival(spark, tmp_path):
    rows = [(0, "s", "kept", "A", BEFORE, "h"), (1, "s", "new", "B", SINCE, "h"), (2, "s", "same", "A", SINCE, "h"), (3, "s", "same", "C", BEFORE, "h"), (6, "s", "other", "C", SINCE, "h2"), (9, "s", "other", "C", BEFORE, "h"), (12, "s", "undated", "B", None, None)]
    spark.createDataFrame(rows, "record_index int, source string, source_job_id string, company_name string, collected_at timestamp_ntz, content_hash string").write.parquet(f"{tmp_path}/job_postings_gold_template.parquet")
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert {r.action: r.n for r in run("import_arrival_actions")} == {"kept": 1, "inserted": 2, "skipped": 1, "updated": 1}
    assert {(r.company_name, r.postings, r.kept_key) for r in run("dim_upsert_arrivals")} == {("A", 2, True), ("B", 2, False), ("C", 3, True)}
