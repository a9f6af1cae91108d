from jobweave.plans import registry


def test_all_four_classes(spark, tmp_path):
    rows = [(1, "Python Engineer", "Acme", "Hà Nội", [], "x"), (2, "Developer", "Engineer Corp", "Hà Nội", None, "we use Python"), (3, "Developer", None, None, ["Python"], "w " * 5_000 + "an engineer"),
            (4, "Python Engineer", "Acme", None, [], "w " * 5_000 + "senior"), (5, "Python dev", "Acme", "Senior Park", [], "engineer"), (6, "Developer", "Acme", "x", ["Python"], None)]
    docs = [(i, "s", str(i), t, c, p, k, e, None, None, None, True, None) for i, t, c, p, k, e in rows]
    spark.createDataFrame(docs, "record_index int, source string, source_job_id string, title_raw string, company_name string, location_raw string, skills_raw array<string>, description_raw string, work_mode string, employment_type string, posted_at timestamp_ntz, is_active boolean, last_seen_at timestamp_ntz").write.parquet(
        f"{tmp_path}/job_postings_gold_template.parquet")
    got = registry.queries()["search_jobs_fulltext"](spark, str(tmp_path)).collect()
    assert [(r.record_index, r.score, r.total_count) for r in got] == [(1, 2.0, 3), (3, 0.5, 3), (2, 0.3, 3)]
