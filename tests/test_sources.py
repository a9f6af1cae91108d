import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.sources import jsonl, pages
from jobweave.streaming import daily

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_strict_jsonl(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"a": 1, "b": "x"}\n\n{"a": 2}\n', encoding="utf-8")
    assert [(r.line_no, r.record.a, r.record.b) for r in jsonl.read_jsonl(spark, str(good), SCHEMA).orderBy("line_no").collect()] == [(1, 1, "x"), (3, 2, None)]
    for bad in ("[1]", "{", "3", "null"):
        (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\n' + bad + "\n", encoding="utf-8")
        with pytest.raises(jsonl.JsonlParseError, match="bad.jsonl:3"):
            jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), SCHEMA)


def test_line_numbers_over_splits(spark, tmp_path):
    (tmp_path / "long.jsonl").write_text("".join(f'{{"a": {i}}}\n' for i in range(1, 3001)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = jsonl.read_jsonl(spark, str(tmp_path / "long.jsonl"), SCHEMA)
        assert rows.where("line_no <> record.a").isEmpty() and rows.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_jsonl_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "b string, a string")
    jsonl.write_jsonl(df, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"a":null,"b":"é"}']
    jsonl.write_report(str(tmp_path / "r.json"), {"b": 1, "a": "é"})
    assert (tmp_path / "r.json").read_text(encoding="utf-8") == '{\n  "a": "é",\n  "b": 1\n}\n' and sorted(os.listdir(tmp_path)) == ["out", "r.json"]


def test_postings_and_links(spark):
    html = ('<a href="/viec-lam/x-12?q=1">a</a><a class=k href="https://evil.test/y-9">b</a><script type="application/ld+json">[{"@type": "JobPosting", "title": " Dev ", "skills": "Java, Go",'
            ' "baseSalary": {"currency": "USD", "value": {"minValue": 1, "maxValue": 2, "unitText": "MONTH"}}, "jobLocation": {"address": {"addressLocality": "Hà Nội", "addressRegion": "Hà Nội"}}}, {"@type": "Thing"}]</script><script type="application/ld+json">{oops</script>')
    df = spark.createDataFrame([(1, "https://jobs.test/list", html), (2, "https://jobs.test/", None)], "id int, url string, html string")
    r = pages.posting_fields(pages.postings(df, "id", "html"), "id").collect()
    assert [(x.id, x.title_raw, x.skills_raw, x.salary_raw, x.location_raw, x.experience_raw) for x in r] == [(1, "Dev", ["Java", "Go"], "1-2 USD/month", "Hà Nội", None)]
    assert [(x.url, x.job_id) for x in pages.listing_links(df, "html", "url", ["jobs.test"]).collect()] == [("https://jobs.test/viec-lam/x-12", "12")]


def test_scope(spark):
    df = spark.createDataFrame([("it_listing_html:1", None, ["Python"], "x"), ("it_listing_html:1", "Finance", None, "x"), ("other", None, None, "x"), ("it_listing_html:2", None, ["Sales"], "x"), ("it_listing_html:2", None, None, "Nhân viên hạ tầng CNTT"), (None, None, None, None)],
                               "d string, c string, t array<string>, n string")
    v = pages.scope_decision(F.col("d"), F.col("c"), F.col("t"), F.col("n"), F.lit(None).cast("string"))
    assert [(r.v.accepted, r.v.reason) for r in df.select(v.alias("v")).collect()] == [(True, None), (False, "source_category_non_it"), (False, "invalid_discovery_method"), (False, "source_tags_non_it"), (True, None), (False, "invalid_discovery_method")]


def test_stream_refreshes_touched_days(spark, tmp_path):
    schema = "observation_id int, observed_at timestamp, state string"
    source, out = tmp_path / "in", str(tmp_path / "out")
    for rows in ([(1, "2026-01-01 10:00:00", "A"), (2, "2026-01-02 10:00:00", "A")], [(3, "2026-01-01 23:00:00", "B"), (1, "2026-01-01 10:00:00", "A")]):
        spark.createDataFrame(rows, "observation_id int, observed_at string, state string").withColumn("observed_at", F.to_timestamp("observed_at")).coalesce(1).write.mode("append").parquet(str(source))
        stream = daily.distinct_observations(spark.readStream.schema(schema).parquet(str(source)), ["observation_id"])
        daily.refresh_days(stream, out, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((str(r.day), r.state, r.n) for r in spark.read.parquet(out + "/daily").collect())
    assert got == [("2026-01-01", "A", 1), ("2026-01-01", "B", 1), ("2026-01-02", "A", 1)]
