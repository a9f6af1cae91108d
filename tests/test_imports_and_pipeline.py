"""Imports that write, the pipeline from file to report, character references."""

import json

import pytest
from pyspark.sql import functions as F

from jobweave.functions.text import html_to_text, unescaped
from jobweave.operators import pipeline
from jobweave.sources import versions


def acted(df):
    return {r.action: r.n for r in df.collect()}


def test_importing_twice_changes_nothing(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "source string, id string, at int, title string, tags array<string>")
    path = str(tmp_path / "t")
    first = frame([("s", "1", 1, "old", ["a"]), ("s", "1", 2, "new", ["a"]), ("s", "2", 1, "x", None), (None, "3", 1, "y", None)])
    assert versions.current(spark, path) is None
    assert acted(versions.upsert(first, path, ["source", "id"], ["at"])) == {"inserted": 2}
    assert acted(versions.upsert(first, path, ["source", "id"], ["at"])) == {"skipped": 2}
    assert sorted((r.id, r.title) for r in versions.current(spark, path).collect()) == [("1", "new"), ("2", "x")]
    more = frame([("s", "2", 1, "x", ["b"]), ("s", "4", 1, "z", [])])
    assert acted(versions.upsert(more, path, ["source", "id"], ["at"])) == {"kept": 1, "updated": 1, "inserted": 1}
    assert acted(versions.upsert(more, path, ["source", "id"], ["at"], delete_missing=True)) == {"deleted": 1, "skipped": 2}
    assert sorted(r.id for r in versions.current(spark, path).collect()) == ["2", "4"]
    assert acted(versions.upsert(more.limit(0), path, ["source", "id"], ["at"])) == {"kept": 2}


def test_pipeline_from_file_to_report(spark, tmp_path):
    rows = [
        {"source": "a", "source_job_id": "1", "source_url": "https://x/jobs/1", "title_raw": "Data Engineer", "salary_raw": "1000 USD/month", "skills_raw": ["Python"], "description_raw": "hybrid", "company_name_raw": "Acme JSC"},
        {"source": "a", "source_job_id": " ", "source_url": "ftp://x", "title_raw": "QA tester"}, {"source": "b", "source_job_id": "2", "source_url": "https://x/jobs/2", "title_raw": "Bảo vệ"}, {"source": "a"}]
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n", encoding="utf-8")
    out = str(tmp_path / "out")
    told = {r.measure: (r.eligible, r.reached) for r in pipeline.run(spark, str(source), out, [("Python", (), "language")], source="a").collect()}
    assert told["accepted"] == (3, 1)
    accepted = [json.loads(r.value) for r in spark.read.text(f"{out}/accepted").collect()]
    assert len(accepted) == 1 and accepted[0]["company"]["legal_form"] == "JSC" and accepted[0]["work_mode"]["value"] == "HYBRID" and accepted[0]["skills"][0]["skill"] == "Python"
    codes = {i["code"] for r in spark.read.text(f"{out}/rejected").collect() for i in json.loads(r.value)["issues"]}
    assert {"required_missing_source_job_id", "url_malformed", "required_missing_title_raw"} <= codes
    assert {r.measure: r.eligible for r in pipeline.run(spark, str(source), out, [], max_records=2).collect()}["accepted"] == 2


@pytest.mark.parametrize("text,want", [("a &amp;lt; b", "a &lt; b"), ("&eacute;&#233;&#xE9;", "ééé"), ("&nosuch; &amp", "&nosuch; &amp"), ("&#0; x", "� x"), ("", ""), (None, None), ("&lt;p&gt;", "<p>"), ("x" * 50_000 + "&quot;", "x" * 50_000 + '"')])
def test_character_references(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(unescaped(F.col("t"))).first()[0] == want
    assert df.select(html_to_text(F.lit("<p>R&amp;D &ndash; x</p>"))).first()[0] == "R&D – x"
