"""The parser queries read the columns of their tables, on long, null and mixed texts."""

from datetime import datetime

import pytest

from jobweave.plans import registry

LONG = "Chúng tôi tuyển dụng. " * 20_000
POSTINGS = [
    (1, "Công ty Cổ phần ÁCMÉ", "Quận 1, TP.HCM", "Kỹ sư Data Engineer", "hybrid", "20-30 triệu VND/tháng gross", LONG, None),
    (2, None, None, None, None, None, None, None),
    (3, LONG + "Công ty TNHH", LONG + "Đà Nẵng", LONG + "QC tester", LONG + "wfh", LONG + "1000 USD", '<div data-job-state="closed">', datetime(2026, 1, 2)),
    (4, "株式会社 Nebucore JSC", "Hà Nội / 東京", "シニア Backend Engineer 開発", "", "Thỏa thuận / negotiable", "làm việc trực tiếp", datetime(2026, 1, 1)),
    (5, "-", "\xa0", "\xa0", "remote interview, on-site", " ", "wfh", datetime(2025, 12, 31)),
]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("texts"))
    columns = "record_index int, company_name string, location_raw string, title_raw string, work_mode string, salary_raw string, description_raw string, expires_at timestamp_ntz, collected_at timestamp_ntz"
    spark.createDataFrame([(*p, datetime(2026, 1, 1)) for p in POSTINGS], columns).write.parquet(f"{d}/job_postings_gold_template.parquet")
    texts = ["2-4 years", None, LONG + "3+ years", "Tối thiểu 2 năm kinh nghiệm / 2 years", " "]
    spark.createDataFrame(list(enumerate(texts, 1)), "record_id bigint, experience_raw string").write.parquet(f"{d}/synthetic_jobs.parquet")
    return d


@pytest.mark.parametrize("name,field,want", [
    ("company_readings", "legal_form", ["Công ty Cổ phần", None, "Công ty TNHH", "JSC", None]),
    ("location_readings", "city", ["Ho Chi Minh City", None, "Da Nang", "Hanoi", None]),
    ("title_readings", "primary_category", ["Data Engineer", None, "QA/Testing", "Backend", "Unclassified"]),
    ("work_mode_readings", "value", ["HYBRID", "UNSPECIFIED", "REMOTE", "ONSITE", "REMOTE"]),
    ("salary_readings", "shape", ["range", "missing", "single_value", "negotiable", "missing"]),
    ("experience_readings", "rule", ["range", "missing", "least", "least", "missing"]),
    ("closed_state_readings", "state", ["UNKNOWN", "UNKNOWN", "CLOSED", "ACTIVE", "EXPIRED"])])
def test_readings(spark, data, name, field, want):
    rows = registry.queries()[name](spark, data)
    assert [r[field] for r in rows.orderBy(rows.columns[0]).collect()] == want
