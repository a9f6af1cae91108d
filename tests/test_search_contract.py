"""All parameters of the search contract on a small set of cards."""

from datetime import datetime
from decimal import Decimal

import pytest

from jobweave.plans.read_queries import InvalidParameter
from jobweave.plans.serving_queries import get_job_v1, search_jobs_v1
from jobweave.operators.search import lexemes
from pyspark.sql import functions as F

CARDS = [
    (1, "s1", "Backend Engineer", "Acme", "Hà Nội", "full_time", "senior", "remote", "active", ["Python"], datetime(2026, 1, 3)),
    (2, "s2", "Data Engineer", "Acme", "Huế", "full_time", "junior", "onsite", "active", ["SQL", "Python"], datetime(2026, 1, 5)),
    (3, "s1", "QA tester", "Beta", None, "contract", "senior", "hybrid", "closed", None, datetime(2026, 1, 4)),
    (4, "s1", "Data Engineer", None, "Huế", None, None, None, "active", [], None),
]
OFFERS = [
    (1, 1, "VND", "month", "gross", "base_salary", Decimal(20), Decimal(30), None, True), (2, 1, None, "month", "net", "bonus", None, None, Decimal(5), True),
    (3, 2, "VND", "month", "net", "base_salary", None, None, Decimal(50), True), (4, 4, "VND", "month", "net", "base_salary", Decimal(10), None, None, False),
]


@pytest.fixture(scope="module")
def data(spark):
    columns = "record_index int, source string, title_raw string, company_name string, location_raw string, employment_type string, seniority string, work_mode string, status string, skills_raw array<string>, posted_at timestamp_ntz"
    cards = spark.createDataFrame(CARDS, columns).withColumns({
        "source_url": F.lit("u"), "source_job_id": F.lit("j"), "title_normalized": F.lit(None).cast("string"), "excerpt": F.lit("x"), "expires_at": F.lit(None).cast("timestamp"), "first_seen_at": F.lit(None).cast("timestamp"),
        "last_seen_at": F.lit(None).cast("timestamp"), "collected_at": F.lit(None).cast("timestamp"), "salary_disclosed": F.lit(True),
        "a": lexemes(F.col("title_raw")), "b": lexemes(F.array_join("skills_raw", " ")), "c": lexemes(F.concat_ws(" ", "company_name", "location_raw")), "d": lexemes(F.lit(None).cast("string"))})
    offers = spark.createDataFrame(OFFERS, "id bigint, record_index int, currency string, period string, tax_basis string, compensation_type string, amount_min decimal(20,2), amount_max decimal(20,2), amount_exact decimal(20,2), is_disclosed boolean")
    return cards, offers


@pytest.mark.parametrize("asked,want", [
    ({}, [2, 1, 4]), ({"statuses": None}, [2, 3, 1, 4]), ({"text": "engineer"}, [2, 1, 4]), ({"text": "data -acme"}, [4]), ({"sources": ["s1"]}, [1, 4]), ({"companies": ["Acme"]}, [2, 1]), ({"locations": ["Huế"]}, [2, 4]),
    ({"occupations": ["Data Engineer"]}, [2, 4]), ({"skills": ["SQL"]}, [2]), ({"employment_types": ["full_time"]}, [2, 1]), ({"seniority_levels": ["junior"]}, [2]), ({"work_modes": ["remote", "hybrid"]}, [1]),
    ({"posted_after": "2026-01-04"}, [2]), ({"sort": "oldest"}, [1, 2, 4]), ({"limit": 1, "offset": 1}, [1]), ({"salary_currency": "VND"}, [2, 1]), ({"salary_tax_basis": "net"}, [2, 1]), ({"salary_period": "year"}, []),
    ({"salary_currency": "VND", "salary_period": "month", "salary_min": 31}, [2]), ({"salary_currency": "VND", "salary_period": "month", "salary_max": 49}, [1]), ({"text": "  "}, [2, 1, 4])])
def test_filters(data, asked, want):
    got = search_jobs_v1(*data, **asked).collect()
    assert [r.record_index for r in got] == want and all(r.total_count >= len(want) for r in got)


def test_offers_of_a_card(data):
    got = {r.record_index: r.salary_offers_json for r in search_jobs_v1(*data).collect()}
    assert got[1].index('"gross"') < got[1].index('"bonus"') and '"currency":null' in got[1] and '"amount_min":20.00' in got[1]
    one = get_job_v1(*data, 3).collect()
    assert len(one) == 1 and one[0].salary_offers_json == "[]" and one[0].skills_json == "[]" and get_job_v1(*data, 99).collect() == []


@pytest.mark.parametrize("bad", [
    {"limit": 0}, {"limit": 51}, {"limit": None}, {"offset": -1}, {"offset": 1001}, {"sort": "salary"}, {"text": "x" * 501}, {"sources": ["a"] * 101}, {"skills": [None]}, {"statuses": [None]}, {"salary_min": -1}, {"salary_max": -1},
    {"salary_currency": "VND", "salary_period": "month", "salary_min": 2, "salary_max": 1}, {"salary_min": 1}, {"salary_max": 1, "salary_currency": "VND"}])
def test_rejected(data, bad):
    with pytest.raises(InvalidParameter) as e:
        search_jobs_v1(*data, **bad)
    assert e.value.sqlstate == "22023"
