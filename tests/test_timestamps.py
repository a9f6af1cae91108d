from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from jobweave.operators.timestamps import known_zones, parse_instant, source_zones

HCM = None
CASES = [
    ("2025-05-19T10:27:54", HCM, "vi-VN", False, "2025-05-19T03:27:54"), ("2025-03-08", HCM, None, False, "2025-03-07T17:00:00"),
    ("2025-03-08", HCM, None, True, "2025-03-08T16:59:59.999999"), ("2026-04-15T19:37:00+07:00", "Asia/Tokyo", None, False, "2026-04-15T12:37:00"),
    ("1760045196", None, None, False, "2025-10-09T21:26:36"), ("1775632560000", None, None, False, "2026-04-08T07:16:00"),
    ("Sun, 27 Sep 2026 19:40:25 +0200", None, None, False, "2026-09-27T17:40:25"), ("20260424T035343Z", None, None, False, "2026-04-24T03:53:43"),
    ("02/03/2025 21:11", "UTC", "en-US", False, "2025-02-03T21:11:00"), ("02/03/2025 21:11", "UTC", "vi-VN", False, "2025-03-02T21:11:00"), ("02/03/2025", "UTC", None, False, "2025-03-02T00:00:00"),
    ("2026-W32-4", "UTC", None, False, "2026-08-06T00:00:00"), ("2026-209", "UTC", None, False, "2026-07-28T00:00:00"), ("30/06/2025 15:10 (GMT+7)", None, None, False, "2025-06-30T08:10:00"),
    ("2025-04-09T22:00:02.8681633+08:00", None, None, False, "2025-04-09T14:00:02.868163"), ("2026-10-23 11:57 BST", None, None, False, "2026-10-23T10:57:00"),
    ("ngày 14 tháng 8 năm 2026 12:42", None, None, False, "2026-08-14T05:42:00"), ("2026年7月12日 23:08", "Asia/Tokyo", None, False, "2026-07-12T14:08:00"),
    ("27. Dezember 2025", "Europe/Berlin", "de-DE", False, "2025-12-26T23:00:00"), ("9:48 PM 03/20/2026", "UTC", "en-US", False, "2026-03-20T21:48:00"),
    ("\xa02026-02-27T24:00:00 ", "UTC", None, False, "2026-02-28T00:00:00"), ("2026-01-30T15:31:48+07:00[Asia/Ho_Chi_Minh]", None, None, False, "2026-01-30T08:31:48"),
    ("2025-11-02 01:30", "America/New_York", None, False, "2025-11-02T05:30:00"), ("2025-03-09 02:30", "America/New_York", None, False, "2025-03-09T07:30:00"),
    ("12:05 AM 28-07-2025", "UTC", None, False, "2025-07-28T00:05:00"), ("２０２５-03-08", "UTC", None, False, "2025-03-08T00:00:00"), ("17/09/26", "UTC", "vi-VN", False, "2026-09-17T00:00:00"),
    *[(x, "UTC", None, False, None) for x in ("", "  ", "ASAP", "hôm qua", "3 days ago", "31/02/2026", "2026-13-05", "0000-00-00", "2025-W54-1", "2025-366", "2025-01-01 25:00", "2025-01-01 13:00 PM", "2025-01-01 10:00 QQQ", "x" * 100_000)],
    (None, "UTC", None, False, None), ("2025-03-08", "No/Zone", None, False, "2025-03-07T17:00:00"),
]


def us(text):
    return text and round((datetime.fromisoformat(text).replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1e6)


def test_cases(spark):
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(CASES)], "i int, t string, z string, l string, e boolean")
    got = df.select("i", parse_instant(F.col("t"), F.col("z"), F.col("l"), F.col("e"), known_zones(spark)).alias("u")).collect()
    wrong = [(CASES[r.i], r.u, us(CASES[r.i][4])) for r in got if r.u != us(CASES[r.i][4])]
    assert not wrong


@pytest.mark.parametrize("ambiguous,skipped,want", [("earlier", "forward", ["2025-11-02T05:30:00", "2025-03-09T07:30:00"]), ("later", "null", ["2025-11-02T06:30:00", None]), ("null", "forward", [None, "2025-03-09T07:30:00"])])
def test_policies(spark, ambiguous, skipped, want):
    df = spark.createDataFrame([(0, "2025-11-02 01:30"), (1, "2025-03-09 02:30")], "i int, t string")
    u = parse_instant(F.col("t"), F.lit("America/New_York"), F.lit(None).cast("string"), False, known_zones(spark), ambiguous=ambiguous, skipped=skipped)
    assert [r.u for r in df.select("i", u.alias("u")).orderBy("i").collect()] == [us(w) for w in want]


def test_empty_table(spark):
    df = spark.createDataFrame([], "t string")
    assert df.select(parse_instant(F.col("t"), F.lit(None).cast("string"), F.lit(None).cast("string"), False, known_zones(spark))).collect() == []


def test_zone_by_source(spark):
    rows = [("a", "Asia/Tokyo"), ("a", "Asia/Tokyo"), ("a", "UTC"), ("b", "No/Zone"), ("b", None), (None, "UTC"), ("c", "UTC"), ("c", "Europe/Berlin")]
    df = spark.createDataFrame(rows, "source string, zone string")
    got = {(r.source, r.zone, r.rows) for r in source_zones(df, F.col("source"), F.col("zone"), known_zones(spark)).collect()}
    assert got == {("a", "Asia/Tokyo", 2), ("c", "Europe/Berlin", 1)}
    texts = spark.createDataFrame([(0, None, "Asia/Tokyo"), (1, "UTC", "Asia/Tokyo"), (2, None, None), (3, "No/Zone", "Asia/Tokyo")], "i int, z string, sz string")
    u = parse_instant(F.lit("2025-03-08 12:00"), F.col("z"), F.lit(None).cast("string"), False, known_zones(spark), source_zone=F.col("sz"))
    assert [r.u for r in texts.select("i", u.alias("u")).orderBy("i").collect()] == [us(x) for x in ("2025-03-08T03:00:00", "2025-03-08T12:00:00", "2025-03-08T05:00:00", "2025-03-08T03:00:00")]
