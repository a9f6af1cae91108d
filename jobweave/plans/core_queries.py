"""Queries of the general data problems: histories, instants and common units, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.operators import history, timestamps, units
from jobweave.operators.lookup import lookup_join
from jobweave.session import checkpointed, small_table, table

STATE = ["closed_state"]


def closed_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints and patches of every posting's closed state."""
    pages = table(spark, sf_dir, "topdev_pilot_diagnostic")
    state = F.upper(F.regexp_replace("closed_state", r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    told = pages.select("extracted_source_job_id", state.alias("closed_state"), "fetched_at", "ingested_at", "snapshot_id").where("closed_state <> ''")
    return history.delta_store(told, "extracted_source_job_id", "fetched_at", ["ingested_at", "snapshot_id"], STATE)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.versions(closed_state_store(spark, sf_dir), STATE, with_end=False)
    return rows.select(F.col("key").alias("extracted_source_job_id"), "closed_state", F.unix_micros(F.col("valid_from").cast("timestamp")).alias("valid_from_us"))


def p2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.versions(closed_state_store(spark, sf_dir), STATE)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return rows.select(
        F.col("key").alias("extracted_source_job_id"), "closed_state", us("valid_from").alias("valid_from_us"),
        us("valid_to").alias("valid_to_us"), F.col("valid_to").isNull().alias("is_current"),
    )


def p2_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting's state at the end of March 2026."""
    at = F.lit("2026-03-31 23:59:59.999999").cast("timestamp_ntz")
    rows = history.as_of(closed_state_store(spark, sf_dir), STATE, at)
    return rows.select(F.col("key").alias("extracted_source_job_id"), "closed_state")


def _instants(spark: SparkSession, pages: DataFrame, source_zone: Column | None) -> DataFrame:
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("dateposted", "validthrough")])
    kept = ["page_id", "page_timezone", "page_locale"] + (["source_zone"] if source_zone is not None else [])
    rows = pages.select(*kept, F.explode(fields).alias("f")).where("f.text IS NOT NULL")
    instant = timestamps.parse_instant(
        F.col("f.text"), F.col("page_timezone"), F.col("page_locale"), F.col("f.field_name") == "validthrough", timestamps.known_zones(spark), source_zone=source_zone)
    return rows.select("page_id", "f.field_name", instant.alias("instant_us")).where("instant_us IS NOT NULL")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup of every source is the one default here, as the table's description has it."""
    return _instants(spark, table(spark, sf_dir, "job_jsonld_pages"), None)


_PAY_COLUMNS = {
    "key": "record_index", "text": "salary_raw", "currency": "salary_currency", "period": "salary_period",
    "source": "source", "category": "company_industry", "rank": "seniority", "level": "city",
}


def monthly_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated pay of every posting in VND per month, by factors of unit_factors and, for missing units, the trained model."""
    jobs = table(spark, sf_dir, "job_postings_gold_template").select(*_PAY_COLUMNS.values())
    factors = [tuple(r) for r in small_table(table(spark, sf_dir, "unit_factors").select("unit_kind", "unit_code", "numerator", "denominator"), 1_000)]
    model = units.train_unit_model(units.stated_pay(units.training_rows(jobs, "record_index", "salary_raw"), **_PAY_COLUMNS))
    return units.to_common_units(units.stated_pay(jobs.where(F.col("salary_raw").rlike(r"[\d０-９]")), **_PAY_COLUMNS), factors, model)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = lambda c: F.coalesce(F.round(F.col(c), 0).cast("bigint"), F.lit(-1).cast("bigint"))
    rows = monthly_pay(spark, sf_dir).where("NOT review")
    return rows.select(F.col("key").alias("record_index"), whole("min_common").alias("min_vnd_month"), whole("max_common").alias("max_vnd_month"))


def p6_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts whose unit is neither stated nor guessed with confidence, with the best guess."""
    rows = monthly_pay(spark, sf_dir).where("review")
    return rows.select(F.col("key").alias("record_index"), "low", "high", "currency", "period", "currency_guess", "currency_sure", "period_guess", "period_sure")


def p6_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit model on all postings it was not trained on (a fifth by hash of their id), whose stated units are hidden from it."""
    jobs = table(spark, sf_dir, "job_postings_gold_template").select(*_PAY_COLUMNS.values())
    held = F.pmod(F.xxhash64(F.lit(3), "record_index"), F.lit(5)) == 0
    model = units.train_unit_model(units.stated_pay(units.training_rows(jobs.where(~held), "record_index", "salary_raw"), **_PAY_COLUMNS))
    return units.model_quality(units.stated_pay(jobs.where(held), **_PAY_COLUMNS), model)


def _host():
    return F.nullif(F.lower(F.regexp_extract("source_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))


def p4_source_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone that most pages of each host state: the lookup for pages that state none."""
    pages = table(spark, sf_dir, "job_jsonld_pages")
    return timestamps.source_zones(pages, _host(), F.col("page_timezone"), timestamps.known_zones(spark))


def p4_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instants where a page without a zone takes its host's instead of the one default that p4_found is told to use."""
    pages = table(spark, sf_dir, "job_jsonld_pages").withColumn("source", _host())
    zones = p4_source_zones(spark, sf_dir).select("source", F.col("zone").alias("source_zone"), F.col("rows").alias("times"))
    zoned = lookup_join(pages, checkpointed(zones), ["source"], F.octet_length("source") + F.octet_length("source_zone") + 48, ["page_id"])
    return _instants(spark, zoned, F.col("source_zone"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found, "p2_history": p2_history, "p2_state_as_of": p2_state_as_of,
    "p4_found": p4_found, "p4_source_zones": p4_source_zones, "p4_by_source": p4_by_source, "p6_found": p6_found, "p6_review": p6_review, "p6_model": p6_model,
}

_VERSIONS = r"""
WITH told AS (
  SELECT extracted_source_job_id AS job, upper(regexp_replace(closed_state, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS state,
         epoch_us(fetched_at) AS t_us, ingested_at, snapshot_id
  FROM topdev_pilot_diagnostic WHERE extracted_source_job_id IS NOT NULL AND closed_state IS NOT NULL AND fetched_at IS NOT NULL),
one AS (
  SELECT job, t_us, state FROM told WHERE state <> ''
  QUALIFY row_number() OVER (PARTITION BY job, t_us ORDER BY ingested_at DESC NULLS LAST, snapshot_id DESC) = 1),
moves AS (
  SELECT job, state, t_us FROM one WINDOW w AS (PARTITION BY job ORDER BY t_us) QUALIFY lag(state) OVER w IS NULL OR lag(state) OVER w <> state)
"""
ORACLE: dict[str, str] = {
    "p4_source_zones": r"""WITH s AS (SELECT nullif(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '') AS source, page_timezone AS zone FROM job_jsonld_pages),
c AS (SELECT source, zone, count(*) AS n FROM s WHERE source IS NOT NULL AND zone IN (SELECT name FROM pg_timezone_names()) GROUP BY source, zone)
SELECT source, zone, n AS rows, round(n::DOUBLE / sum(n) OVER (PARTITION BY source), 4) AS share FROM c QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, zone) = 1""",
    "p2_found": _VERSIONS + "SELECT job AS extracted_source_job_id, state AS closed_state, t_us AS valid_from_us FROM moves",
    "p2_history": _VERSIONS + """, ends AS (SELECT *, lead(t_us) OVER (PARTITION BY job ORDER BY t_us) AS till FROM moves)
SELECT job AS extracted_source_job_id, state AS closed_state, t_us AS valid_from_us, till AS valid_to_us, till IS NULL AS is_current FROM ends""",
    "p2_state_as_of": _VERSIONS + """SELECT job AS extracted_source_job_id, max_by(state, t_us) AS closed_state FROM moves
WHERE t_us <= epoch_us(TIMESTAMP '2026-03-31 23:59:59.999999') GROUP BY job""",
}
