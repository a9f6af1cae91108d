"""From raw postings to normalised records in one pass, and reports over them.

``normalise`` adds a struct per field reading, a provenance map and the issues of the reading;
``enrich`` adds company, place, employment and work mode; ``report`` measures what was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.functions.text import is_web_url
from jobweave.operators import parsers, skills
from jobweave.session import checkpointed
from jobweave.sources import jsonl

RECORD = ["source", "source_job_id", "source_url", "title_raw", "company_name_raw", "location_raw", "employment_type_raw", "salary_raw", "experience_raw", "description_raw", "posted_at_raw", "collected_at"]

RULE_VERSIONS = {"title": "title.1", "salary": "salary.1", "experience": "experience.1", "skills": "skills.1"}


def _issue(when: Column, field: str, code: str, severity: str) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(severity).alias("severity")))


def normalise(df: DataFrame, taxonomy: Sequence[tuple[str, Sequence[str], str]]) -> DataFrame:
    """``df`` (title_raw, salary_raw, experience_raw, skills_raw, description_raw) with title, salary, experience, skills, provenance, issues.

    Skills come from the source's own list where there is one, even an empty one, else from the description.
    """
    rows = df.withColumns({
        "title": F.struct(parsers.display_title(F.col("title_raw")).alias("display"), parsers.classify_title(F.col("title_raw")).alias("category")),
        "salary": parsers.parse_salary(F.col("salary_raw")), "experience": parsers.parse_experience(F.col("experience_raw")),
        "_skill_text": F.coalesce(F.array_join("skills_raw", "\n"), F.col("description_raw")),
    })
    rows = skills.match_skills(rows, "_skill_text", taxonomy).drop("_skill_text")
    from_list = F.when(F.col("skills_raw").isNotNull(), "skills_raw").otherwise("description_raw")
    least = F.coalesce(F.array_min(F.transform("skills", lambda s: s["confidence"])), F.lit(1.0))

    def origin(field: Column, rule: str, sure: Column) -> Column:
        return F.struct(field.alias("source_field"), F.lit(rule).alias("rule_version"), sure.alias("confidence"))

    provenance = F.create_map(
        F.lit("title"), origin(F.lit("title_raw"), RULE_VERSIONS["title"], F.coalesce("title.category.confidence", F.lit(0.0))), F.lit("salary"), origin(F.lit("salary_raw"), RULE_VERSIONS["salary"], F.col("salary.confidence")),
        F.lit("experience"), origin(F.lit("experience_raw"), RULE_VERSIONS["experience"], F.col("experience.confidence")), F.lit("skills"), origin(from_list, RULE_VERSIONS["skills"], least))
    found = F.array(
        _issue((F.coalesce("salary_raw", F.lit("")) != "") & (F.col("salary.confidence") == 0), "salary", "salary_unparsed", "WARNING"),
        _issue(F.col("salary.disclosed") & F.col("salary.currency").isNull(), "salary.currency", "currency_missing_or_ambiguous", "WARNING"),
        _issue((F.coalesce("experience_raw", F.lit("")) != "") & (F.col("experience.confidence") == 0), "experience", "experience_unparsed", "WARNING"),
        _issue(F.coalesce("title.category.primary_category", F.lit("Unclassified")) == "Unclassified", "title", "title_unclassified", "INFO"))
    return rows.withColumns({"provenance": provenance, "issues": F.filter(found, lambda x: x.isNotNull())})


def enrich(df: DataFrame, company: str | None = None, location: str | None = None, employment: str | None = None, aliases: dict[str, str] | None = None) -> DataFrame:
    """``df`` with company, location, employment and work_mode; columns that a source lacks are None. Work mode is read from the description."""
    col = lambda c: F.col(c) if c else F.lit(None).cast("string")
    return df.withColumns({
        "company": parsers.normalise_company(col(company), aliases), "location": parsers.normalise_location(col(location)),
        "employment": parsers.employment_type(col(employment), F.col("title_raw")), "work_mode": parsers.work_mode(F.lit(None).cast("string"), F.col("description_raw")),
    })


REPORTED = ["title_raw", "salary_raw", "experience_raw", "skills_raw", "description_raw"]


def report(records: DataFrame) -> DataFrame:
    """(measure, eligible, reached, rate): field coverage and success of the readings, in one pass over ``normalise``'s output."""
    eligible: dict[str, tuple[Column, Column]] = {f"coverage:{c}": (F.lit(True), F.col(c).isNotNull() & (F.col(c).cast("string") != "")) for c in REPORTED}
    eligible |= {
        "success:salary": (F.col("salary_raw").isNotNull(), (F.col("salary.confidence") > 0) & (F.col("salary.disclosed") | (F.coalesce("salary.salary_type", F.lit("")) == "negotiable"))),
        "success:experience": (F.col("experience_raw").isNotNull(), F.col("experience.confidence") > 0), "success:skills": (F.lit(True), F.size("skills") > 0),
        "success:title": (F.lit(True), F.col("title.category.primary_category") != "Unclassified"),
    }
    counts = [F.struct(F.lit(m).alias("measure"), F.count_if(a).alias("eligible"), F.count_if(a & F.coalesce(b, F.lit(False))).alias("reached")) for m, (a, b) in eligible.items()]
    rows = records.agg(F.array(*counts).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    return rows.withColumn("rate", F.round(F.col("reached") / F.nullif(F.col("eligible"), F.lit(0)), 4))


def run(spark: SparkSession, path: str, out: str, taxonomy: Sequence[tuple[str, Sequence[str], str]], source: str | None = None, max_records: int | None = None, strict: bool = False) -> DataFrame:
    """The offline pipeline: strict JSON Lines under ``path`` to accepted, rejected, profile and report under ``out``; returns the report.

    ``source`` keeps one source; ``max_records`` is the caller's limit, the first records by file and line.
    Records are rejected for what is missing that every record must have, if ``strict`` also for errors.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RECORD] + [T.StructField("skills_raw", T.ArrayType(T.StringType()))])
    lines = jsonl.read_jsonl(spark, path, schema)
    if source is not None:
        lines = lines.where(F.col("record.source") == source)
    if max_records is not None:
        lines = lines.orderBy("file", "line_no").limit(max_records)
    read = enrich(normalise(lines.select("file", "line_no", "record.*"), taxonomy), company="company_name_raw", location="location_raw", employment="employment_type_raw")
    missing = F.array(*[_issue(F.coalesce(F.trim(c), F.lit("")) == "", c, f"required_missing_{c}", "REJECT") for c in ("source", "source_job_id", "source_url", "title_raw")])
    bad_url = _issue(~is_web_url(F.col("source_url")), "source_url", "url_malformed", "REJECT")
    records = checkpointed(read.withColumn("issues", F.filter(F.concat("issues", missing, F.array(bad_url)), lambda x: x.isNotNull())))
    rejected = F.exists("issues", lambda i: i["severity"].isin("ERROR", "REJECT") if strict else i["severity"] == "REJECT")
    jsonl.write_jsonl(records.where(~rejected), f"{out}/accepted", mode="overwrite")
    jsonl.write_jsonl(records.where(rejected), f"{out}/rejected", mode="overwrite")
    issues = records.select(F.explode("issues").alias("i")).groupBy("i.code", "i.severity").agg(F.count(F.lit(1)).alias("n"))
    jsonl.write_jsonl(issues, f"{out}/profile", mode="overwrite")
    counts = records.agg(F.count(F.lit(1)).alias("eligible"), F.count_if(~rejected).alias("reached"))
    told = report(records).unionByName(counts.select(F.lit("accepted").alias("measure"), "eligible", "reached", F.round(F.col("reached") / F.nullif(F.col("eligible"), F.lit(0)), 4).alias("rate")))
    jsonl.write_jsonl(told, f"{out}/report", mode="overwrite")
    return told
