"""Pages, skills in text and streams, as queries; where SQL cannot say them they are tested on fixtures."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.operators import pipeline, skills, timestamps
from jobweave.operators.parsers import classify_title
from jobweave.plans.warehouse_queries import observations
from jobweave.session import small_table, table
from jobweave.sources import pages
from jobweave.streaming import daily

QUERIES, ORACLE = {}, {}


def query(sql=None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query()
def pages_expired(spark, d):
    """The state of every page at its fetch, by the expiry it names."""
    p = table(spark, d, "job_jsonld_pages")
    expires = timestamps.parse_instant(F.col("validthrough"), F.col("page_timezone"), F.col("page_locale"), True, timestamps.known_zones(spark))
    return p.select("page_id", pages.closed_state(F.lit(None).cast("string"), expires, F.unix_micros(F.col("fetched_at").cast("timestamp"))).alias("s")).select("page_id", "s.*")


_TAGS = "lower(coalesce(array_to_string(source_tags, ' | '), ''))"
_SKILL_NAMES = "(SELECT list(DISTINCT lower(n)) FROM (SELECT unnest(list_concat([canonical_name], coalesce(aliases, []))) AS n FROM ref_items WHERE kind = 'skill') WHERE n <> '')"


@query(f"""WITH p AS (SELECT snapshot_id, discovery_method, source_category_raw AS category, coalesce(array_to_string(source_tags, ' | '), '') AS tags, title_raw AS title, normalized_primary_category AS classified,
  list_has_any(list_transform(coalesce(source_tags, []), lambda x: lower(trim(x, ' '))), {_SKILL_NAMES}) AS skilled FROM topdev_pilot_diagnostic),
m AS (SELECT *, regexp_matches(tags, '{pages.TECHNICAL_TAG.replace("(?iU)", "(?i)")}') AS tech, regexp_matches(tags, '{pages.NON_IT_TAG.replace("(?iU)", "(?i)")}') AS other FROM p),
r AS (SELECT snapshot_id, CASE WHEN NOT coalesce(starts_with(discovery_method, 'it_listing_html'), false) THEN 'invalid_discovery_method'
  WHEN category IS NOT NULL AND lower(trim(category, ' ')) NOT IN ('information technology', 'công nghệ thông tin') THEN 'source_category_non_it' WHEN other AND NOT tech THEN 'source_tags_non_it' WHEN tech THEN NULL
  WHEN coalesce(classified, 'Unclassified') <> 'Unclassified' OR coalesce(skilled, false) THEN NULL WHEN coalesce(regexp_matches(title, '{pages.IT_TITLE.replace("(?iU)", "(?i)")}'), false) THEN NULL ELSE 'insufficient_it_evidence' END AS reason FROM m)
SELECT snapshot_id, reason IS NULL AS accepted, reason FROM r""")
def scope_decision(spark, d):
    """Whether each delivered page is of information technology: its tags, its category, its skills (tags that the reference list has) and its title."""
    names = sorted({n.lower() for name, aliases, _ in taxonomy_of(spark, d) for n in (name, *aliases)})  # of a fixed list
    p = table(spark, d, "topdev_pilot_diagnostic")
    skills_of = F.array_intersect(F.transform("source_tags", lambda x: F.lower(F.trim(x))), F.from_json(F.lit(json.dumps(names)), "array<string>"))
    verdict = pages.scope_decision(F.col("discovery_method"), F.col("source_category_raw"), F.col("source_tags"), F.col("title_raw"), F.col("normalized_primary_category"), skills_of)
    return p.select("snapshot_id", verdict.alias("v")).select("snapshot_id", "v.*")


def posting_block() -> Column:
    """The html of a page of ``job_jsonld_pages``: all its schema.org fields in one JSON-LD block; what is null is left out."""
    given = lambda c, block: F.when(F.col(c).isNotNull(), block)
    body = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), "title", F.col("dateposted").alias("datePosted"), F.col("validthrough").alias("validThrough"), F.col("employmenttype").alias("employmentType"), "skills", "identifier",
        given("hiringorganization", F.struct(F.col("hiringorganization.name").alias("name"))).alias("hiringOrganization"),
        given("basesalary", F.struct(F.col("basesalary.currency").alias("currency"), F.struct(F.col("basesalary.amount").alias("value"), F.col("basesalary.unittext").alias("unitText")).alias("value"))).alias("baseSalary"),
        given("joblocation", F.struct(F.struct(F.col("joblocation.addresslocality").alias("addressLocality"), F.col("joblocation.addressregion").alias("addressRegion")).alias("address"))).alias("jobLocation"),
        given("monthsofexperience", F.struct(F.col("monthsofexperience").alias("monthsOfExperience"))).alias("experienceRequirements")))
    return F.concat(F.lit('<html><script type="application/ld+json">{"@graph": ['), F.replace(body, F.lit("</"), F.lit("<\\/")), F.lit("]}</script><script type='application/ld+json'>{bad</script></html>"))


@query(r"""WITH p AS (SELECT page_id, nullif(trim(title, ' '), '') AS title_raw, nullif(trim(hiringorganization.name, ' '), '') AS company_name_raw, nullif(trim(skills, ' '), '') AS s,
  list_distinct(list_filter([nullif(trim(joblocation.addresslocality, ' '), ''), nullif(trim(joblocation.addressregion, ' '), '')], lambda x: x IS NOT NULL)) AS places, basesalary.amount AS amount, nullif(trim(basesalary.currency, ' '), '') AS currency,
  nullif(trim(basesalary.unittext, ' '), '') AS unit, monthsofexperience AS months, nullif(trim(employmenttype, ' '), '') AS employment_type_raw, nullif(trim(dateposted, ' '), '') AS posted_at_raw, nullif(trim(validthrough, ' '), '') AS expires_at_raw,
  nullif(trim(joblocation.addresslocality, ' '), '') AS l1, nullif(trim(joblocation.addressregion, ' '), '') AS l2 FROM job_jsonld_pages)
SELECT page_id, title_raw, company_name_raw, array_to_string(list_filter(regexp_split_to_array(s, '\s*[,;|]\s*'), lambda x: x <> ''), '|') AS skills_raw, nullif(concat_ws(', ', l1, CASE WHEN l2 IS DISTINCT FROM l1 THEN l2 END), '') AS location_raw,
CASE WHEN regexp_matches(lower(amount), 'negotiable|thỏa thuận') THEN amount ELSE amount || coalesce(' ' || currency, '') || coalesce('/' || lower(unit), '') END AS salary_raw,
CASE WHEN months IS NOT NULL THEN 'minimum ' || months || ' months' END AS experience_raw, employment_type_raw, posted_at_raw, expires_at_raw FROM p""")
def jsonld_extract(spark, d):
    """``jsonld_fields`` with its skills as one text: every page's fields, written into JSON-LD and read back from the html."""
    return jsonld_fields(spark, d).withColumn("skills_raw", F.array_join("skills_raw", "|")).drop("description_raw")


@query()
def jsonld_fields(spark, d):
    """All fields of every page, read back from its html; the table has no descriptions."""
    p = table(spark, d, "job_jsonld_pages")
    return pages.posting_fields(pages.postings(p.select("page_id", posting_block().alias("html")), "page_id", "html"), "page_id")


def taxonomy_of(spark, d):
    """The reference list's skills: a fixed list."""
    reference = small_table(table(spark, d, "ref_items").where("kind = 'skill'"), 10_000)
    return [(r.canonical_name, [a for a in r.aliases or [] if a], "skill") for r in reference]


@query()
def match_skills(spark, d):
    """Skills named in the raw descriptions, by the names of the reference list."""
    taxonomy = taxonomy_of(spark, d)
    texts = table(spark, d, "synthetic_jobs").select("record_id", "description_raw")
    found = skills.match_skills(texts, "description_raw", taxonomy)
    return found.select("record_id", F.explode("skills").alias("s")).select("record_id", "s.skill", "s.start", "s.stop", "s.confidence")


@query(r"""SELECT CAST(CAST(fetched_at AS DATE) AS VARCHAR) AS day, nullif(upper(regexp_replace(closed_state, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '') AS state, count(*) AS n FROM topdev_pilot_diagnostic
WHERE extracted_source_job_id IS NOT NULL AND nullif(upper(regexp_replace(closed_state, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '') IS NOT NULL GROUP BY ALL""")
def stream_daily_counts(spark, d):
    """The streaming operator on a table; its test runs it on a stream."""
    o = observations(spark, d).withColumn("observed_at", F.col("fetched_at").cast("timestamp"))
    return daily.daily_counts(o).withColumn("day", F.col("day").cast("string"))


def normalised(spark, d):
    raw = table(spark, d, "synthetic_jobs")
    return pipeline.enrich(pipeline.normalise(raw, taxonomy_of(spark, d)))


def normalised_postings(spark, d):
    """The gold postings with all readings, company, place and employment included."""
    raw = table(spark, d, "job_postings_gold_template").withColumn("experience_raw", F.lit(None).cast("string"))
    return pipeline.enrich(pipeline.normalise(raw, taxonomy_of(spark, d)), company="company_name", location="location_raw", employment="employment_type")


@query()
def pipeline_postings(spark, d):
    """Every gold posting with the readings of ``enrich``."""
    r = normalised_postings(spark, d)
    return r.select(
        "record_index", F.col("title.category.primary_category").alias("category"), F.col("company.key").alias("company"), F.col("company.legal_form").alias("legal_form"), F.col("location.city").alias("city"), F.col("employment.value").alias("employment"),
        F.col("work_mode.value").alias("work_mode"), F.col("salary.shape").alias("salary"), F.size("skills").alias("skills"), F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("issues"))


@query()
def pipeline_records(spark, d):
    """Every raw posting with all its readings."""
    r = normalised(spark, d)
    return r.select(
        "record_id", F.col("title.display").alias("title"), F.col("title.category.primary_category").alias("category"), F.col("salary.minimum").alias("salary_min"), F.col("salary.maximum").alias("salary_max"),
        F.col("experience.minimum_years").alias("years_min"), F.array_join(F.transform("skills", lambda s: s["skill"]), ", ").alias("skills"), F.col("work_mode.value").alias("work_mode"),
        F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("issues"))


@query("""SELECT 'coverage:' || field AS measure, count(*) AS eligible, count(*) FILTER (v IS NOT NULL AND v <> '') AS reached,
round(CAST(count(*) FILTER (v IS NOT NULL AND v <> '') AS DOUBLE) / nullif(count(*), 0), 4) AS rate
FROM (SELECT unnest(['title_raw', 'salary_raw', 'experience_raw', 'description_raw']) AS field, unnest([title_raw, salary_raw, experience_raw, description_raw]) AS v FROM synthetic_jobs) GROUP BY field""")
def pipeline_coverage(spark, d):
    """How many postings have each raw text field."""
    return pipeline.report(normalised(spark, d)).where("measure LIKE 'coverage:%' AND measure <> 'coverage:skills_raw'")


@query()
def pipeline_report(spark, d):
    return pipeline.report(normalised(spark, d))
