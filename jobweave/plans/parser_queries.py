"""Field parsers over the texts of the tables, with SQL that says the same rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.operators import parsers
from jobweave.plans.read_queries import _PLAIN, jobs
from jobweave.session import table
from jobweave.sources import pages

QUERIES, ORACLE = {}, {}


def query(sql=None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""SELECT page_id, CASE WHEN employmenttype IS NULL OR trim(employmenttype) = '' OR lower(trim(employmenttype)) = 'other' THEN 'UNSPECIFIED'
WHEN regexp_matches(employmenttype, '(?i)\\b(internship|intern)\\b') THEN 'INTERNSHIP' WHEN regexp_matches(employmenttype, '(?i)\\bpart[ -]?time\\b') THEN 'PART_TIME' WHEN regexp_matches(employmenttype, '(?i)\\bfull[ -]?time\\b') THEN 'FULL_TIME'
WHEN regexp_matches(employmenttype, '(?i)\\bfreelance\\b') THEN 'FREELANCE' WHEN regexp_matches(employmenttype, '(?i)\\btemporary\\b') THEN 'TEMPORARY' WHEN regexp_matches(employmenttype, '(?i)\\bcontract\\b') THEN 'CONTRACT' ELSE 'UNSPECIFIED' END AS value
FROM job_jsonld_pages""")
def employment_type(spark, d):
    p = table(spark, d, "job_jsonld_pages")
    return p.select("page_id", parsers.employment_type(F.col("employmenttype"), F.lit(None).cast("string"))["value"].alias("value"))


_KEY = "nullif(trim(regexp_replace(" + _PLAIN + r", '[^\p{{L}}\p{{N}}_]+', ' ', 'g')), '')"
_FORMS = [(words, name) for words, name in parsers.LEGAL_FORMS]
_FORM_CASE = "CASE " + " ".join(f"WHEN regexp_matches(k, '(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])') THEN '{{0}}'".replace("{0}", w) for w, _ in _FORMS) + " END"
_FORM_NAMES = "CASE f " + " ".join(f"WHEN '{w}' THEN '{n}'" for w, n in _FORMS) + " END"
_HIDDEN = ", ".join(f"'{x}'" for x in parsers.HIDDEN_COMPANIES)


@query(f"""WITH c AS (SELECT record_index, company_name, {_KEY.format('company_name')} AS k FROM job_postings_gold_template), f AS (SELECT *, {_FORM_CASE} AS f FROM c),
n AS (SELECT *, k IS NULL OR k IN ({_HIDDEN}) AS hidden, nullif(trim(regexp_replace(' ' || replace(k, ' ', '  ') || ' ', ' ' || replace(f, ' ', '  ') || ' ', ' ', 'g')), '') AS cut FROM f)
SELECT record_index, CASE WHEN NOT hidden THEN nullif(trim(regexp_replace(translate(company_name, '–—’“”', '--''""'), '[\\s\\p{{Z}}]+', ' ', 'g')), '') END AS name,
CASE WHEN NOT hidden THEN coalesce(regexp_replace(cut, ' +', ' ', 'g'), k) END AS key, CASE WHEN NOT hidden THEN {_FORM_NAMES} END AS legal_form, CASE WHEN hidden THEN 1.0::DOUBLE ELSE 0.95::DOUBLE END AS confidence FROM n""")
def company_readings(spark, d):
    """The company of every posting, read from its name."""
    return jobs(spark, d).select("record_index", parsers.normalise_company(F.col("company_name")).alias("p")).select("record_index", "p.*")


_CITY = "list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'contains(k, {chr(39)}{a}{chr(39)})' for a in names)} THEN '{city}' END" for city, names in parsers.CITIES.items()) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH c AS (SELECT record_index, location_raw AS t, {_KEY.format('location_raw')} AS k FROM job_postings_gold_template),
f AS (SELECT *, coalesce({_CITY}, []) AS found, coalesce(regexp_matches(t, '(?i)\\b(?:remote|work from home|wfh|làm việc từ xa|flexible location)\\b'), false) AS remote,
  nullif(regexp_extract(t, '(?i)(?:quận|\\bq\\.)\\s*([0-9]+)\\b', 1), '') AS number FROM c)
SELECT record_index, CASE WHEN len(found) = 1 THEN found[1] END AS city, CASE WHEN number IS NOT NULL THEN 'District ' || number WHEN regexp_matches(t, '(?i)\\bthủ đức') THEN 'Thu Duc' END AS district,
CASE WHEN len(found) > 0 THEN 'Vietnam' END AS country, array_to_string(found, ',') AS cities, remote AND len(found) = 0 AS remote_only,
(CASE WHEN k IS NULL THEN 1.0 WHEN len(found) > 0 OR remote THEN 0.95 ELSE 0.0 END)::DOUBLE AS confidence FROM f""")
def location_readings(spark, d):
    """The place of every posting, read from its location."""
    p = jobs(spark, d).select("record_index", parsers.normalise_location(F.col("location_raw")).alias("p")).select("record_index", "p.*")
    return p.withColumn("cities", F.array_join("cities", ","))


def _title_sql(column: str) -> str:
    """The categories' list of (place, rank, name), sorted: the place in the raw title, else in its key."""
    at = lambda p, x: f"CASE WHEN regexp_matches({x}, '(?i){p}') THEN length(regexp_extract({x}, '(?is)^(.*?)(?:{p})', 1)) + 1 END"
    cells = ", ".join(f"CASE WHEN coalesce({at(p, 't')}, {at(p, 'k')}) IS NOT NULL THEN {{{{'at': coalesce({at(p, 't')}, {at(p, 'k')}), 'i': {i}, 'name': '{n}'}}}} END".replace("{{", "{").replace("}}", "}") for i, (n, p) in enumerate(parsers.TITLE_CATEGORIES))
    return f"list_transform(list_sort(list_filter([{cells}], lambda x: x IS NOT NULL)), lambda x: x.name)"


@query(f"""WITH c AS (SELECT record_index, title_raw AS t, coalesce({_KEY.format('title_raw')}, lower(title_raw)) AS k0 FROM job_postings_gold_template), k AS (SELECT *, replace(k0, '_', ' ') AS k FROM c),
n AS (SELECT *, CASE WHEN regexp_matches(k, '{parsers.NON_IT_TITLE}') THEN [] ELSE {_title_sql('t')} END AS n FROM k)
SELECT record_index, CASE WHEN t IS NOT NULL THEN coalesce(n[1], 'Unclassified') END AS primary_category, CASE WHEN t IS NOT NULL THEN array_to_string(n[2:], ',') END AS secondary_categories,
(CASE WHEN t IS NULL THEN NULL WHEN len(n) = 0 THEN 0.0 WHEN len(n) = 1 THEN 0.95 ELSE 0.82 END)::DOUBLE AS confidence FROM n""")
def title_readings(spark, d):
    """The categories of every posting's title."""
    p = jobs(spark, d).select("record_index", parsers.classify_title(F.col("title_raw")).alias("p")).select("record_index", "p.*")
    return p.withColumn("secondary_categories", F.array_join("secondary_categories", ","))


@query()
def title_display(spark, d):
    """The shown title of every posting."""
    return jobs(spark, d).select("record_index", parsers.display_title(F.col("title_raw")).alias("display"))


_FOUND = lambda c, sure: f"CASE WHEN {c} IS NULL OR {c} = '' OR regexp_matches({c}, '(?i)\\b(?:remote interview|support remote users)\\b') THEN [] ELSE list_filter([" + ", ".join(f"CASE WHEN regexp_matches({c}, '(?i){p}') THEN {{'v': '{v}', 's': {sure}}} END" for v, p in parsers.WORK_MODES) + "], lambda x: x IS NOT NULL) END"


@query(f"""WITH c AS (SELECT record_index, nullif(trim(work_mode, ' '), '') AS w, description_raw AS t FROM job_postings_gold_template), f AS (SELECT *, list_concat({_FOUND('w', 0.98)}, {_FOUND('t', 0.75)}) AS f FROM c),
x AS (SELECT *, len(list_distinct(list_transform(f, lambda h: h.v))) > 1 AS conflict FROM f)
SELECT record_index, coalesce(f[1].v, 'UNSPECIFIED') AS value, coalesce(CASE WHEN conflict THEN least(f[1].s, 0.6) ELSE f[1].s END, CASE WHEN w IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS confidence, conflict FROM x""")
def work_mode_readings(spark, d):
    """The work mode of every posting: its own field first, then the description."""
    return jobs(spark, d).select("record_index", parsers.work_mode(F.col("work_mode"), F.col("description_raw")).alias("p")).select("record_index", "p.*")


@query()
def salary_readings(spark, d):
    """The salary of every posting, read from its text."""
    return jobs(spark, d).select("record_index", parsers.parse_salary(F.col("salary_raw")).alias("p")).select("record_index", "p.*")


_RULES = {n: p.replace(r"\b(?:tối\s+thiểu|ít\s+nhất)", r"(?:tối\s+thiểu|ít\s+nhất)") for n, p in parsers.EXPERIENCE_RULES}  # its \b knows ASCII letters only
_YEARS = lambda n, groups: "CAST(replace(coalesce(" + ", ".join(f"nullif(regexp_extract(t, '{_RULES[n]}', {g}), '')" for g in groups) + "), ',', '.') AS DOUBLE)"


@query(f"""WITH c AS (SELECT record_id, lower(experience_raw) AS t FROM synthetic_jobs), r AS (SELECT *, CASE WHEN t IS NULL OR NOT regexp_matches(t, '[^\\s\\p{{Z}}]') THEN 'missing' {" ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in _RULES.items())} ELSE 'unparsed' END AS r FROM c),
v AS (SELECT *, CASE r WHEN 'range' THEN {_YEARS('range', (1, 3))} END AS a, CASE r WHEN 'range' THEN {_YEARS('range', (2, 4))} END AS b FROM r)
SELECT record_id, round(CASE WHEN r = 'none' THEN 0 WHEN r = 'range' AND a <= b THEN a WHEN r = 'over' THEN {_YEARS('over', (1, 2))} WHEN r = 'months' THEN {_YEARS('months', (1, 2))} / 12 WHEN r = 'least' THEN {_YEARS('least', (1, 2, 3, 4))} END, 2) AS minimum_years,
round(CASE WHEN r = 'none' THEN 0 WHEN r = 'under' THEN {_YEARS('under', (1, 2))} WHEN r = 'range' AND a <= b THEN b END, 2) AS maximum_years, CASE WHEN r = 'range' AND a > b THEN 'invalid_range' ELSE r END AS rule FROM v""")
def experience_readings(spark, d):
    """The experience that every raw posting asks for, read from its text."""
    return table(spark, d, "synthetic_jobs").select("record_id", parsers.parse_experience(F.col("experience_raw")).alias("p")).select("record_id", F.col("p.minimum_years").cast("double").alias("minimum_years"), F.col("p.maximum_years").cast("double").alias("maximum_years"), "p.rule")


@query(f"""WITH m AS (SELECT record_index, expires_at, collected_at, description_raw, lower(regexp_extract(description_raw, '{pages.EXPLICIT_STATE.replace("'", "''")}', 1)) AS m FROM job_postings_gold_template)
SELECT record_index, CASE WHEN m = 'expired' THEN 'EXPIRED' WHEN m = 'closed' THEN 'CLOSED' WHEN expires_at < collected_at THEN 'EXPIRED' WHEN expires_at >= collected_at THEN 'ACTIVE'
  WHEN regexp_matches(description_raw, '{pages.ACTIVE_STATE.replace("'", "''")}') THEN 'ACTIVE' ELSE 'UNKNOWN' END AS state,
CASE WHEN m IN ('expired', 'closed') THEN 'explicit_marker' WHEN expires_at IS NOT NULL AND collected_at IS NOT NULL THEN 'valid_through' WHEN regexp_matches(description_raw, '{pages.ACTIVE_STATE.replace("'", "''")}') THEN 'application_state' ELSE 'insufficient_evidence' END AS method,
(CASE WHEN m IN ('expired', 'closed') THEN 1.0 WHEN expires_at IS NOT NULL AND collected_at IS NOT NULL THEN 0.98 WHEN regexp_matches(description_raw, '{pages.ACTIVE_STATE.replace("'", "''")}') THEN 0.95 ELSE 0.0 END)::DOUBLE AS confidence FROM m""")
def closed_state_readings(spark, d):
    """The state of every posting at its collection: markers in its description, then its expiry."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return jobs(spark, d).select("record_index", pages.closed_state(F.col("description_raw"), us("expires_at"), us("collected_at")).alias("p")).select("record_index", "p.*")
