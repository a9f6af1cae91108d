"""The read model: filtered pages, details, counts, salaries, quality and profile, each with its SQL.

Filters that are not given are not applied; every ordering says where nulls go; money is decimal.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import text as tx
from jobweave.operators import quantiles
from jobweave.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class InvalidParameter(ValueError):
    """A parameter out of its contract; carries the SQL state of an invalid parameter value."""

    sqlstate = "22023"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "job_postings_gold_template")


def offers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "job_search_salary_offers")


def checked_page(page: int, page_size: int, most: int = 100) -> tuple[int, int]:
    if page < 1 or not 1 <= page_size <= most:
        raise InvalidParameter(f"page must be at least 1 and page_size between 1 and {most}")
    return (page - 1) * page_size, page_size


def job_filter(*, keyword: str | None = None, salary_disclosed: bool | None = None, salary_min=None, salary_max=None, **equal) -> Column:
    """The conjunction of the filters that are given; keyword looks in two titles, salary in ranges that overlap."""
    parts: list[Column] = [F.lit(True)]
    parts += [F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == F.lit(v) for c, v in equal.items() if v not in (None, "", [])]
    if keyword:
        parts.append(F.col("title_raw").ilike(f"%{keyword}%") | F.coalesce(F.col("title_normalized").ilike(f"%{keyword}%"), F.lit(False)))
    if salary_disclosed is not None:
        parts.append(F.col("salary_disclosed") == F.lit(salary_disclosed))
    if salary_min is not None:
        parts.append(F.col("salary_max") >= F.lit(salary_min))
    if salary_max is not None:
        parts.append(F.col("salary_min") <= F.lit(salary_max))
    return functools.reduce(operator.and_, parts)


SORTS = {"posted_at": "posted_at", "collected_at": "collected_at", "experience": "experience_min_years"}


def job_page(df: DataFrame, page: int = 1, page_size: int = 20, sort: str = "posted_at", order: str = "desc", **filters) -> DataFrame:
    """One page of postings; ties by record_index, nulls last."""
    if sort not in SORTS or order not in ("asc", "desc"):
        raise InvalidParameter("unknown sort or order")
    skip, size = checked_page(page, page_size)
    by = F.col(SORTS[sort])
    return df.where(job_filter(**filters)).orderBy(by.desc_nulls_last() if order == "desc" else by.asc_nulls_last(), "record_index").offset(skip).limit(size)


@query("""SELECT record_index, title_raw, source, posted_at FROM job_postings_gold_template
WHERE source = 'nestboard' AND title_raw ILIKE '%engineer%' ORDER BY posted_at DESC NULLS LAST, record_index LIMIT 20 OFFSET 20""")
def jobs_filtered_page(spark, d):
    return job_page(jobs(spark, d), page=2, source="nestboard", keyword="engineer").select("record_index", "title_raw", "source", "posted_at")


@query("""SELECT count(*) AS total, CAST(ceil(count(*) / 20.0) AS BIGINT) AS pages FROM job_postings_gold_template
WHERE source IN ('nestboard', 'kodjobs') AND title_raw ILIKE '%analyst%'""")
def jobs_page_count(spark, d):
    n = jobs(spark, d).where(job_filter(source=["nestboard", "kodjobs"], keyword="analyst")).agg(F.count(F.lit(1)).alias("total"))
    return n.withColumn("pages", F.ceil(F.col("total") / 20).cast("bigint"))


@query(r"""SELECT record_index, nullif(left(trim(regexp_replace(description_raw, '<[^>]+>', ' ', 'g')), 500), '') AS preview,
array_to_string(skills_raw, '|') AS skills FROM job_postings_gold_template""")
def job_detail(spark, d):
    return jobs(spark, d).select("record_index", tx.preview(F.col("description_raw")).alias("preview"), F.array_join("skills_raw", "|").alias("skills"))


@query("""SELECT company_name, count(*) AS jobs, count(*) FILTER (is_active) AS active_jobs FROM job_postings_gold_template GROUP BY company_name""")
def companies_list(spark, d):
    return jobs(spark, d).groupBy("company_name").agg(F.count(F.lit(1)).alias("jobs"), F.count_if("is_active").alias("active_jobs"))


@query("""SELECT company_name, 'employment' AS kind, employment_type AS name, count(*) AS n FROM job_postings_gold_template GROUP BY ALL
UNION ALL SELECT company_name, 'skill', skill, count(*) FROM (SELECT company_name, record_index, unnest(list_distinct(skills_raw)) AS skill FROM job_postings_gold_template) GROUP BY ALL""")
def company_detail(spark, d):
    j = jobs(spark, d)
    a = j.groupBy("company_name", F.col("employment_type").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("employment"))
    s = j.select("company_name", F.explode(F.filter(F.array_distinct("skills_raw"), lambda x: x.isNotNull())).alias("name"))
    return a.unionByName(s.groupBy("company_name", "name").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("skill")))


@query("""SELECT skill, count(DISTINCT record_index) AS jobs, count(DISTINCT company_name) AS companies, array_to_string(list_sort(list_distinct(array_agg(source))), ',') AS sources
FROM (SELECT record_index, company_name, source, unnest(skills_raw) AS skill FROM job_postings_gold_template) GROUP BY skill""")
def skills_list(spark, d):
    s = jobs(spark, d).select("record_index", "company_name", "source", F.explode("skills_raw").alias("skill"))
    return s.groupBy("skill").agg(
        F.countDistinct("record_index").alias("jobs"), F.countDistinct("company_name").alias("companies"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("""SELECT count(*) AS jobs, count(*) FILTER (is_active) AS active, count(salary_raw) AS with_salary, count(DISTINCT company_name) AS companies,
round(CAST(count(salary_raw) AS DOUBLE) / count(*), 4) AS salary_rate FROM job_postings_gold_template""")
def overview(spark, d):
    return jobs(spark, d).agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if("is_active").alias("active"), F.count("salary_raw").alias("with_salary"), F.countDistinct("company_name").alias("companies"),
        F.round(F.count("salary_raw") / F.count(F.lit(1)), 4).alias("salary_rate"))


def grouped(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, nulls a group of their own, with their share of all in percent."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.lit(1).alias("one")).agg(F.count("one").alias("all"))  # one row
    return counts.join(F.broadcast(total)).select(F.lit(column).alias("field"), "value", "n", F.round(F.col("n") * 100 / F.col("all"), 2).alias("percent"))


@query("\nUNION ALL ".join(f"""SELECT '{c}' AS field, {c} AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent
FROM job_postings_gold_template GROUP BY {c}""" for c in ("seniority", "work_mode", "employment_type", "location_raw")))
def categories_pct(spark, d):
    return functools.reduce(DataFrame.unionByName, [grouped(jobs(spark, d), c) for c in ("seniority", "work_mode", "employment_type", "location_raw")])


_TIDY = "upper(trim(currency))"


@query(f"""SELECT {_TIDY} AS currency, period, count(*) AS n, CAST(min(amount_min) AS DOUBLE) AS lowest, CAST(max(amount_max) AS DOUBLE) AS highest,
round(avg(CAST(amount_min + amount_max AS DOUBLE) / 2), 4) AS mean_mid, round(median(CAST(amount_min + amount_max AS DOUBLE) / 2), 4) AS median_mid, count(*) > 1 AS meaningful
FROM job_search_salary_offers WHERE amount_min IS NOT NULL AND amount_max IS NOT NULL GROUP BY ALL""")
def salary_by_currency(spark, d):
    both = offers(spark, d).where("amount_min IS NOT NULL AND amount_max IS NOT NULL").select(
        F.upper(F.trim("currency")).alias("currency"), "period", "amount_min", "amount_max", ((F.col("amount_min") + F.col("amount_max")).cast("double") / 2).alias("mid"))
    groups = ["currency", "period"]
    rows = both.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.min("amount_min").cast("double").alias("lowest"), F.max("amount_max").cast("double").alias("highest"), F.round(F.avg("mid"), 4).alias("mean_mid"), (F.count(F.lit(1)) > 1).alias("meaningful"))
    middle = quantiles.quantiles(both, groups, F.col("mid"), {"median_mid": 0.5})
    return quantiles.joined(rows, middle.withColumn("median_mid", F.round("median_mid", 4)), groups)


@query(f"""SELECT {_TIDY} AS currency, CASE WHEN grouping(period) = 1 THEN 'all' ELSE coalesce(period, 'unspecified') END AS period, count(*) AS n,
round(quantile_cont(CAST(normalized_monthly_min AS DOUBLE), 0.25), 4) AS q1, round(quantile_cont(CAST(normalized_monthly_min AS DOUBLE), 0.75), 4) AS q3
FROM job_search_salary_offers WHERE normalized_monthly_min IS NOT NULL GROUP BY GROUPING SETS (({_TIDY}, period), ({_TIDY})) HAVING count(*) >= 2""")
def salary_quartiles(spark, d):
    o = offers(spark, d).where("normalized_monthly_min IS NOT NULL").select(F.upper(F.trim("currency")).alias("currency"), F.coalesce("period", F.lit("unspecified")).alias("period"), F.col("normalized_monthly_min").alias("v"))
    each = o.select("currency", F.explode(F.array("period", F.lit("all"))).alias("period"), "v")
    groups = ["currency", "period"]
    counted = each.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    q = quantiles.quantiles(each, groups, F.col("v"), {"q1": 0.25, "q3": 0.75})
    return quantiles.joined(counted, q.select(*groups, F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3")), groups)


@query("""SELECT DISTINCT job_posting_id FROM job_search_salary_offers p WHERE EXISTS (SELECT 1 FROM job_search_salary_offers o WHERE o.job_posting_id = p.job_posting_id
AND o.is_disclosed AND upper(trim(o.currency)) = 'VND' AND coalesce(o.amount_max, o.amount_exact, o.amount_min) >= 10000000 AND coalesce(o.amount_min, o.amount_exact, o.amount_max) <= 30000000)""")
def salary_overlap(spark, d):
    """Postings with a disclosed offer whose range overlaps the asked one."""
    o = offers(spark, d).where(F.col("is_disclosed") & (F.upper(F.trim("currency")) == "VND") & (F.coalesce("amount_max", "amount_exact", "amount_min") >= 10_000_000) & (F.coalesce("amount_min", "amount_exact", "amount_max") <= 30_000_000))
    return offers(spark, d).select("job_posting_id").distinct().join(o.select("job_posting_id").distinct(), "job_posting_id", "left_semi")


# --- quality ---------------------------------------------------------------------------------
#: code, severity, condition in SQL that both engines read alike
RULES: list[tuple[str, str, str]] = [
    *[(f"required_missing_{c}", "REJECT", f"{c} IS NULL OR replace({c}, ' ', '') = ''") for c in ("source", "source_job_id", "source_url", "title_raw")],
    ("url_malformed", "REJECT", "source_url IS NOT NULL AND NOT regexp_like(source_url, '^[hH][tT][tT][pP][sS]?://[^/?#]+')"),
    ("salary_negative", "ERROR", "salary_min < 0 OR salary_max < 0"),
    ("salary_range_invalid", "ERROR", "salary_min > salary_max"),
    ("negotiable_numeric", "ERROR", "salary_type = 'negotiable' AND (salary_min IS NOT NULL OR salary_max IS NOT NULL)"),
    ("undisclosed_numeric", "ERROR", "NOT salary_disclosed AND (salary_min IS NOT NULL OR salary_max IS NOT NULL)"),
    ("numeric_salary_semantics_missing", "WARNING", "(salary_min IS NOT NULL OR salary_max IS NOT NULL) AND (salary_currency IS NULL OR salary_period IS NULL)"),
    ("experience_negative", "ERROR", "experience_min_years < 0 OR experience_max_years < 0"),
    ("experience_range_invalid", "ERROR", "experience_min_years > experience_max_years"),
    ("posted_after_collected", "WARNING", "posted_at > collected_at"),
    ("active_past_expiry", "ERROR", "is_active AND expires_at < collected_at"),
    ("state_missing", "ERROR", "is_active IS NULL"),
    ("skill_empty", "WARNING", "len(list_filter(skills_raw, lambda s: s IS NULL OR replace(s, ' ', '') = '')) > 0"),
    ("skill_duplicate", "WARNING", "len(list_distinct(list_transform(list_filter(skills_raw, lambda s: s IS NOT NULL), lambda s: lower(s)))) < len(list_filter(skills_raw, lambda s: s IS NOT NULL))"),
]
_NATIVE = {
    "skill_empty": "exists(skills_raw, s -> s IS NULL OR replace(s, ' ', '') = '')",
    "skill_duplicate": "size(array_distinct(transform(filter(skills_raw, s -> s IS NOT NULL), s -> lower(s)))) < size(filter(skills_raw, s -> s IS NOT NULL))",
}
SEVERITIES = ["INFO", "WARNING", "ERROR", "REJECT"]


def with_issues(df: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``df`` with ``issues``: the rules it breaks, in the order of the rules."""
    broken = [F.when(F.coalesce(F.expr(_NATIVE.get(c, sql)), F.lit(False)), F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"))) for c, s, sql in rules]
    return df.withColumn("issues", F.filter(F.array(*broken), lambda x: x.isNotNull()))


def split_by_severity(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected are rows with an issue of REJECT, or of ERROR and above if strict."""
    bad = F.exists("issues", lambda i: i["severity"].isin("ERROR", "REJECT") if strict else i["severity"] == "REJECT")
    return df.where(~bad), df.where(bad)


_ISSUES_SQL = "WITH issues AS (" + "\nUNION ALL ".join(
    f"SELECT record_index, '{c}' AS code, '{s}' AS severity FROM job_postings_gold_template WHERE {sql.replace('regexp_like', 'regexp_matches')}" for c, s, sql in RULES) + ")\n"


@query(_ISSUES_SQL + "SELECT record_index, code, severity FROM issues")
def quality_rules(spark, d):
    return with_issues(jobs(spark, d)).select("record_index", F.explode("issues").alias("i")).select("record_index", "i.*")


@query(_ISSUES_SQL + """SELECT code, severity, count(*) AS issues, count(DISTINCT record_index) AS records, round(CAST(count(DISTINCT record_index) AS DOUBLE) / (SELECT count(*) FROM job_postings_gold_template), 4) AS rate
FROM issues GROUP BY code, severity""")
def quality_summary(spark, d):
    j = with_issues(jobs(spark, d))
    total = j.count()  # one number
    return j.select("record_index", F.explode("issues").alias("i")).groupBy("i.code", "i.severity").agg(
        F.count(F.lit(1)).alias("issues"), F.countDistinct("record_index").alias("records"), F.round(F.countDistinct("record_index") / F.lit(max(total, 1)), 4).alias("rate"))


@query(_ISSUES_SQL + """SELECT count(*) FILTER (NOT bad) AS accepted, count(*) FILTER (bad) AS rejected FROM (
SELECT j.record_index, j.record_index IN (SELECT record_index FROM issues WHERE severity IN ('ERROR', 'REJECT')) AS bad FROM job_postings_gold_template j)""")
def quality_split(spark, d):
    strict = F.exists("issues", lambda i: i["severity"].isin("ERROR", "REJECT"))
    return with_issues(jobs(spark, d)).agg(F.count_if(~strict).alias("accepted"), F.count_if(strict).alias("rejected"))


PROFILED = ["source", "source_job_id", "title_raw", "company_name", "location_raw", "work_mode", "employment_type", "seniority", "salary_raw", "education_level", "description_raw"]


@query("\nUNION ALL ".join(f"""SELECT '{c}' AS field, count(*) AS records, count({c}) AS present, count(*) - count({c}) AS nulls,
count(*) FILTER (replace({c}, ' ', '') = '') AS empties, count(DISTINCT {c}) AS distincts FROM job_postings_gold_template""" for c in PROFILED))
def profile_fields(spark, d):
    """One pass: all fields are rows of one exploded array, so that distinct counts share a shuffle."""
    cells = jobs(spark, d).select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in PROFILED])).alias("c")).select("c.*")
    per_value = cells.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("field").agg(
        F.sum("n").alias("records"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.coalesce(F.sum(F.when(F.replace("value", F.lit(" "), F.lit("")) == "", F.col("n"))), F.lit(0)).alias("empties"), F.count("value").alias("distincts"))


@query("""SELECT skill, count(*) AS n FROM (SELECT unnest(skills_raw) AS skill FROM job_postings_gold_template) GROUP BY skill ORDER BY n DESC, skill LIMIT 10""")
def top_skills(spark, d):
    s = jobs(spark, d).select(F.explode("skills_raw").alias("skill"))
    return s.groupBy("skill").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("skill")).limit(10)


@query("""WITH s AS (SELECT record_index, list_sort(list_filter(skills_raw, lambda x: x IS NOT NULL)) AS k FROM job_postings_gold_template),
p AS (SELECT k, unnest(range(1, len(k))) AS i FROM s WHERE len(k) >= 2) SELECT k[i] || ' | ' || k[i + 1] AS pair, count(*) AS n FROM p GROUP BY pair""")
def skill_adjacent_pairs(spark, d):
    """Neighbours in each posting's sorted skills: not all pairs."""
    s = jobs(spark, d).select(F.array_sort(F.filter("skills_raw", lambda x: x.isNotNull())).alias("k")).where(F.size("k") >= 2)
    pairs = s.select(F.explode(F.zip_with(F.slice("k", 1, F.size("k") - 1), F.slice("k", 2, F.size("k") - 1), lambda a, b: F.concat(a, F.lit(" | "), b))).alias("pair"))
    return pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


# --- text --------------------------------------------------------------------------------------
_PLAIN = "replace(replace(strip_accents(nfc_normalize(lower({}))), 'đ', 'd'), 'ß', 'ss')"


@query("SELECT record_index, nullif(trim(regexp_replace(" + _PLAIN.format("title_raw") + r", '[^\p{L}\p{N}_]+', ' ', 'g')), '') AS key FROM job_postings_gold_template")
def text_comparison_key(spark, d):
    return jobs(spark, d).select("record_index", tx.comparison_key(F.col("title_raw")).alias("key"))


_WORDS = r"list_filter(string_split(coalesce(regexp_replace(" + _PLAIN + r", '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ''), ' '), lambda x: x <> '')"


@query(f"""WITH k AS (SELECT record_index, {_WORDS.format('company_industry')} AS a, {_WORDS.format('seniority')} AS b FROM job_postings_gold_template)
SELECT record_index, round(coalesce(len(list_distinct(list_intersect(a, b)))::DOUBLE / nullif(len(list_distinct(list_concat(a, b))), 0), 0), 4) AS share FROM k""")
def tokenize_jaccard_all(spark, d):
    """``tokenize_jaccard`` over every posting, whatever letters and digits it has."""
    share = tx.jaccard(tx.tokens(F.col("company_industry")), tx.tokens(F.col("seniority")))
    return jobs(spark, d).select("record_index", F.round(share.cast("double"), 4).alias("share"))


@query(r"""SELECT record_index, nullif(regexp_extract(regexp_replace(source_url, '[?#].*$', ''), '[-/](\d+)[^0-9]*$', 1), '') AS job_id,
coalesce(regexp_matches(source_url, '^[hH][tT][tT][pP][sS]?://[^/?#]+'), false) AS valid FROM job_postings_gold_template""")
def url_parts(spark, d):
    return jobs(spark, d).select("record_index", tx.job_id_of(F.col("source_url")).alias("job_id"), tx.is_web_url(F.col("source_url")).alias("valid"))


@query()
def html_redacted(spark, d):
    return table(spark, d, "synthetic_jobs").select("record_id", tx.html_to_text(F.col("description_raw")).alias("text"))
