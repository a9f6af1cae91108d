"""Facts with their dimensions: market metrics, star views, dimension lists, identities, checks of taxonomy and catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.operators import history, search
from jobweave.plans import warehouse_queries as wh
from jobweave.plans.read_queries import InvalidParameter, jobs, offers
from jobweave.plans.serving_queries import _DOCS
from jobweave.session import table

QUERIES, ORACLE = {}, {}


def query(sql=None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- market metrics ----------------------------------------------------------------------------
GRAIN = ["day", "source", "employment_type", "seniority", "work_mode"]
METRICS = ["new_postings", "closed_postings", "expired_postings", "content_changes", "salary_disclosed", "remote_postings", "seen_postings"]


def market_daily_rows(spark, d) -> DataFrame:
    """A row per day and grain with every metric: each posting gives its events, which are counted in one pass.

    Content changes come from the history of the postings' content, which cuts a posting of very many deliveries by days.
    """
    j = jobs(spark, d)
    keyed = j.select(F.concat_ws("\u001f", "source", "source_job_id").alias("key"), F.col("collected_at").alias("at"), "record_index", "content_hash").where(F.col("source").isNotNull() & F.col("source_job_id").isNotNull())
    moved = history.delta_store(keyed, "key", "at", ["record_index"], ["content_hash"]).where("starts AND kind = 'P'").select("key", "at")
    counted = keyed.groupBy("key", "at").agg(F.max("record_index").alias("record_index"))  # of deliveries of one instant the last counts
    changes = counted.join(moved, ["key", "at"], "left_semi").select("record_index", F.lit(True).alias("changed"))
    event = lambda metric, when, at: F.when(F.coalesce(when, F.lit(False)) & F.col(at).isNotNull(), F.struct(F.to_date(at).alias("day"), F.lit(metric).alias("metric")))
    yes = F.lit(True)
    events = F.array_compact(F.array(
        event("new_postings", yes, "first_seen_at"), event("closed_postings", ~F.col("is_active"), "last_seen_at"), event("expired_postings", F.col("expires_at") < F.col("collected_at"), "expires_at"),
        event("content_changes", F.col("changed"), "collected_at"), event("salary_disclosed", F.col("salary_raw").rlike("[0-9]"), "first_seen_at"), event("remote_postings", F.col("work_mode") == "remote", "first_seen_at"), event("seen_postings", yes, "last_seen_at")))
    rows = j.join(changes, "record_index", "left").select(*GRAIN[1:], F.explode(events).alias("e")).select(*GRAIN[1:], "e.*")
    return rows.groupBy(*GRAIN).agg(*[F.count_if(F.col("metric") == m).alias(m) for m in METRICS])


_MARKET = """WITH one AS (SELECT record_index, source, source_job_id, collected_at, content_hash FROM job_postings_gold_template WHERE source IS NOT NULL AND source_job_id IS NOT NULL AND collected_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, source_job_id, collected_at ORDER BY record_index DESC) = 1),
c AS (SELECT record_index FROM one WINDOW w AS (PARTITION BY source, source_job_id ORDER BY collected_at) QUALIFY row_number() OVER w > 1 AND content_hash IS DISTINCT FROM lag(content_hash) OVER w),
j AS (SELECT *, record_index IN (SELECT record_index FROM c) AS changed FROM job_postings_gold_template),
e AS (SELECT source, employment_type, seniority, work_mode, unnest([
  CASE WHEN first_seen_at IS NOT NULL THEN {'day': CAST(first_seen_at AS DATE), 'metric': 'new_postings'} END, CASE WHEN NOT is_active AND last_seen_at IS NOT NULL THEN {'day': CAST(last_seen_at AS DATE), 'metric': 'closed_postings'} END,
  CASE WHEN expires_at < collected_at THEN {'day': CAST(expires_at AS DATE), 'metric': 'expired_postings'} END, CASE WHEN changed AND collected_at IS NOT NULL THEN {'day': CAST(collected_at AS DATE), 'metric': 'content_changes'} END,
  CASE WHEN regexp_matches(salary_raw, '[0-9]') AND first_seen_at IS NOT NULL THEN {'day': CAST(first_seen_at AS DATE), 'metric': 'salary_disclosed'} END, CASE WHEN work_mode = 'remote' AND first_seen_at IS NOT NULL THEN {'day': CAST(first_seen_at AS DATE), 'metric': 'remote_postings'} END,
  CASE WHEN last_seen_at IS NOT NULL THEN {'day': CAST(last_seen_at AS DATE), 'metric': 'seen_postings'} END]) AS e FROM j),
m AS (SELECT e.day AS day, source, employment_type, seniority, work_mode, """ + ", ".join(f"count(*) FILTER (e.metric = '{m}') AS {m}" for m in METRICS) + " FROM e WHERE e IS NOT NULL GROUP BY ALL)\n"


@query(_MARKET + "SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM m")
def market_daily(spark, d):
    return market_daily_rows(spark, d).withColumn("day", F.col("day").cast("string"))


def market_overview_v1(daily: DataFrame, first: str, last: str, *, sources=None, employment_types=None, seniority_levels=None, work_modes=None) -> DataFrame:
    """All metrics summed by day, between two days and within the given members."""
    given = {"source": sources, "employment_type": employment_types, "seniority": seniority_levels, "work_mode": work_modes}
    if first > last or any(v is not None and (len(v) > 100 or any(x is None for x in v)) for v in given.values()):
        raise InvalidParameter("days must be in order, lists of at most 100 values without nulls")
    rows = daily.where(F.col("day").between(first, last))
    for column, values in given.items():
        rows = rows if values is None else rows.where(F.col(column).isin(list(values)))
    return rows.groupBy("day").agg(*[F.sum(m).alias(m) for m in METRICS]).orderBy("day")


@query(_MARKET + "SELECT CAST(day AS VARCHAR) AS day, " + ", ".join(f"sum({m})::BIGINT AS {m}" for m in METRICS) + " FROM m WHERE day BETWEEN '2026-01-10' AND '2026-04-10' AND source IN ('nestboard', 'kodjobs') AND work_mode IN ('remote', 'hybrid') GROUP BY day")
def market_overview(spark, d):
    daily = market_daily(spark, d)
    return market_overview_v1(daily, "2026-01-10", "2026-04-10", sources=["nestboard", "kodjobs"], work_modes=["remote", "hybrid"])


# --- star views: a daily aggregate with its calendar and its member -----------------------------
def members(spark, d, column: Column) -> DataFrame:
    """A dimension: every member with its postings and first and last day."""
    j = jobs(spark, d).select(F.coalesce(column, F.lit("unknown")).alias("member"), F.to_date("posted_at").alias("day"))
    return j.groupBy("member").agg(F.count(F.lit(1)).alias("member_postings"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def star(daily: DataFrame, member: DataFrame, calendar: DataFrame, name: str) -> DataFrame:
    """The daily rows with calendar and member attributes: the calendar has a row per day and is broadcast, the member side is the optimizer's choice."""
    dated = daily.withColumn("date_key", wh.date_key(F.col("day"))).join(F.broadcast(calendar.select("date_key", "year", "quarter", "iso_week", "month_name")), "date_key", "left")
    return dated.join(member.withColumnRenamed("member", name), name, "left").withColumns({c: F.col(c).cast("string") for c in ("day", "first_day", "last_day")})


def _view(key: str, name: str, column: str) -> None:
    def run(spark, d):
        daily = wh._daily(spark, d, F.col(column), name)
        return star(daily, members(spark, d, F.col(column)), wh.calendar(spark, "2020-01-01", "2035-12-31"), name)

    run.__name__ = key
    QUERIES[key] = run
    ORACLE[key] = f"""WITH f AS ({wh._daily_sql(column, name)}), m AS (SELECT coalesce({column}, 'unknown') AS {name}, count(*) AS member_postings, CAST(CAST(min(posted_at) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(posted_at) AS DATE) AS VARCHAR) AS last_day
FROM job_postings_gold_template GROUP BY 1)
SELECT CAST(f.day AS VARCHAR) AS day, f.{name}, postings, active, CAST(strftime(f.day, '%Y%m%d') AS INTEGER) AS date_key, year(f.day)::INTEGER AS year, quarter(f.day)::INTEGER AS quarter, weekofyear(f.day)::INTEGER AS iso_week, monthname(f.day) AS month_name,
member_postings, first_day, last_day FROM f LEFT JOIN m USING ({name})"""


for _key, _name, _column in (("v_company_hiring_daily", "company", "company_name"), ("v_location_demand_daily", "location", "location_raw"), ("v_occupation_demand_daily", "occupation", "seniority"), ("v_work_mode_daily", "work_mode", "work_mode")):
    _view(_key, _name, _column)


@query("""WITH n AS (SELECT company_name FROM job_postings_gold_template UNION SELECT company_name FROM documents), c AS (SELECT company_name, count(*) AS jobs, count(*) FILTER (is_active) AS active FROM job_postings_gold_template GROUP BY 1),
t AS (SELECT company_name, count(*) AS texts FROM documents GROUP BY 1)
SELECT n.company_name, coalesce(jobs, 0) AS jobs, coalesce(active, 0) AS active, coalesce(texts, 0) AS texts FROM n LEFT JOIN c USING (company_name) LEFT JOIN t USING (company_name) WHERE n.company_name IS NOT NULL""")
def company_dimension(spark, d):
    """Every company that postings or documents name, also those without postings: both sides are counted before they meet."""
    j = jobs(spark, d).where("company_name IS NOT NULL").groupBy("company_name").agg(F.count(F.lit(1)).alias("jobs"), F.count_if("is_active").alias("active"), F.lit(0).cast("bigint").alias("texts"))
    t = table(spark, d, "documents").where("company_name IS NOT NULL").groupBy("company_name").agg(F.lit(0).cast("bigint").alias("jobs"), F.lit(0).cast("bigint").alias("active"), F.count(F.lit(1)).alias("texts"))
    return j.unionByName(t).groupBy("company_name").agg(*[F.sum(c).alias(c) for c in ("jobs", "active", "texts")])


@query("""SELECT r.ref_id, r.canonical_name, count(DISTINCT j.record_index) AS jobs FROM ref_items r LEFT JOIN (SELECT record_index, lower(trim(unnest(skills_raw), ' ')) AS k FROM job_postings_gold_template) j ON j.k = lower(r.canonical_name)
WHERE r.kind = 'skill' GROUP BY ALL""")
def skill_dimension(spark, d):
    """Every skill of the reference list with the postings that name it, none included."""
    s = jobs(spark, d).select("record_index", F.explode("skills_raw").alias("s")).select("record_index", F.lower(F.trim("s")).alias("k"))
    counted = s.groupBy("k").agg(F.countDistinct("record_index").alias("jobs"))
    r = table(spark, d, "ref_items").where("kind = 'skill'").select("ref_id", "canonical_name", F.lower("canonical_name").alias("k"))
    return r.join(counted, "k", "left").select("ref_id", "canonical_name", F.coalesce("jobs", F.lit(0)).alias("jobs"))


@query("SELECT j.source, t.trust_rank, count(*) AS jobs, count(*) FILTER (j.is_active) AS active FROM job_postings_gold_template j LEFT JOIN source_trust t ON t.source = lower(trim(j.source, ' ')) GROUP BY ALL")
def postings_by_trust(spark, d):
    """Postings counted per source before the source's rank is joined."""
    counted = jobs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("jobs"), F.count_if("is_active").alias("active")).withColumn("by", F.lower(F.trim("source")))
    return counted.join(table(spark, d, "source_trust").withColumnRenamed("source", "by"), "by", "left").select("source", "trust_rank", "jobs", "active")


@query("SELECT count(*) AS rows, count(DISTINCT (source, source_job_id)) AS identities, count(*) - count(DISTINCT (source, source_job_id)) AS surplus, count(DISTINCT content_hash) AS contents FROM job_postings_gold_template WHERE source IS NOT NULL AND source_job_id IS NOT NULL")
def identity_counts(spark, d):
    """Rows, identities and the surplus of repeated deliveries."""
    j = jobs(spark, d).where("source IS NOT NULL AND source_job_id IS NOT NULL")
    per = j.groupBy("source", "source_job_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("identities"))
    return per.join(F.broadcast(j.agg(F.countDistinct("content_hash").alias("contents")))).select("rows", "identities", (F.col("rows") - F.col("identities")).alias("surplus"), "contents")  # one row each


@query("""SELECT record_index, date_diff('day', CAST(first_seen_at AS DATE), CAST(last_seen_at AS DATE)) AS days_seen, date_diff('day', CAST(posted_at AS DATE), CAST(expires_at AS DATE)) AS days_open, posted_at IS NOT NULL AND collected_at IS NOT NULL AND epoch_us(collected_at) - epoch_us(posted_at) <= 172800000000 AS collected_fresh,
len(skills_raw) AS skill_count, coalesce(regexp_matches(salary_raw, '[0-9]'), false) AS has_salary FROM job_postings_gold_template""")
def posting_facts(spark, d):
    """The measures derived for every posting's fact row."""
    day = F.to_date
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return jobs(spark, d).select(
        "record_index", F.date_diff(day("last_seen_at"), day("first_seen_at")).cast("bigint").alias("days_seen"), F.date_diff(day("expires_at"), day("posted_at")).cast("bigint").alias("days_open"),
        F.coalesce(us("collected_at") - us("posted_at") <= 172_800_000_000, F.lit(False)).alias("collected_fresh"), F.when(F.col("skills_raw").isNotNull(), F.size("skills_raw")).cast("bigint").alias("skill_count"),
        F.coalesce(F.col("salary_raw").rlike("[0-9]"), F.lit(False)).alias("has_salary"))


@query(r"SELECT record_index, sha256(coalesce(source, '') || chr(31) || coalesce(source_job_id, '') || chr(31) || coalesce(lower(trim(title_raw, ' ')), '')) AS fingerprint FROM job_postings_gold_template")
def posting_fingerprints(spark, d):
    """A stable fingerprint of every posting's identity and title."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return jobs(spark, d).select("record_index", F.sha2(F.concat_ws("\u001f", part(F.col("source")), part(F.col("source_job_id")), part(F.lower(F.trim("title_raw")))), 256).alias("fingerprint"))


@query("""SELECT job_posting_id, id, currency, CAST(coalesce(amount_exact, amount_max, amount_min) AS DOUBLE) AS amount FROM job_search_salary_offers
QUALIFY row_number() OVER (PARTITION BY job_posting_id ORDER BY updated_at DESC NULLS LAST, id DESC) = 1""")
def latest_offer(spark, d):
    """The newest offer of every posting, as a combinable aggregate instead of a lateral top one."""
    o = offers(spark, d).select("job_posting_id", F.struct(F.coalesce("updated_at", F.lit("0001-01-01").cast("timestamp_ntz")), "id").alias("at"), F.struct("id", "currency", F.coalesce("amount_exact", "amount_max", "amount_min").cast("double").alias("amount")).alias("o"))
    return o.groupBy("job_posting_id").agg(F.max_by("o", "at").alias("o")).select("job_posting_id", "o.*")


@query("SELECT refresh_run_id, bool_and(id IS NOT NULL AND job_posting_id IS NOT NULL) AS keyed, bool_and(updated_at IS NOT NULL) AS dated, bool_and(NOT is_disclosed OR coalesce(amount_exact, amount_max, amount_min) IS NOT NULL) AS amounts, count(*) AS rows FROM job_search_salary_offers GROUP BY refresh_run_id")
def archive_checks(spark, d):
    """Whether every run's rows are fit to be archived."""
    return offers(spark, d).groupBy("refresh_run_id").agg(
        F.bool_and(F.col("id").isNotNull() & F.col("job_posting_id").isNotNull()).alias("keyed"), F.bool_and(F.col("updated_at").isNotNull()).alias("dated"),
        F.bool_and(~F.col("is_disclosed") | F.coalesce("amount_exact", "amount_max", "amount_min").isNotNull()).alias("amounts"), F.count(F.lit(1)).alias("rows"))


@query("""WITH n AS (SELECT kind, ref_id, lower(x) AS name FROM (SELECT kind, ref_id, unnest(list_concat([canonical_name], coalesce(aliases, []))) AS x FROM ref_items) WHERE trim(x, ' ') <> '')
SELECT kind, name, count(DISTINCT ref_id) AS owners FROM n GROUP BY kind, name""")
def taxonomy_names(spark, d):
    """Every name and alias of the reference list with how many entries own it: more than one is a conflict."""
    r = table(spark, d, "ref_items").select("kind", "ref_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("x")).where("trim(x) <> ''")
    return r.groupBy("kind", F.lower("x").alias("name")).agg(F.countDistinct("ref_id").alias("owners"))


@query(_DOCS + "SELECT record_index, source FROM docs WHERE description_raw IS NOT NULL AND NOT contains(description_raw, '[REDACTED') AND (expires_at IS NULL OR expires_at >= collected_at)")
def served_after_redaction(spark, d):
    """The serving documents that stay when redacted and expired descriptions are withdrawn."""
    docs = search.serving_documents(jobs(spark, d)).select("record_index", "source")
    gone = jobs(spark, d).where(F.col("description_raw").isNull() | F.contains("description_raw", F.lit("[REDACTED")) | (F.col("expires_at") < F.col("collected_at"))).select("record_index")
    return docs.join(gone, "record_index", "left_anti")


_CATALOG = ["job_postings_gold_template", "topdev_pilot_diagnostic", "topdev_duplicates", "job_jsonld_pages", "job_search_salary_offers", "synthetic_jobs", "documents"]


@query("SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal FROM information_schema.columns WHERE table_name IN (" + ", ".join(f"'{t}'" for t in _CATALOG) + ")")
def catalog_columns(spark, d):
    """Tables and columns as rows, from the tables' own schemas."""
    rows = [(t, c, i) for t in _CATALOG for i, c in enumerate(table(spark, d, t).columns, 1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int")


@query("SELECT snapshot_id, closed_state AS observed FROM topdev_pilot_diagnostic WHERE closed_state IS NULL OR closed_state NOT IN ('ACTIVE', 'EXPIRED', 'CLOSED', 'UNKNOWN')")
def closed_state_invalid(spark, d):
    """Snapshots whose state is none of the four, as delivered."""
    return table(spark, d, "topdev_pilot_diagnostic").where(~F.coalesce(F.col("closed_state").isin("ACTIVE", "EXPIRED", "CLOSED", "UNKNOWN"), F.lit(False))).select("snapshot_id", F.col("closed_state").alias("observed"))


_ISO = r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?:[T ](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?(?:Z|[+-](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"


@query(f"SELECT page_id, dateposted AS observed FROM job_jsonld_pages WHERE dateposted IS NOT NULL AND NOT regexp_matches(dateposted, '{_ISO}')")
def posted_at_malformed(spark, d):
    """Pages whose posting date is not written as ISO 8601 has it."""
    return table(spark, d, "job_jsonld_pages").where(F.col("dateposted").isNotNull() & ~F.col("dateposted").rlike(_ISO)).select("page_id", F.col("dateposted").alias("observed"))


@query(r"SELECT record_index, CASE WHEN contains(p, '/companies/') THEN 'company page' WHEN contains(p, '/tim-kiem') OR contains(p, '/jobs/search') THEN 'category/listing page' ELSE 'duplicate or malformed URL' END AS page_type FROM (SELECT record_index, coalesce(lower(regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)), '') AS p FROM job_postings_gold_template)")
def invalid_page_types(spark, d):
    """What every posting's url would be reported as if it had no job id."""
    from jobweave.sources.pages import invalid_page_type

    return jobs(spark, d).select("record_index", invalid_page_type(F.col("source_url")).alias("page_type"))
