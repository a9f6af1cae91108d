"""The warehouse: calendar, dimensions, facts, daily aggregates, as-of counts, change events, late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobweave.plans.core_queries import STATE, closed_state_store
from jobweave.plans.read_queries import jobs, offers
from jobweave.operators import history, quantiles
from jobweave.session import table

QUERIES, ORACLE = {}, {}


def query(sql: str, dates: tuple[str, ...] = ()):
    """Registers a query and its SQL; days are compared as text, which every engine writes alike."""

    def add(f):
        def run(spark, d):
            out = f(spark, d)
            return out.withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[f.__name__] = run if dates else f
        as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
        ORACLE[f.__name__] = f"SELECT * REPLACE ({as_text}) FROM ({sql}) AS q" if dates else sql
        return f

    return add


DAY = ("day",)


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    d = F.col("day")
    return days.select(
        date_key(d).alias("date_key"), "day", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), (F.weekday(d) + 1).alias("iso_day"), F.weekofyear(d).alias("iso_week"),
        F.date_format(d, "MMMM").alias("month_name"), F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"), F.trunc(d, "quarter").alias("quarter_start"), F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1).alias("quarter_end"))


@query("""SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, CAST(day AS DATE) AS day, year(day) AS year, quarter(day) AS quarter, month(day) AS month, isodow(day) AS iso_day, weekofyear(day) AS iso_week,
monthname(day) AS month_name, CAST(date_trunc('month', day) AS DATE) AS month_start, last_day(day) AS month_end, CAST(date_trunc('quarter', day) AS DATE) AS quarter_start,
CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end
FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS day)""", ("day", "month_start", "month_end", "quarter_start", "quarter_end"))
def dim_dates(spark, d):
    return calendar(spark, "2020-01-01", "2035-12-31")


def upsert_dimension(existing: DataFrame, incoming: DataFrame, natural: str, surrogate: str, attributes: list[str]) -> DataFrame:
    """Type 1: known members keep their surrogate key and take the new attributes; new ones get the next keys.

    New keys are numbered by natural key within hash buckets whose offsets are added up, so no task
    numbers all new members. Members that are not in ``incoming`` stay as they are.
    """
    top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).first()[0]
    joined = incoming.join(existing.select(natural, F.col(surrogate).alias("_old")), natural, "left")
    new = joined.where("_old IS NULL").withColumn("_b", F.pmod(F.xxhash64(natural), F.lit(64)))
    offsets = new.groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("_b", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_b")) - F.col("n")).alias("_before"))  # 64 rows
    numbered = new.join(offsets, "_b").withColumn(surrogate, F.lit(top) + F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy(natural)))
    kept = joined.where("_old IS NOT NULL").withColumn(surrogate, F.col("_old"))
    cols = [surrogate, natural, *attributes]
    untouched = existing.join(incoming.select(natural), natural, "left_anti")
    return kept.select(*cols).unionByName(numbered.select(*cols)).unionByName(untouched.select(*cols))


@query("""WITH old AS (SELECT DISTINCT company_name FROM job_postings_gold_template WHERE company_name IS NOT NULL AND record_index % 2 = 0),
new AS (SELECT company_name, count(*) AS postings FROM job_postings_gold_template WHERE company_name IS NOT NULL GROUP BY company_name)
SELECT company_name, postings, company_name IN (SELECT company_name FROM old) AS kept_key FROM new""")
def dim_upsert(spark, d):
    """Companies known from every second posting, updated from all: keys of the known stay, keys are unique."""
    j = jobs(spark, d).where("company_name IS NOT NULL")
    old = j.where("record_index % 2 = 0").select("company_name").distinct().withColumn("company_key", F.xxhash64("company_name")).withColumn("postings", F.lit(0).cast("bigint"))
    after = upsert_dimension(old, j.groupBy("company_name").agg(F.count(F.lit(1)).alias("postings")), "company_name", "company_key", ["postings"])
    return after.join(old.select("company_name", F.col("company_key").alias("was")), "company_name", "left").select("company_name", "postings", F.coalesce(F.col("was") == F.col("company_key"), F.lit(False)).alias("kept_key"))


ARRIVED = "2026-04-01"  # deliveries before this instant are there, the others come in


@query(f"""SELECT company_name, count(*) AS postings, count(*) FILTER (collected_at < TIMESTAMP '{ARRIVED}') > 0 AS kept_key
FROM job_postings_gold_template WHERE company_name IS NOT NULL GROUP BY company_name""")
def dim_upsert_arrivals(spark, d):
    """Companies of the postings collected before an instant, updated by those of later postings with the counts of all."""
    j = jobs(spark, d).where("company_name IS NOT NULL").select("company_name", F.coalesce(F.col("collected_at") < F.lit(ARRIVED).cast("timestamp_ntz"), F.lit(False)).alias("there"))
    counted = j.groupBy("company_name").agg(F.count_if("there").alias("before"), F.count_if(~F.col("there")).alias("since"))
    old = counted.where("before > 0").select("company_name", F.xxhash64("company_name").alias("company_key"), F.col("before").alias("postings"))
    new = counted.where("since > 0").select("company_name", (F.col("before") + F.col("since")).alias("postings"))
    after = upsert_dimension(old, new, "company_name", "company_key", ["postings"])
    return after.join(old.select("company_name", F.col("company_key").alias("was")), "company_name", "left").select("company_name", "postings", F.coalesce(F.col("was") == F.col("company_key"), F.lit(False)).alias("kept_key"))


def observations(spark: SparkSession, d: str) -> DataFrame:
    """One fact per delivered snapshot: job, instant, UTC day, state."""
    p = table(spark, d, "topdev_pilot_diagnostic")
    state = F.nullif(F.upper(F.regexp_replace("closed_state", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))
    return p.select("snapshot_id", F.col("extracted_source_job_id").alias("job"), "fetched_at", "ingested_at", F.to_date("fetched_at").alias("day"), state.alias("state"), "final_classification", "source").where("job IS NOT NULL AND state IS NOT NULL")


_OBS = r"""WITH obs AS (SELECT snapshot_id, extracted_source_job_id AS job, fetched_at, ingested_at, CAST(fetched_at AS DATE) AS day,
  nullif(upper(regexp_replace(closed_state, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '') AS state, source FROM topdev_pilot_diagnostic WHERE extracted_source_job_id IS NOT NULL),
o AS (SELECT * FROM obs WHERE state IS NOT NULL)
"""


def load_facts(existing: DataFrame, incoming: DataFrame, key: str, at: str, watermark: Column, lookback_days: int = 7) -> DataFrame:
    """New facts since the watermark less the lookback that ``existing`` does not have: safe to run again."""
    return incoming.where(F.col(at) >= watermark - F.make_dt_interval(F.lit(lookback_days))).join(existing.select(key), key, "left_anti")


@query(_OBS + """SELECT count(*) AS loaded, count(DISTINCT day) AS days FROM o WHERE ingested_at >= TIMESTAMP '2026-02-01' - INTERVAL 7 DAY AND snapshot_id NOT IN (SELECT snapshot_id FROM o WHERE ingested_at < TIMESTAMP '2026-02-01')""")
def fact_late_load(spark, d):
    o = observations(spark, d)
    mark = F.lit("2026-02-01").cast("timestamp_ntz")
    return load_facts(o.where(F.col("ingested_at") < mark), o, "snapshot_id", "ingested_at", mark).agg(F.count(F.lit(1)).alias("loaded"), F.countDistinct("day").alias("days"))


@query(_OBS + """SELECT day, state, count(*) AS observations, count(DISTINCT job) AS jobs FROM o GROUP BY ALL""", DAY)
def daily_market(spark, d):
    return observations(spark, d).groupBy("day", "state").agg(F.count(F.lit(1)).alias("observations"), F.countDistinct("job").alias("jobs"))


@query(_OBS + """, last AS (SELECT job, fetched_at, state FROM o QUALIFY row_number() OVER (PARTITION BY job, fetched_at ORDER BY ingested_at DESC NULLS LAST, snapshot_id DESC) = 1),
v AS (SELECT job, state, fetched_at AS f, lead(fetched_at) OVER (PARTITION BY job ORDER BY fetched_at) AS t FROM last),
days AS (SELECT CAST(unnest(generate_series(DATE '2026-02-01', DATE '2026-02-28', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, state, count(*) AS jobs FROM days JOIN v ON f < day + INTERVAL 1 DAY AND (t IS NULL OR t >= day + INTERVAL 1 DAY) GROUP BY ALL""", DAY)
def active_as_of_day(spark, d):
    """Postings by state at the end of every UTC day of February 2026.

    Versions are cut to the window and exploded to the days at whose end they hold: no range join.
    """
    v = history.versions(closed_state_store(spark, d), STATE)
    first, last = F.to_date(F.lit("2026-02-01")), F.to_date(F.lit("2026-02-28"))
    begin = F.greatest(F.to_date("valid_from"), first)
    end = F.least(F.coalesce(F.date_sub(F.to_date("valid_to"), 1), last), last)
    days = v.withColumn("b", begin).withColumn("e", end).where("b <= e").select(F.explode(F.sequence("b", "e")).alias("day"), F.col("closed_state").alias("state"))
    return days.groupBy("day", "state").agg(F.count(F.lit(1)).alias("jobs"))


@query(_OBS + """, last AS (SELECT job, fetched_at, state FROM o QUALIFY row_number() OVER (PARTITION BY job, fetched_at ORDER BY ingested_at DESC NULLS LAST, snapshot_id DESC) = 1),
e AS (SELECT job, fetched_at, state, lag(state) OVER (PARTITION BY job ORDER BY fetched_at) AS was FROM last)
SELECT CAST(fetched_at AS DATE) AS day, CASE WHEN was IS NULL THEN 'first_seen' WHEN state = 'ACTIVE' THEN 'reactivated' ELSE lower(state) END AS event, count(*) AS n
FROM e WHERE was IS NULL OR was <> state GROUP BY ALL""", DAY)
def status_events(spark, d):
    store = closed_state_store(spark, d)
    born = F.col("kind") == "C"
    moves = store.where("starts").select(F.to_date("at").alias("day"), born.alias("born"), F.col("patch.closed_state.value").alias("state"))
    event = F.when(F.col("born"), "first_seen").when(F.col("state") == "ACTIVE", "reactivated").otherwise(F.lower("state"))
    return moves.groupBy("day", event.alias("event")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(updated_at AS DATE) AS day, upper(trim(currency)) AS currency, lower(trim(period)) AS period, tax_basis, count(*) AS offers, count(*) FILTER (is_disclosed) AS disclosed,
round(avg(CAST(normalized_monthly_min AS DOUBLE)), 4) AS mean_min, round(median(CAST(normalized_monthly_min AS DOUBLE)), 4) AS median_min FROM job_search_salary_offers GROUP BY ALL""", DAY)
def daily_salary(spark, d):
    """Never mixes currencies, periods or tax bases."""
    groups = ["day", "currency", "period", "tax_basis"]
    o = offers(spark, d).select(F.to_date("updated_at").alias("day"), F.upper(F.trim("currency")).alias("currency"), F.lower(F.trim("period")).alias("period"), "tax_basis", "is_disclosed", F.col("normalized_monthly_min").cast("double").alias("v"))
    rows = o.groupBy(*groups).agg(F.count(F.lit(1)).alias("offers"), F.count_if("is_disclosed").alias("disclosed"), F.round(F.avg("v"), 4).alias("mean_min"))
    middle = quantiles.quantiles(o, groups, F.col("v"), {"median_min": 0.5})
    return quantiles.joined(rows, middle.withColumn("median_min", F.round("median_min", 4)), groups)


def _daily(spark, d, dimension: Column, name: str) -> DataFrame:
    j = jobs(spark, d).withColumn("day", F.to_date("posted_at")).where("day IS NOT NULL")
    return j.groupBy("day", F.coalesce(dimension, F.lit("unknown")).alias(name)).agg(F.count(F.lit(1)).alias("postings"), F.count_if("is_active").alias("active"))


def _daily_sql(column: str, name: str) -> str:
    return f"""SELECT CAST(posted_at AS DATE) AS day, coalesce({column}, 'unknown') AS {name}, count(*) AS postings, count(*) FILTER (is_active) AS active
FROM job_postings_gold_template WHERE posted_at IS NOT NULL GROUP BY ALL"""


@query(_daily_sql("company_name", "company"), DAY)
def daily_company(spark, d):
    return _daily(spark, d, F.col("company_name"), "company")


@query(_daily_sql("location_raw", "location"), DAY)
def daily_location(spark, d):
    return _daily(spark, d, F.col("location_raw"), "location")


@query(_daily_sql("seniority", "occupation"), DAY)
def daily_occupation(spark, d):
    return _daily(spark, d, F.col("seniority"), "occupation")


@query("""SELECT CAST(posted_at AS DATE) AS day, skill, count(*) AS postings FROM (SELECT posted_at, record_index, unnest(list_distinct(skills_raw)) AS skill FROM job_postings_gold_template)
WHERE posted_at IS NOT NULL GROUP BY ALL""", DAY)
def daily_skill(spark, d):
    s = jobs(spark, d).where("posted_at IS NOT NULL").select(F.to_date("posted_at").alias("day"), F.explode(F.filter(F.array_distinct("skills_raw"), lambda x: x.isNotNull())).alias("skill"))
    return s.groupBy("day", "skill").agg(F.count(F.lit(1)).alias("postings"))


@query(_OBS + """, late AS (SELECT DISTINCT day FROM o WHERE ingested_at >= TIMESTAMP '2026-01-20' AND fetched_at < TIMESTAMP '2026-01-20')
SELECT day, state, count(DISTINCT job) AS jobs FROM o WHERE day IN (SELECT day FROM late) GROUP BY ALL""", DAY)
def late_data_rebuild(spark, d):
    """The daily rows that deliveries after 20 January change: exactly their days are counted again."""
    o = observations(spark, d)
    cut = F.lit("2026-01-20").cast("timestamp_ntz")
    late = o.where((F.col("ingested_at") >= cut) & (F.col("fetched_at") < cut)).select("day").distinct()
    return o.join(late, "day", "left_semi").groupBy("day", "state").agg(F.countDistinct("job").alias("jobs"))


@query(_OBS + """SELECT source, max(fetched_at) AS newest, CASE WHEN max(fetched_at) IS NULL THEN 'missing' WHEN date_diff('second', max(fetched_at), TIMESTAMP '2026-06-30') > 86400 THEN 'stale' ELSE 'fresh' END AS status FROM o GROUP BY source""")
def data_freshness(spark, d):
    as_of = F.lit("2026-06-30").cast("timestamp_ntz")
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    g = observations(spark, d).groupBy("source").agg(F.max("fetched_at").alias("newest"))
    return g.withColumn("status", F.when(F.col("newest").isNull(), "missing").when(age > 86_400, "stale").otherwise("fresh"))


@query(_OBS + "SELECT source, job, state FROM o QUALIFY row_number() OVER (PARTITION BY source ORDER BY fetched_at DESC, ingested_at DESC, snapshot_id DESC) = 1")
def latest_per_source(spark, d):
    """DISTINCT ON as a combinable aggregate: no sort of a whole source."""
    best = F.max_by(F.struct("job", "state"), F.struct("fetched_at", "ingested_at", "snapshot_id")).alias("b")
    return observations(spark, d).groupBy("source").agg(best).select("source", "b.*")


@query("""SELECT 'negative_amount' AS check_name, id FROM job_search_salary_offers WHERE amount_min < 0 OR amount_max < 0
UNION ALL SELECT 'reversed_range', id FROM job_search_salary_offers WHERE amount_min > amount_max
UNION ALL SELECT 'undisclosed_amount', id FROM job_search_salary_offers WHERE NOT is_disclosed AND (amount_min IS NOT NULL OR amount_max IS NOT NULL OR amount_exact IS NOT NULL)
UNION ALL SELECT 'exact_and_range', id FROM job_search_salary_offers WHERE amount_exact IS NOT NULL AND (amount_min IS NOT NULL OR amount_max IS NOT NULL)
UNION ALL SELECT 'unknown_member', CAST(r.id AS BIGINT) FROM (SELECT cluster_id AS id, unnest(member_indices) AS m FROM topdev_duplicates) r WHERE NOT EXISTS (SELECT 1 FROM job_postings_gold_template g WHERE g.record_index = r.m)""")
def lineage_violations(spark, d):
    """Integrity rules as rows: every rule of one table in one pass, then the anti join."""
    rules = {"negative_amount": "amount_min < 0 OR amount_max < 0", "reversed_range": "amount_min > amount_max",
             "undisclosed_amount": "NOT is_disclosed AND (amount_min IS NOT NULL OR amount_max IS NOT NULL OR amount_exact IS NOT NULL)",
             "exact_and_range": "amount_exact IS NOT NULL AND (amount_min IS NOT NULL OR amount_max IS NOT NULL)"}
    broken = offers(spark, d).select("id", F.explode(F.filter(F.array(*[F.when(F.expr(x), F.lit(n)) for n, x in rules.items()]), lambda x: x.isNotNull())).alias("check_name"))
    members = table(spark, d, "topdev_duplicates").select(F.col("cluster_id").alias("id"), F.explode("member_indices").alias("record_index"))
    lost = members.join(jobs(spark, d).select("record_index"), "record_index", "left_anti").select("id", F.lit("unknown_member").alias("check_name"))
    return broken.select("id", "check_name").unionByName(lost)


@query("""WITH new AS (SELECT source, source_job_id, max_by(content_hash, record_index) AS h FROM job_postings_gold_template WHERE record_index % 3 <> 0 GROUP BY ALL),
old AS (SELECT source, source_job_id, max_by(content_hash, record_index) AS h FROM job_postings_gold_template WHERE record_index % 3 = 0 GROUP BY ALL)
SELECT CASE WHEN old.source IS NULL THEN 'inserted' WHEN new.h IS DISTINCT FROM old.h THEN 'updated' ELSE 'skipped' END AS action, count(*) AS n
FROM new LEFT JOIN old ON new.source = old.source AND new.source_job_id = old.source_job_id GROUP BY action""")
def import_upsert_actions(spark, d):
    """What importing two thirds of the postings over the last third would do."""
    side = lambda c: jobs(spark, d).where(c).groupBy("source", "source_job_id").agg(F.max_by("content_hash", "record_index").alias("h"))
    n, o = side("record_index % 3 <> 0").alias("n"), side("record_index % 3 = 0").alias("o")
    action = F.when(F.col("o.source").isNull(), "inserted").when(~F.col("n.h").eqNullSafe(F.col("o.h")), "updated").otherwise("skipped")
    joined = n.join(o, (F.col("n.source") == F.col("o.source")) & (F.col("n.source_job_id") == F.col("o.source_job_id")), "left")
    return joined.groupBy(action.alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH k AS (SELECT source, source_job_id, max_by({{'h': content_hash}}, {{'t': collected_at, 'i': record_index}}) FILTER (collected_at < TIMESTAMP '{ARRIVED}') AS old,
  max_by({{'h': content_hash}}, {{'t': coalesce(collected_at, TIMESTAMP '1970-01-01'), 'i': record_index}}) FILTER (NOT coalesce(collected_at < TIMESTAMP '{ARRIVED}', false)) AS new FROM job_postings_gold_template GROUP BY ALL)
SELECT CASE WHEN new IS NULL THEN 'kept' WHEN old IS NULL THEN 'inserted' WHEN new.h IS DISTINCT FROM old.h THEN 'updated' ELSE 'skipped' END AS action, count(*) AS n FROM k GROUP BY action""")
def import_arrival_actions(spark, d):
    """What importing the postings collected since an instant over those from before does to every key."""
    there = F.coalesce(F.col("collected_at") < F.lit(ARRIVED).cast("timestamp_ntz"), F.lit(False))
    at = F.struct(F.coalesce("collected_at", F.lit("1970-01-01").cast("timestamp_ntz")), "record_index")
    last = lambda side: F.max_by(F.struct(F.col("content_hash").alias("h")), F.when(side, at))
    k = jobs(spark, d).groupBy("source", "source_job_id").agg(last(there).alias("old"), last(~there).alias("new"))
    action = F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "inserted").when(~F.col("new.h").eqNullSafe(F.col("old.h")), "updated").otherwise("skipped")
    return k.groupBy(action.alias("action")).agg(F.count(F.lit(1)).alias("n"))
