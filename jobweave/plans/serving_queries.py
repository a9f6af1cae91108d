"""Serving documents, search and the parameterised dashboard queries, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.operators import parsers, search
from jobweave.plans import warehouse_queries as wh
from jobweave.plans.read_queries import InvalidParameter, jobs, offers

QUERIES, ORACLE = {}, {}
CLASSES = {"a": "a", "b": "b", "c": "c", "d": "d"}


def query(sql=None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def search_jobs(documents: DataFrame, text: str | None = None, *, work_modes=None, employment_types=None, skills_any=None, active_only: bool = False, sort: str = "relevance", limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of documents, best first, with the count of all matches in ``total_count``."""
    if not 1 <= limit <= 50 or offset < 0 or sort not in ("relevance", "newest", "oldest"):
        raise InvalidParameter("limit must be 1 to 50, offset not negative, sort one of relevance, newest, oldest")
    for given in (work_modes, employment_types, skills_any):
        if given is not None and (not given or any(x is None for x in given)):
            raise InvalidParameter("a list must have values, and no nulls")
    hits = documents.where(search.matches(text, CLASSES))
    if work_modes:
        hits = hits.where(F.col("work_mode").isin(list(work_modes)))
    if employment_types:
        hits = hits.where(F.col("employment_type").isin(list(employment_types)))
    if skills_any:
        hits = hits.where(F.arrays_overlap("skills_raw", F.array(*[F.lit(s) for s in skills_any])))
    if active_only:
        hits = hits.where("is_active")
    total = hits.count()  # one number; the page itself is a top-k
    score = search.rank(text, CLASSES) if sort == "relevance" and text and text.strip() else F.lit(0.0)
    by_date = F.col("posted_at").asc_nulls_last() if sort == "oldest" else F.col("posted_at").desc_nulls_last()
    page = hits.withColumn("score", score).orderBy(F.desc("score"), by_date, "record_index").offset(offset).limit(limit)
    return page.withColumn("total_count", F.lit(total).cast("bigint"))


_DOCS = r"""WITH cur AS (SELECT * FROM job_postings_gold_template QUALIFY row_number() OVER (PARTITION BY source, source_job_id ORDER BY last_seen_at DESC NULLS LAST, record_index DESC) = 1),
docs AS (SELECT *, list_filter(regexp_split_to_array(lower(title_raw), '[^\p{L}\p{N}+#]+'), lambda w: w <> '') AS a,
  list_filter(regexp_split_to_array(lower(array_to_string(skills_raw, ' ')), '[^\p{L}\p{N}+#]+'), lambda w: w <> '') AS b FROM cur)
"""


@query(_DOCS + "SELECT record_index, coalesce(len(a), 0) AS title_words, coalesce(len(b), 0) AS skill_words, left(description_raw, 1200) AS excerpt FROM docs")
def serving_documents(spark, d):
    return search.serving_documents(jobs(spark, d)).select("record_index", F.size("a").alias("title_words"), F.size("b").alias("skill_words"), "excerpt")


_SPLIT = r"coalesce(list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}+#]+'), lambda w: w <> ''), [])"
_ANY = "({0})".format(" OR ".join(f"list_contains({c}, '{{0}}')" for c in "abcd"))
_RANK = " + ".join(f"CASE WHEN list_contains({c}, '{w}') THEN {search.WEIGHTS[c]} ELSE 0 END" for w in ("engineer", "python") for c in "abcd")


@query(_DOCS + f""", texts AS (SELECT record_index, posted_at, coalesce(a, []) AS a, coalesce(b, []) AS b, {_SPLIT.format("concat_ws(' ', company_name, location_raw)")} AS c, {_SPLIT.format('description_raw')} AS d FROM docs),
hits AS (SELECT *, {_RANK} AS score FROM texts WHERE {_ANY.format('engineer')} AND {_ANY.format('python')} AND NOT {_ANY.format('senior')})
SELECT record_index, round(score, 4) AS score, count(*) OVER () AS total_count FROM hits ORDER BY hits.score DESC, posted_at DESC NULLS LAST, record_index LIMIT 20""")
def search_jobs_fulltext(spark, d):
    """Documents that have engineer and python but not senior, in title, skills, company and place or the whole description."""
    docs = search.serving_documents(jobs(spark, d))
    return search_jobs(docs, "engineer python -senior").select("record_index", F.round("score", 4).alias("score"), "total_count")


@query(_DOCS + """SELECT record_index FROM docs WHERE work_mode IN ('remote', 'hybrid') AND list_has_any(skills_raw, ['Python', 'Java']) AND is_active ORDER BY posted_at ASC NULLS LAST, record_index LIMIT 50""")
def search_jobs_filtered(spark, d):
    docs = search.serving_documents(jobs(spark, d))
    return search_jobs(docs, None, work_modes=["remote", "hybrid"], skills_any=["Python", "Java"], active_only=True, sort="oldest", limit=50).select("record_index")


def dashboard(daily: DataFrame, first: str, last: str, *, name: str | None = None, values=None, include_unknown: bool = True, limit: int = 1000, offset: int = 0) -> DataFrame:
    """Rows of a daily aggregate between two days, ordered by day and member."""
    if first > last or (date.fromisoformat(last) - date.fromisoformat(first)).days > 366 or not 1 <= limit <= 1000 or not 0 <= offset <= 10_000:
        raise InvalidParameter("days must be in order and at most 366 apart, limit 1 to 1000, offset 0 to 10000")
    out = daily.where(F.col("day").between(first, last))
    if values is not None:
        out = out.where(F.col(name).isin(list(values)))
    if name and not include_unknown:
        out = out.where(F.col(name) != "unknown")
    return out.orderBy("day", *([F.col(name).asc_nulls_last()] if name else [])).offset(offset).limit(limit)


@query(wh._OBS + "SELECT CAST(day AS VARCHAR) AS day, count(*) AS observations, count(*) FILTER (state = 'ACTIVE') AS active FROM o WHERE day BETWEEN '2026-01-05' AND '2026-01-15' GROUP BY day")
def rpc_market_overview(spark, d):
    daily = wh.daily_market(spark, d).where(F.col("day").between("2026-01-05", "2026-01-15"))
    return daily.groupBy(F.col("day").cast("string").alias("day")).agg(F.sum("observations").alias("observations"), F.coalesce(F.sum(F.when(F.col("state") == "ACTIVE", F.col("observations"))), F.lit(0)).alias("active"))


def _rpc(name: str, daily: str, unknown: bool) -> None:
    source, extra = QUERIES_OF[daily], "" if unknown else f" AND {name} <> 'unknown'"
    active = ", active" if daily != "daily_skill" else ""

    def run(spark, d):
        return dashboard(source(spark, d).withColumn("day", F.col("day").cast("string")), "2026-02-01", "2026-03-15", name=name, include_unknown=unknown)

    key = {"company": "rpc_company_hiring", "location": "rpc_location_demand", "occupation": "rpc_occupation_demand", "skill": "rpc_skill_demand"}[name]
    run.__name__ = key
    QUERIES[key] = run
    ORACLE[key] = f"SELECT day, {name}, postings{active} FROM ({wh.ORACLE[daily]}) AS r WHERE day BETWEEN '2026-02-01' AND '2026-03-15'{extra} ORDER BY day, {name} NULLS LAST LIMIT 1000"


QUERIES_OF = wh.QUERIES
for _name, _daily_query, _unknown in (("company", "daily_company", True), ("location", "daily_location", False), ("occupation", "daily_occupation", False), ("skill", "daily_skill", True)):
    _rpc(_name, _daily_query, _unknown)


@query("""SELECT currency, period, tax_basis, sum(offers)::BIGINT AS offers, sum(disclosed)::BIGINT AS disclosed FROM (""" + wh.ORACLE["daily_salary"] + """) AS r
WHERE day BETWEEN '2026-05-01' AND '2026-06-15' AND currency IN ('VND', 'USD') GROUP BY ALL""")
def rpc_salary_metrics(spark, d):
    daily = wh.QUERIES["daily_salary"](spark, d).where(F.col("day").between("2026-05-01", "2026-06-15") & F.col("currency").isin("VND", "USD"))
    return daily.groupBy("currency", "period", "tax_basis").agg(F.sum("offers").alias("offers"), F.sum("disclosed").alias("disclosed"))


OFFER = ["currency", "period", "tax_basis", "compensation_type", "amount_min", "amount_max", "amount_exact", "is_disclosed"]
def offers_of(rows: DataFrame, key: str) -> DataFrame:
    """(key, salary_offers_json): the offers of each of a page's cards as one document, ordered by what they are; offers without a currency included."""
    cell = F.struct(*OFFER)
    order = [F.struct(F.col(c).isNull().alias("last"), F.col(c).alias("v")).alias(c) for c in OFFER[:4]]
    listed = F.array_sort(F.collect_list(F.struct(*order, "id", cell.alias("cell"))))
    return rows.groupBy(key).agg(F.to_json(F.transform(listed, lambda x: x["cell"]), {"ignoreNullFields": "false"}).alias("salary_offers_json"))


@query("""SELECT job_posting_id, currency, period, tax_basis, compensation_type, count(*) AS offers, count(*) FILTER (is_disclosed) AS disclosed, CAST(min(coalesce(amount_min, amount_exact, amount_max)) AS DOUBLE) AS lowest,
CAST(max(coalesce(amount_max, amount_exact, amount_min)) AS DOUBLE) AS highest FROM job_search_salary_offers GROUP BY ALL""")
def posting_offers(spark, d):
    """Every posting's offers by kind, also those without a currency; no list of a posting's offers is built, since one posting may have a tenth of all."""
    return offers(spark, d).groupBy("job_posting_id", *OFFER[:4]).agg(
        F.count(F.lit(1)).alias("offers"), F.count_if("is_disclosed").alias("disclosed"), F.min(F.coalesce("amount_min", "amount_exact", "amount_max")).cast("double").alias("lowest"),
        F.max(F.coalesce("amount_max", "amount_exact", "amount_min")).cast("double").alias("highest"))


def cards(spark, d) -> DataFrame:
    """The current job cards: a document per posting with what search filters by and shows."""
    j = jobs(spark, d).select("record_index", "source_url", "expires_at", "first_seen_at", "last_seen_at", "seniority", "salary_currency", "salary_period", "salary_raw", "collected_at", "title_normalized")
    status = F.when(F.col("is_active"), "active").when(~F.col("is_active"), "closed").otherwise("unknown")
    docs = search.serving_documents(jobs(spark, d)).withColumn("status", status)
    return docs.join(j, "record_index").withColumn("salary_disclosed", F.coalesce(F.col("salary_raw").rlike("[0-9]"), F.lit(False)))


def card_offers(documents: DataFrame) -> DataFrame:
    """The salary projection of the current cards: an offer per card whose salary text has digits, in the units of its columns; amounts are the parser's."""
    p = parsers.parse_salary(F.col("salary_raw"))
    said = documents.where(F.coalesce(F.col("salary_raw").rlike(r"\S"), F.lit(False))).withColumn("p", p)
    money = lambda c: F.col(c).cast("decimal(20,2)")
    exact = F.col("p.minimum").eqNullSafe(F.col("p.maximum")) & F.col("p.minimum").isNotNull()
    return said.select(
        F.col("record_index").cast("bigint").alias("id"), "record_index", F.upper(F.trim("salary_currency")).alias("currency"), F.lower(F.trim("salary_period")).alias("period"), F.coalesce("p.salary_type", F.lit("unknown")).alias("tax_basis"),
        F.lit("base_salary").alias("compensation_type"), F.when(~exact, money("p.minimum")).alias("amount_min"), F.when(~exact, money("p.maximum")).alias("amount_max"), F.when(exact, money("p.minimum")).alias("amount_exact"), F.col("salary_disclosed").alias("is_disclosed"))


_ROWS_OF_CARD = ["record_index", "title", "company_name", "source", "source_url", "status", "posted_at", "expires_at", "first_seen_at", "last_seen_at", "employment_type", "seniority", "work_mode", "location_labels", "occupation_names", "skill_names", "salary_disclosed", "salary_offers_json", "rank_score", "total_count"]


def search_jobs_v1(
    documents: DataFrame, offered: DataFrame, text: str | None = None, *, sources=None, companies=None, locations=None, occupations=None, skills=None, employment_types=None, seniority_levels=None, work_modes=None,
    statuses=("active",), posted_after=None, salary_currency: str | None = None, salary_period: str | None = None, salary_tax_basis: str | None = None, salary_min=None, salary_max=None, sort: str = "relevance", limit: int = 20, offset: int = 0,
) -> DataFrame:
    """One page of job cards by all filters of the search contract, with offers and the count of all matches.

    A list of None does not filter. Invalid parameters raise InvalidParameter (22023).
    """
    equal = {"source": sources, "company_name": companies, "location_raw": locations, "employment_type": employment_types, "seniority": seniority_levels, "work_mode": work_modes, "status": statuses}
    overlap = {"occupation_names": occupations, "skill_names": skills}
    if limit is None or offset is None or not 1 <= limit <= 50 or not 0 <= offset <= 1000 or sort not in ("relevance", "newest", "oldest") or (text is not None and len(text) > 500):
        raise InvalidParameter("limit must be 1 to 50, offset 0 to 1000, sort one of relevance, newest, oldest, and the query at most 500 characters")
    if any(v is not None and (len(v) > 100 or any(x is None for x in v)) for v in (*equal.values(), *overlap.values())):
        raise InvalidParameter("a list has at most 100 values and no nulls")
    if any(x is not None and x < 0 for x in (salary_min, salary_max)) or (salary_min is not None and salary_max is not None and salary_min > salary_max):
        raise InvalidParameter("salaries are not negative, and the least is not over the most")
    if (salary_min is not None or salary_max is not None) and (salary_currency is None or salary_period is None):
        raise InvalidParameter("a salary needs its currency and period")
    asked = bool(text and text.strip())
    rows = documents.withColumns({"skill_names": F.col("skills_raw"), "occupation_names": F.array(parsers.classify_title(F.col("title_raw"))["primary_category"]), "location_labels": F.array_compact(F.array("location_raw"))})
    hits = rows.where(search.matches(text, CLASSES)) if asked else rows
    for column, values in equal.items():
        hits = hits if values is None else hits.where(F.col(column).isin(list(values)))
    for column, values in overlap.items():
        hits = hits if values is None else hits.where(F.arrays_overlap(column, F.array(*[F.lit(x) for x in values]).cast("array<string>")))
    if posted_after is not None:
        hits = hits.where(F.col("posted_at") >= F.lit(posted_after).cast("timestamp_ntz"))
    given = {"currency": salary_currency, "period": salary_period, "tax_basis": salary_tax_basis}
    if any(x is not None for x in (*given.values(), salary_min, salary_max)):
        fit = offered.where("is_disclosed")
        for column, value in given.items():
            fit = fit if value is None else fit.where(F.col(column) == value)
        fit = fit if salary_min is None else fit.where(F.coalesce("amount_max", "amount_exact", "amount_min") >= F.lit(salary_min))
        fit = fit if salary_max is None else fit.where(F.coalesce("amount_min", "amount_exact", "amount_max") <= F.lit(salary_max))
        hits = hits.join(fit.select("record_index"), "record_index", "left_semi")
    total = hits.count()  # one number; the page itself is a top-k
    score = search.rank(text, CLASSES) if asked else F.lit(0.0)
    by_date = F.col("posted_at").asc_nulls_last() if sort == "oldest" else F.col("posted_at").desc_nulls_last()
    order = ([F.desc("rank_score")] if sort == "relevance" and asked else []) + [by_date, F.asc("record_index")]
    page = hits.withColumn("rank_score", score).orderBy(*order).offset(offset).limit(limit)
    own = offers_of(offered.join(F.broadcast(page.select("record_index")), "record_index", "left_semi"), "record_index").select("record_index", "salary_offers_json")  # at most 50 cards
    shown = page.join(F.broadcast(own), "record_index", "left").withColumns({"salary_offers_json": F.coalesce("salary_offers_json", F.lit("[]")), "total_count": F.lit(total).cast("bigint"), "title": F.col("title_raw")})
    return shown.select(*_ROWS_OF_CARD).orderBy(*order)


def get_job_v1(documents: DataFrame, offered: DataFrame, record_index: int) -> DataFrame:
    """The whole card of one posting, with its excerpt and offers; no row if there is none."""
    one = documents.where(F.col("record_index") == record_index)
    own = offers_of(offered.where(F.col("record_index") == record_index), "record_index").select("record_index", "salary_offers_json")
    return one.join(F.broadcast(own), "record_index", "left").select(
        "record_index", "source", "source_job_id", "source_url", F.col("title_raw").alias("title"), "title_normalized", "company_name", F.col("excerpt").alias("description_excerpt"), "employment_type", "seniority", "work_mode", "status", "posted_at",
        "expires_at", "first_seen_at", "last_seen_at", F.to_json(F.array_compact(F.array("location_raw"))).alias("locations_json"), F.to_json(F.array(parsers.classify_title(F.col("title_raw"))["primary_category"])).alias("occupations_json"),
        F.to_json(F.coalesce("skills_raw", F.array().cast("array<string>"))).alias("skills_json"), "salary_disclosed", F.coalesce("salary_offers_json", F.lit("[]")).alias("salary_offers_json"), F.col("collected_at").alias("updated_at"))


_CARDS = _DOCS + f""", texts AS (SELECT *, coalesce(a, []) AS la, coalesce(b, []) AS lb, {_SPLIT.format("concat_ws(' ', company_name, location_raw)")} AS lc, {_SPLIT.format('description_raw')} AS ld,
  CASE WHEN is_active THEN 'active' WHEN NOT is_active THEN 'closed' ELSE 'unknown' END AS status, coalesce(regexp_matches(salary_raw, '[0-9]'), false) AS said FROM docs)
"""
_IN = lambda w: "(" + " OR ".join(f"list_contains(l{c}, '{w}')" for c in "abcd") + ")"
_SCORE = " + ".join(f"CASE WHEN list_contains(l{c}, '{w}') THEN {search.WEIGHTS[c]} ELSE 0 END" for w in ("engineer",) for c in "abcd")


@query(_CARDS + f"""SELECT record_index, title_raw AS title, status, round(CAST({_SCORE} AS DOUBLE), 4) AS rank_score, said AS salary_disclosed, count(*) OVER () AS total_count FROM texts
WHERE {_IN('engineer')} AND source IN ('nestboard', 'kodjobs', 'lotusit') AND seniority IN ('junior', 'mid', 'senior', 'lead', 'fresher')
  AND work_mode IN ('remote', 'hybrid', 'onsite') AND list_has_any(skills_raw, ['Python', 'Java', 'SQL', 'Docker', 'React', 'JavaScript', 'Kubernetes']) AND status = 'active' AND posted_at >= TIMESTAMP '2025-06-01'
  AND said AND lower(trim(salary_period)) = 'month'
ORDER BY rank_score DESC, posted_at DESC NULLS LAST, record_index LIMIT 20""")
def search_jobs_v1_page(spark, d):
    """Active cards of three sources that have engineer, by skills, seniority, work mode, date and a disclosed monthly salary."""
    documents = cards(spark, d)
    page = search_jobs_v1(documents, card_offers(documents), "engineer", sources=["nestboard", "kodjobs", "lotusit"], seniority_levels=["junior", "mid", "senior", "lead", "fresher"], work_modes=["remote", "hybrid", "onsite"],
                          skills=["Python", "Java", "SQL", "Docker", "React", "JavaScript", "Kubernetes"], posted_after="2025-06-01", salary_period="month")
    return page.select("record_index", "title", "status", F.round("rank_score", 4).alias("rank_score"), "salary_disclosed", "total_count")


@query(_CARDS + """SELECT record_index, title_raw AS title, location_raw AS location, company_name, count(*) OVER () AS total_count FROM texts
WHERE company_name = (SELECT company_name FROM texts WHERE company_name IS NOT NULL GROUP BY company_name ORDER BY count(*) DESC, company_name LIMIT 1) AND status IN ('active', 'closed') ORDER BY posted_at ASC NULLS LAST, record_index LIMIT 50 OFFSET 25""")
def search_jobs_v1_company(spark, d):
    """The third half page of the largest company's cards, oldest first."""
    documents = cards(spark, d)
    largest = documents.where("company_name IS NOT NULL").groupBy("company_name").count().orderBy(F.desc("count"), "company_name").first()
    page = search_jobs_v1(documents, card_offers(documents), companies=[largest.company_name] if largest else [], statuses=["active", "closed"], sort="oldest", limit=50, offset=25)
    return page.select("record_index", "title", F.get("location_labels", F.lit(0)).alias("location"), "company_name", "total_count")


@query(_CARDS + """SELECT record_index, source, source_job_id, title_raw AS title, company_name, left(description_raw, 1200) AS description_excerpt, status, to_json(coalesce(skills_raw, [])) AS skills_json, said AS salary_disclosed
FROM texts WHERE record_index = (SELECT max(record_index) FROM texts)""")
def get_job_v1_latest(spark, d):
    """The card of the posting with the greatest index."""
    documents = cards(spark, d)
    top = documents.agg(F.max("record_index")).first()[0]
    return get_job_v1(documents, card_offers(documents), top).select("record_index", "source", "source_job_id", "title", "company_name", "description_excerpt", "status", "skills_json", "salary_disclosed")
