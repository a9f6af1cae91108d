"""Duplicate queries over the postings, with their SQL; and the import of a duplicate report."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobweave.functions import text as tx
from jobweave.operators import duplicates as dup
from jobweave.plans.read_queries import jobs
from jobweave.session import table

QUERIES, ORACLE = {}, {}


def query(sql=None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""WITH RECURSIVE k AS (
  SELECT record_index AS id, 'a' || source || chr(31) || source_job_id AS key FROM job_postings_gold_template WHERE source IS NOT NULL AND source_job_id IS NOT NULL
  UNION ALL SELECT record_index, 'b' || content_hash FROM job_postings_gold_template WHERE content_hash IS NOT NULL),
e AS (SELECT DISTINCT x.id AS a, y.id AS b FROM k x JOIN k y USING (key)),
r AS (SELECT record_index AS id, record_index AS reach FROM job_postings_gold_template UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT id AS record_index, min(reach) AS component FROM r GROUP BY id""")
def exact_duplicate_components(spark, d):
    j = jobs(spark, d).select("record_index", "source", "source_job_id", "source_url", "content_hash")
    keys = [F.when(F.col("source").isNotNull() & F.col("source_job_id").isNotNull(), F.concat_ws("\u001f", "source", "source_job_id")), F.col("content_hash"), tx.comparison_key(F.col("source_url"))]
    return dup.connected(j, "record_index", keys).withColumnRenamed("id", "record_index")


def fingerprints(spark, d):
    """A row per posting: what probable duplicates are compared by."""
    known = lambda c: F.when(~F.coalesce(F.col(c), F.lit("")).rlike(r"^[\s\p{Z}\p{P}]*$"), F.col(c))
    return jobs(spark, d).select(
        F.col("record_index").alias("id"), tx.comparison_key(F.col("company_name")).alias("company"), F.array_sort(F.array_distinct(tx.tokens(F.col("title_raw")))).alias("title_tokens"),
        tx.comparison_key(F.col("location_raw")).alias("city"), known("employment_type").alias("employment"),
        F.array_sort(F.array_distinct(F.transform(F.coalesce("skills_raw", F.array().cast("array<string>")), lambda s: F.coalesce(tx.comparison_key(s), F.lit(""))))).alias("skills"), known("salary_raw").alias("salary"))


_KEY = r"nullif(trim(regexp_replace(replace(replace(strip_accents(nfc_normalize(lower({0}))), 'đ', 'd'), 'ß', 'ss'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')), '')"
_KNOWN = r"CASE WHEN NOT regexp_matches(coalesce({0}, ''), '^[\s\p{{Z}}\p{{P}}]*$') THEN {0} END"
_PRINTS = f"""WITH f AS (SELECT record_index AS id, {_KEY.format('company_name')} AS company,
  list_sort(list_distinct(string_split(coalesce({_KEY.format('title_raw')}, ''), ' '))) AS t, {_KEY.format('location_raw')} AS city, {_KNOWN.format('employment_type')} AS employment,
  list_sort(list_distinct(list_transform(coalesce(skills_raw, []), lambda s: coalesce({_KEY.format('s')}, '')))) AS skills, {_KNOWN.format('salary_raw')} AS salary FROM job_postings_gold_template),
c AS (SELECT company, t, city, employment, skills, salary, min(id) AS class_id FROM f WHERE company IS NOT NULL GROUP BY ALL)
"""


@query(_PRINTS + """, p AS (SELECT x.class_id AS left_id, y.class_id AS right_id,
  len(list_intersect(x.t, y.t))::DECIMAL(18,10) / len(list_distinct(list_concat(x.t, y.t))) * 40
  + coalesce(len(list_intersect(x.skills, y.skills))::DECIMAL(18,10) / nullif(len(list_distinct(list_concat(x.skills, y.skills))), 0), 0) * 15 + 25
  + CASE WHEN x.city = y.city THEN 10 ELSE 0 END + CASE WHEN x.employment = y.employment THEN 5 ELSE 0 END + CASE WHEN x.salary = y.salary THEN 5 ELSE 0 END AS s
  FROM c x JOIN c y ON x.company = y.company AND x.class_id < y.class_id AND x.t <> [''] AND y.t <> [''])
SELECT left_id, right_id, round(s::DOUBLE / 100, 4) AS score FROM p WHERE s >= 80 - 1e-7""")
def probable_duplicates(spark, d):
    pairs = dup.probable_pairs(fingerprints(spark, d))
    return pairs.select("left_id", "right_id", F.round(F.col("score").cast("double") / 100, 4).alias("score"))


@query(_PRINTS + "SELECT f.id AS record_index, c.class_id FROM f JOIN c ON f.company = c.company AND f.t = c.t AND f.city IS NOT DISTINCT FROM c.city AND f.employment IS NOT DISTINCT FROM c.employment AND f.skills = c.skills AND f.salary IS NOT DISTINCT FROM c.salary")
def duplicate_classes(spark, d):
    """Every posting of a known company with the class of its fingerprint."""
    f = fingerprints(spark, d).where("company IS NOT NULL")
    c = dup.classes(f)
    return f.join(c, [f[x].eqNullSafe(c[x]) for x in f.columns if x != "id"]).select(F.col("id").alias("record_index"), "class_id")


@query("""WITH m AS (SELECT cluster_id, unnest(member_indices) AS member FROM topdev_duplicates),
s AS (SELECT cluster_id, array_to_string(list_sort(list_distinct(array_agg(member))), ',') AS members, count(DISTINCT member) AS size, count(*) FILTER (g.record_index IS NULL) AS unknown
FROM m LEFT JOIN job_postings_gold_template g ON g.record_index = m.member GROUP BY cluster_id)
SELECT s.*, list_contains(member_indices, representative_index) AS has_representative, decision.score AS score FROM s JOIN topdev_duplicates USING (cluster_id)""")
def duplicate_report(spark, d):
    """Clusters of a report with resolved members: how many there are, and how many no record has."""
    r = table(spark, d, "topdev_duplicates")
    m = r.select("cluster_id", F.explode("member_indices").alias("record_index"))
    known = jobs(spark, d).select("record_index", F.lit(True).alias("known"))
    s = m.join(known, "record_index", "left").groupBy("cluster_id").agg(
        F.array_join(F.array_sort(F.collect_set("record_index")), ",").alias("members"), F.countDistinct("record_index").alias("size"), F.count_if(F.col("known").isNull()).alias("unknown"))
    about = r.select("cluster_id", F.array_contains("member_indices", F.col("representative_index")).alias("has_representative"), F.col("decision.score").alias("score"))
    return s.join(about, "cluster_id")


@query("""WITH new AS (SELECT cluster_id, array_to_string(list_sort(list_distinct(member_indices)), ',') AS key, decision.score AS score FROM topdev_duplicates WHERE method_version = 'dedup.v2'),
old AS (SELECT cluster_id, array_to_string(list_sort(list_distinct(member_indices)), ',') AS key, decision.score AS score FROM topdev_duplicates WHERE method_version = 'dedup.v1'),
n AS (SELECT key, max(score) AS score FROM new GROUP BY key), o AS (SELECT key, max(score) AS score FROM old GROUP BY key)
SELECT coalesce(n.key, o.key) AS key, CASE WHEN o.key IS NULL THEN 'insert' WHEN n.key IS NULL THEN 'delete' WHEN n.score IS DISTINCT FROM o.score THEN 'update' ELSE 'skip' END AS action
FROM n FULL JOIN o ON n.key = o.key""")
def duplicate_import_actions(spark, d):
    """What importing the v2 report over the v1 report would do, cluster by member set."""
    r = table(spark, d, "topdev_duplicates").select("method_version", F.array_join(F.array_sort(F.array_distinct("member_indices")), ",").alias("key"), F.col("decision.score").alias("score"))
    side = lambda v: r.where(F.col("method_version") == v).groupBy("key").agg(F.max("score").alias("score"))
    n, o = side("dedup.v2").alias("n"), side("dedup.v1").alias("o")
    action = F.when(F.col("o.key").isNull(), "insert").when(F.col("n.key").isNull(), "delete").when(~F.col("n.score").eqNullSafe(F.col("o.score")), "update").otherwise("skip")
    return n.join(o, F.col("n.key") == F.col("o.key"), "full").select(F.coalesce("n.key", "o.key").alias("key"), action.alias("action"))
