"""Queries of the text problems, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.llm import consensus, encoding, matching, mixing, percentiles, pii, splitting
from jobweave.session import checkpointed, table

SURVIVING = ["company_name", "company_industry", "company_size", "seniority", "education_level"]
FRACTIONS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "synthetic_jobs").select("record_id", "description_raw")


def reference_rows(spark: SparkSession, sf_dir: str, most: int = 100_000) -> list:
    """The reference list, which does not grow with the data; raises where it is no such list."""
    rows = table(spark, sf_dir, "ref_items").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the reference list is meant to be a fixed list of at most {most} entries")
    return rows


def _things(spark: SparkSession, sf_dir: str) -> set[str]:
    """The words of all titles and skills of the reference list: no part of a person's name."""
    names = [n for r in reference_rows(spark, sf_dir) if r.kind in ("title", "skill") for n in (r.canonical_name, *(r.aliases or ())) if n]
    return {w for n in names for w in matching.words(n) if len(w) > 1}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find(_described(spark, sf_dir), "record_id", "description_raw", things=_things(spark, sf_dir))
    return spans.select(F.col("id").alias("record_id"), "pii_type", F.col("a").alias("span_start"))


def p1_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every description with typed placeholders."""
    texts = _described(spark, sf_dir)
    return pii.redact(texts, "record_id", "description_raw", pii.find(texts, "record_id", "description_raw", things=_things(spark, sf_dir)))


def p1_changed_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions whose redaction has not the length that replacing their spans gives, or differs where there is no span: none. Lengths, not letters, are compared where there are spans."""
    texts = _described(spark, sf_dir)
    spans = checkpointed(pii.find(texts, "record_id", "description_raw", things=_things(spark, sf_dir)))
    redacted = pii.redact(texts, "record_id", "description_raw", spans)
    sums = spans.groupBy(F.col("id").alias("record_id")).agg(F.sum(F.col("b") - F.col("a")).alias("cut"), F.sum(F.length("pii_type") + 2).alias("put"))
    both = texts.join(redacted, "record_id").join(sums, "record_id", "left")
    grown = F.length("redacted") - F.length("description_raw") - F.coalesce("put", F.lit(0)) + F.coalesce("cut", F.lit(0))
    same = F.when(F.col("put").isNull(), F.col("redacted").eqNullSafe(F.col("description_raw"))).otherwise(F.lit(True))
    return both.where((F.coalesce(grown, F.lit(0)) != 0) | ~same).select("record_id")


def p1_labelers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each labeler said over all descriptions, and its estimated reliability."""
    return pii.labelers(_described(spark, sf_dir), "record_id", "description_raw", _things(spark, sf_dir))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, jobs, trust = (table(spark, sf_dir, t) for t in ("topdev_duplicates", "job_postings_gold_template", "source_trust"))
    return consensus.members(
        clusters, jobs, trust, SURVIVING, group="cluster_id", indices="member_indices",
        sources=F.col("members.source"), index="record_index", source="source", latest="collected_at")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _members(spark, sf_dir)
    fields = consensus.survivors(rows, SURVIVING).select("cluster", "field", "member")
    records = consensus.best_records(rows, SURVIVING).select("cluster", F.lit("record").alias("field"), "member")
    return fields.unionByName(records).select(
        F.col("cluster").alias("cluster_id"), F.col("field").alias("field_name"), F.col("member").cast("int").alias("member_index"))


def p3_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving posting of every cluster: its best record, and each field's consensus value."""
    rows = _members(spark, sf_dir)
    fields = consensus.survivors(rows, SURVIVING).groupBy("cluster").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in SURVIVING])
    records = consensus.best_records(rows, SURVIVING).withColumnRenamed("member", "representative_index")
    return records.join(fields, "cluster", "left").withColumnRenamed("cluster", "cluster_id")


def p3_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields by an open vote in which many less trusted members can outweigh a trusted one."""
    fields = consensus.survivors(_members(spark, sf_dir), SURVIVING, dominant=False)
    return fields.select(F.col("cluster").alias("cluster_id"), F.col("field").alias("field_name"), F.col("member").cast("int").alias("member_index"), "value")


def _raw_values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    """(record_index, field_name, kind, value_no, value) of all places, titles and skills, and the reference list."""
    jobs = table(spark, sf_dir, "job_postings_gold_template").select("record_index", "location_raw", "title_raw", "skills_raw")
    reference = [(r.ref_id, r.kind, r.canonical_name, r.aliases) for r in reference_rows(spark, sf_dir)]
    one = lambda field, kind: F.array(F.struct(F.lit(field).alias("field_name"), F.lit(kind).alias("kind"), F.lit(0).alias("value_no"), F.col(field).alias("value")))
    skills = F.transform(
        F.coalesce("skills_raw", F.array().cast("array<string>")),
        lambda s, i: F.struct(F.lit("skills_raw").alias("field_name"), F.lit("skill").alias("kind"), i.alias("value_no"), s.alias("value")))
    return jobs.select("record_index", F.explode(F.concat(one("location_raw", "city"), one("title_raw", "title"), skills)).alias("v")).select("record_index", "v.*"), reference


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values, reference = _raw_values(spark, sf_dir)
    return matching.map_values(values, reference, ["record_index", "field_name", "value_no"]).select("record_index", "field_name", "value_no", "ref_id")


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that mean no entry, with how often each occurs."""
    values, reference = _raw_values(spark, sf_dir)
    rows = matching.map_values(values, reference, ["record_index", "field_name", "value_no"]).where("ref_id < 0")
    return rows.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("times"))


def p5_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries within their distance of every distinct value."""
    values, reference = _raw_values(spark, sf_dir)
    return matching.candidates(values, reference)


def p5_too_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that are further from every name, alias and form of their entry than their edits say: none. A swap counts two here."""
    values, reference = _raw_values(spark, sf_dir)
    forms = matching.short_forms_of(reference)
    paths = [(r, "".join(matching.words(p))) for r, kind, name, aliases in reference for p in (name, *(aliases or ()), *forms.get(kind, {}).get(name, ())) if p]
    of = spark.createDataFrame(paths or [(0, "")], "ref_id bigint, path string").groupBy("ref_id").agg(F.collect_set("path").alias("paths"))
    near = matching.candidates(values, reference).join(F.broadcast(of), "ref_id")  # a row per entry of the reference list
    least = F.array_min(F.transform("paths", lambda p: F.levenshtein(F.col("matched"), p)))
    return near.where(least > 2 * F.col("edits")).select("kind", "value", "ref_id")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each column were mapped, and how many mean no entry."""
    rows = p5_found(spark, sf_dir)
    return rows.groupBy("field_name").agg(
        F.count(F.lit(1)).alias("asked"), F.count_if(F.col("ref_id") >= 0).alias("mapped"), F.count_if(F.col("ref_id") < 0).alias("unmatched"))


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "job_search_salary_offers").select("currency", "refresh_run_id", "normalized_monthly_min")


def _currency():
    tidy = F.upper(F.trim(F.regexp_replace("currency", r"[\s\p{Z}]+", " ")))
    return F.when(tidy != "", tidy).alias("currency")


def p7_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of the monthly minimum per currency; currencies that are not stated are one group."""
    summary = percentiles.summarise(_offers(spark, sf_dir), [_currency()], "normalized_monthly_min")
    return percentiles.percentiles(summary, ["currency"], FRACTIONS).withColumn("value", F.col("value").cast("double"))


def p7_merged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from summaries of single days, rounded to four digits, put together later."""
    days = percentiles.summarise(_offers(spark, sf_dir), [_currency(), F.col("refresh_run_id")], "normalized_monthly_min", digits=4)
    return percentiles.percentiles(percentiles.merge(days, ["currency"]), ["currency"], FRACTIONS, digits=4)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose decoded ids are not their text again: none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encoding.decode(encoding.encode(docs, "doc_id", "text"), "doc_id", "ids").withColumnRenamed("text", "decoded")
    return docs.join(back, "doc_id").where(F.coalesce("text", F.lit("")) != F.col("decoded")).select("doc_id")


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, source and quality weight, in one pass."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return encoding.token_counts(docs, "doc_id", "text", keep={"source": F.lower(F.trim("source")), "weight": mixing.quality_weight(F.col("text"))})


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_over_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mix that are used more often than their source allows, or more than once listed: none."""
    rows = p9_mix(spark, sf_dir).join(table(spark, sf_dir, "mix_targets").select("source", "max_repeats"), "source")
    return rows.groupBy("doc_id").agg(F.sum("copies").alias("copies"), F.max("max_repeats").alias("most"), F.count(F.lit(1)).alias("rows")).where("copies > most OR rows > 1").select("doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_long(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).where("piece_no = 0").select("doc_id")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir)


def p10_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces that are over the limit, do not begin 64 to 67 tokens before the end of the one before, or are not in their text: none."""
    pieces = checkpointed(_pieces(spark, sf_dir))
    before = pieces.select("doc_id", (F.col("piece_no") + 1).alias("piece_no"), (F.col("start_token") + F.col("n_tokens")).alias("ended"))
    chained = pieces.join(before, ["doc_id", "piece_no"], "left").join(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("whole")), "doc_id")
    overlap = F.coalesce(F.col("ended") - F.col("start_token"), F.lit(64))
    first = (F.col("piece_no") == 0) & (F.col("start_token") != 0)
    return chained.where((F.col("n_tokens") > 1024) | ~overlap.between(64, 67) | first | ((F.col("piece_no") > 0) & F.col("ended").isNull()) | ~F.contains("whole", F.col("text"))).select("doc_id", "piece_no")


def p7_out_of_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles put together from rounded days that differ from the exact ones by more than the stated error: none."""
    exact, merged = p7_percentiles(spark, sf_dir).alias("e"), p7_merged_days(spark, sf_dir).alias("m")
    both = exact.join(merged, F.col("e.currency").eqNullSafe(F.col("m.currency")) & (F.col("e.fraction") == F.col("m.fraction")), "full")
    far = F.abs(F.col("e.value") - F.col("m.value")) > F.abs(F.col("e.value")) * F.col("m.relative_error") * 1.0000001
    return both.where(far | F.col("e.n").isNull() | F.col("m.n").isNull() | (F.col("e.n") != F.col("m.n"))).select("e.currency", "e.fraction")


def p3_vote_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open vote where all usable values of a field are single words: there the alignment has one column, and the heaviest word wins."""
    cells = _members(spark, sf_dir).select("cluster", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in SURVIVING])).alias("c")).select("cluster", "c.*")
    plain = cells.where(consensus.usable(F.col("value"))).groupBy("cluster", "field").agg(F.bool_and(~F.col("value").rlike(r"\s|\p{Z}")).alias("words"))
    return p3_vote(spark, sf_dir).join(plain.where("words").select(F.col("cluster").alias("cluster_id"), F.col("field").alias("field_name")), ["cluster_id", "field_name"], "left_semi")


def p3_outvoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields in which the open vote and the most believed member differ."""
    first = consensus.survivors(_members(spark, sf_dir), SURVIVING).select(F.col("cluster").alias("cluster_id"), F.col("field").alias("field_name"), F.col("value").alias("most_believed"))
    voted = p3_vote(spark, sf_dir).select("cluster_id", "field_name", F.col("value").alias("voted"))
    return first.join(voted, ["cluster_id", "field_name"]).where("most_believed <> voted")


_ALL = [
    p1_found, p1_redacted, p1_labelers, p3_found, p3_golden, p3_vote, p3_outvoted, p5_found, p5_report, p5_unmatched, p5_candidates, p7_percentiles, p7_merged_days, p8_ids, p9_mix, p9_shares, p10_found, p10_pieces,
    p1_changed_outside, p3_vote_words, p5_too_far, p7_out_of_bound, p8_round_trip, p9_over_cap, p10_gaps,  # what must hold, after the results themselves
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_FOLD = f"translate(lower(v), '{consensus._ACCENTED}', '{consensus._PLAIN}')"
_KEY = f"trim(regexp_replace({_FOLD}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_FILLER_LIST = ", ".join(f"'{x}'" for x in consensus.FILLERS)
_MEMBERS = f"""
WITH listed AS (
  SELECT DISTINCT cluster_id, unnest(member_indices) AS member, unnest(list_transform(members, lambda m: m.source)) AS stated FROM topdev_duplicates),
ranked AS (
  SELECT l.cluster_id, l.member, coalesce(t.trust_rank, 2147483647) AS trust, j.collected_at AS latest, j.company_name, j.company_industry, j.company_size, j.seniority, j.education_level
  FROM listed l JOIN job_postings_gold_template j ON j.record_index = l.member
  LEFT JOIN source_trust t ON t.source = lower(regexp_replace(coalesce(l.stated, j.source), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'))
  QUALIFY row_number() OVER (PARTITION BY l.cluster_id, l.member ORDER BY coalesce(t.trust_rank, 2147483647)) = 1),
cells AS (
  SELECT cluster_id, member, trust, latest, unnest(['company_name', 'company_industry', 'company_size', 'seniority', 'education_level']) AS field,
         unnest([company_name, company_industry, company_size, seniority, education_level]) AS v FROM ranked),
known AS (SELECT *, v IS NOT NULL AND {_KEY} <> '' AND {_KEY} NOT IN ({_FILLER_LIST}) AS good FROM cells),
best AS (
  SELECT cluster_id, field AS field_name, member AS member_index, v FROM known WHERE good
  QUALIFY row_number() OVER (PARTITION BY cluster_id, field ORDER BY trust, latest DESC NULLS LAST, member) = 1),
counted AS (SELECT cluster_id, member, any_value(trust) AS trust, any_value(latest) AS latest, count(*) FILTER (good) AS filled FROM known GROUP BY ALL),
record AS (
  SELECT cluster_id, 'record' AS field_name, member AS member_index FROM counted
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY filled DESC, trust, latest DESC NULLS LAST, member) = 1)
"""
_P7 = """
WITH asked AS (
  SELECT nullif(upper(trim(regexp_replace(currency, '[\\s\\p{Z}]+', ' ', 'g'))), '') AS currency, normalized_monthly_min AS value
  FROM job_search_salary_offers WHERE normalized_monthly_min IS NOT NULL),
counted AS (SELECT currency, value, count(*) AS c FROM asked GROUP BY ALL),
running AS (
  SELECT *, sum(c) OVER (PARTITION BY currency ORDER BY value) AS upto, sum(c) OVER (PARTITION BY currency) AS n FROM counted)
SELECT currency, fraction, min(value)::DOUBLE AS value, any_value(n)::BIGINT AS n, 0.0::DOUBLE AS relative_error
FROM running, (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])::DOUBLE AS fraction)
WHERE upto >= greatest(ceil(fraction * n - 1e-9), 1) GROUP BY currency, fraction
"""
ORACLE: dict[str, str] = {
    "p3_found": _MEMBERS + "SELECT cluster_id, field_name, member_index FROM best UNION ALL SELECT cluster_id, field_name, member_index FROM record",
    "p3_golden": _MEMBERS + """SELECT r.cluster_id, r.member_index AS representative_index,
  max(v) FILTER (b.field_name = 'company_name') AS company_name, max(v) FILTER (b.field_name = 'company_industry') AS company_industry,
  max(v) FILTER (b.field_name = 'company_size') AS company_size, max(v) FILTER (b.field_name = 'seniority') AS seniority,
  max(v) FILTER (b.field_name = 'education_level') AS education_level
FROM record r LEFT JOIN best b USING (cluster_id) GROUP BY ALL""",
    "p7_percentiles": _P7,
    "p3_vote_words": _MEMBERS + """, w AS (
  SELECT cluster_id, field, v, sum(1.0 / least(trust, 1000)) AS weight, min({'t': trust, 'l': -epoch_us(coalesce(latest, TIMESTAMP '1900-01-01')), 'm': member}) AS b FROM known WHERE good GROUP BY ALL),
only_words AS (SELECT cluster_id, field FROM w GROUP BY ALL HAVING bool_and(NOT regexp_matches(v, '[\\s\\p{Z}]')))
SELECT cluster_id, field AS field_name, b.m AS member_index, v AS value FROM w SEMI JOIN only_words USING (cluster_id, field)
QUALIFY row_number() OVER (PARTITION BY cluster_id, field ORDER BY round(weight, 9) DESC, b) = 1""",
    # invariants: no row may break them
    "p1_changed_outside": "SELECT record_id FROM synthetic_jobs WHERE false",
    "p5_too_far": "SELECT '' AS kind, '' AS value, CAST(0 AS BIGINT) AS ref_id WHERE false",
    "p7_out_of_bound": "SELECT '' AS currency, CAST(0 AS DOUBLE) AS fraction WHERE false",
    "p8_round_trip": "SELECT doc_id FROM documents WHERE false",
    "p9_over_cap": "SELECT doc_id FROM documents WHERE false",
    "p10_gaps": "SELECT doc_id, 0 AS piece_no FROM documents WHERE false",
}
