"""Job pages: links of a listing, JSON-LD postings of a detail page, closed state, scope.

Pages are rows with an html column; everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.functions.text import job_id_of

# How states, tags and titles are written.
EXPLICIT_STATE = r"(?i)data-job-state\s*=\s*[\"'](closed|expired)[\"']"
ACTIVE_STATE = r"(?i)data-application-state\s*=\s*[\"'](active|open)[\"']"
IT_CATEGORIES = ["information technology", "công nghệ thông tin"]
TECHNICAL_TAG = (r"(?iU)\b(?:python|java|javascript|golang|c#|c/c\+\+|sql|postgresql?|mysql|mongodb|redis|linux|cloud|docker|kubernetes|fastapi|asp\.net|\.net|back-?end|devops|database|server|network|"
                 r"data analytics|big data|data visualization|ui design|ux/ui design|game developer|unity|ai|tensorflow|computer vision|infrastructure|solution architect|it comtor)\b")
NON_IT_TAG = (r"(?iU)\b(?:autocad|revit|cad|marketing|content|tiktok|sales|talent acquisition|hr|accounting|legal|law|social media|business development|business coordinator|ngân hàng|tài chính|kiểm toán|kế toán)\b")
IT_TITLE = (r"(?iU)\b(?:data analyst|business analyst(?: it)?|product owner|technical project manager|erp consultant|system administrator|it support|qa/qc|embedded engineer|dba|it comtor|solution architect|cloud|"
            r"data center|machine learning|ai\b|devops|back[ -]?end|front[ -]?end|full[ -]?stack|software engineer|game developer)\b|\b(?:giải pháp cntt|hạ tầng cntt|công nghệ thông tin|an toàn thông tin)\b")


def listing_links(pages: DataFrame, html: str, base: str, hosts: list[str]) -> DataFrame:
    """(base, url, job_id): the distinct job links of allowed hosts, without query and fragment."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"'#?]+)"), 1)
    root = F.regexp_extract(F.col(base), r"^(https?://[^/]+)", 1)
    links = pages.select(F.col(base).alias("base"), root.alias("root"), F.explode(F.array_distinct(hrefs)).alias("href"))
    url = F.when(F.col("href").rlike("^(?i)https?://"), F.col("href")).when(F.col("href").startswith("/"), F.concat("root", "href"))
    out = links.select("base", url.alias("url")).where(F.lower(F.regexp_extract("url", r"^(?i)https?://([^/]+)", 1)).isin(hosts))
    return out.withColumn("job_id", job_id_of(F.col("url"))).where("job_id IS NOT NULL").distinct()


def postings(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, posting): JobPosting objects of all JSON-LD blocks as variants; blocks that are no JSON are skipped."""
    blocks = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    roots = pages.select(F.col(key), F.explode(blocks).alias("block")).select(key, F.try_parse_json("block").alias("v")).where("v IS NOT NULL")
    whole = F.array("v")
    as_list = F.try_variant_get("v", "$", "array<variant>")
    graph = F.try_variant_get("v", "$['@graph']", "array<variant>")
    objects = roots.select(key, F.explode(F.concat(F.coalesce(as_list, whole), F.coalesce(graph, F.slice(whole, 1, 0)))).alias("posting"))
    return objects.where(F.try_variant_get("posting", "$['@type']", "string") == "JobPosting")


def posting_fields(found: DataFrame, key: str) -> DataFrame:
    """The raw fields of each posting, as text."""
    v = lambda path, kind="string": F.nullif(F.trim(F.try_variant_get("posting", path, kind)), F.lit(""))
    listed = F.try_variant_get("posting", "$.skills", "array<string>")
    skills = F.coalesce(listed, F.split(v("$.skills"), r"\s*[,;|]\s*"))
    places = F.array_distinct(F.filter(F.array(*[v(f"$.jobLocation.address.{p}") for p in ("streetAddress", "addressLocality", "addressRegion", "addressCountry")]), lambda x: x.isNotNull()))
    low, high, one = (F.try_variant_get("posting", f"$.baseSalary.value.{p}", "string") for p in ("minValue", "maxValue", "value"))
    bare = v("$.baseSalary.value")  # a value that is an object has its parts above
    amount = F.coalesce(F.concat(low, F.lit("-"), high), low, high, one, F.when(~bare.startswith("{"), bare))
    unit = F.coalesce(v("$.baseSalary.value.unitText"), v("$.baseSalary.unitText"))
    salary = F.when(F.lower(amount).rlike("negotiable|thỏa thuận"), amount).otherwise(F.concat(amount, F.coalesce(F.concat(F.lit(" "), v("$.baseSalary.currency")), F.lit("")), F.coalesce(F.concat(F.lit("/"), F.lower(unit)), F.lit(""))))
    months = F.try_variant_get("posting", "$.experienceRequirements.monthsOfExperience", "int")
    return found.select(
        key, v("$.title").alias("title_raw"), v("$.hiringOrganization.name").alias("company_name_raw"), F.filter(skills, lambda s: s != "").alias("skills_raw"),
        F.nullif(F.array_join(places, ", "), F.lit("")).alias("location_raw"), salary.alias("salary_raw"), F.concat(F.lit("minimum "), months.cast("string"), F.lit(" months")).alias("experience_raw"),
        v("$.employmentType").alias("employment_type_raw"), v("$.datePosted").alias("posted_at_raw"), v("$.validThrough").alias("expires_at_raw"), v("$.description").alias("description_raw"))


def closed_state(html: Column, expires_us: Column, fetched_us: Column) -> Column:
    """struct(state, method, confidence): an explicit marker, then the expiry (inclusive), then an open application."""
    marker = F.lower(F.regexp_extract(html, EXPLICIT_STATE, 1))
    decided = lambda state, method, sure: F.struct(state.alias("state"), F.lit(method).alias("method"), F.lit(sure).alias("confidence"))
    return (
        F.when(F.coalesce(marker, F.lit("")) != "", decided(F.when(marker == "expired", "EXPIRED").otherwise("CLOSED"), "explicit_marker", 1.0))
        .when(expires_us.isNotNull() & fetched_us.isNotNull(), decided(F.when(expires_us < fetched_us, "EXPIRED").otherwise("ACTIVE"), "valid_through", 0.98))
        .when(F.coalesce(html.rlike(ACTIVE_STATE), F.lit(False)), decided(F.lit("ACTIVE"), "application_state", 0.95))
        .otherwise(decided(F.lit("UNKNOWN"), "insufficient_evidence", 0.0)))


def invalid_page_type(url: Column) -> Column:
    """What a url without a job id leads to, by its path."""
    path = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1))
    has = lambda x: F.coalesce(F.contains(path, F.lit(x)), F.lit(False))
    return F.when(has("/companies/"), "company page").when(has("/tim-kiem") | has("/jobs/search"), "category/listing page").otherwise("duplicate or malformed URL")


def scope_decision(discovery: Column, category: Column, tags: Column, title: Column, classified: Column, skills: Column | None = None) -> Column:
    """struct(accepted, reason): whether a posting is of information technology, by the first rule that applies; ``skills`` are those found in it."""
    skilled = F.lit(False) if skills is None else F.coalesce(F.size(skills) > 0, F.lit(False))
    joined = F.coalesce(F.array_join(tags, " | "), F.lit(""))
    technical, other = joined.rlike(TECHNICAL_TAG), joined.rlike(NON_IT_TAG)
    verdict = lambda ok, why: F.struct(F.lit(ok).alias("accepted"), F.lit(why).cast("string").alias("reason"))
    return (
        F.when(~F.coalesce(discovery.startswith("it_listing_html"), F.lit(False)), verdict(False, "invalid_discovery_method"))
        .when(category.isNotNull() & ~F.lower(F.trim(category)).isin(IT_CATEGORIES), verdict(False, "source_category_non_it"))
        .when(other & ~technical, verdict(False, "source_tags_non_it")).when(technical, verdict(True, None))
        .when((F.coalesce(classified, F.lit("Unclassified")) != "Unclassified") | skilled, verdict(True, None)).when(F.coalesce(title.rlike(IT_TITLE), F.lit(False)), verdict(True, None))
        .otherwise(verdict(False, "insufficient_it_evidence")))
