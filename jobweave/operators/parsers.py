"""Deterministic readers of raw job fields, as column expressions.

Each takes raw columns and gives a struct with the reading, a rule confidence and the rule's name.
Null and blank inputs have a defined reading of their own; nothing is guessed that is not stated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.functions.text import comparison_key, display, title_case

MONEY = T.DecimalType(20, 2)
YEARS = T.DecimalType(6, 2)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _folded(text: Column) -> Column:
    return F.replace(F.lower(F.translate(text, "０１２３４５６７８９．，–—−", "0123456789.,---")), F.lit("₫"), F.lit(" vnd "))


# --- salary ---------------------------------------------------------------------------------
# The patterns of stated currency, period, tax basis and bounds.
SALARY_NUMBER = r"(?U)(?<![\w.])(\d+(?:[.,]\d+)*)(?:(?=\s*(?:k|triệu|trieu|million|mn|mio)\b)|(?!\w))(?=((?s).{0,15}))"
SALARY_WORDS = {
    "usd": r"(?U)(?<!\w)(?:usd|us\s*dollars?|dollars?)(?!\w)|\$", "vnd": r"(?U)(?<!\w)(?:vnd|vnđ|đồng)(?!\w)",
    "hour": r"(?U)/\s*(?:h|hr|hour)\b|\b(?:per\s+)?hour(?:ly)?\b|\b(?:mỗi\s+)?giờ\b",
    "month": r"(?U)/\s*(?:mo|month)\b|\b(?:per\s+)?month(?:ly)?\b|\b(?:mỗi\s+)?tháng\b",
    "year": r"(?U)/\s*(?:yr|year)\b|\b(?:per\s+)?year(?:ly)?\b|\bannual(?:ly)?\b|\b(?:mỗi\s+)?năm\b",
    "gross": r"(?U)(?<!\w)gross(?!\w)|\btrước\s+thuế\b", "net": r"(?U)(?<!\w)net(?!\w)|\bsau\s+thuế\b",
    "negotiable": r"(?U)\bnegotiable\b|\bthỏa\s+thuận\b|\bthoa\s+thuan\b|\bthương\s+lượng\b",
    "upper": r"(?U)\b(?:up\s+to|maximum|max|tối\s+đa|đến)\b", "lower": r"(?U)\b(?:from|minimum|min|at\s+least|từ|ít\s+nhất)\b",
    "millions": r"(?U)^\s*(?:triệu|trieu|million|mn|mio)\b|^\s*(?:-|to|đến)\s*\d+(?:[.,]\d+)*\s*(?:triệu|trieu|million)\b",
    "thousands": r"(?U)^\s*(?:k\b|thousand\b)|^\s*(?:-|to)\s*\d+(?:[.,]\d+)*\s*k\b",
}


def _amount(token: Column) -> Column:
    """Two kinds of separators: the last is the decimal one; one kind: groups if three digits follow or it repeats."""
    dot, comma = F.instr(token, "."), F.instr(token, ",")
    last_dot = F.length(token) - F.instr(F.reverse(token), ".") > F.length(token) - F.instr(F.reverse(token), ",")
    both = F.when(last_dot, F.replace(token, F.lit(","), F.lit(""))).otherwise(F.replace(F.replace(token, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    grouped = token.rlike(r"[.,]\d+[.,]|^\d+[.,]\d{3}$")
    one = F.when(grouped, F.regexp_replace(token, "[.,]", "")).otherwise(F.replace(token, F.lit(","), F.lit(".")))
    return F.when((dot > 0) & (comma > 0), both).otherwise(one).try_cast(T.DecimalType(30, 6))


def parse_salary(raw: Column) -> Column:
    """struct(minimum, maximum, currency, period, salary_type, disclosed, confidence, shape)."""
    w = SALARY_WORDS

    def read(t: Column) -> Column:
        one_of = lambda a, b: F.when(a & ~b, 1).when(b & ~a, 2)
        cur = one_of(t.rlike(w["usd"]), t.rlike(w["vnd"]))
        currency = F.when(cur == 1, "USD").when(cur == 2, "VND")
        spans = F.filter(F.array(*[F.when(t.rlike(w[p]), F.lit(p)) for p in ("hour", "month", "year")]), lambda x: x.isNotNull())
        period = F.when(F.size(spans) == 1, spans[0])
        tax = one_of(t.rlike(w["gross"]), t.rlike(w["net"]))
        basis = F.when(tax == 1, "gross").when(tax == 2, "net")
        scaled = F.zip_with(
            F.regexp_extract_all(t, F.lit(SALARY_NUMBER), 1), F.regexp_extract_all(t, F.lit(SALARY_NUMBER), 2),
            lambda n, after: (_amount(n) * F.when(after.rlike(w["millions"]), 1_000_000).when(after.rlike(w["thousands"]), 1_000).otherwise(1)).cast(MONEY))
        values = F.filter(scaled, lambda v: v.isNotNull())
        stated = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in (currency, period, basis)), F.lit(0))

        def result(v: Column) -> Column:
            a, b = F.try_element_at(v, F.lit(1)), F.try_element_at(v, F.lit(2))
            shape = (
                F.when(t.rlike(w["negotiable"]), "negotiable").when(a.isNull(), "unparsed")
                .when(b.isNotNull(), F.when(a > b, "range_reordered").otherwise("range"))
                .when(t.rlike(w["upper"]), "upper_bound").when(t.rlike(w["lower"]), "lower_bound").otherwise("single_value"))
            told = ~shape.isin("negotiable", "unparsed")
            nothing = F.lit(None).cast(MONEY)
            low = F.when(b.isNotNull(), F.least(a, b)).when(shape == "upper_bound", nothing).otherwise(a)
            high = F.when(b.isNotNull(), F.greatest(a, b)).when(shape == "lower_bound", nothing).otherwise(a)
            confidence = F.when(shape == "negotiable", 1.0).when(shape == "unparsed", 0.0).otherwise(F.least(F.lit(0.99), F.lit(0.72) + F.lit(0.08) * stated))
            return F.struct(
                F.when(told, low).alias("minimum"), F.when(told, high).alias("maximum"), currency.alias("currency"), period.alias("period"),
                F.when(shape == "negotiable", "negotiable").otherwise(basis).alias("salary_type"), told.alias("disclosed"),
                confidence.alias("confidence"), shape.alias("shape"))

        return _let(values, result)

    missing = F.struct(
        F.lit(None).cast(MONEY).alias("minimum"), F.lit(None).cast(MONEY).alias("maximum"), F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("string").alias("period"), F.lit(None).cast("string").alias("salary_type"), F.lit(False).alias("disclosed"),
        F.lit(1.0).alias("confidence"), F.lit("missing").alias("shape"))
    return F.when(raw.isNull() | ~raw.rlike(r"(?U)\S"), missing).otherwise(_let(_folded(raw), read))


# --- experience -----------------------------------------------------------------------------
_N = r"(\d+(?:[.,]\d+)?)"
_Y = r"(?:years?|yrs?)\b"
# The phrases of each rule; the first rule that matches decides.
EXPERIENCE_RULES = [
    ("none", r"\bno\s+(?:work\s+)?experience\s+(?:is\s+)?required\b|\bexperience\s+not\s+required\b|\bkhông\s+(?:yêu\s+cầu|cần)\s+kinh\s+nghiệm\b|\bchưa\s+có\s+kinh\s+nghiệm\b"),
    ("under", rf"\b(?:under|less\s+than|below)\s*{_N}\s*{_Y}|\b(?:dưới|ít\s+hơn)\s*{_N}\s*năm\b"),
    ("range", rf"\b{_N}\s*(?:-|–|—|to)\s*{_N}\s*{_Y}|\b(?:từ\s+)?{_N}\s*(?:-|–|—|đến|tới)\s*{_N}\s*năm\b"),
    ("over", rf"\b(?:more\s+than|over|greater\s+than)\s*{_N}\s*{_Y}|\b(?:hơn|trên)\s*{_N}\s*năm\b"),
    ("months", rf"\b(?:minimum|min(?:imum)?\.?|at\s+least)\s*{_N}\s*(?:months?|mos?)\b|\b(?:tối\s+thiểu|ít\s+nhất)\s*{_N}\s*tháng\b"),
    ("least", rf"\b(?:minimum|min(?:imum)?\.?|at\s+least)\s*{_N}\s*{_Y}|\b{_N}\+\s*{_Y}|\b(?:tối\s+thiểu|ít\s+nhất)\s*{_N}\s*năm\b|\b(?:từ)\s*{_N}\s*năm\b"),
]


def parse_experience(raw: Column) -> Column:
    """struct(minimum_years, maximum_years, minimum_inclusive, maximum_inclusive, confidence, rule); absence is never zero."""

    def read(t: Column) -> Column:
        rule: Column | None = None
        for name, pattern in EXPERIENCE_RULES:
            hit = t.rlike("(?U)" + pattern)
            rule = F.when(hit, F.lit(name)) if rule is None else rule.when(hit, F.lit(name))
        rule = rule.otherwise(F.lit("unparsed"))

        def number(name: str, groups: Sequence[int]) -> Column:
            pattern = "(?U)" + dict(EXPERIENCE_RULES)[name]
            found = F.coalesce(*[F.nullif(F.regexp_extract(t, pattern, g), F.lit("")) for g in groups])
            return F.replace(found, F.lit(","), F.lit(".")).try_cast(T.DecimalType(20, 6))

        low, high = number("range", (1, 3)), number("range", (2, 4))
        valid = low <= high
        name = F.when((rule == "range") & ~valid, "invalid_range").otherwise(rule)
        minimum = (
            F.when(name == "none", F.lit(0)).when(name == "range", low).when(name == "over", number("over", (1, 2)))
            .when(name == "months", (number("months", (1, 2)) / 12).cast(T.DecimalType(20, 6))).when(name == "least", number("least", (1, 2, 3, 4))))
        maximum = F.when(name == "none", F.lit(0)).when(name == "under", number("under", (1, 2))).when(name == "range", high)
        sure = F.when(name == "none", 1.0).when(name == "range", 0.99).when(name.isin("under", "over", "months", "least"), 0.98).otherwise(0.0)
        return F.struct(
            minimum.cast(YEARS).alias("minimum_years"), maximum.cast(YEARS).alias("maximum_years"), name.isin("none", "range", "months", "least").alias("minimum_inclusive"),
            name.isin("none", "range").alias("maximum_inclusive"), sure.alias("confidence"), name.alias("rule"))

    missing = F.struct(
        F.lit(None).cast(YEARS).alias("minimum_years"), F.lit(None).cast(YEARS).alias("maximum_years"), F.lit(False).alias("minimum_inclusive"),
        F.lit(False).alias("maximum_inclusive"), F.lit(1.0).alias("confidence"), F.lit("missing").alias("rule"))
    return F.when(raw.isNull() | ~raw.rlike(r"(?U)\S"), missing).otherwise(_let(F.lower(raw), read))


# --- titles ---------------------------------------------------------------------------------
# Title categories in order of priority, each with its pattern.
TITLE_CATEGORIES = [
    ("Full-stack", r"\bfull[\s-]?stack\b"),
    ("AI/Machine Learning", r"\b(?:ai(?: software| solution)?|agentic|ml|machine learning|nlp|computer vision|mlops)\s+(?:engineer(?:ing)?|developer|scientist|architect)\b"),
    ("Data Scientist", r"\b(?:data|decision|applied)\s+scientist\b"),
    ("Data Engineer", r"\b(?:data|big data|data platform|analytics)\s+engineer\b|\betl\s+developer\b"),
    ("Business Intelligence", r"\b(?:business intelligence|bi|power bi)\s+(?:developer|engineer|analyst)\b|\b(?:business model validation|model validation) analyst\b.*\bbi\b"),
    ("Data Analyst", r"\b(?:data|product|marketing|reporting)\s+analyst\b"),
    ("DevOps/Cloud/SRE", r"\b(?:devops|cloud|platform|site reliability|sre|infrastructure)\s+(?:engineer|architect)\b|\bsite reliability\b|\b(?:giai phap cloud|data center|thiet ke giai phap cntt)\b"),
    ("Cybersecurity", r"\b(?:cyber ?security|security|soc|infosec|appsec)\s+(?:engineer|analyst|specialist)|\bpenetration tester\b|\ban toan thong tin\b"),
    ("Mobile", r"\b(?:mobile(?: app)?|android|ios|flutter|react native)\s+(?:game )?(?:developer|engineer)\b"),
    ("QA/Testing", r"\b(?:qa|qc|sdet|test(?: automation)?|manual test)\s*(?:engineer|tester)?\b|\btester\b"),
    ("Embedded/IoT", r"\b(?:embedded(?: software)?|firmware|iot|bsp)\s+(?:developer|engineer)\b"),
    ("ERP", r"\b(?:sap|erp|dynamics 365|oracle erp|odoo)\s+(?:consultant|developer|engineer)\b"),
    ("Business Analyst", r"\b(?:business|system|requirements|functional|technical|it ba)\s+analyst\b|\bit ba\b"),
    ("Product Management", r"\b(?:technical )?product (?:manager|owner)\b"),
    ("Project Management", r"\b(?:it |technical )?project manager\b|\b(?:scrum master|delivery manager|project coordinator)\b"),
    ("UI/UX", r"\b(?:ui(?:/ux)?|ui ux|ux ui|ux|product|interaction)\s+(?:designer|researcher|artist)\b"),
    ("IT Support/System Administration", r"\b(?:it|desktop)\s+support\b|\bhelp ?desk\b|\b(?:system|network|database) administrator\b|\bsysadmin\b|\bdba\b|\b(?:van hanh ha tang cntt|ha tang cntt)\b"),
    ("Frontend", r"\b(?:front[\s-]?end|frontend|fe|web ui|react|vue|angular)\s+(?:developer|engineer)\b"),
    ("Backend", r"\b(?:back[\s-]?end|backend|api|server[\s-]?side|java|\.net)\s+(?:developer|engineer)\b"),
]
NON_IT_TITLE = r"(?i)\b(?:sales|marketing|digital marketing|business development)\b"
ACRONYMS = ["AI", "BI", "ERP", "FE", "iOS", "IoT", "IT", "ML", "NLP", "QA", "QC", "SAP", "SDET", "SOC", "SRE", "UI/UX", "UX"]


def display_title(raw: Column) -> Column:
    t = F.trim(F.regexp_replace(raw, r"(?U)\s+", " "))
    for pattern, word in ((r"back[\s-]?end", "Backend"), (r"front[\s-]?end", "Frontend"), (r"full[\s-]?stack", "Full-stack")):
        t = F.regexp_replace(t, rf"(?iU)\b{pattern}\b", word)
    t = title_case(t)
    for word in ACRONYMS:
        written = "/".join(x[0].upper() + x[1:].lower() for x in word.split("/"))
        t = F.regexp_replace(t, rf"(?U)\b{written}\b", word)
    return t


def classify_title(raw: Column) -> Column:
    """struct(primary_category, secondary_categories, confidence): categories by where they begin, then by priority."""
    key = F.replace(F.coalesce(comparison_key(raw), F.lower(raw)), F.lit("_"), F.lit(" "))

    def read(x: Column) -> Column:
        hits = []
        for i, (name, pattern) in enumerate(TITLE_CATEGORIES):
            at = F.nullif(F.regexp_instr(x["raw"], F.lit("(?i)" + pattern)), F.lit(0))
            at = F.coalesce(at, F.nullif(F.regexp_instr(x["key"], F.lit("(?i)" + pattern)), F.lit(0)))
            hits.append(F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit(i).alias("i"), F.lit(name).alias("name"))))
        found = F.array_sort(F.filter(F.array(*hits), lambda h: h.isNotNull()))
        names = F.when(x["key"].rlike(NON_IT_TITLE), F.array().cast("array<string>")).otherwise(F.transform(found, lambda h: h["name"]))
        return _let(names, lambda n: F.struct(
            F.coalesce(F.try_element_at(n, F.lit(1)), F.lit("Unclassified")).alias("primary_category"), F.slice(n, 2, 99).alias("secondary_categories"),
            F.when(F.size(n) == 0, 0.0).when(F.size(n) == 1, 0.95).otherwise(0.82).alias("confidence")))

    return F.when(raw.isNotNull(), _let(F.struct(raw.alias("raw"), key.alias("key")), read))


# --- companies, places, employment, work mode ------------------------------------------------
# Legal forms in order of search, names that hide the company, city aliases.
LEGAL_FORMS = [
    ("joint stock company", "Joint Stock Company"), ("công ty cổ phần", "Công ty Cổ phần"), ("cong ty co phan", "Công ty Cổ phần"), ("công ty tnhh", "Công ty TNHH"),
    ("cong ty tnhh", "Công ty TNHH"), ("limited liability company", "LLC"), ("corporation", "Corporation"), ("company limited", "Limited"), ("limited", "Limited"),
    ("ltd", "Ltd"), ("llc", "LLC"), ("jsc", "JSC"), ("ctcp", "CTCP"), ("tnhh", "TNHH"), ("corp", "Corp"),
]
HIDDEN_COMPANIES = ["hidden company", "confidential", "ẩn danh", "n/a"]
CITIES = {
    "Ho Chi Minh City": ["tp hcm", "hcm", "ho chi minh", "ho chi minh city", "sai gon"], "Hanoi": ["ha noi", "hanoi"], "Da Nang": ["da nang"],
    "Binh Duong": ["binh duong"], "Dong Nai": ["dong nai"], "Hai Phong": ["hai phong"], "Can Tho": ["can tho"],
}
EMPLOYMENT = [
    ("INTERNSHIP", r"\b(?:internship|intern|thực tập)\b"), ("PART_TIME", r"\b(?:part[ -]?time|bán thời gian)\b"), ("FULL_TIME", r"\b(?:full[ -]?time|toàn thời gian)\b"),
    ("FREELANCE", r"\bfreelance\b"), ("APPRENTICESHIP", r"\b(?:apprenticeship|học việc)\b"), ("TEMPORARY", r"\b(?:temporary|tạm thời)\b"), ("CONTRACT", r"\b(?:contract|hợp đồng)\b"),
]
WORK_MODES = [
    ("HYBRID", r"\b(?:hybrid|kết hợp)\b"), ("REMOTE", r"\b(?:remote work|work from home|wfh|làm việc từ xa)\b"), ("FLEXIBLE", r"\b(?:flexible location|linh hoạt địa điểm)\b"),
    ("ONSITE", r"\b(?:on[ -]?site|tại văn phòng|làm việc trực tiếp)\b"),
]
NOT_REMOTE = r"(?iU)\b(?:remote interview|support remote users)\b"
REMOTE_PLACE = r"(?iU)\b(?:remote|work from home|wfh|làm việc từ xa|flexible location)\b"
DISTRICT = r"(?iU)\b(?:quận|q\.)\s*([0-9]+)\b|\b(thủ đức)\b"


def normalise_company(raw: Column, aliases: dict[str, str] | None = None) -> Column:
    """struct(name, key, legal_form, confidence): hidden names give nulls, aliases come first, then the first legal form found is cut."""
    known = F.create_map(*[F.lit(x) for kv in (aliases or {"": ""}).items() for x in kv])

    def read(x: Column) -> Column:
        hidden = x["key"].isNull() | x["key"].isin(HIDDEN_COMPANIES)
        form: Column | None = None
        for words, name in LEGAL_FORMS:
            test = x["key"].rlike(rf"(?U)(?<!\w){words}(?!\w)")
            pair = F.struct(F.lit(words).alias("words"), F.lit(name).alias("name"))
            form = F.when(test, pair) if form is None else form.when(test, pair)
        cut = F.nullif(F.trim(F.regexp_replace(F.regexp_replace(x["key"], F.concat(F.lit(r"(?U)(?<!\w)"), form["words"], F.lit(r"(?!\w)")), F.lit(" ")), " +", " ")), F.lit(""))
        alias = known[x["key"]]
        key = F.when(alias.isNotNull(), comparison_key(alias)).otherwise(F.coalesce(F.when(form.isNotNull(), cut), x["key"]))
        return F.struct(
            F.when(~hidden, F.coalesce(alias, x["shown"])).alias("name"), F.when(~hidden, key).alias("key"), F.when(~hidden & alias.isNull(), form["name"]).alias("legal_form"),
            F.when(hidden, 1.0).when(alias.isNotNull(), 0.99).otherwise(0.95).alias("confidence"))

    return _let(F.struct(display(raw).alias("shown"), comparison_key(raw).alias("key")), read)


def normalise_location(raw: Column) -> Column:
    """struct(city, district, country, cities, remote_only, confidence); a city only if exactly one is named."""
    key = comparison_key(raw)

    def read(k: Column) -> Column:
        found = F.filter(F.array(*[
            F.when(F.exists(F.array(*[F.lit(a) for a in names]), lambda a: F.contains(k, a)), F.lit(city)) for city, names in CITIES.items()
        ]), lambda c: c.isNotNull())
        found = F.coalesce(found, F.array().cast("array<string>"))
        remote = F.coalesce(raw.rlike(REMOTE_PLACE), F.lit(False))
        number = F.nullif(F.regexp_extract(raw, DISTRICT, 1), F.lit(""))
        named = F.nullif(F.regexp_extract(raw, DISTRICT, 2), F.lit(""))
        return F.struct(
            F.when(F.size(found) == 1, found[0]).alias("city"), F.when(number.isNotNull(), F.concat(F.lit("District "), number)).when(named.isNotNull(), "Thu Duc").alias("district"),
            F.when(F.size(found) > 0, "Vietnam").alias("country"), found.alias("cities"), (remote & (F.size(found) == 0)).alias("remote_only"),
            F.when(k.isNull(), 1.0).when((F.size(found) > 0) | remote, 0.95).otherwise(0.0).alias("confidence"))

    return _let(key, read)


def _hits(text: Column, rules: Sequence[tuple[str, str]], skip: Column, sure: float) -> Column:
    found = F.array(*[F.when(text.rlike("(?iU)" + p), F.struct(F.lit(v).alias("value"), F.lit(sure).alias("sure"))) for v, p in rules])
    kept = F.filter(found, lambda h: h.isNotNull())
    return F.when(text.isNull() | (text == "") | skip, F.slice(kept, 1, 0)).otherwise(kept)


def employment_type(raw: Column, fallback: Column) -> Column:
    """struct(value, confidence): the source's own value first, then title or description."""
    raw = F.trim(raw)
    other = lambda t: F.coalesce(F.lower(t) == "other", F.lit(False))
    found = F.concat(_hits(raw, EMPLOYMENT, other(raw), 0.98), _hits(fallback, EMPLOYMENT, other(fallback), 0.75))
    return _let(found, lambda f: F.struct(
        F.coalesce(F.try_element_at(f, F.lit(1))["value"], F.lit("UNSPECIFIED")).alias("value"),
        F.coalesce(F.try_element_at(f, F.lit(1))["sure"], F.when(raw.isNull() | (raw == "") | other(raw), 1.0).otherwise(0.0)).alias("confidence")))


def work_mode(raw: Column, fallback: Column) -> Column:
    """struct(value, confidence, conflict): texts about remote interviews or users do not count."""
    raw = F.nullif(F.trim(raw), F.lit(""))
    false = lambda t: F.coalesce(t.rlike(NOT_REMOTE), F.lit(False))
    found = F.concat(_hits(raw, WORK_MODES, false(raw), 0.98), _hits(fallback, WORK_MODES, false(fallback), 0.75))

    def read(f: Column) -> Column:
        first = F.try_element_at(f, F.lit(1))
        conflict = F.size(F.array_distinct(F.transform(f, lambda h: h["value"]))) > 1
        sure = F.when(conflict, F.least(first["sure"], F.lit(0.6))).otherwise(first["sure"])
        return F.struct(F.coalesce(first["value"], F.lit("UNSPECIFIED")).alias("value"), F.coalesce(sure, F.when(raw.isNull(), 1.0).otherwise(0.0)).alias("confidence"), conflict.alias("conflict"))

    return _let(found, read)
