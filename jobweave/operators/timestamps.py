"""Timestamps of many notations and zones, brought to one instant (microseconds since 1970 UTC).

An ordered cascade of anchored patterns; the first that matches decides, and what it names must
exist (strict: no 30 February, no hour 25). A zone or offset in the text counts, then the
row's own zone, then the one looked up for its source (``source_zones`` learns such a lookup), then the default. Local times that occur twice or not at all follow an explicit
policy. Everything is a column expression; nothing leaves the JVM.

Defined results: null, blank, relative and impossible texts give null; an unknown zone column
counts as missing, an unknown zone in the text gives null; digits beyond microseconds are cut;
24:00 is the next midnight; texts of any length are matched whole, so a long text is no instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names by language, numbered 1 to 12.
MONTHS = [
    ["january", "jan", "januar", "jän", "jänner"], ["february", "feb", "februar"], ["march", "mar", "märz", "mär"],
    ["april", "apr"], ["may", "mai"], ["june", "jun", "juni"], ["july", "jul", "juli"], ["august", "aug"],
    ["september", "sep", "sept"], ["october", "oct", "oktober", "okt"], ["november", "nov"], ["december", "dec", "dezember", "dez"],
]
# Zone abbreviations and their offset in minutes.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
    "ist": 330, "ict": 420, "wib": 420, "sgt": 480, "hkt": 480, "pht": 480, "awst": 480, "jst": 540, "kst": 540,
    "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}
DEFAULT_ZONE = "Asia/Ho_Chi_Minh"
MONTH_FIRST_LOCALES = ("en-us", "en_us")

_TIME = r"(?<H>\d{1,2}):(?<M>\d{2})(?::(?<S>\d{2})(?:[.,](?<f>\d{1,9}))?)?(?:\s?(?<ap>[ap])\.?m\.?)?"
_ZONE = r"(?:\s?\(?(?<z>z|[+-]\d{2}:?\d{2}|[+-]\d{2}|(?:gmt|utc)\s?[+-]\d{1,2}(?::?\d{2})?|[a-z]{2,5})\)?)?(?:\[(?<r>[a-z_/+\-0-9]+)\])?"
_NAME = r"(?<b>[a-zäöüéû]{3,9})"
_TAIL = rf"(?:[,\s]\s?{_TIME}{_ZONE})?"
#: name, pattern, order of the date's numbers: ymd, dmy (a day, b month), or local (by the row's locale)
CASCADE = [
    ("iso", rf"^(?<y>\d{{4}})-(?<b>\d{{2}})-(?<a>\d{{2}})(?:[t\s]{_TIME}{_ZONE})?$", "dmy"),
    ("basic", r"^(?<y>\d{4})(?<b>\d{2})(?<a>\d{2})(?:t(?<H>\d{2})(?<M>\d{2})(?<S>\d{2})(?:[.,](?<f>\d{1,9}))?(?<z>z|[+-]\d{2}:?(?:\d{2})?)?)?$", "dmy"),
    ("week", r"^(?<y>\d{4})-?w(?<b>\d{2})-?(?<a>\d)$", "week"),
    ("ordinal", r"^(?<y>\d{4})-(?<a>\d{3})$", "ordinal"),
    ("named", rf"^(?:[a-zäöü]{{2,10}}\.?,\s?)?(?<a>\d{{1,2}})(?:st|nd|rd|th|\.)?\s{_NAME}\.?,?\s(?<y>\d{{4}}){_TAIL}$", "named"),
    ("month first", rf"^(?:[a-z]{{3,9}},\s?)?{_NAME}\.?\s(?<a>\d{{1,2}})(?:st|nd|rd|th)?,?\s(?<y>\d{{4}}){_TAIL}$", "named"),
    ("vietnamese", rf"^(?:ngày\s)?(?<a>\d{{1,2}})\stháng\s(?<b>\d{{1,2}})(?:,|\snăm|,\snăm)?\s(?<y>\d{{4}}){_TAIL}$", "dmy"),
    ("japanese", rf"^(?<y>\d{{4}})年\s?(?<b>\d{{1,2}})月\s?(?<a>\d{{1,2}})日(?:[,\s]?\s?{_TIME}{_ZONE})?$", "dmy"),
    ("year first", rf"^(?<y>\d{{4}})(?<sep>[/.])(?<b>\d{{1,2}})\k<sep>(?<a>\d{{1,2}}){_TAIL}$", "dmy"),
    ("numeric", rf"^(?<a>\d{{1,2}})(?<sep>[/.\-])(?<b>\d{{1,2}})\k<sep>(?<y>\d{{4}}|\d{{2}}){_TAIL}$", "local"),
    ("time first, year first", rf"^{_TIME}{_ZONE},?\s(?<y>\d{{4}})(?<sep>[/.\-])(?<b>\d{{1,2}})\k<sep>(?<a>\d{{1,2}})$", "dmy"),
    ("time first", rf"^{_TIME}{_ZONE},?\s(?<a>\d{{1,2}})(?<sep>[/.\-])(?<b>\d{{1,2}})\k<sep>(?<y>\d{{4}}|\d{{2}})$", "local"),
]
#: What the texts of each pattern begin with.
_BEGINS = {
    "iso": "year", "basic": "year", "week": "year", "ordinal": "year", "named": "both", "month first": "word", "vietnamese": "both", "japanese": "year",
    "year first": "year", "numeric": "day", "time first, year first": "time", "time first": "time",
}
_PARTS = ["y", "b", "a", "H", "M", "S", "f", "ap", "z", "r"]
_WIDE = "０１２３４５６７８９：／－．，　"
_NARROW = "0123456789:/-., "


def _let(value: Column, body) -> Column:
    """A name for a value, so that it is worked out once."""
    return F.transform(F.array(value), body)[0]


def _cleaned(text: Column) -> Column:
    spaced = F.regexp_replace(F.translate(text, _WIDE + "\u0001\u0002", _NARROW), r"[\s\p{Z}]+", " ")
    return F.lower(F.trim(spaced))


def known_zones(spark: SparkSession) -> list[str]:
    """Region names that the JVM knows (about 600, whatever the data)."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())


def source_zones(df: DataFrame, source: Column, zone: Column, zones: list[str]) -> DataFrame:
    """(source, zone, rows, share): the zone that most rows of each source state, ties going to the first by name; sources that state none have no row."""
    stated = df.select(source.alias("source"), zone.alias("zone")).where(F.col("source").isNotNull() & F.col("zone").isin(zones))
    counted = stated.groupBy("source", "zone").agg(F.count(F.lit(1)).alias("rows"))
    best = counted.groupBy("source").agg(F.min(F.struct((-F.col("rows")).alias("n"), "zone")).alias("b"), F.sum("rows").alias("all"))
    return best.select("source", "b.zone", (-F.col("b.n")).alias("rows"), F.round(-F.col("b.n") / F.col("all"), 4).alias("share"))


def to_instant(local: Column, zone: Column, ambiguous: str = "earlier", skipped: str = "forward") -> Column:
    """Microseconds of a local time (microseconds as if UTC) in a region.

    ambiguous: earlier, later or null; skipped: forward (by the skipped length) or null.
    """
    at = F.timestamp_micros(local)
    first = F.to_utc_timestamp(at, zone)
    out = F.unix_micros(first)
    if ambiguous != "earlier":
        day = F.lit(86_400_000_000)
        second = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local + day), zone)) - day
        twice = (second != out) & (F.from_utc_timestamp(F.timestamp_micros(second), zone) == at) & (F.from_utc_timestamp(first, zone) == at)
        out = F.when(twice, second if ambiguous == "later" else F.lit(None)).otherwise(out)
    if skipped == "null":
        out = F.when(F.from_utc_timestamp(first, zone) == at, out)
    return out


def parse_instant(
    text: Column, zone: Column, locale: Column, end_of_day: Column | bool, zones: list[str],
    default_zone: str = DEFAULT_ZONE, source_zone: Column | None = None, ambiguous: str = "earlier", skipped: str = "forward",
) -> Column:
    """Microseconds since 1970 UTC, or null where ``text`` names no instant.

    A date alone is the first microsecond of the local day, or its last where ``end_of_day``.
    ``source_zone`` is the zone of the row's source, which counts where ``zone`` is null or unknown.
    """
    source_zone = F.lit(None).cast("string") if source_zone is None else source_zone
    if isinstance(end_of_day, bool):
        end_of_day = F.lit(end_of_day)
    return _let(_cleaned(text), lambda s: _let(_matched(s), lambda hit: _let(
        F.struct(F.when(hit.startswith("\u0002"), F.split(F.substr(hit, F.lit(2)), "\u0001")).alias("g"), s.alias("s"), zone.alias("zone"), source_zone.alias("source_zone"), F.lower(locale).alias("locale"), end_of_day.alias("end")),
        lambda x: _assemble(x, zones, default_zone, ambiguous, skipped))))


def _matched(s: Column) -> Column:
    """What the first pattern that matches says: a mark, the pattern's number and its parts; else the text itself.

    The patterns are tried in order, each once: a replacement that matches puts the mark in front, after
    which no pattern, all being anchored and none having the mark, matches again. Texts are sent to those patterns only that their first
    characters allow.
    """
    def tried(kinds: str) -> Column:
        out = s
        for i, (name, pattern, _) in enumerate(CASCADE):
            if _BEGINS[name] == kinds or (_BEGINS[name] == "both" and kinds in ("day", "word")):
                template = "\u0002" + "\u0001".join([str(i), *[f"${{{p}}}" if f"(?<{p}>" in pattern else "" for p in _PARTS]])
                out = F.regexp_replace(out, pattern, template)
        return out

    shape = F.translate(F.left(s, F.lit(5)), "123456789", "000000000")
    return (
        F.when(shape.startswith("0000"), tried("year")).when(shape.startswith("00:") | shape.startswith("0:"), tried("time"))
        .when(shape.startswith("0"), tried("day")).otherwise(tried("word")))


def _assemble(x: Column, zones: list[str], default_zone: str, ambiguous: str, skipped: str) -> Column:
    g = x["g"]
    part = {p: F.nullif(g[i + 1], F.lit("")) for i, p in enumerate(_PARTS)}
    number = {p: part[p].try_cast("int") for p in ("y", "b", "a", "H", "M", "S")}
    order = F.element_at(F.array(*[F.lit(c[2]) for c in CASCADE]), g[0].cast("int") + 1)
    month_names = F.create_map(*[F.lit(v) for i, names in enumerate(MONTHS) for n in names for v in (n, i + 1)])
    month_first = (order == "local") & x["locale"].isin(*MONTH_FIRST_LOCALES)
    year = F.when(number["y"] < 100, number["y"] + 2000).otherwise(number["y"])
    month = F.when(order == "named", month_names[part["b"]]).when(month_first, number["a"]).otherwise(number["b"])
    day = F.when(month_first, number["b"]).otherwise(number["a"])
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    plain = F.concat_ws("-", pad(year, 4), pad(month, 2), pad(day, 2)).try_cast("date")
    jan4 = F.concat(pad(year, 4), F.lit("-01-04")).try_cast("date")
    week_day = F.date_add(jan4, (number["b"] - 1) * 7 + number["a"] - 1 - F.weekday(jan4))
    week_ok = number["a"].between(1, 7) & (F.weekofyear(week_day) == number["b"])
    jan1 = F.concat(pad(year, 4), F.lit("-01-01")).try_cast("date")
    nth = F.date_add(jan1, number["a"] - 1)
    date = (
        F.when(order == "week", F.when(week_ok, week_day))
        .when(order == "ordinal", F.when((number["a"] >= 1) & (F.year(nth) == year), nth))
        .otherwise(F.when(month.isNotNull() & day.isNotNull(), plain))
    )
    hour = (
        F.when(part["ap"].isNull(), number["H"])
        .when(number["H"].between(1, 12), number["H"] % 12 + F.when(part["ap"] == "p", 12).otherwise(0))
    )
    second = F.coalesce(number["S"], F.lit(0))
    micro = F.rpad(F.left(F.coalesce(part["f"], F.lit("0")), F.lit(6)), 6, "0").cast("long")
    time_ok = (hour.between(0, 23) & number["M"].between(0, 59) & second.between(0, 59)) | ((hour == 24) & (number["M"] == 0) & (second == 0) & (micro == 0))
    dated = part["H"].isNull()
    of_day = F.when(dated, F.when(x["end"], F.lit(86_399_999_999)).otherwise(F.lit(0))).when(
        time_ok, ((hour * 60 + number["M"]).cast("long") * 60 + second) * 1_000_000 + micro)
    local = F.unix_date(date).cast("long") * 86_400_000_000 + of_day
    offset_text = F.regexp_replace(F.regexp_replace(part["z"], r"^(?:gmt|utc)\s?(?=[+-])", ""), r"^([+-])(\d)$", r"$10$2")
    digits = F.rpad(F.regexp_replace(F.substring(offset_text, 2, 6), ":", ""), 4, "0")
    minutes = F.when(
        offset_text.rlike(r"^[+-]\d{2}"),
        F.when(F.left(offset_text, F.lit(1)) == "-", -1).otherwise(1) * (F.left(digits, F.lit(2)).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")),
    ).otherwise(F.create_map(*[F.lit(v) for kv in ABBREVIATIONS.items() for v in kv])[offset_text])
    regions = F.create_map(*[F.lit(v) for z in zones if "/" in z or z == "UTC" for v in (z.lower(), z)])
    known = F.when(x["zone"].isin(zones), x["zone"]).when(x["source_zone"].isin(zones), x["source_zone"])
    epoch = (
        F.when(x["s"].rlike(r"^\d{10}$"), x["s"].try_cast("long") * 1_000_000)
        .when(x["s"].rlike(r"^\d{13}$"), x["s"].try_cast("long") * 1_000)
        .when(x["s"].rlike(r"^\d{16}$"), x["s"].try_cast("long"))
    )

    def placed(v: Column) -> Column:
        with_offset = F.when(F.abs(v["minutes"]) <= 18 * 60, v["local"] - v["minutes"].cast("long") * 60_000_000)
        region = F.when(v["r"].isNotNull(), regions[v["r"]]).otherwise(F.coalesce(v["known"], F.lit(default_zone)))
        in_region = F.when(region.isNotNull() & v["local"].isNotNull(), to_instant(v["local"], region, ambiguous, skipped))
        return F.when(v["z"].isNotNull(), with_offset).otherwise(in_region)

    values = F.struct(local.alias("local"), minutes.alias("minutes"), part["z"].alias("z"), part["r"].alias("r"), known.alias("known"))
    return F.when(epoch.isNotNull(), epoch).when(g.isNotNull(), _let(values, placed))
