"""Pay amounts of many units and scales, brought to one currency per month.

Three steps, all as column expressions but for the training of a small model on the driver:
``parse_pay`` reads numbers, scales, currency and period from the text; the columns fill what the
text leaves out; units that neither gives are predicted by calibrated random forests, whose
confident answers are converted while the rest is routed for review.

Defined results: null, blank and amountless texts state no amount; extra months, bonuses,
percentages and days off are no amounts; a side left open is null; a reversed range is put in
order; a unit code without a factor counts as missing; long texts are matched whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.session import checkpointed

# How currencies, periods, scales and bounds are written.
CURRENCIES = {
    "SGD": [r"sgd", r"s\$", r"đô sing", r"đô la sing", r"sing"],
    "USD": [r"usd", r"us\$", r"đô la mỹ", r"đô mỹ", r"đô la", r"đô", r"dollars?", r"\$"],
    "EUR": [r"eur", r"euros?", r"€"],
    "GBP": [r"gbp", r"bảng anh", r"bảng", r"pounds?", r"£"],
    "JPY": [r"jpy", r"yen", r"yên", r"円", r"¥"],
    "KRW": [r"krw", r"won", r"원", r"₩"],
    "VND": [r"vnđ", r"vnd", r"đồng", r"dong", r"₫", r"đ"],
}
PERIODS = {
    "hour": [r"hours?", r"hr", r"h", r"giờ", r"tiếng", r"hourly", r"theo giờ", r"時間", r"時給", r"p\.?h\."],
    "day": [r"days?", r"ngày", r"daily", r"công", r"日給", r"日", r"p\.?d\."],
    "week": [r"weeks?", r"wk", r"tuần", r"weekly", r"週給", r"週", r"p\.?w\."],
    "month": [r"months?", r"mo", r"mth", r"th", r"tháng", r"monthly", r"月給", r"月", r"p\.?m\."],
    "year": [r"years?", r"yr", r"năm", r"yearly", r"annually", r"annum", r"annual", r"年俸", r"年", r"p\.?a\."],
}
SCALES = {
    9: [r"tỷ", r"tỉ", r"billion", r"bn"], 8: [r"億"], 6: [r"triệu", r"trieu", r"tr", r"củ", r"million", r"mil", r"mio", r"m"],
    4: [r"万", r"萬", r"만"], 3: [r"nghìn", r"ngàn", r"nghin", r"ngan", r"thousand", r"k"],
}
LOWER_WORDS = [r"từ", r"from", r"min\.?", r"minimum", r"tối thiểu", r"trên", r"over", r"above", r"at least", r"ít nhất", r"hơn", r"starting at", r">=?"]
UPPER_WORDS = [r"lên đến", r"lên tới", r"up ?to", r"max\.?", r"maximum", r"tối đa", r"đến", r"tới", r"dưới", r"under", r"below", r"không quá", r"<=?"]
NOT_PAY = [
    r"\([^)]*(?:\d\s*%|thử việc|months?|tháng)[^)]*\)", r"[;+|].*$", r",\s*(?:thưởng|bonus|hoa hồng|phụ cấp).*$",
    r"(?:lương )?tháng\s*(?:thứ\s*)?1[3-9](?!\d)", r"\d+\s*(?:%|percent|phần trăm)", r"\d+\s*(?:times|lần|vòng|rounds)\b.*$",
    r"\d+\s*(?:months?|tháng)\s(?:lương|salary|pay|bonus)", r"\d+\s*(?:days?|ngày)\s(?:phép|off|leave|of leave).*$", r"(?<![a-z])x\s*1[2-9](?!\d|[.,' ]\d)",
]
_SEPARATOR = r"\s*(?:-|–|—|−|~|〜|～|to|đến|tới|and|và|→)\s*"
_WIDE, _NARROW = "０１２３４５６７８９，．－／＄￥％（）＋；：", "0123456789,.-/$¥%()+;:"


def _any(words: Sequence[str]) -> str:
    return "(?:" + "|".join(sorted(words, key=len, reverse=True)) + ")"


_CUR = _any([w for ws in CURRENCIES.values() for w in ws])
_SCALE = _any([w for ws in SCALES.values() for w in ws])
_LETTER = r"(?![a-zà-ỹđ])"
_NUMBER = r"\d{1,3}(?:(?:[.,'’ ]\d{3})+(?!\d)(?:[.,]\d{1,2}(?!\d))?)|\d+(?:[.,]\d+)?"


def _side(n: int) -> str:
    cur = rf"(?:{_CUR})"
    return rf"(?<c{n}>{cur})?\s*(?<n{n}>{_NUMBER})\s*(?<s{n}>{_SCALE}(?=\d{{1,3}}(?!\d)|\s*{_CUR}{_LETTER}|{_LETTER}))?(?<t{n}>(?<=tr|triệu)\d{{1,3}}(?![\d.,]))?\s*(?<d{n}>{cur}{_LETTER})?"


#: [bound words] amount [separator amount] [period and other words]
PAY = rf"^(?<pre>[^\d]*?)\s*(?:{_side(1)})(?:{_SEPARATOR}(?:{_side(2)}))?(?<post>[^\d]*)$"
_PARTS = ["pre", "c1", "n1", "s1", "t1", "d1", "c2", "n2", "s2", "t2", "d2", "post"]


def _code(text: Column, table: dict[str, list[str]], whole: bool = True) -> Column:
    out: Column | None = None
    for code, words in table.items():
        test = text.rlike(("^" if whole else r"(?<![a-zà-ỹđ])") + _any(words) + ("$" if whole else r"(?![a-zà-ỹđ])"))
        out = F.when(test, F.lit(code)) if out is None else out.when(test, F.lit(code))
    return out


def _number(text: Column, scale: Column) -> Column:
    """A decimal: two kinds of separators end in the decimal one; a lone one before three digits groups, unless a scale follows a 0."""
    t = F.regexp_replace(text, r"['’ ]", "")
    both = t.rlike(r"\..*,|,.*\.")
    grouped = t.rlike(r"^\d{1,3}(?:\.\d{3})+$|^\d{1,3}(?:,\d{3})+$") & ~(scale.isNotNull() & t.rlike(r"^0[.,]"))
    digits = (
        F.when(both, F.regexp_replace(F.regexp_replace(t, r"[.,](?=.*[.,])", ""), ",", "."))
        .when(grouped, F.regexp_replace(t, "[.,]", "")).otherwise(F.regexp_replace(t, ",", "."))
    )
    return digits.try_cast(T.DecimalType(24, 4))


def parse_pay(text: Column) -> Column:
    """struct(low, high, currency, period) in units of the text; null where no amount of pay is stated.

    low and high are decimals, null on a side left open.
    """
    s = F.lower(F.translate(text, _WIDE, _NARROW))
    s = F.trim(F.regexp_replace(s, r"[\s\p{Z}]+", " "))
    for noise in NOT_PAY:
        s = F.regexp_replace(s, noise, " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    template = "\u0001".join("${%s}" % p for p in _PARTS)
    hit = F.when(s.rlike(PAY), F.split(F.regexp_replace(s, PAY, template), "\u0001"))
    return F.transform(F.array(hit), _read_pay)[0]


def _read_pay(g: Column) -> Column:
    part = {p: F.nullif(F.trim(g[i]), F.lit("")) for i, p in enumerate(_PARTS)}

    def scale(p: str) -> Column:
        out: Column | None = None
        for power, words in SCALES.items():
            test = part[p].rlike("^" + _any(words) + "$")
            out = F.when(test, F.lit(10 ** power)) if out is None else out.when(test, F.lit(10 ** power))
        return out.cast("bigint")

    s1, s2 = scale("s1"), scale("s2")
    tail = lambda p: F.concat(F.lit("0."), part[p]).try_cast(T.DecimalType(24, 4))
    a = _number(part["n1"], s1) + F.coalesce(tail("t1"), F.lit(0).cast(T.DecimalType(24, 4)))
    b = _number(part["n2"], s2) + F.coalesce(tail("t2"), F.lit(0).cast(T.DecimalType(24, 4)))
    low = (a * F.coalesce(s1, s2, F.lit(1)).cast(T.DecimalType(12, 0))).cast(T.DecimalType(30, 4))
    high = (b * F.coalesce(s2, F.lit(1)).cast(T.DecimalType(12, 0))).cast(T.DecimalType(30, 4))
    pre = F.coalesce(part["pre"], F.lit(""))
    ends = lambda words: pre.rlike(r"(?:^|[^a-zà-ỹđ])" + _any(words) + r"\s*$")
    post = F.coalesce(part["post"], F.lit(""))
    upper = ends(UPPER_WORDS)
    lower = ~upper & (ends(LOWER_WORDS) | post.rlike(r"^\s*(?:\+|trở lên|以上|or more|and up)"))
    single = part["n2"].isNull()
    words = F.coalesce(part["c1"], part["d1"], part["c2"], part["d2"])
    return F.when(
        part["n1"].isNotNull(),
        F.struct(
            F.when(single, F.when(~upper, low)).otherwise(F.least(low, high)).alias("low"),
            F.when(single, F.when(~lower, low)).otherwise(F.greatest(low, high)).alias("high"),
            F.coalesce(_code(words, CURRENCIES), _code(post, CURRENCIES, False), _code(pre, CURRENCIES, False)).alias("currency"),
            F.coalesce(_code(post, PERIODS, False), _code(pre, PERIODS, False)).alias("period"),
        ),
    )


def column_unit(value: Column, table: dict[str, list[str]]) -> Column:
    """The unit a column states, whatever its case and outer white space; null if unknown."""
    v = F.lower(F.trim(F.regexp_replace(value, r"[\s\p{Z}]+", " ")))
    return _code(v, table)


@dataclass(frozen=True)
class UnitModel:
    """Random forests with calibrated confidence for the missing unit kinds."""

    stages: dict
    classes: dict
    curves: dict
    accuracy: dict


_FEATURES = ["magnitude", "spread", "source_id", "category_id", "rank_id", "level_id", "currency_id", "period_id"]
CURRENCY_CODES, PERIOD_CODES = list(CURRENCIES), list(PERIODS)


def _features(df: DataFrame, hide: str) -> DataFrame:
    """Numbers for the forest; ``hide`` is the unit kind to be predicted."""
    index = lambda c, codes: F.coalesce(F.array_position(F.array(*[F.lit(x) for x in codes]), c).cast("double"), F.lit(0.0))
    bucket = lambda c, n: F.pmod(F.xxhash64(F.lower(F.trim(c))), F.lit(n)).cast("double")
    nominal = lambda name, value, n: value.alias(name, metadata={"ml_attr": {"type": "nominal", "num_vals": n, "name": name}})  # noqa: E731; a category, not a magnitude
    amount = F.coalesce("low", "high").cast("double")
    return (
        df.withColumn("magnitude", F.log10(F.greatest(amount, F.lit(1e-4))))
        .withColumn("spread", F.coalesce(F.log10(F.greatest(F.col("high").cast("double"), F.lit(1e-4))) - F.col("magnitude"), F.lit(0.0)))
        .select(
            "*", nominal("source_id", bucket(F.col("source"), 61), 61), nominal("category_id", bucket(F.col("category"), 61), 61), nominal("rank_id", bucket(F.col("rank"), 31), 31), nominal("level_id", bucket(F.col("level"), 31), 31),
            nominal("currency_id", F.lit(0.0) if hide == "currency" else index(F.col("currency"), CURRENCY_CODES), len(CURRENCY_CODES) + 1),
            nominal("period_id", F.lit(0.0) if hide == "period" else index(F.col("period"), PERIOD_CODES), len(PERIOD_CODES) + 1))
    )


def training_rows(df: DataFrame, key: str, text: str, rows: int = 4_000) -> DataFrame:
    """The at most ``rows`` rows of smallest key hash whose text has a digit: a bounded sample that no partitioning changes."""
    return df.where(F.col(text).rlike(r"\d")).orderBy(F.xxhash64(F.col(key)), F.col(key), F.col(text)).limit(rows)


def train_unit_model(labelled: DataFrame, trees: int = 20, depth: int = 8, seed: int = 7) -> UnitModel:
    """Fit a forest per unit kind on ``labelled``, a bounded sample (``training_rows``) that went through ``stated_pay``.

    A fifth is held out; there an isotonic curve turns the forest's vote into a calibrated confidence.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    cols = ["key", "low", "high", "source", "category", "rank", "level", "currency", "period"]
    rows = labelled.select(*cols).withColumn("h", F.xxhash64("key"))
    pinned = labelled.sparkSession.createDataFrame(rows.toPandas().astype(object).where(lambda x: x.notna(), None), rows.schema)
    stages, classes, curves, accuracy = {}, {}, {}, {}
    for kind, codes in (("currency", CURRENCY_CODES), ("period", PERIOD_CODES)):
        data = VectorAssembler(inputCols=_FEATURES, outputCol="features").transform(_features(pinned.where(F.col(kind).isNotNull()), kind))
        data = data.withColumn("label", (F.array_position(F.array(*[F.lit(c) for c in codes]), F.col(kind)) - 1).cast("double"))
        fit, held = data.where(F.pmod("h", F.lit(5)) != 0), data.where(F.pmod("h", F.lit(5)) == 0)
        if fit.select("label").distinct().count() < 2 or held.isEmpty():
            continue
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, maxBins=64).fit(fit)
        scored = model.transform(held).select("label", "prediction", F.array_max(vector_to_array("probability")).alias("vote"))
        scored = scored.select((F.col("label") == F.col("prediction")).cast("double").alias("label"), "vote")
        curve = IsotonicRegression(featuresCol="vote", labelCol="label").fit(scored)
        stages[kind], classes[kind] = model, codes
        curves[kind] = list(zip(curve.boundaries.toArray().tolist(), curve.predictions.toArray().tolist()))
        accuracy[kind] = scored.agg(F.avg("label")).first()[0]
    return UnitModel(stages, classes, curves, accuracy)


def _calibrated(vote: Column, curve: list[tuple[float, float]]) -> Column:
    """The isotonic curve, read as a step function from the left (at most as many steps as held-out rows)."""
    steps, last = [], None
    for x, y in curve:
        if y != last:
            steps.append((x, y))
        last = y
    out = F.lit(float(steps[0][1]) if steps else 0.0)
    for x, y in steps:
        out = F.when(vote >= x, F.lit(float(y))).otherwise(out)
    return out


def predict_units(df: DataFrame, model: UnitModel) -> DataFrame:
    """``df`` with a guess and its calibrated confidence for each unit kind."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    keep = df.columns
    for kind in ("currency", "period"):
        if kind not in model.stages:
            df = df.withColumn(f"{kind}_guess", F.lit(None).cast("string")).withColumn(f"{kind}_sure", F.lit(0.0))
        else:
            x = VectorAssembler(inputCols=_FEATURES, outputCol="features").transform(_features(df, kind))
            x = model.stages[kind].transform(x)
            df = x.select(
                *[c for c in df.columns],
                F.element_at(F.array(*[F.lit(c) for c in model.classes[kind]]), F.col("prediction").cast("int") + 1).alias(f"{kind}_guess"),
                _calibrated(F.array_max(vector_to_array("probability")), model.curves[kind]).alias(f"{kind}_sure"),
            )
        keep = [*keep, f"{kind}_guess", f"{kind}_sure"]
    return df.select(*keep)


def model_quality(stated: DataFrame, model: UnitModel, sure: float = 0.9) -> DataFrame:
    """(kind, rows, accuracy, converted, converted_accuracy, routed, calibration_error): the model on rows whose stated units are hidden from it.

    ``calibration_error`` is the mean gap, by tenths of confidence and weighted by rows, between confidence and accuracy.
    """
    said = predict_units(stated, model)
    one = lambda k: F.struct(F.lit(k).alias("kind"), F.col(k).alias("true"), F.coalesce(F.col(f"{k}_guess"), F.lit("")).alias("guess"), F.col(f"{k}_sure").alias("sure"))
    rows = said.select(F.explode(F.array(one("currency"), one("period"))).alias("x")).select("x.*").where("true IS NOT NULL")
    hit = (F.col("guess") == F.col("true")).cast("int")
    tenths = rows.groupBy("kind", F.least(F.floor(F.col("sure") * 10), F.lit(9)).alias("tenth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"), F.sum("sure").alias("sure"), F.count_if(F.col("sure") >= sure).alias("converted"), F.sum(F.when(F.col("sure") >= sure, hit).otherwise(0)).alias("right"))
    return tenths.groupBy("kind").agg(
        F.sum("n").alias("rows"), F.round(F.sum("hits") / F.sum("n"), 4).alias("accuracy"), F.sum("converted").alias("converted"), F.round(F.sum("right") / F.nullif(F.sum("converted"), F.lit(0)), 4).alias("converted_accuracy"),
        F.sum(F.col("n") - F.col("converted")).alias("routed"), F.round(F.sum(F.abs(F.col("sure") - F.col("hits"))) / F.sum("n"), 4).alias("calibration_error"))


def stated_pay(df: DataFrame, key: str, text: str, currency: str, period: str, source: str, category: str, rank: str, level: str) -> DataFrame:
    """(key, low, high, currency, period, currency_from, period_from, source, category, rank, level); a row per text that states an amount."""
    base = df.select(
        F.col(key).alias("key"), parse_pay(F.col(text)).alias("p"),
        column_unit(F.col(currency), CURRENCIES).alias("cc"), column_unit(F.col(period), PERIODS).alias("cp"),
        F.col(source).alias("source"), F.col(category).alias("category"), F.col(rank).alias("rank"), F.col(level).alias("level"),
    ).where("p IS NOT NULL")
    origin = lambda t, c: F.when(t.isNotNull(), "text").when(c.isNotNull(), "column")
    return base.select(
        "key", F.col("p.low").alias("low"), F.col("p.high").alias("high"),
        F.coalesce("p.currency", "cc").alias("currency"), F.coalesce("p.period", "cp").alias("period"),
        origin(F.col("p.currency"), F.col("cc")).alias("currency_from"), origin(F.col("p.period"), F.col("cp")).alias("period_from"),
        "source", "category", "rank", "level",
    )


def to_common_units(stated: DataFrame, factors: list[tuple[str, str, int, int]], model: UnitModel | None, sure: float = 0.9) -> DataFrame:
    """``stated`` with guesses for missing units, ``min_common`` and ``max_common`` (decimal) and ``review``.

    A guessed unit is used where its calibrated confidence is at least ``sure``; rows that still
    lack a unit have null results and ``review`` true. ``factors``: (kind, code, numerator,
    denominator), one row per unit code, so it never grows with the data.
    """
    stated = checkpointed(stated)  # parsed once; its two halves go different ways
    known, lacking = stated.where("currency IS NOT NULL AND period IS NOT NULL"), stated.where("currency IS NULL OR period IS NULL")
    blank = lambda d: d.withColumns({"currency_guess": F.lit(None).cast("string"), "currency_sure": F.lit(None).cast("double"), "period_guess": F.lit(None).cast("string"), "period_sure": F.lit(None).cast("double")})
    guessed = predict_units(lacking, model) if model is not None else blank(lacking)
    rows = blank(known).unionByName(guessed)
    use = lambda k: F.coalesce(F.col(k), F.when(F.col(f"{k}_sure") >= sure, F.col(f"{k}_guess")))
    rows = rows.withColumns({
        "currency_from": F.when(F.col("currency").isNull() & use("currency").isNotNull(), "model").otherwise(F.col("currency_from")),
        "period_from": F.when(F.col("period").isNull() & use("period").isNotNull(), "model").otherwise(F.col("period_from")),
        "currency": use("currency"), "period": use("period"),
    })
    big = T.DecimalType(18, 0)

    def factor(kind: str, code: Column, at: int) -> Column:
        pairs = [F.lit(v) for f in factors if f[0] == kind for v in (f[1], int(f[at]))]
        return (F.create_map(*pairs)[code] if pairs else F.lit(None)).cast(big)

    def common(x: str) -> Column:
        up = (F.col(x).cast(T.DecimalType(20, 2)) * factor("currency", F.col("currency"), 2)).cast(T.DecimalType(36, 2))
        up = (up * factor("period", F.col("period"), 2).cast(T.DecimalType(6, 0))).cast(T.DecimalType(38, 2))
        return (up / (factor("currency", F.col("currency"), 3) * factor("period", F.col("period"), 3)).cast(T.DecimalType(12, 0))).cast(T.DecimalType(36, 2))

    return rows.withColumns({"min_common": common("low"), "max_common": common("high")}).withColumn(
        "review", F.col("min_common").isNull() & F.col("max_common").isNull())
