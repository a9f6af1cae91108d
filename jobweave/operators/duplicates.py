"""Exact and probable duplicates.

Exact: records that share an identity key (or one of several) are connected; every record gets the
smallest id of its component. Components grow by joins of edges, never on the driver.

Probable: a score over fingerprints (title tokens 0.40, company 0.25, skills 0.15, city 0.10,
employment 0.05, salary 0.05; another company is another posting). Records with equal fingerprints are
one class; pairs are between class representatives. Candidates share one of the rarest title tokens
that any pair over the threshold must share (prefix filter), and those of one city the city, too. They
are scored where they meet: what moves between tasks is a few rows per class, never a candidate.

Defined results: null keys connect nothing; empty tables give empty results; ids must be unique; tokens
are not null and hold no U+001F (comparison keys never do).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.functions.text import jaccard
from jobweave.session import checkpointed

#: So many of the most frequent title tokens are put in the order of their frequency; all others come before them, by their text.
HOT_TOKENS = 4096


def _settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, and without its size estimate: that is a product over all joins, so each round would square it."""
    spark, done = df.sparkSession, checkpointed(df)
    return DataFrame(spark._jsparkSession.createDataFrame(done._jdf.toJavaRDD(), done._jdf.schema()), spark)


def connected(records: DataFrame, id_col: str, keys: Sequence[Column]) -> DataFrame:
    """(id, component): smallest id among the records reachable over equal keys; hub labels spread through the keys.

    Each round takes, over keys, the smallest label per key, and back; a record hands what it sees to the
    record it is labelled by, and labels then skip to their labels' labels, so that long chains take few
    rounds. Rounds go on until no label moves. Aggregations combine on the map side, so a key of a third
    of all rows is no larger task than others.
    """
    keyed = records.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.when(k.isNotNull(), F.concat(F.lit(f"{i}|"), k)) for i, k in enumerate(keys)])).alias("key")).where("key IS NOT NULL")
    shared = keyed.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key")  # other keys connect nothing
    edges = checkpointed(keyed.join(shared, "key"))
    labels = edges.select("id", F.col("id").alias("component")).distinct()
    while True:
        by_key = edges.join(labels, "id").groupBy("key").agg(F.min("component").alias("component"))
        seen = edges.join(by_key, "key").groupBy("id").agg(F.min("component").alias("least"))
        now = labels.join(seen, "id", "left").select("id", "component", F.least("component", F.coalesce("least", "component")).alias("least"))
        news = now.where("least < component")
        told = news.select(F.col("component").alias("id"), "least").groupBy("id").agg(F.min("least").alias("told"))
        hooked = _settled(now.join(told, "id", "left").select("id", F.col("component").alias("was"), F.least("least", F.coalesce("told", "least")).alias("component")))
        up = hooked.where("id <> component").select(F.col("id").alias("component"), F.col("component").alias("up"))  # labels that have a smaller label themselves
        after = _settled(hooked.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component"), (F.coalesce("up", "component") < F.col("was")).alias("moved")))
        labels = after.select("id", "component")
        if after.where("moved").isEmpty():
            return records.select(F.col(id_col).alias("id")).distinct().join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def classes(prints: DataFrame) -> DataFrame:
    """(class_id, prints..., copies) and membership: equal fingerprints are one class, named by its smallest id."""
    cols = [c for c in prints.columns if c != "id"]
    return prints.groupBy(*cols).agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"))


def score(a: str, b: str, words: Callable[[Column], Column] = lambda tokens: tokens) -> Column:
    """100 times the similarity of two fingerprints, in exact decimals; ``words`` gives the array of a column of tokens."""
    c = lambda s, n: F.col(f"{s}.{n}")
    same = lambda n: F.when(c(a, n).isNotNull() & (c(a, n) == c(b, n)), 1).otherwise(0)
    alike = lambda n: jaccard(words(c(a, n)), words(c(b, n)))
    ten = "decimal(20,10)"
    total = (
        F.lit(40).cast(ten) * alike("title_tokens") + F.lit(15).cast(ten) * alike("skills")
        + (25 * same("company") + 10 * same("city") + 5 * same("employment") + 5 * same("salary")).cast(ten))
    return F.round(total, 6)  # thirds of tokens would else end just below a threshold


def _packed(tokens: Column) -> Column:
    """``tokens`` as one text, each after a U+001F: as arrays they take half as much again where rows are shuffled."""
    return F.when(F.size(tokens) > 0, F.concat(F.lit("\u001f"), F.array_join(tokens, "\u001f"))).otherwise("")


def _unpacked(text: Column) -> Column:
    return F.slice(F.split(text, "\u001f"), 2, 2**31 - 1)


def _rarest_first(prints: DataFrame, tokens: Column, most: int) -> Column:
    """``tokens`` in one order for all rows, about the rarest first: a literal of at most ``most`` frequent tokens ranks them."""
    slots = max(1, most // 8)
    slot = lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int")
    names: list[list[str]] = [[] for _ in range(slots)]
    times: list[list[int]] = [[] for _ in range(slots)]
    counted = prints.select(F.explode("title_tokens").alias("token")).where("token IS NOT NULL").groupBy("token").count()
    for r in counted.orderBy(F.desc("count"), "token").limit(most).select("token", "count", slot(F.col("token")).alias("slot")).collect():
        names[r["slot"]].append(r["token"])
        times[r["slot"]].append(r["count"])
    literal = lambda x, kind: F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), f"array<array<{kind}>>")  # noqa: E731  arrays, not maps: two equal literals of maps are unequal to Spark, which would then shuffle both sides of a self-join
    names_at, times_at = literal(names, "string"), literal(times, "bigint")
    n = lambda t: F.get(times_at[slot(t)], F.array_position(names_at[slot(t)], t).cast("int") - 1)
    ordered = F.array_sort(F.transform(F.array_distinct(tokens), lambda t: F.struct(F.coalesce(n(t), F.lit(0)).alias("n"), t.alias("token"))))
    return F.transform(ordered, lambda x: x["token"])


def _bits(tokens: Column) -> Column:
    """A bit of 64 for each of ``tokens``; several may have the same."""
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda bits, t: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))


def _most_alike(n: str, bits: str) -> Column:
    """What the Jaccard similarity of l and r is at most: each bit that only one has is at least one token that only it has.

    In doubles: whole numbers are checked for overflow at each step, which took most of the join's time.
    """
    own = lambda x, y: F.col(f"{x}.{n}") - F.bit_count(F.col(f"{x}.{bits}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{bits}")))).cast("double")
    shared = F.least(own("l", "r"), own("r", "l"))
    return shared / F.greatest(F.col(f"l.{n}") + F.col(f"r.{n}") - shared, F.lit(1.0))


def probable_pairs(prints: DataFrame, threshold: int = 80) -> DataFrame:
    """(left_id, right_id, score) between classes of the same company whose score reaches ``threshold`` (of 100, over 60).

    The other features add at most 60, 50 between cities, and less where a class lacks some, so a pair must
    share a part of its title tokens; the first that it shares is among the ceil-bounded rarest tokens of
    both. It is found there and only there: pairs of one city by (company, city, token), others by
    (company, token). A bound on the score by counts and bits goes before the score itself.
    """
    if threshold <= 60:
        raise ValueError("below 60 a pair need not share a title token; use a threshold over 60")
    lacks = lambda points, is_lacking: F.when(is_lacking, points).otherwise(0)
    lack = lacks(5, F.col("employment").isNull()) + lacks(5, F.col("salary").isNull()) + lacks(15, F.col("skills_n") == 0)
    c = classes(prints).withColumns({  # no filter here: it would work out the prints once more, before they are grouped
        "known": F.col("company").isNotNull(), "company": F.coalesce("company", F.lit("")), "title_tokens": _rarest_first(prints, F.col("title_tokens"), HOT_TOKENS)})
    c = c.withColumns({
        "title_n": F.size("title_tokens").cast("double"), "title_bits": _bits(F.col("title_tokens")),
        "skills_n": F.coalesce(F.size(F.array_distinct("skills")), F.lit(0)).cast("double"), "skills_bits": F.coalesce(_bits(F.col("skills")), F.lit(0))})

    def rarest(near: bool) -> Column:
        least = (F.lit(threshold - (60 if near else 50)) + lack) / F.lit(40.0)
        kept = (F.col("title_n") - F.ceil(F.col("title_n") * least * F.lit(1 - 1e-6)) + 1).cast("int")
        kept = F.when(F.col("known") & F.col("city").isNotNull() if near else F.col("known"), kept).otherwise(0)
        return F.transform(F.slice("title_tokens", F.lit(1), F.greatest(kept, F.lit(0))), lambda t: F.struct(F.lit(near).alias("near"), t.alias("token")))

    keyed = c.withColumns({"key": F.explode(F.concat(rarest(True), rarest(False))), "title_tokens": _packed(F.col("title_tokens")), "skills": _packed(F.col("skills"))}).select("key.*", *[x for x in c.columns if x not in ("known", "copies")])
    both = lambda n: F.col(f"l.{n}") == F.col(f"r.{n}")
    place = lambda s: F.when(F.col(f"{s}.near"), F.col(f"{s}.city")).otherwise("")
    points = lambda n, yes: F.when(yes, n).otherwise(0.0)
    bound = (F.lit(25.0) + points(10.0, F.col("l.near")) + points(5.0, both("employment")) + points(5.0, both("salary"))
             + F.lit(40.0) * _most_alike("title_n", "title_bits") + F.lit(15.0) * _most_alike("skills_n", "skills_bits"))
    first = F.get(F.array_intersect(_unpacked(F.col("l.title_tokens")), _unpacked(F.col("r.title_tokens"))), 0)
    apart = F.col("l.near") | ~F.coalesce(both("city"), F.lit(False))
    met = keyed.alias("l").join(keyed.alias("r"), both("company") & both("near") & (place("l") == place("r")) & both("token") & (F.col("l.class_id") < F.col("r.class_id")) & apart & (bound >= threshold - 1e-5))
    # Many meet, few are scored: that is kept out of the join's loop (by coalesce to no fewer partitions, and explode, which no filter is pushed through), which else is too long to be compiled.
    scored = met.coalesce(2**31 - 1).select(F.col("l.class_id").alias("left_id"), F.col("r.class_id").alias("right_id"), F.explode(F.when(first == F.col("l.token"), F.array(score("l", "r", _unpacked)))).alias("score"))
    return scored.where(F.col("score") >= threshold)


def decide(score_: Column) -> Column:
    return F.when(score_ >= 80, "PROBABLE_DUPLICATE").when(score_ >= 60, "POSSIBLE_DUPLICATE").otherwise("DISTINCT")


def representatives(members: DataFrame, component: str, id_col: str) -> DataFrame:
    """(component, id, members) with the smallest id first, for reports."""
    w = Window.partitionBy(component)
    return members.withColumn("members", F.count(F.lit(1)).over(w)).withColumn("is_representative", F.col(id_col) == F.min(id_col).over(w))
