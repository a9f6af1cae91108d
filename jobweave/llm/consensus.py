"""One surviving record per duplicate group, field by field, by token-level consensus.

The usable values of a field are aligned token by token (progressive alignment, heaviest first);
each column of the alignment is voted on by weight, a gap being a vote too; the survivor is the
existing value closest to the voted tokens, by weighted token edits, ties going to the heavier value.

Weights follow a strict order of belief (trust rank, then latest, then smallest index). With
``dominant`` each value weighs more than all less believed ones together, so that the consensus is
the most believed usable value; otherwise a value's weight is the sum of its holders' trust weights.

A group of any size is voted in two rounds: values are spread over CHUNKS by hash. With ``dominant`` the
chunks' survivors vote again: the most believed value wins its chunk and the group. In the open vote a
chunk hands on all its votes, as values up to HANDED, else as the columns of their alignment with the
summed weight of every token; the columns of all are aligned and voted, and every value's distance to
the outcome is taken in its chunk. Equal values are merged before either round.

Defined results: null, blank and filler values are not usable; a field without a usable value has no
row; members listed twice count once, with their best trust; members without a record are left out; a
group of no known member has no row; equal records are ordered by all their fields.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.session import checkpointed

CHUNKS = 1_024
HANDED = 32  # values of a chunk that go on as they are
# Texts that say only that a value is unknown, pending or withheld (lower case, no accents or marks).
FILLERS = [
    "n a", "na", "none", "null", "nil", "nan", "unknown", "undefined", "unspecified", "not specified", "not available", "not applicable", "not provided",
    "not disclosed", "undisclosed", "no information", "no data", "tbd", "tba", "tbc", "to be determined", "to be announced", "to be confirmed", "to be updated",
    "updating", "update later", "pending", "coming soon", "confidential", "hidden", "hidden by employer", "hidden company", "private", "secret", "withheld",
    "anonymous", "company confidential", "confidential company", "chua ro", "khong ro", "chua biet", "khong biet", "chua cap nhat", "dang cap nhat",
    "se cap nhat", "cap nhat sau", "khong co", "khong co thong tin", "chua co", "chua co thong tin", "khong xac dinh", "chua xac dinh", "an danh",
    "cong ty an danh", "bao mat", "cong ty bao mat", "thong tin bao mat", "khong tiet lo", "khong cong khai", "an", "x", "xxx",
]
_ACCENTED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
_PLAIN = "aaaaaaaaaaaaaaaaaeeeeeeeeeeeiiiiiooooooooooooooooouuuuuuuuuuuyyyyyd"


def plain_key(value: Column) -> Column:
    """Lower case, without accents or marks, one space between words."""
    bare = F.regexp_replace(F.translate(F.lower(value), _ACCENTED, _PLAIN), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))


def usable(value: Column) -> Column:
    """Not null, blank, bare punctuation or a filler."""
    key = plain_key(value)
    return value.isNotNull() & (key != "") & ~key.isin(FILLERS)


def align(a: list[list[tuple[str, float]]], b: list[str], weight: float) -> list[list[tuple[str, float]]]:
    """Columns of votes ``a`` with the tokens of one more value aligned to them; "" is a gap."""
    held = sum(w for _, w in a[0]) if a else 0.0
    m, n = len(a), len(b)
    cost = [[0.0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        cost[i][0] = cost[i - 1][0] + 1
    for j in range(1, n + 1):
        cost[0][j] = cost[0][j - 1] + 1
    gain = [[0.0 if any(t == x for t, _ in col) else 1.5 for x in b] for col in a]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + gain[i - 1][j - 1], cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, i, j = [], m, n
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + gain[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append([*a[i], (b[j], weight)])
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append([*a[i], ("", weight)])
        else:
            j -= 1
            out.append([("", held), (b[j], weight)])
    return out[::-1]


def distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Token edits between two values."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def survivor(values: Sequence[str], weights: Sequence[float]) -> int:
    """The position of the surviving value; values come most believed first."""
    tokens = [v.split() for v in values]
    columns: list[list[tuple[str, float]]] = [[(t, weights[0])] for t in tokens[0]]
    for t, w in zip(tokens[1:], weights[1:]):
        columns = align(columns, t, w)
    voted = []
    for column in columns:
        votes: dict[str, float] = {}
        for t, w in column:
            votes[t] = votes.get(t, 0.0) + w
        if best := max(votes, key=lambda t: votes[t]):
            voted.append(best)
    return min(range(len(values)), key=lambda i: (distance(tokens[i], voted), i))


Profile = tuple[float, list[dict[str, float]]]  # the weight of all values, and by column the weight of each token; "" is a gap


def profile(value: str, weight: float) -> Profile:
    return weight, [{t: weight} for t in value.split()]


def merged(a: Profile, b: Profile) -> Profile:
    """The columns of both aligned, by the costs of ``align``; every column keeps the weight of all values. ``a`` is used up."""
    (x, left), (y, right) = a, b
    m, n = len(left), len(right)
    gain = [[0.0 if (c.keys() & d.keys()) - {""} else 1.5 for d in right] for c in left]
    cost = [[float(i + j) for j in range(n + 1)] for i in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + gain[i - 1][j - 1], cost[i - 1][j] + 1, cost[i][j - 1] + 1)

    def put(column: dict[str, float], more: dict[str, float]) -> dict[str, float]:
        for t, w in more.items():
            column[t] = column.get(t, 0.0) + w
        return column

    out, i, j = [], m, n
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + gain[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append(put(left[i], right[j]))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append(put(left[i], {"": y}))
        else:
            j -= 1
            out.append(put({"": x}, right[j]))
    return x + y, out[::-1]


def profile_of(items: Sequence[Profile]) -> Profile:
    """All of them merged, in their order."""
    whole = items[0]
    for item in items[1:]:
        whole = merged(whole, item)
    return whole


def voted(whole: Profile) -> list[str]:
    """The token of most weight of every column, without gaps; sums that differ by their rounding tie, and the first seen wins."""
    best = [max(column, key=lambda t: round(column[t], 9)) for column in whole[1]]
    return [t for t in best if t]


def _open_vote(values: DataFrame) -> DataFrame:
    """(cluster, field, value, belief, weight) -> (cluster, field, value, belief): each group's value closest to the vote of all."""
    keys = ["cluster", "field"]

    @F.pandas_udf("string")
    def packed(values: pd.Series, weights: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(profile_of([profile(x, y) for x, y in zip(v, w)])) for v, w in zip(values, weights)])

    @F.pandas_udf("array<string>")
    def vote(values: pd.Series, weights: pd.Series, profiles: pd.Series) -> pd.Series:
        return pd.Series([voted(profile_of([profile(x, y) if p is None else tuple(json.loads(p)) for x, y, p in zip(v, w, ps)])) for v, w, ps in zip(values, weights, profiles)])

    @F.pandas_udf("array<int>")
    def closest(values: pd.Series, outcomes: pd.Series) -> pd.Series:
        return pd.Series([min((distance(x.split(), list(o)), i) for i, x in enumerate(v)) for v, o in zip(values, outcomes)])

    of = lambda column, part: F.transform(column, lambda x: x[part])
    chunk = F.pmod(F.xxhash64("value"), F.lit(CHUNKS)).alias("chunk")
    chunks = checkpointed(values.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(F.struct("belief", "value", "weight"))).alias("v")))
    few, many = chunks.where(F.size("v") <= HANDED), chunks.where(F.size("v") > HANDED)
    handed = few.select(*keys, F.explode("v").alias("x")).select(*keys, "x.*", F.lit(None).cast("string").alias("profile"))
    handed = handed.unionByName(many.select(
        *keys, F.col("v")[0]["belief"].alias("belief"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("double").alias("weight"), packed(of("v", "value"), of("v", "weight")).alias("profile")))
    groups = handed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("belief", "value", "weight", "profile"))).alias("x"))
    alone = (F.size("x") == 1) & F.col("x")[0]["profile"].isNull()
    lone = groups.where(alone).select(*keys, F.col("x")[0]["value"].alias("value"), F.col("x")[0]["belief"].alias("belief"))
    outcome = groups.where(~alone).select(*keys, vote(of("x", "value"), of("x", "weight"), of("x", "profile")).alias("outcome"))
    asked = chunks.select(*keys, "chunk").join(outcome, keys)  # by chunk, so that a hot group's values stay apart
    near = chunks.join(asked, [*keys, "chunk"]).withColumn("at", closest(of("v", "value"), F.col("outcome")))
    nearest = near.groupBy(*keys).agg(F.min(F.struct(F.col("at")[0].alias("distance"), F.col("v")[F.col("at")[1]]["belief"].alias("belief"), F.col("v")[F.col("at")[1]]["value"].alias("value"))).alias("m"))
    return lone.unionByName(nearest.select(*keys, "m.value", "m.belief"))


def _round(rows: DataFrame, keys: Sequence[str], dominant: bool) -> DataFrame:
    """(keys, value, belief, weight) -> one survivor per group of ``keys``; lone values skip Python."""

    @F.pandas_udf("int")
    def pick(values: pd.Series, weights: pd.Series) -> pd.Series:
        half = lambda n: [2.0 ** -min(i, 1000) for i in range(n)]
        return pd.Series([survivor(v, half(len(v)) if dominant else w) for v, w in zip(values, weights)])

    groups = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("belief", "value", "weight"))).alias("v"))
    lone = groups.where(F.size("v") == 1).select(*keys, F.col("v")[0].alias("s"))
    many = groups.where(F.size("v") > 1).withColumn("i", pick(F.transform("v", lambda x: x["value"]), F.transform("v", lambda x: x["weight"])))
    chosen = lone.unionByName(many.select(*keys, F.col("v")[F.col("i")].alias("s")))
    return chosen.select(*keys, F.col("s.value").alias("value"), F.col("s.belief").alias("belief"), F.col("s.weight").alias("weight"))


def members(groups: DataFrame, records: DataFrame, trust: DataFrame, fields: Sequence[str], *, group: str, indices: str, sources: Column, index: str, source: str, latest: str) -> DataFrame:
    """(cluster, member, belief, trust, fields): a row per group and known member, with its place in the order of belief."""
    listed = groups.select(F.col(group).alias("cluster"), F.explode(F.arrays_zip(F.col(indices).alias("i"), sources.alias("s"))).alias("m"))
    listed = listed.select("cluster", F.col("m.i").alias("member"), F.col("m.s").alias("stated")).where("cluster IS NOT NULL AND member IS NOT NULL").distinct()
    own = records.select(F.col(index).alias("member"), F.col(source).alias("own"), F.col(latest).alias("latest"), *[F.col(f) for f in fields])
    tidy = lambda c: F.lower(F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " ")))
    ranked = trust.groupBy(tidy(F.col("source")).alias("by")).agg(F.min("trust_rank").alias("rank"))
    rows = listed.join(own, "member").withColumn("by", tidy(F.coalesce("stated", "own"))).join(ranked, "by", "left")
    us = F.unix_micros(F.col("latest").cast("timestamp"))
    belief = F.struct(F.coalesce("rank", F.lit(2 ** 31 - 1)).cast("int").alias("rank"), (-F.coalesce(us, F.lit(-(2 ** 62)))).alias("age"), "member")
    return rows.groupBy("cluster", "member").agg(F.min(F.struct(belief.alias("belief"), *fields)).alias("r")).select("cluster", "member", "r.*")


def survivors(rows: DataFrame, fields: Sequence[str], dominant: bool = True) -> DataFrame:
    """(cluster, field, member, value): the surviving value of every field, and its most believed holder, from ``members``."""
    cells = rows.select("cluster", "belief", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("c"))
    cells = cells.select("cluster", "belief", "c.field", "c.value").where(usable(F.col("value")))
    weight = F.lit(1.0) / F.least(F.col("belief.rank"), F.lit(1000))
    values = cells.groupBy("cluster", "field", "value").agg(F.min("belief").alias("belief"), F.sum(weight).alias("weight"))
    if not dominant:
        return _open_vote(values).select("cluster", "field", F.col("belief.member").alias("member"), "value")
    chunked = _round(values.withColumn("chunk", F.pmod(F.xxhash64("value"), F.lit(CHUNKS))), ["cluster", "field", "chunk"], dominant)
    final = _round(chunked, ["cluster", "field"], dominant)
    return final.select("cluster", "field", F.col("belief.member").alias("member"), "value")


def best_records(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(cluster, member): the member with most usable values, then the most believed."""
    filled = sum((F.when(usable(F.col(f)), 1).otherwise(0) for f in fields), F.lit(0))
    best = rows.groupBy("cluster").agg(F.min(F.struct((-filled).alias("missing"), "belief")).alias("b"))
    return best.select("cluster", F.col("b.belief.member").alias("member"))
