"""Mixing sources to target shares of the total size in tokens.

Every source gets a budget of tokens. The whole source is repeated as often as it fits (complete
epochs, at most its cap); the rest is filled by weighted sampling without replacement after
Efraimidis and Spirakis: each document draws an exponential key divided by its quality weight, the
documents are ordered by key within their source, and those whose running token sum fits are taken.

The total is the largest at which no source needs more than its capped repeats, or the caller's.
Shares of sources that have no tokens are spread over the others in proportion, and reported as 0.

Defined results: documents without a source, or of one without a target, are not part of the mix; a
document without tokens is never drawn; a source of one long document may stay under its share by less
than that document; ties of keys are broken by the document id; targets may be empty, so is the mix then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.operators.prefix import prefix_sums
from jobweave.session import checkpointed


def _all():
    """One window over all rows of a table that does not grow with the data."""
    return Window.partitionBy(F.lit(0))


def quality_weight(text: Column) -> Column:
    """0.05 to 1: the share of letters times the share of distinct words among the words."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", "")) / F.greatest(F.length(text), F.lit(1))
    distinct = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    return F.least(F.greatest(F.coalesce(letters * F.sqrt(distinct), F.lit(0.0)), F.lit(0.05)), F.lit(1.0))


def _budgets(sized: DataFrame, targets: DataFrame, total_tokens: float | None) -> DataFrame:
    """A row per target: tokens there are, budget, complete epochs and the tokens left to draw."""
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    rows = targets.join(have, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    usable = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    rows = rows.withColumn("share", F.when(usable, F.col("target_share")).otherwise(F.lit(0.0)))
    rows = rows.withColumns({  # windows over the targets, a table that does not grow with the data
        "present": F.sum("share").over(_all()),
        "reach": F.min(F.when(usable, F.col("tokens") * F.col("max_repeats") / F.col("share"))).over(_all()),
    })
    total = F.lit(float(total_tokens)) if total_tokens else F.col("reach") * F.col("present")
    budget = F.least(F.col("share") / F.col("present") * total, F.col("tokens") * F.col("max_repeats"))
    rows = rows.withColumn("budget", F.when(usable, budget).otherwise(F.lit(0.0)))
    rows = rows.withColumn("epochs", F.when(usable, F.floor(F.col("budget") / F.col("tokens") + F.lit(1e-9))).otherwise(F.lit(0)).cast("int"))
    return rows.withColumn("to_draw", F.greatest(F.col("budget") - F.col("epochs") * F.col("tokens"), F.lit(0.0))).drop("present", "reach", "share")


def mix(sized: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 11) -> DataFrame:
    """(doc_id, source, copies, n_tokens, target_share, actual_share) from (doc_id, source, n_tokens, weight).

    A row per document of the mix; ``actual_share`` is what its source reached.
    """
    sized = checkpointed(sized.where((F.col("n_tokens") > 0) & F.col("source").isNotNull()).select("doc_id", "source", "n_tokens", "weight"))  # read for the budgets, the cut points and the draw
    targets = targets.select("source", "target_share", "max_repeats")
    budgets = checkpointed(_budgets(sized, targets, total_tokens))
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2 ** 52)) + 1) / F.lit(2.0 ** 52 + 1)
    keyed = sized.join(budgets.drop("tokens"), "source").withColumn("draw", -F.log(uniform) / F.col("weight"))
    ordered = prefix_sums(keyed, ["source"], "draw", ["doc_id"], "n_tokens")
    drawn = (F.col("running") <= F.col("to_draw") + F.lit(1e-6)).cast("int")
    rows = checkpointed(ordered.withColumn("copies", F.col("epochs") + drawn).where("copies > 0").select("doc_id", "source", "copies", "n_tokens", "target_share"))
    got = rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("got"))
    got = got.select("source", (F.col("got") / F.sum("got").over(_all())).alias("actual_share"))  # a row per target
    return rows.join(got, "source").select("doc_id", "source", "copies", "n_tokens", "target_share", "actual_share")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_copies): the report, sources without documents included."""
    targets = targets.select("source", "target_share")
    got = mixed.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    rows = targets.join(got, "source", "left").select(
        "source", "target_share", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "most_copies")])
    everything = F.greatest(F.sum("tokens").over(_all()), F.lit(1))
    return rows.select("source", "target_share", (F.col("tokens") / everything).alias("actual_share"), "tokens", "documents", "most_copies")
