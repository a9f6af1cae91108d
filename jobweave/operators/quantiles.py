"""Exact interpolated quantiles per group, without a group's values in one buffer.

Values are reduced to counts, running sums come from ``prefix_sums`` (which cuts a hot group into value
ranges), and the two values around each wanted rank are interpolated, as in SQL's continuous percentile.

Defined results: null values do not count; a group without values has no row; a null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.operators.prefix import prefix_sums
from jobweave.session import checkpointed


def quantiles(df: DataFrame, groups: Sequence[str], value: Column, fractions: dict[str, float]) -> DataFrame:
    """(groups, a column per name of ``fractions``)."""
    valued = df.select(*groups, value.cast("double").alias("v")).where("v IS NOT NULL")
    counts = checkpointed(valued.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy(*groups).agg(F.sum("n").alias("total")).alias("t")
    running = prefix_sums(counts, groups, "v", [], "n").alias("r")
    rows = running.join(totals, F.expr("true") if not groups else _same(groups)).select("r.*", "t.total")
    first, last = F.col("running") - F.col("n"), F.col("running") - 1  # the ranks from 0 that a row of counts holds
    at = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    held = lambda rank: F.max(F.when(rank.between(first, last), F.col("v")))
    ends = rows.groupBy(*groups).agg(*[x for n, p in fractions.items() for x in (held(F.floor(at(p))).alias(f"_{n}_a"), held(F.ceil(at(p))).alias(f"_{n}_b"), F.max(at(p) - F.floor(at(p))).alias(f"_{n}_w"))])
    return ends.select(*groups, *[(F.col(f"_{n}_a") + (F.col(f"_{n}_b") - F.col(f"_{n}_a")) * F.col(f"_{n}_w")).alias(n) for n in fractions])


def _same(groups: Sequence[str]) -> Column:
    out = F.lit(True)
    for g in groups:
        out = out & F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}"))
    return out


def joined(left: DataFrame, right: DataFrame, groups: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, groups that are null included."""
    both = left.alias("r").join(right.alias("t"), _same(groups), how)
    return both.select("r.*", *[F.col(f"t.{c}") for c in right.columns if c not in groups])
