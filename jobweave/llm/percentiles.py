"""Exact percentiles of very large numeric columns, from mergeable summaries.

A summary holds one row per (group, value) with its count; summaries of partitions or days are put
together by adding counts. Percentiles come from cumulative frequencies: values are cut into
ranges, window sums run inside each, the totals of the ranges before are added, and the first
value that reaches a target rank is taken. The rank error is 0. With ``digits`` the values are first
rounded to so many significant digits, which bounds the size of a summary whatever the data; the
relative error is then at most 0.5 * 10 ** (1 - digits), and is stated beside each result.

Defined results: null values do not count; a group without values has no row; a null group is a
group; the p-th percentile is the smallest value whose cumulative count reaches ceil(p * n), at
least 1, so ties and repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.operators.prefix import prefix_sums


def _rounded(value: Column, digits: int | None) -> Column:
    if digits is None:
        return value
    x = value.cast("double")
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - (digits - 1))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / step, 0) * step)


def summarise(df: DataFrame, groups: Sequence[Column], value: str, digits: int | None = None) -> DataFrame:
    """(groups, value, n): counts per group and value."""
    named = df.where(F.col(value).isNotNull()).select(*groups, _rounded(F.col(value), digits).alias("value"))
    return named.groupBy(*[c for c in named.columns if c != "value"], "value").agg(F.count(F.lit(1)).alias("n"))


def merge(summaries: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One summary out of many (their union), of partitions, days or both."""
    return summaries.groupBy(*groups, "value").agg(F.sum("n").alias("n"))


def percentiles(summary: DataFrame, groups: Sequence[str], fractions: Sequence[float], digits: int | None = None) -> DataFrame:
    """(groups, fraction, value, n, relative_error) at every fraction."""
    running = prefix_sums(summary, groups, "value", ["value"], "n")
    totals = summary.groupBy(*groups).agg(F.sum("n").alias("total"))
    joined = running.alias("r").join(totals.alias("t"), [F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}")) for g in groups]).select("r.*", "t.total")
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("fraction"), F.greatest(F.ceil(F.lit(float(p)) * F.col("total") - F.lit(1e-9)), F.lit(1)).alias("rank")) for p in fractions])
    reached = F.filter(wanted, lambda w: (w["rank"] <= F.col("running")) & (w["rank"] > F.col("running") - F.col("n")))
    error = 0.0 if digits is None else 0.5 * 10.0 ** (1 - digits)
    return joined.select(*groups, F.explode(reached).alias("w"), "value", "total").select(
        *groups, "w.fraction", "value", F.col("total").alias("n"), F.lit(error).alias("relative_error"))
