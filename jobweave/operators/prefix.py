"""Running sums over any number of rows per group, without one task per group.

The order column is cut into buckets at approximate quantiles of the whole input (a bounded list
of numbers on the driver); a window sums inside each (group, bucket) and the totals of the
buckets before are added. Ties of the order column are ordered by the tie columns.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 500_000
MOST_BUCKETS = 65_536


def bucket_bounds(df: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Increasing cut points of ``order``, about one per ``rows_per_bucket`` rows and at most MOST_BUCKETS."""
    fractions = [i / 256 for i in range(1, 256)]
    n, cuts = df.agg(F.count(F.lit(1)), F.percentile_approx(F.col(order).cast("double"), fractions, 10_000)).first()
    wanted = min(MOST_BUCKETS, max(1, -(-(n or 0) // rows_per_bucket)))
    if wanted > 256:
        fractions = [i / wanted for i in range(1, wanted)]
        cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), fractions, 20 * wanted)).first()[0]
    elif cuts:
        cuts = [cuts[min(254, round(i * 256 / wanted) - 1)] for i in range(1, wanted)]
    return sorted(set(cuts or []))


def bucket_of(x: Column, bounds: Sequence[float]) -> Column:
    """How many of the increasing ``bounds`` are below ``x``, by halving; 0 for null."""
    if not bounds:
        return F.lit(0)
    cuts = F.from_json(F.lit(json.dumps([float(b) for b in bounds])), "array<double>")  # folded to a literal
    whole = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(cuts: Column, state: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        above = cuts[F.least(middle, F.lit(len(bounds) - 1))] < x
        return F.when(state["low"] >= state["high"], state).when(above, F.struct((middle + 1).alias("low"), state["high"].alias("high"))).otherwise(F.struct(state["low"].alias("low"), middle.alias("high")))

    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    found = F.transform(F.array(cuts), lambda c: F.aggregate(steps, whole, lambda state, _: halve(c, state), lambda state: state["low"]))[0]
    return F.when(x.isNull(), F.lit(0)).otherwise(found)


def prefix_sums(df: DataFrame, groups: Sequence[str], order: str, ties: Sequence[str], value: str, out: str = "running", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with the sum of ``value`` up to and with each row of its group, in order."""
    bounds = bucket_bounds(df, order, rows_per_bucket)
    rows = df.withColumn("_bucket", bucket_of(F.col(order).cast("double"), bounds))
    totals = rows.groupBy(*groups, "_bucket").agg(F.sum(value).alias("_total"))
    before = totals.select(*groups, "_bucket", (F.sum("_total").over(Window.partitionBy(*groups).orderBy("_bucket")) - F.col("_total")).alias("_before"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(F.col(order).asc_nulls_first(), *ties).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.alias("r").join(before.alias("b"), [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*groups, "_bucket")])
    return joined.select("r.*", F.col("b._before")).withColumn(out, F.sum(value).over(inside) + F.col("_before")).drop("_bucket", "_before")
