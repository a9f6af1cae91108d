"""History of changing attributes, kept as checkpoints and patches.

The store cuts every key's time line into periods. Each period in which the key was seen has
one checkpoint (kind ``C``: the full version in force when the period began, or the key's first
version) and a patch (kind ``P``) per later change, which holds only the attributes that changed.
Validity rows come from folding the patches of a period forward from its checkpoint.

A key that holds a third of all rows is cut by its periods: the only per-key window runs over
one summary row per period.

On disk (``write_store``) the entries and the instants they come from are partitioned by period. A late batch
(``append``) rebuilds only the (key, period)s it touches and each key's next one, whose checkpoint may change.

Defined results: rows with a null key or instant tell nothing and are left out; of rows with equal
(key, instant) the greatest by ``order_by`` counts, exact repeats collapse, and a full tie is
broken by the attribute values themselves; attribute values may be null; other columns of the
input, whatever their names, are never read; an empty input gives an empty store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobweave.session import checkpointed

DAY_US = 86_400_000_000


def _same(a: str, b: str, attrs: Sequence[str]) -> Column:
    same = F.lit(True)
    for x in attrs:
        same = same & F.col(f"{a}.{x}").eqNullSafe(F.col(f"{b}.{x}"))
    return same


def delta_store(df: DataFrame, key: str, at: str, order_by: Sequence[str], attrs: Sequence[str], period_us: int = DAY_US) -> DataFrame:
    """(key, period, kind, at, starts, patch) from snapshots or updates in any order.

    ``patch`` has a struct ``value`` per attribute, null where the attribute did not change.
    ``starts`` is false for checkpoints that only repeat the version in force.
    """
    return _entries(_instants(df, key, at, order_by, attrs, period_us), attrs, period_us)


def _instants(df: DataFrame, key: str, at: str, order_by: Sequence[str], attrs: Sequence[str], period_us: int) -> DataFrame:
    """(key, at, seq, now, period): the row that counts of every key and instant."""
    full = F.struct(*[F.col(a).alias(a) for a in attrs])
    rows = df.select(F.col(key).alias("key"), F.col(at).alias("at"), F.struct(*[F.col(c) for c in order_by]).alias("seq"), full.alias("now"))
    return _latest(rows.where(F.col("key").isNotNull() & F.col("at").isNotNull())).withColumn("period", F.floor(F.unix_micros(F.col("at").cast("timestamp")) / F.lit(period_us)))


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "at").agg(F.max(F.struct("seq", "now")).alias("m")).select("key", "at", "m.seq", "m.now")


def _entries(instants: DataFrame, attrs: Sequence[str], period_us: int, only: DataFrame | None = None) -> DataFrame:
    """The store's rows of ``instants``; of the (key, period)s in ``only``, if given, to whose periods the ones before are there too."""
    inside = Window.partitionBy("key", "period").orderBy("at")
    moves = instants.drop("seq").withColumn("was", F.lag("now").over(inside)).where(F.col("was").isNull() | ~_same("now", "was", attrs))
    moves = checkpointed(moves)  # read for the tails and for the entries
    tails = moves.groupBy("key", "period").agg(F.max_by("now", "at").alias("tail"))
    carried = tails.select("key", "period", F.lag("tail").over(Window.partitionBy("key").orderBy("period")).alias("carried"))
    rows = moves.join(carried, ["key", "period"])
    if only is not None:
        rows = rows.join(only, ["key", "period"], "left_semi")
    head, born = F.col("was").isNull(), F.col("carried").isNull()
    rows = rows.withColumn("before", F.coalesce("was", "carried"))

    def cells(of: str, only_changed: bool) -> Column:
        return F.struct(*[
            (F.when(F.col("before").isNull() | ~F.col(f"now.{a}").eqNullSafe(F.col(f"before.{a}")), F.struct(F.col(f"{of}.{a}").alias("value")))
             if only_changed else F.struct(F.col(f"{of}.{a}").alias("value"))).alias(a)
            for a in attrs
        ])

    start_of_period = F.timestamp_micros(F.col("period") * F.lit(period_us)).cast(instants.schema["at"].dataType)
    entry = lambda kind, when, starts, patch: F.struct(F.lit(kind).alias("kind"), when.alias("at"), F.lit(starts).alias("starts"), patch.alias("patch"))
    out = F.when(head & born, F.array(entry("C", F.col("at"), True, cells("now", False))))
    out = out.when(head & _same("now", "before", attrs), F.array(entry("C", start_of_period, False, cells("before", False))))
    out = out.when(head, F.array(entry("C", start_of_period, False, cells("before", False)), entry("P", F.col("at"), True, cells("now", True))))
    out = out.otherwise(F.array(entry("P", F.col("at"), True, cells("now", True))))
    return rows.select("key", "period", F.explode(out).alias("e")).select("key", "period", "e.*")


def _overwrite(df: DataFrame, path: str) -> None:
    """Replaces exactly the periods that ``df`` has."""
    df.repartition("period", F.pmod(F.xxhash64("key"), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def write_store(df: DataFrame, path: str, key: str, at: str, order_by: Sequence[str], attrs: Sequence[str], period_us: int = DAY_US) -> None:
    """Writes the instants and the entries of ``df`` under ``path``."""
    instants = checkpointed(_instants(df, key, at, order_by, attrs, period_us))
    _overwrite(instants, f"{path}/instants")
    _overwrite(_entries(instants, attrs, period_us), f"{path}/entries")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/entries").withColumn("period", F.col("period").cast("bigint"))


def append(batch: DataFrame, path: str, key: str, at: str, order_by: Sequence[str], attrs: Sequence[str], period_us: int = DAY_US) -> DataFrame:
    """Adds a batch, late or not, to a store written with the same parameters; returns the (key, period)s that were rebuilt.

    Running it again changes nothing: repeated rows collapse.
    """
    spark, periods = batch.sparkSession, lambda df: F.broadcast(df.select("period").distinct())  # one row per period of a batch
    new = checkpointed(_instants(batch, key, at, order_by, attrs, period_us))
    old = spark.read.parquet(f"{path}/instants").withColumn("period", F.col("period").cast("bigint"))
    touched = new.select("key", "period").distinct()
    known = read_store(spark, path).where("kind = 'C'").select("key", "period").join(touched.select("key").distinct(), "key", "left_semi")
    line = Window.partitionBy("key").orderBy("period")
    marked = known.unionByName(touched).distinct().join(touched.withColumn("hit", F.lit(True)), ["key", "period"], "left")
    marked = marked.withColumn("redone", F.coalesce("hit", F.lit(False)) | F.coalesce(F.lag("hit").over(line), F.lit(False)))
    marked = checkpointed(marked.withColumn("needed", F.col("redone") | F.coalesce(F.lead("redone").over(line), F.lit(False))))
    redone, needed = marked.where("redone").select("key", "period"), marked.where("needed").select("key", "period")
    merged = old.join(periods(needed), "period", "left_semi").join(needed, ["key", "period"], "left_semi").unionByName(new)
    merged = _latest(merged).withColumn("period", F.floor(F.unix_micros(F.col("at").cast("timestamp")) / F.lit(period_us)))
    entries = _entries(merged, attrs, period_us, redone)
    kept = read_store(spark, path).join(periods(redone), "period", "left_semi").join(redone, ["key", "period"], "left_anti")
    entries = checkpointed(kept.unionByName(entries))
    instants = checkpointed(_latest(old.join(periods(touched), "period", "left_semi").drop("period").unionByName(new.drop("period"))).withColumn("period", F.floor(F.unix_micros(F.col("at").cast("timestamp")) / F.lit(period_us))))
    _overwrite(instants, f"{path}/instants")
    _overwrite(entries, f"{path}/entries")
    return redone


def versions(store: DataFrame, attrs: Sequence[str], with_end: bool = True) -> DataFrame:
    """(key, attributes, valid_from[, valid_to]) by folding patches forward from the nearest checkpoint.

    ``valid_to`` is the start of the next version, null for the one in force.
    """
    fold = Window.partitionBy("key", "period").orderBy("at", "kind")
    out = store.select(
        "key", "period", "at", "starts",
        *[F.last(F.col(f"patch.{a}"), ignorenulls=True).over(fold)["value"].alias(a) for a in attrs],
    ).where("starts")
    if not with_end:
        return out.select("key", *attrs, F.col("at").alias("valid_from"))
    firsts = out.groupBy("key", "period").agg(F.min("at").alias("first"))
    following = firsts.select("key", "period", F.lead("first").over(Window.partitionBy("key").orderBy("period")).alias("following"))
    inside = Window.partitionBy("key", "period").orderBy("at")
    return (
        out.withColumn("next", F.lead("at").over(inside)).join(following, ["key", "period"])
        .select("key", *attrs, F.col("at").alias("valid_from"), F.coalesce("next", "following").alias("valid_to"))
    )


def as_of(store: DataFrame, attrs: Sequence[str], instant: Column) -> DataFrame:
    """(key, attributes) in force at ``instant``: each key's last checkpoint before it, with the patches after that."""
    seen = store.where(F.col("at") <= instant)
    nearest = seen.groupBy("key").agg(F.max("period").alias("period"))
    last = seen.join(nearest, ["key", "period"]).groupBy("key").agg(
        *[F.max_by(F.col(f"patch.{a}"), F.when(F.col(f"patch.{a}").isNotNull(), F.struct("at", "kind"))).alias(a) for a in attrs])
    return last.select("key", *[F.col(f"{a}.value").alias(a) for a in attrs])
