"""A table as numbered versions in a folder: an import reads the current one, writes the next and then names it current.

Readers see one whole version; a failed import leaves the current one in place; running an import again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.session import checkpointed


def _folder(spark: SparkSession, path: str):
    """The folder's file system, of whatever kind the cluster has, and its path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _named(spark: SparkSession, path: str) -> str | None:
    """The name of the current version: that of the newest marker, which is written last."""
    fs, folder = _folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [int(n[len("CURRENT-"):]) for n in names if n.startswith("CURRENT-")]
    return f"v{max(done)}" if done else None


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version, or None where nothing was imported yet."""
    name = _named(spark, path)
    return None if name is None else spark.read.parquet(f"{path}/{name}")


def _write(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    number = int((_named(spark, path) or "v0")[1:]) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{number}")
    fs, _ = _folder(spark, path)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT-{number}"), False).close()  # fails where another import was faster


def upsert(incoming: DataFrame, path: str, keys: Sequence[str], latest: Sequence[str], delete_missing: bool = False) -> DataFrame:
    """Imports ``incoming`` and returns (action, n): inserted, updated, skipped, and deleted or kept.

    Of rows with equal ``keys`` the greatest by ``latest`` counts; rows with a null key are left out. A row is
    updated where any other column differs. With ``delete_missing`` rows that are not in ``incoming``
    are removed, as in importing a whole report. Nothing is written where nothing changes.
    """
    spark, columns = incoming.sparkSession, incoming.columns
    rest = [c for c in columns if c not in keys]
    keyed = incoming.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    order = F.struct(*[F.struct(F.col(c).isNotNull().alias("there"), F.col(c).alias("v")).alias(c) for c in latest]) if latest else F.lit(0)
    new = keyed.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order.alias("o"), F.xxhash64(*rest).alias("h"))).alias("new"))
    old = current(spark, path)
    old = new.limit(0).select(*keys, F.col("new").alias("old")) if old is None else old.select(*keys, F.struct(*rest).alias("old"))
    both = new.join(old, list(keys), "full")
    action = (
        F.when(F.col("new").isNull(), "deleted" if delete_missing else "kept").when(F.col("old").isNull(), "inserted")
        .when(F.col("new").eqNullSafe(F.col("old")), "skipped").otherwise("updated"))
    merged = checkpointed(both.select(*keys, F.coalesce("new", "old").alias("row"), action.alias("action")))
    actions = merged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    if not merged.where("action NOT IN ('skipped', 'kept')").isEmpty():
        _write(merged.where("action <> 'deleted'").select(*keys, "row.*").select(*columns), path)
    return actions
