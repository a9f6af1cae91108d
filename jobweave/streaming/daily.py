"""Observations as a stream: repeats dropped within the watermark, days counted as windows, late data kept until it passes.

``daily_counts`` works on streams and tables alike; ``refresh_days`` is the foreachBatch side, which
overwrites exactly the days that a batch touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

LATENESS = "7 days"


def distinct_observations(observed: DataFrame, keys: list[str], at: str = "observed_at", lateness: str = LATENESS) -> DataFrame:
    """Each (keys) once; a stream forgets keys older than the watermark."""
    if observed.isStreaming:
        return observed.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)
    return observed.dropDuplicates(keys)


def daily_counts(observed: DataFrame, at: str = "observed_at", by: str = "state", lateness: str = LATENESS) -> DataFrame:
    """(day, by, n) per UTC day."""
    marked = observed.withWatermark(at, lateness) if observed.isStreaming else observed
    counted = marked.groupBy(F.window(at, "1 day").alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.to_date("w.start").alias("day"), by, "n")


def refresh_days(observed: DataFrame, path: str, checkpoint: str, by: str = "state", at: str = "observed_at") -> DataStreamWriter:
    """Appends a stream's observations under ``path``/facts and rewrites the daily rows of the days each batch touched."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        dated = rows.withColumn("day", F.to_date(at)).persist()
        try:
            if dated.isEmpty():
                return
            dated.write.mode("append").partitionBy("day").parquet(f"{path}/facts")
            touched = dated.select("day").distinct()
            facts = spark.read.parquet(f"{path}/facts").join(F.broadcast(touched), "day", "left_semi")  # days of one batch
            fresh = facts.dropDuplicates(["observation_id"]).groupBy("day", by).agg(F.count(F.lit(1)).alias("n"))
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/daily")
        finally:
            dated.unpersist()

    return observed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
