"""Joining rows to a dictionary of their distinct values, whatever its size and however hot its values."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dictionary of at most so many bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 24_000_000
#: Beyond that, a key with more than this share of all rows is salted; there can be at most 1 / HOT_SHARE such keys.
HOT_SHARE, SALTS = 0.002, 32


def lookup_join(rows: DataFrame, known: DataFrame, keys: Sequence[str], row_size: Column, spread: Sequence[str], times: str = "times", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` left joined to ``known`` (a row per ``keys``, with how many ``times`` they occur).

    ``known`` should be written (a checkpoint), since it is read twice. ``row_size`` are the bytes of
    one of its rows; ``spread`` are columns of ``rows`` that tell rows of one hot key apart.
    """
    size, total = known.agg(F.sum(row_size), F.sum(times)).first()
    if (size or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(known.drop(times)), list(keys), "left")
    hot = known.where(F.col(times) > HOT_SHARE * total).select(*keys, F.lit(True).alias("_hot"))
    salted = known.drop(times).join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    empty = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])  # rows that can match nothing go anywhere
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).when(empty, F.pmod(F.xxhash64(*spread), F.lit(1_000_003)).cast("int")).otherwise(F.lit(0))
    marked = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", salt).drop("_hot")
    return marked.join(salted, [*keys, "_salt"], "left").drop("_salt")
