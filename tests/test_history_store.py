"""A store on disk, with batches that come late, is the store of all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobweave.operators import history

SCHEMA = "job string, at timestamp_ntz, seq int, state string"
ARGS = ("job", "at", ["seq"], ["state"])


def snapshots(n, seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", "c", None]), datetime(2026, 1, 1) + timedelta(hours=rng.randrange(240)), rng.randrange(5), rng.choice("XYZ")) for _ in range(n)]


def contents(store):
    return sorted((r.key, r.period, r.kind, r.at, r.starts, str(r.patch)) for r in store.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_late_batches(spark, tmp_path, seed):
    rows, path = snapshots(120, seed), str(tmp_path)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    history.write_store(frame(rows[:60]), path, *ARGS)
    for part in (rows[60:64], rows[64:], rows[64:70]):
        history.append(frame(part), path, *ARGS)
    whole = history.delta_store(frame(rows), *ARGS)
    assert contents(history.read_store(spark, path)) == contents(whole)
    at = F.lit("2026-01-05 12:00:00").cast("timestamp_ntz")
    assert sorted(history.as_of(history.read_store(spark, path), ["state"], at).collect()) == sorted(history.as_of(whole, ["state"], at).collect())


def test_only_what_a_batch_touches_is_rebuilt(spark, tmp_path):
    day = lambda d: datetime(2026, 1, d, 5)
    rows = [("a", day(d), 0, "XY"[d % 2]) for d in range(1, 9)] + [("b", day(d), 0, "X") for d in range(1, 9)]
    history.write_store(spark.createDataFrame(rows, SCHEMA), str(tmp_path), *ARGS)
    redone = history.append(spark.createDataFrame([("a", datetime(2026, 1, 3, 9), 0, "Z")], SCHEMA), str(tmp_path), *ARGS).collect()
    first = (datetime(2026, 1, 3) - datetime(1970, 1, 1)).days
    assert {(r.key, r.period) for r in redone} == {("a", first), ("a", first + 1)}
    assert history.append(spark.createDataFrame([], SCHEMA), str(tmp_path), *ARGS).collect() == []
