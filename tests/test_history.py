import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobweave.operators import history

T0 = datetime(2026, 1, 1)
SCHEMA = "job string, at timestamp_ntz, seq int, state string, note string, key string, period int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", 7) for r in rows], SCHEMA)


def brute(rows):
    """(job, state, note, from, to) by walking each job's rows in order."""
    best = {}
    for job, at, seq, state, note in rows:
        if job is not None and at is not None:
            rank = (seq is not None, seq or 0, state is not None, state or "", note is not None, note or "")
            best[job, at] = max(best.get((job, at), ((), None)), (rank, (state, note)), key=lambda x: x[0])
    out, last = [], {}
    for (job, at), (_, value) in sorted(best.items()):
        if job not in last or last[job][0] != value:
            if job in last:
                out[last[job][1]][4] = at
            last[job] = (value, len(out))
            out.append([job, *value, at, None])
    return sorted(map(tuple, out), key=str)


def test_versions_against_a_walk(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        rows.append((rng.choice(["a", "a", "a", "b", "c", None]), T0 + timedelta(minutes=30 * rng.randrange(400)), rng.randrange(3), rng.choice(["X", "Y", None]), rng.choice(["p", None])))
    rows += rows[:50]
    for period in (3_600_000_000, history.DAY_US, 30 * history.DAY_US):
        store = history.delta_store(frame(spark, rows), "job", "at", ["seq"], ["state", "note"], period)
        got = sorted([tuple(r) for r in history.versions(store, ["state", "note"]).collect()], key=str)
        assert got == brute(rows)


def test_as_of_matches_the_versions(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), T0 + timedelta(hours=rng.randrange(300)), 0, rng.choice("XYZ"), "n") for _ in range(200)]
    store = history.delta_store(frame(spark, rows), "job", "at", ["seq"], ["state"])
    at = T0 + timedelta(hours=133, minutes=5)
    got = {r.key: r.state for r in history.as_of(store, ["state"], F.lit(at).cast("timestamp_ntz")).collect()}
    want = {r[0]: r[1] for r in brute([(*r[:4], None) for r in rows]) if r[3] <= at and (r[4] is None or r[4] > at)}
    assert got == want


def test_store_holds_patches_and_checkpoints(spark):
    rows = [("a", T0, 0, "X", "n"), ("a", T0 + timedelta(hours=1), 0, "Y", "n"), ("a", T0 + timedelta(days=3), 0, "Y", "n")]
    store = history.delta_store(frame(spark, rows), "job", "at", ["seq"], ["state", "note"]).orderBy("at").collect()
    assert [(r.kind, r.starts) for r in store] == [("C", True), ("P", True), ("C", False)]
    assert store[1].patch.note is None and store[1].patch.state.value == "Y"


def test_empty_and_null_rows(spark):
    for rows in ([], [(None, T0, 0, "X", "n"), ("a", None, 0, "X", "n")]):
        store = history.delta_store(frame(spark, rows), "job", "at", ["seq"], ["state"])
        assert store.collect() == [] and history.versions(store, ["state"]).collect() == []
