import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobweave.llm import consensus
from jobweave.llm.consensus import best_records, members, survivor, survivors, usable

FIELDS = ["name", "size"]


def build(spark, clusters, records, trust):
    c = spark.createDataFrame(clusters, "cluster_id int, idx array<int>, members array<struct<source:string>>, member string")
    r = spark.createDataFrame(records, "record_index int, source string, name string, size string, at timestamp_ntz, rank string, belief string")
    t = spark.createDataFrame(trust, "source string, trust_rank int")
    return members(c, r, t, FIELDS, group="cluster_id", indices="idx", sources=F.col("members.source"), index="record_index", source="source", latest="at")


def test_rule_against_a_loop(spark, monkeypatch):
    rng = random.Random(1)
    trust = [("a", 1), ("b", 2), ("c", 2)]
    records = [(i, rng.choice("abcd"), rng.choice(["Acme JSC", "Acme Co", "Acme", "N/A", " ", None, "…"]), rng.choice(["1-24", "25-99", "Đang cập nhật", None]), rng.choice([None, *(datetime(2026, 1, 1) + timedelta(days=k) for k in range(3))]), "r", "b") for i in range(60)]
    clusters = []
    for k in range(50):
        idx = [rng.randrange(66) for _ in range(rng.randint(0, 9))]
        clusters.append((k, idx, [(rng.choice([None, "A ", "b", "\tC", "zz"]),) for _ in idx], "m"))
    good = lambda v: v in ("Acme JSC", "Acme Co", "Acme", "1-24", "25-99")
    ranks, by = dict(trust), {r[0]: r for r in records}
    want_f, want_r = {}, {}
    for k, idx, ms, _ in clusters:
        order = {}
        for i, (s,) in zip(idx, ms):
            if i in by:
                key = (ranks.get((s if s is not None else by[i][1]).strip().lower(), 10**9), -(by[i][4] - datetime(2020, 1, 1)).total_seconds() if by[i][4] else 10**12, i)
                order[i] = min(key, order.get(i, key))
        for f, at in (("name", 2), ("size", 3)):
            if usable_members := [o for i, o in order.items() if good(by[i][at])]:
                want_f[k, f] = min(usable_members)[2]
        if order:
            want_r[k] = min((-(good(by[i][2]) + good(by[i][3])), o) for i, o in order.items())[1][2]
    rows = build(spark, clusters, records, trust)
    for chunks in (1024, 1, 3):
        monkeypatch.setattr(consensus, "CHUNKS", chunks)
        assert {(r.cluster, r.field): r.member for r in survivors(rows, FIELDS).collect()} == want_f
    assert {r.cluster: r.member for r in best_records(rows, FIELDS).collect()} == want_r


def test_open_vote(spark):
    assert survivor(["Acme Software JSC", "Acme Softwares", "Acme Software Company", "Acme Software"], [0.2, 0.25, 0.25, 0.3]) == 3
    assert survivor(["x"], [1.0]) == 0 and survivor(["a b", "a c", "a c"], [0.4, 0.3, 0.3]) == 1
    assert survivor(["a", "b"], [0.5, 0.5]) == 0


@pytest.mark.parametrize("value,want", [("N.A.", False), ("--", False), ("Không có thông tin", False), ("Đang cập nhật", False), ("\xa0", False), (None, False), ("1000+", True), ("Confidential Systems", True), ("(bảo mật)", False), ("x" * 50_000, True)])
def test_usable(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(usable(F.col("v")).alias("u")).first().u is want


def test_empty(spark):
    rows = build(spark, [], [], [])
    assert survivors(rows, FIELDS).collect() == [] and best_records(rows, FIELDS).collect() == []
    rows = build(spark, [(1, None, None, "m"), (2, [5], [(None,)], "m")], [(None, None, None, None, None, None, None)], [(None, None)])
    assert survivors(rows, FIELDS).collect() == [] and best_records(rows, FIELDS).collect() == []
