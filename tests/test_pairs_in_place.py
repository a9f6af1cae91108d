import random

import pytest

from jobweave.operators import duplicates

KINDS = "id int, company string, title_tokens array<string>, city string, employment string, skills array<string>, salary string"


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 0


def all_pairs(rows, threshold):
    first = {}
    for r in rows:
        first.setdefault(str(r[1:]), r)
    known = [r for r in first.values() if r[1] is not None and r[2]]
    same = lambda a, b: a is not None and a == b
    score = lambda x, y: 40 * jaccard(x[2], y[2]) + 25 + 15 * jaccard(x[5], y[5]) + 10 * same(x[3], y[3]) + 5 * same(x[4], y[4]) + 5 * same(x[6], y[6])
    return {(x[0], y[0]): score(x, y) for x in known for y in known if x[0] < y[0] and x[1] == y[1] and score(x, y) >= threshold - 1e-7}


def shuffled_rows(spark):
    store, gate = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = store.stageList(None, False, False, gate.new_array(gate.jvm.double, 0), gate.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_candidates_of_a_large_company_are_not_shuffled(spark):
    rows = [(i, "acme", sorted(["engineer", f"x{i}"]), "y", "full", [f"s{i}"], None) for i in range(500)]
    rows += [(1000 + i, "acme", sorted(["engineer", f"x{i}"]), "y", "full", [f"s{i}", f"s{i}b"], None) for i in range(0, 500, 50)]
    df = spark.createDataFrame(rows, KINDS)
    before = shuffled_rows(spark)
    got = {(r.left_id, r.right_id): float(r.score) for r in duplicates.probable_pairs(df, 80).collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert got == {(i, 1000 + i): 87.5 for i in range(0, 500, 50)}
    assert shuffled_rows(spark) - before < 20 * len(rows)  # a few rows for each class; each pair of "engineer" would be 130,000


@pytest.mark.parametrize("threshold", [61, 80, 91])
def test_pairs_of_lacking_features(spark, threshold):
    rng = random.Random(threshold)
    words = [f"w{i}" for i in range(7)]
    some = lambda most: sorted(set(rng.choices(words, k=rng.randint(0, most))))
    rows = [(i, rng.choice(["acme", "acme", "", None]), some(8), rng.choice(["x", "y", "", None]), rng.choice(["full", "part", None]), rng.choice([[], [""], some(4), some(2)]), rng.choice(["1", "2", None])) for i in range(300)]
    rows += [(1000 + r[0], *r[1:]) for r in rows[:40]]
    got = [(r.left_id, r.right_id, float(r.score)) for r in duplicates.probable_pairs(spark.createDataFrame(rows, KINDS), threshold).collect()]
    want = all_pairs(rows, threshold)
    assert len(got) == len(want) > 0 and all(abs(want[a, b] - s) < 1e-5 for a, b, s in got)


def test_no_postings_no_pairs(spark):
    assert duplicates.probable_pairs(spark.createDataFrame([], KINDS)).collect() == []


def test_packed_tokens_come_back(spark):
    rows = [([],), ([""],), (["a"],), (["", "a b"],)]
    df = spark.createDataFrame(rows, "t array<string>")
    assert [r[0] for r in df.select(duplicates._unpacked(duplicates._packed(df.t))).collect()] == [r[0] for r in rows]
