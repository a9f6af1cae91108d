"""The open vote counts every value of a group, however its values fall into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from jobweave.llm import consensus
from jobweave.llm.consensus import merged, profile, profile_of, survivor, survivors, voted


def rows_of(spark, cells):
    """cells: (cluster, member, rank, value)."""
    df = spark.createDataFrame(cells, "cluster int, member int, rank int, value string")
    return df.select("cluster", "member", F.struct("rank", F.lit(0).cast("bigint").alias("age"), "member").alias("belief"), F.col("value").alias("name"))


def test_every_weight_reaches_the_vote(spark, monkeypatch):
    cells = [(1, 0, 1, "Zeta Corp")] + [(1, i, 2, f"Acme Soft {i}") for i in range(1, 200)]
    for chunks in (1, 2, 7, 1024):
        for handed in (0, 4, 32):
            monkeypatch.setattr(consensus, "CHUNKS", chunks)
            monkeypatch.setattr(consensus, "HANDED", handed)
            assert [r.value for r in survivors(rows_of(spark, cells), ["name"], dominant=False).collect()] == ["Acme Soft 1"], (chunks, handed)


def test_against_one_list(spark, monkeypatch):
    rng = random.Random(3)
    words = ["Acme", "Software", "Soft", "JSC", "Co", "Viet"]
    cells = [(k, i, rng.choice([1, 2, 4]), " ".join(rng.choices(words, k=rng.randint(1, 4)))) for k in range(40) for i in range(rng.randint(1, 25))]
    want = {}
    for k in range(40):
        best = {}
        for _, i, rank, v in sorted((c for c in cells if c[0] == k), key=lambda c: (c[2], c[1])):
            best.setdefault(v, []).append(1 / rank)
        want[k] = list(best)[survivor(list(best), [sum(w) for w in best.values()])]
    for chunks in (2, 5, 1024):
        monkeypatch.setattr(consensus, "CHUNKS", chunks)
        assert {r.cluster: r.value for r in survivors(rows_of(spark, cells), ["name"], dominant=False).collect()} == want


@pytest.mark.parametrize("split", [1, 2, 3])
def test_merged_profiles_keep_all_weights(split):
    values = [("a b c", 1.0), ("a c", 2.0), ("b c d", 4.0), ("x", 8.0)]
    whole = merged(profile_of([profile(*v) for v in values[:split]]), profile_of([profile(*v) for v in values[split:]]))
    assert whole[0] == 15.0 and all(sum(c.values()) == 15.0 for c in whole[1])
    assert voted(profile_of([profile("a b", 1.0), profile("a c", 2.0)])) == ["a", "c"]
