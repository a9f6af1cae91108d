import random

from jobweave.llm.mixing import mix, shares

TARGETS = [("a", 0.5, 1, "x"), ("b", 0.3, 3, "x"), ("c", 0.2, 4, "x"), ("absent", 0.1, 2, "x")]


def frames(spark, rows, targets=TARGETS):
    sized = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id int, source string, n_tokens bigint, weight double, tokens int, budget double")
    return sized, spark.createDataFrame(targets, "source string, target_share double, max_repeats int, doc_id string")


def test_shares_caps_and_report(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaaaaabbc") if i % 50 else None, rng.randrange(0, 60), rng.choice([0.1, 1.0])) for i in range(3000)]
    sized, targets = frames(spark, rows)
    mixed = mix(sized, targets)
    got = mixed.collect()
    tokens = {s: sum(r.copies * r.n_tokens for r in got if r.source == s) for s in "abc"}
    total = sum(tokens.values())
    for s, share, cap, _ in TARGETS[:3]:
        assert abs(tokens[s] / total - share) < 0.005
        own = [r for r in got if r.source == s]
        assert all(1 <= r.copies <= cap for r in own) and all(abs(r.actual_share - tokens[s] / total) < 1e-9 for r in own)
        full = {r.doc_id for r in own if r.copies == max(x.copies for x in own) - 1}
        assert not full or len({r.copies for r in own}) <= 2
    assert len({r.doc_id for r in got}) == len(got)
    reach = min(sum(n for _, s, n, _ in rows if s == t) * cap / share for t, share, cap, _ in TARGETS[:3])
    assert total > 0.99 * reach
    report = {r.source: r for r in shares(mixed, targets).collect()}
    assert report["absent"].actual_share == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9


def test_heavier_documents_come_first(spark):
    rows = [(i, "a", 10, 1.0 if i % 2 else 0.1) for i in range(2000)]
    sized, targets = frames(spark, rows, [("a", 1.0, 1, "x")])
    got = mix(sized, targets, total_tokens=5000).collect()
    heavy = sum(r.doc_id % 2 for r in got) / len(got)
    assert 495 <= len(got) <= 500 and heavy > 0.8


def test_one_long_document_ties_and_empty_tables(spark):
    sized, targets = frames(spark, [(1, "a", 10**6, 1.0), (2, "b", 0, 1.0)])
    assert all(r.source == "a" and r.copies == 1 for r in mix(sized, targets).collect())
    assert mix(sized.limit(0), targets).collect() == [] and mix(sized, targets.limit(0)).collect() == []
    assert {r.tokens for r in shares(mix(sized.limit(0), targets), targets).collect()} == {0}
