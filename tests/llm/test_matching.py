import random

import pytest

from jobweave.llm.matching import Trie, distance_for, generated_forms, map_values, tries

REF = [(1, "city", "Hà Nội", ["Hanoi"]), (2, "city", "Hồ Chí Minh", ["Saigon"]), (5, "city", "Quảng Nam", None), (6, "city", "Nam Định", []), (3, "skill", "Spring", []), (4, "skill", "Spring Boot", []), (7, "skill", "C++", ["cpp"]), (8, "skill", "Go", ["golang"]),
       (9, "skill", "JavaScript", []), (10, "skill", "Java", []), (11, "title", "Project Manager", []), (12, "title", "Data Engineer", ["Kỹ sư dữ liệu"])]
CASES = [("city", "TP. HN", 1), ("city", "ha-noi", 1), ("city", "HàNội | 3 ngày", 1), ("city", "Ho Chi iMnh", 2), ("city", "Quận 6, Nam Dihn", 6), ("city", "Vientiane", -1), ("skill", "Spring oot", 4), ("skill", "spring-boot 3", 4), ("skill", "Sprng", 3), ("skill", "C++17", 7),
         ("skill", "C plus plus", 7), ("skill", "Java Script", 9), ("skill", "java (ưu tiên)", 10), ("skill", "biết go", 8), ("skill", "good", -1), ("title", "Senior Manager, Project", 11), ("title", "Manager, Project", 11), ("title", "🔥 Ky su du lieu 🔥", 12), ("title", "12", -1), ("skill", "x" * 20_000, -1)]


@pytest.mark.parametrize("kind,text,want", CASES)
def test_meaning(kind, text, want):
    assert tries(REF)[kind].meant(text) == want


def test_forms_are_made_by_rule():
    ref = [(1, "title", "Site Reliability Engineer", []), (2, "title", "Data Engineer", []), (3, "title", "Database Administrator", []), (4, "city", "Hồ Chí Minh", []), (5, "skill", "C++", []), (6, "skill", "Kubernetes", []), (7, "skill", "Apache Spark", []),
           (8, "title", "UI/UX Designer", []), (9, "title", "Data Entry", [])]
    got = tries(ref)
    for kind, text, want in [("title", "SRE", 1), ("title", "Data Eng", 2), ("title", "DBA", 3), ("city", "TP HCM", 4), ("city", "HCMC", 4), ("skill", "C plus plus", 5), ("skill", "k8s", 6), ("skill", "Spark", 7), ("title", "UX Designer", 8)]:
        assert got[kind].meant(text) == want, text
    assert got["title"].meant("DE") == -1  # two entries could have it
    assert generated_forms("") == set() and tries([(1, "x", None, None), (2, "x", "", ["y"])])["x"].meant("y") == 2


def edits(a, b):
    """Edits with swaps of neighbours, by the full table."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_search_returns_all_entries_within_their_distance():
    rng = random.Random(1)
    names = list({"".join(rng.choice("abc") for _ in range(rng.randint(2, 14))) for _ in range(40)})
    trie = Trie(enumerate(names))
    for _ in range(150):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 15)))
        got = {}
        for ref_id, _, e, p in trie.search(text, frozenset([len(text)])):
            got[ref_id] = min(e, got.get(ref_id, 9))
        assert got == {i: edits(n, text) for i, n in enumerate(names) if edits(n, text) <= distance_for(len(n))}


def test_rows(spark):
    rows = [(1, "city", "Hà Nội", 0), (2, "city", "hanoi", 0), (3, "city", "  ", 0), (4, "city", None, 0), (5, "other", "x", 0), (6, "skill", "", 0), (7, "city", "hanoi", 0), (7, "city", "hanoi", 1), (8, None, "x", 0)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "id int, kind string, value string, no int, ref_id int")
    got = sorted((r.id, r.no, r.ref_id if r.ref_id is not None else -1) for r in map_values(df, REF, ["id", "no"]).collect())
    assert got == [(2, 0, 1), (5, 0, -1), (7, 0, 1), (7, 1, 1), (8, 0, -1)]
    assert map_values(df.limit(0), REF, ["id", "no"]).collect() == []
    assert {r.ref_id for r in map_values(df.where("id = 2"), [], ["id", "no"]).collect()} == {-1}
