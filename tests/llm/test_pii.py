import random
import unicodedata

import numpy as np
import pytest

from jobweave.llm import pii

TEMPLATES = [
    ("Gửi CV về {} nhé. ", "EMAIL", ["an.tran@mail.example", "hr+kha (at) mail (dot) visgate (dot) test", "QUYEN@X-Y.EXAMPLE"]),
    ("Hotline {} để được tư vấn. ", "PHONE", ["0912345678", "+84 912 345 678", "(028) 3822 1234", "０９１２３４５６７８", "(+84)951761391"]),
    ("CCCD số {} có hiệu lực. ", "ID_NUMBER", ["099095156183", "098 081 460 870"]), ("Passport {} is registered. ", "ID_NUMBER", ["X4363276"]), ("SSN {} ok. ", "ID_NUMBER", ["000-98-6774"]),
    ("Phỏng vấn tại {}. ", "ADDRESS", ["414 đường Suối Tơ, phường Hải Đăng, quận 17", "Hẻm 56/13 Đồi Thông Nhỏ, xã Bến Mộng", "80 Old Kiln Lane, Ward 31, Bac Ninh", "208 duong Canh Dieu, phuong Suoi Tien Nu", "Am Falkenhang 38, 00151 Ostringen"]),
    ("Ask for Mr {}, phone later. ", "NAME", ["Nguyễn Lĩnh Vịnh", "T. Dunmarrow"]), ("Gặp anh {} (HR). ", "NAME", ["Lê Văn Khuê", "水守　航", "Taddeo Osterby"]),
]
FILLER = ["Order no. 499699843022 was handled in 118 ms. ", "Mã tin 445297710, cập nhật ngày 20/04/2026. ", "Mã số doanh nghiệp 0004860005. ", "Use the pattern user@host in the config. ", "Uptime 99.9%, version 10.24.108.7. ", "Liên hệ: [REDACTED_EMAIL]. ", "Tầng 13, khu A. ",
          "We use Apache Kafka in Hà Nội. ", "Follow @team, tag #x2026. ", "Công ty TNHH Diramind. "]


def corpus(n, seed):
    rng, out = random.Random(seed), []
    for i in range(n):
        text, spans = "", []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.55:
                t, kind, values = rng.choice(TEMPLATES)
                v = rng.choice(values)
                at = len(text) + t.index("{}")
                text += t.format(v)
                spans.append((kind, at, at + len(v)))
            else:
                text += rng.choice(FILLER)
        if rng.random() < 0.3:
            text, spans = moved(text, spans)
        out.append((i, text, spans))
    return out


def moved(text, spans):
    """The same in decomposed letters, with the spans' new places."""
    at = lambda k: len(unicodedata.normalize("NFD", text[:k]))
    return unicodedata.normalize("NFD", text), [(k, at(a), at(b)) for k, a, b in spans]


def test_found_spans_and_redaction(spark):
    docs = corpus(400, 1)
    df = spark.createDataFrame([(i, t, "c", 1) for i, t, _ in docs] + [(900, None, "c", 1), (901, "", "c", 1), (902, " \n", "c", 1), (903, "word " * 30_000, "c", 1), (0, docs[0][1], "c", 1)], "id int, text string, h string, a int")
    found = pii.find(df, "id", "text")
    got = {(r.id, r.pii_type, r.a) for r in found.collect()}
    want = {(i, k, a) for i, _, spans in docs for k, a, _ in spans}
    hit = len(got & want)
    assert hit / len(want) > 0.97 and hit / len(got) > 0.97
    texts = {(r.id): r.redacted for r in pii.redact(df, "id", "text", found).collect()}
    assert texts[900] is None and texts[901] == "" and texts[902] == " \n" and texts[903] == "word " * 30_000
    i, text, spans = next(d for d in docs if len(d[2]) > 1 and {(d[0], k, a) for k, a, _ in d[2]} == {g for g in got if g[0] == d[0]})
    out, upto = "", 0
    for k, a, b in spans:
        out, upto = out + text[upto:a] + f"[{k}]", b
    assert texts[i] == out + text[upto:]


def test_nothing(spark):
    df = spark.createDataFrame([], "id int, text string")
    assert pii.find(df, "id", "text").collect() == [] and pii.redact(df, "id", "text", pii.find(df, "id", "text")).collect() == []


def test_reliabilities_recover_labelers():
    rng = np.random.default_rng(1)
    patterns, truth = {}, {}
    for _ in range(20_000):
        y = rng.random() < 0.3
        v = tuple(int(x) for x in (rng.choice([1, 0, -1], p=[0.7, 0.25, 0.05] if y else [0.05, 0.55, 0.4]) for _ in range(4)))
        patterns[v] = patterns.get(v, 0) + 1
        truth.setdefault(v, []).append(y)
    p = pii.reliabilities(patterns)
    error = sum(abs(p[v] - np.mean(truth[v])) * len(truth[v]) for v in patterns) / 20_000
    assert error < 0.05


@pytest.mark.parametrize("text", ["abc", "Kỹ sư", "０１ａ", "ﬁx é"])
def test_normal_maps_back(text):
    t, back = pii.normal(text)
    assert t == unicodedata.normalize("NFKC", text) and (back is None or (len(back) == len(t) + 1 and back == sorted(back)))
