import pytest

from jobweave.llm.splitting import split_long
from jobweave.llm.encoding import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(vocabulary_path(name="byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


SENTENCE = "We build services for hiring teams and measure what happens. "
TEXTS = {
    1: "\n\n".join(SENTENCE * 5 for _ in range(30)), 2: SENTENCE * 200, 3: "\n".join("line of words number %d" % i for i in range(500)), 4: "漢字かな" * 900, 5: "abc" * 3000, 6: "short", 7: "", 8: None,
    9: "Kỹ sư dữ liệu làm việc tại Hà Nội, " * 150, 10: "🚀" * 1500, 11: "word " * 3000, 12: "<p>" + "</p><p>".join(SENTENCE * 3 for _ in range(40)) + "</p>",
}


def test_pieces(spark, library):
    limit, overlap = 256, 32
    df = spark.createDataFrame([(k, v, "clash") for k, v in TEXTS.items()] + [(1, TEXTS[1], "clash")], "doc_id int, text string, piece_no string")
    rows = split_long(df, "doc_id", "text", limit, overlap).orderBy("doc_id", "piece_no").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {k for k, v in TEXTS.items() if v and len(library(v)) > limit}
    for k, pieces in by.items():
        ids, end = library(TEXTS[k]), 0
        assert [p.piece_no for p in pieces] == list(range(len(pieces)))
        for i, p in enumerate(pieces):
            assert 0 < p.n_tokens <= limit and len(library(p.text)) <= limit and "�" not in p.text
            assert p.text in TEXTS[k]
            if i:
                assert overlap <= end - p.start_token <= overlap + 3 and p.start_token > pieces[i - 1].start_token
            else:
                assert p.start_token == 0
            end = p.start_token + p.n_tokens
        assert end == len(ids)
    cuts = {k: {p.cut for p in pieces[:-1]} for k, pieces in by.items()}
    assert cuts[1] == {"paragraph"} and cuts[2] == {"sentence"} and cuts[3] == {"line"} and cuts[5] == {"hard"} and cuts[11] == {"word"}


def test_nothing_to_cut(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "doc_id int, text string")
    assert split_long(df, "doc_id", "text").collect() == [] and split_long(df.limit(0), "doc_id", "text").collect() == []
