"""Encoding texts with a public byte-level BPE vocabulary, and decoding.

Words (the pattern's matches) are encoded once each: the distinct words' bytes, as hex pairs,
are folded by ranked merges with higher-order functions over a literal rank map. The rank map is an
array of small maps, picked by CRC, since a lookup in one map of 50,000 keys would read them all. A word is
first cut wherever no token of the vocabulary has the two bytes side by side: no merge ever crosses
such a place, so the parts are folded apart and long words cost little more than short ones.

The ``HOT_WORDS`` most frequent words go into the plan as a literal of the same kind and are looked up in
place; only the other words leave their text, are joined to the dictionary and put back between them.

Defined results: null and empty texts give an empty list; rows with the same id and text are one
document; rows with the same id and other texts stay apart; a null id is an id like any other.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.operators.lookup import lookup_join
from jobweave.session import checkpointed

TOKENIZER_DIR = os.environ.get("JOBWEAVE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The public pattern of this vocabulary; \s is Unicode white space, which Java has to be told.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
MAPS = 8_192
HOT_WORDS = 16_384
NO_RANK = 2_147_483_647
WORDS_PER_TASK = 20_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: bytes and rank, a line each."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def vocabulary_path(directory: str | None = None, name: str = VOCABULARY) -> str:
    return os.path.join(directory or TOKENIZER_DIR, name)


@lru_cache(maxsize=4)
def _rank_json(path: str) -> str:
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for piece, rank in load_ranks(path).items():
        key = piece.hex().upper()
        maps[zlib.crc32(key.encode()) % MAPS][key] = rank
    return json.dumps(maps, separators=(",", ":"))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _rank_map(path: str) -> Column:
    return F.from_json(F.lit(_rank_json(path)), "array<map<string,int>>")  # folded to a literal


@lru_cache(maxsize=4)
def _crossing_json(path: str) -> str:
    """For every two bytes whether some token has them side by side."""
    pairs = {token[i:i + 2] for token in load_ranks(path) for i in range(len(token) - 1)}
    return json.dumps([(n.to_bytes(2, "big") in pairs) for n in range(65_536)], separators=(",", ":"))


def _rank(ranks: Column, piece: Column) -> Column:
    """The rank of one byte string, given in hex; NO_RANK if it is no token."""
    return F.coalesce(ranks[(F.crc32(piece.cast("binary")) % MAPS).cast("int")][piece], F.lit(NO_RANK))


def fold_word(word: Column, path: str) -> Column:
    """array<int>: the token ids of one word, by merging the pair of lowest rank until none is left.

    The literals are bound once to names, since plans, and all that keeps their text, would else hold them at every use.
    """
    crossing = F.from_json(F.lit(_crossing_json(path)), "array<boolean>")
    return _let(crossing, lambda cross: _let(_rank_map(path), lambda ranks: _let(F.hex(word.cast("binary")), lambda h: F.flatten(F.transform(_parts(h, cross), lambda part: _fold_hex(part, ranks))))))


def _parts(h: Column, cross: Column) -> Column:
    """The hex of a word, cut between bytes that no token has side by side."""
    n = (F.length(h) / 2).cast("int")
    inner = F.filter(F.sequence(F.lit(0), n), lambda i: (i > 0) & (i < n) & ~cross[F.conv(F.substr(h, i * 2 - 1, F.lit(4)), 16, 10).cast("int")])
    cuts = F.concat(F.array(F.lit(0)), inner, F.array(n))
    return _let(cuts, lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.substr(h, a * 2 + 1, (b - a) * 2)))


def _fold_hex(h: Column, ranks: Column) -> Column:
    """The state holds the pieces and the ranks of neighbouring pairs; a merge works out two of them again."""

    def merge(state: Column, _: Column) -> Column:
        p, r = state["p"], state["r"]

        def at(i: Column) -> Column:  # the pair of pieces i and i + 1, from 1
            def put(m: Column) -> Column:
                pieces = F.concat(F.slice(p, 1, i - 1), F.array(m), F.slice(p, i + 2, F.size(p)))
                left = F.when(i > 1, F.array(_rank(ranks, F.concat(p[i - 2], m)))).otherwise(F.slice(r, 1, 0))
                right = F.when(i + 1 < F.size(p), F.array(_rank(ranks, F.concat(m, p[i + 1])))).otherwise(F.slice(r, 1, 0))
                pairs = F.concat(F.slice(r, 1, F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, F.size(r)))
                return F.struct(pieces.alias("p"), pairs.alias("r"))

            return _let(F.concat(p[i - 1], p[i]), put)

        return _let(F.array_min(r), lambda best: F.when(F.coalesce(best, F.lit(NO_RANK)) == NO_RANK, state).otherwise(_let(F.array_position(r, best).cast("int"), at)))

    n = (F.length(h) / 2).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(h, i * 2 + 1, F.lit(2)))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: _rank(ranks, F.substr(h, i * 2 + 1, F.lit(4))))).otherwise(F.array().cast("array<int>"))
    start = F.struct(pieces.alias("p"), pairs.alias("r"))
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, merge, lambda s: F.transform(s["p"], lambda x: _rank(ranks, x)))
    return _let(_rank(ranks, h), lambda whole: F.when(whole != NO_RANK, F.array(whole)).otherwise(folded))


def bpe(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word without Spark: a heap of adjacent pairs over a linked list; what the fold is tested against."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    piece = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, piece[i] + piece[i + 1]) for i in range(n - 1) if (r := ranks.get(piece[i] + piece[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if piece[i] else n
        if j >= n or piece[i] + piece[j] != joined:
            continue
        piece[i], piece[j] = joined, b""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(joined + piece[after[i]])) is not None:
                heapq.heappush(heap, (r, i, joined + piece[after[i]]))
        if before[i] >= 0 and (r := ranks.get(piece[before[i]] + joined)) is not None:
            heapq.heappush(heap, (r, before[i], piece[before[i]] + joined))
    return [ranks[p] for p in piece if p]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), 0)


def dictionary(words: DataFrame, path: str) -> DataFrame:
    """(word, times, ids) for the distinct words of ``words``, written to the checkpoint folder."""
    distinct = checkpointed(words.where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("times")))
    # a word costs far more than its bytes tell, so tasks are cut by words, not by bytes
    distinct = distinct.repartition(max(2 * words.sparkSession.sparkContext.defaultParallelism, -(-distinct.count() // WORDS_PER_TASK)))
    return checkpointed(distinct.withColumn("ids", fold_word(F.col("word"), path)))


def _hot_ids(words: Column, known: DataFrame, most: int) -> Column:
    """The ids of each of ``words`` that is one of the ``most`` most frequent, else null: a literal of bounded size."""
    slot = lambda w: F.pmod(F.hash(w), F.lit(most))
    maps: list[dict[str, list[int]]] = [{} for _ in range(most)]
    for r in known.orderBy(F.desc("times"), "word").limit(most).select("word", "ids", slot(F.col("word")).alias("slot")).collect():
        maps[r.slot][r.word] = list(r.ids)
    literal = F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,array<int>>>")
    return _let(literal, lambda hot: F.transform(words, lambda w: hot[slot(w)][w]))


def _keyed(df: DataFrame, id_col: str, text_col: str, keep: dict[str, Column] | None = None) -> DataFrame:
    return df.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("key"), F.col(text_col).alias("text"), F.struct(*[c.alias(n) for n, c in (keep or {"_": F.lit(0)}).items()]).alias("kept"))


def _looked_up(docs: DataFrame, path: str, of_hot) -> DataFrame:
    """(key, kept, word, pos, hot, ids) from (key, text, kept): a row per document with ``hot``, ``of_hot`` of its words' ids, and one per word that is not hot."""
    known = dictionary(docs.select(F.explode(words_of(F.col("text"))).alias("word")), path)
    words = docs.select("key", "kept", F.coalesce(words_of(F.col("text")), F.array().cast("array<string>")).alias("words"))
    cells = words.withColumn("found", _hot_ids(F.col("words"), known, HOT_WORDS)).withColumn("flat", F.flatten("found"))  # null if a word is not hot
    hot = of_hot(F.col("found"), F.col("flat"))
    rare = F.filter(F.sequence(F.lit(0), F.size("found") - 1), lambda i: F.col("found")[i].isNull())
    rare = F.when(F.col("flat").isNull(), rare).otherwise(F.array().cast("array<int>"))
    packed = F.struct(F.lit(None).cast("string").alias("word"), F.lit(-1).alias("pos"), hot.alias("hot"))
    rows = F.concat(F.array(packed), F.transform(rare, lambda i: F.struct(F.col("words")[i].alias("word"), i.alias("pos"), F.when(F.lit(False), hot).alias("hot"))))
    tokens = cells.select("key", "kept", F.explode(rows).alias("t")).select("key", F.when(F.col("t.pos") == -1, F.col("kept")).alias("kept"), "t.*")
    return lookup_join(tokens, known, ["word"], F.octet_length("word") + 4 * F.size("ids") + 48, ["key", "pos"])


def encode(df: DataFrame, id_col: str, text_col: str, path: str | None = None, with_hash: bool = False, keep: dict[str, Column] | None = None) -> DataFrame:
    """(id_col[, text_hash], ids, kept columns): the token ids of every text, without special tokens.

    The texts are shuffled, once, so that what leaves a document meets it again in the partition it was cut in.
    """
    rows = _looked_up(_keyed(df, id_col, text_col, keep).repartition("key"), path or vocabulary_path(), lambda found, flat: F.when(flat.isNotNull(), F.array(flat)).otherwise(found))
    cells = F.when(F.col("ids").isNotNull(), F.struct("pos", "ids"))
    grouped = rows.groupBy("key").agg(F.first("hot", ignorenulls=True).alias("hot"), F.first("kept", ignorenulls=True).alias("kept"), F.sort_array(F.collect_list(cells)).alias("rare"))
    # repeated rows have every place twice, side by side once sorted
    grouped = grouped.withColumn("rare", F.filter("rare", lambda c, i: (i == 0) | (F.col("rare")[F.greatest(i - 1, F.lit(0))]["pos"] != c["pos"])))
    closed = F.concat("rare", F.array(F.struct(F.size("hot").alias("pos"), F.array().cast("array<int>").alias("ids"))))

    def before(cs: Column, c: Column, k: Column) -> Column:  # the hot words up to a rare one, then its ids
        last = F.when(k == 0, F.lit(-1)).otherwise(cs[F.greatest(k - 1, F.lit(0))]["pos"])
        return F.concat(F.flatten(F.slice("hot", last + 2, c["pos"] - last - 1)), c["ids"])

    mixed = _let(closed, lambda cs: F.flatten(F.transform(cs, lambda c, k: before(cs, c, k))))
    names = [F.col("key.id").alias(id_col)] + ([F.col("key.h").alias("text_hash")] if with_hash else [])
    return grouped.select(*names, F.when(F.size("rare") == 0, F.flatten("hot")).otherwise(mixed).alias("ids"), *[F.col(f"kept.{c}").alias(c) for c in keep or ()])


def token_counts(df: DataFrame, id_col: str, text_col: str, path: str | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """(id_col, n_tokens, kept columns) of every document, in one pass over the texts after the dictionary's."""
    rows = _looked_up(_keyed(df, id_col, text_col, keep), path or vocabulary_path(), lambda found, flat: F.when(flat.isNotNull(), F.size(flat).cast("bigint")).otherwise(F.aggregate(found, F.lit(0).cast("bigint"), lambda n, ids: n + F.when(ids.isNotNull(), F.size(ids)).otherwise(0))))
    sums = rows.groupBy("key").agg(F.sum("hot").alias("hot"), F.sum(F.when(F.col("ids").isNotNull(), F.size("ids"))).alias("rare"), F.count_if(F.col("pos") == -1).alias("copies"), F.first("kept", ignorenulls=True).alias("kept"))
    n = ((F.col("hot") + F.coalesce("rare", F.lit(0))) / F.col("copies")).cast("bigint")  # repeated rows count once
    return sums.select(F.col("key.id").alias(id_col), n.alias("n_tokens"), *[F.col(f"kept.{c}").alias(c) for c in keep or ()])


def decode(df: DataFrame, id_col: str, ids_col: str, path: str | None = None) -> DataFrame:
    """(id_col, text) from token ids: a literal array of the pieces' bytes, concatenated."""
    ranks = load_ranks(path or vocabulary_path())
    table = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece.hex()
    pieces = F.from_json(F.lit(json.dumps(table)), "array<string>")
    text = F.decode(F.unhex(F.array_join(F.transform(ids_col, lambda i: pieces[i]), "")), "UTF-8")
    return df.select(F.col(id_col), text.alias("text"))
