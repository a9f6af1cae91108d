"""Cutting long texts into pieces of a limited number of tokens, at natural boundaries.

A text over the limit is laid out as token offsets (prefix sums of the tokens' byte lengths). The
ends of paragraphs, lines and sentences are sorted arrays of token offsets; each piece ends at the
last boundary under the limit, found by binary search, best kind first, as long as the piece is at
least half full; then at any boundary, then between words, else by a hard cut between characters. The next
piece steps back by the overlap from there.

The limit holds for a piece's text on its own as well: ranked merges never crossed a token boundary of the
whole text, so the tokens between two boundaries are encoded alike without what is around them.
The overlap is exact, but where it would begin inside a character it begins with that character.

Defined results: null, empty and short texts give no piece (nothing has to be cut); rows with the
same id and text are one document; a text without any boundary is cut hard.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.encoding import encode, load_ranks, vocabulary_path

BOUNDARIES = [
    ("paragraph", re.compile(r"(?:\r\n|\n|\r)[^\S\r\n]*(?:\r\n|\n|\r)\s*|</p>|</div>|</ul>")),
    ("line", re.compile(r"\r\n|\n|\r| |<br\s*/?>|</li>")),
    ("sentence", re.compile(r"[.!?…]+[\"'”’)\]]*(?=\s)|[。！？]+[」』）]*")),
]
_WORD_END = re.compile(r"(?<=\S)(?=\s)")


class Layout:
    """One document as token offsets."""

    def __init__(self, text: str, ids: np.ndarray, lengths: np.ndarray):
        self.text, self.raw, self.n = text, text.encode("utf-8", "surrogatepass"), len(ids)
        self.start = np.concatenate([[0], np.cumsum(lengths[ids])])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.char_at = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])
        self.cuts = [(kind, self.offsets(m.end() for m in pattern.finditer(text))) for kind, pattern in BOUNDARIES]
        self.any = sorted({x for _, cuts in self.cuts for x in cuts})

    @cached_property
    def words(self) -> list[int]:
        return self.offsets(m.start() for m in _WORD_END.finditer(self.text))

    def whole(self, i: int) -> bool:
        """Whether token ``i`` begins with a character, not inside one."""
        at = self.start[i]
        return at >= len(self.raw) or self.raw[at] & 0xC0 != 0x80

    def offsets(self, chars: Iterator[int]) -> list[int]:
        """Token offsets of those character positions at which a token begins."""
        at = self.char_at[np.fromiter(chars, np.int64)]
        i = np.searchsorted(self.start, at)
        return sorted(set(i[(i <= self.n) & (self.start[np.minimum(i, self.n)] == at)].tolist()))

    def end_from(self, a: int, limit: int) -> tuple[int, str]:
        """Where a piece that begins at token ``a`` ends, and at what."""
        most = a + limit
        if most >= self.n:
            return self.n, "end"
        half = a + limit // 2
        for kind, cuts in self.cuts:
            i = bisect_right(cuts, most) - 1
            if i >= 0 and cuts[i] > half:
                return cuts[i], kind
        for kind, least in (("any", a + limit // 4), ("word", half)):
            cuts = self.any if kind == "any" else self.words
            i = bisect_right(cuts, most) - 1
            if i >= 0 and cuts[i] > least:
                return cuts[i], kind
        while most > a + 1 and not self.whole(most):
            most -= 1
        return most, "hard"

    def pieces(self, limit: int, overlap: int) -> Iterator[tuple[int, int, str]]:
        a = 0
        while True:
            b, kind = self.end_from(a, limit)
            yield a, b, kind
            if b >= self.n:
                return
            back = max(b - overlap, a + 1)
            while back > a + 1 and not self.whole(back):
                back -= 1
            a = back


PIECE = "piece_no int, start_token int, n_tokens int, cut string, text string"


def split_long(df: DataFrame, id_col: str, text_col: str, limit: int = 1024, overlap: int = 64, path: str | None = None) -> DataFrame:
    """(id_col, piece_no, start_token, n_tokens, cut, text): the pieces of every text over ``limit`` tokens.

    A token has at least one byte, so a text of at most ``limit`` bytes needs no encoding.
    """
    path = path or vocabulary_path()
    may = df.where(F.octet_length(text_col) > limit).select(id_col, text_col)
    long = encode(may, id_col, text_col, path, keep={"_text": F.col(text_col)}).where(F.size("ids") > limit)
    sizes = np.zeros(max((ranks := load_ranks(path)).values()) + 1, np.int32)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    shared = df.sparkSession.sparkContext.broadcast(sizes)  # a number per token of the vocabulary

    @F.pandas_udf(f"array<struct<{', '.join(x.replace(' ', ':', 1) for x in PIECE.split(', '))}>>")
    def cut(texts: pd.Series, ids: pd.Series) -> pd.Series:
        out = []
        for text, tokens in zip(texts, ids):
            x = Layout(text, np.asarray(tokens, np.int64), shared.value)
            out.append([
                {"piece_no": i, "start_token": a, "n_tokens": b - a, "cut": kind, "text": x.raw[x.start[a]:x.start[b]].decode("utf-8", "replace")}
                for i, (a, b, kind) in enumerate(x.pieces(limit, overlap))
            ])
        return pd.Series(out)

    pieces = long.select(id_col, F.explode(cut(F.col("_text"), F.col("ids"))).alias("p"))
    return pieces.select(id_col, "p.*")
