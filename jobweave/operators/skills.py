"""Skills named in free text: every alias at word boundaries, with rules against common false hits.

The taxonomy is a small list; one compiled alternation finds all aliases of a text at once (Arrow UDF,
since all occurrences and their places are needed). The first occurrence per skill counts, the longest of
those that begin together.

Defined results: null and empty texts give an empty list; spans are code points of the composed text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words around an ambiguous alias that make it a skill, and the ambiguous aliases.
TECH_CONTEXT = r"\b(?:skill|skills|experience|experienced|proficien(?:t|cy)|knowledge|developer|engineer|framework|language|stack|required|requirements?|lập\s+trình|kỹ\s+năng|kinh\s+nghiệm|thành\s+thạo|yêu\s+cầu)\b"
LANGUAGE_CONTEXT = r"\b(?:fluent|proficien(?:t|cy)|communication|written|spoken|required|language|thành\s+thạo|giao\s+tiếp|đọc|viết|yêu\s+cầu|tiếng)\b"
AMBIGUOUS = {"angular", "excel", "flutter", "go", "js", "node", "py", "react", "spark", "spring", "tf", "torch", "ts", "vue"}
HUMAN_LANGUAGES = {"English", "Japanese", "Korean"}
WINDOW = 55
SKILL = "array<struct<skill:string,alias:string,category:string,start:int,stop:int,confidence:double>>"


def read_taxonomy(lines: Iterable[str]) -> list[tuple[str, tuple[str, ...], str]]:
    """(name, aliases, category) from a Markdown table of four columns; a name or alias has one owner."""
    out: list[tuple[str, tuple[str, ...], str]] = []
    owner: dict[str, str] = {}
    for line in lines:
        cells = [c.strip() for c in line.strip().strip("|").split("|")] if line.strip().startswith("|") else []
        if len(cells) != 4 or cells[0].lower() == "canonical name" or set(cells[0]) <= set("-: "):
            continue
        aliases = tuple(a.strip() for a in cells[1].split(",") if a.strip())
        for term in {cells[0].casefold(), *(a.casefold() for a in aliases)}:
            if owner.setdefault(term, cells[0]) != cells[0]:
                raise ValueError(f"{term!r} belongs to {owner[term]!r} and {cells[0]!r}")
        out.append((cells[0], aliases, cells[2]))
    return out


class Matcher:
    def __init__(self, taxonomy: Sequence[tuple[str, Sequence[str], str]]):
        self.terms: dict[str, tuple[str, str, str]] = {}
        for name, aliases, category in taxonomy:
            for term in (name, *aliases):
                self.terms.setdefault(" ".join(term.casefold().split()), (name, term, category))
        body = "|".join(r"\s+".join(map(re.escape, t.split())) for t in sorted(self.terms, key=len, reverse=True))
        self.find = re.compile(rf"(?<!\w)(?=({body})(?!\w))", re.I) if self.terms else None
        self.tech, self.lang = re.compile(TECH_CONTEXT, re.I), re.compile(LANGUAGE_CONTEXT, re.I)

    def excluded(self, text: str, name: str, key: str, a: int, b: int) -> bool:
        around = text[max(0, a - WINDOW):b + WINDOW]
        before = text[max(0, a - 16):a]
        return (
            (key == "py" and text[a - 1:a] == ".") or (key in AMBIGUOUS and not self.tech.search(around)) or (name in HUMAN_LANGUAGES and not self.lang.search(around))
            or (name == "Selenium" and re.search(r"\belement\s+$", before, re.I) is not None) or (name == "Playwright" and re.search(r"\b(?:the|a)\s+$", before, re.I) is not None))

    def match(self, text: str | None) -> list[dict]:
        if not text or self.find is None:
            return []
        t, seen, out = unicodedata.normalize("NFC", text), set(), []
        for m in self.find.finditer(t):
            a, b = m.span(1)
            key = " ".join(m.group(1).casefold().split())
            name, term, category = self.terms[key]
            if name in seen or self.excluded(t, name, key, a, b):
                continue
            seen.add(name)
            out.append({"skill": name, "alias": term, "category": category, "start": a, "stop": b, "confidence": 0.95 if key == name.casefold() else 0.9})
        return out


def match_skills(df: DataFrame, text_col: str, taxonomy: Sequence[tuple[str, Sequence[str], str]], out: str = "skills") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast([(n, tuple(a), c) for n, a, c in taxonomy])
    compiled: list[Matcher] = []

    @F.pandas_udf(SKILL)
    def matched(texts: pd.Series) -> pd.Series:
        if not compiled:
            compiled.append(Matcher(shared.value))
        return texts.map(compiled[0].match)

    return df.withColumn(out, matched(F.col(text_col)))
