"""Full-text search over serving documents: weighted lexemes, web-style queries, ranked pages.

A document keeps its lexemes (with positions) per weight class, title A, skills B, company and place C,
description D. A query string is read on the driver: words are joined by AND, ``or`` between words, a
leading ``-`` negates, quotes make a phrase. Matching and ranking are column expressions.

Defined results: a blank query matches everything with rank 0; null fields have no lexemes; ties
of rank go by date, then id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.functions.text import comparison_key

WEIGHTS = {"a": 1.0, "b": 0.4, "c": 0.2, "d": 0.1}


def lexemes(text: Column) -> Column:
    """Lower-case words in order; an empty array for null."""
    words = F.split(F.lower(text), r"(?U)[^\p{L}\p{N}+#]+")
    return F.coalesce(F.filter(words, lambda w: w != ""), F.array().cast("array<string>"))


@dataclass(frozen=True)
class Term:
    words: tuple[str, ...]
    negated: bool = False


def parse_query(text: str | None) -> list[list[Term]]:
    """Groups joined by AND, the terms of a group by OR."""
    groups: list[list[Term]] = []
    joined = False
    for m in re.finditer(r'(-?)"([^"]*)"|(\S+)', text or ""):
        raw = m.group(2) if m.group(3) is None else m.group(3)
        negated = bool(m.group(1)) or (m.group(3) or "").startswith("-")
        if m.group(3) is not None and m.group(3).lower() == "or":
            joined = bool(groups)
            continue
        words = tuple(w for w in re.split(r"[^\w+#]+", raw.lower()) if w)
        if not words:
            continue
        if joined:
            groups[-1].append(Term(words, negated))
        else:
            groups.append([Term(words, negated)])
        joined = False
    return groups


def _has(words: Column, term: Term) -> Column:
    if len(term.words) == 1:
        return F.array_contains(words, term.words[0])
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.contains(joined, F.lit(" " + " ".join(term.words) + " "))


def matches(query: str | None, classes: dict[str, str]) -> Column:
    """Whether a document's lexeme columns (by weight class) satisfy the query."""
    out = F.lit(True)
    for group in parse_query(query):
        any_of = F.lit(False)
        for term in group:
            found = F.lit(False)
            for c in classes.values():
                found = found | _has(F.col(c), term)
            any_of = any_of | (~found if term.negated else found)
        out = out & any_of
    return out


def rank(query: str | None, classes: dict[str, str]) -> Column:
    """The sum, over the query's terms and the classes they occur in, of the class weights."""
    out = F.lit(0.0)
    for group in parse_query(query):
        for term in group:
            if not term.negated:
                for k, c in classes.items():
                    out = out + F.when(_has(F.col(c), term), WEIGHTS[k]).otherwise(0.0)
    return F.round(out, 6)  # else equal sums, added in another order, would not tie


def serving_documents(jobs: DataFrame) -> DataFrame:
    """One current document per posting: its newest version by last_seen_at, with lexemes per class."""
    current = jobs.groupBy("source", "source_job_id").agg(F.max(F.struct("last_seen_at", "record_index")).alias("m")).select(F.col("m.record_index").alias("record_index"))
    docs = jobs.join(current, "record_index", "left_semi")
    return docs.select(
        "record_index", "source", "source_job_id", "title_raw", "company_name", "location_raw", "work_mode", "employment_type", "posted_at", "is_active",
        F.left("description_raw", F.lit(1200)).alias("excerpt"), comparison_key(F.col("company_name")).alias("company_key"), "skills_raw",
        lexemes(F.col("title_raw")).alias("a"), lexemes(F.array_join("skills_raw", " ")).alias("b"), lexemes(F.concat_ws(" ", "company_name", "location_raw")).alias("c"), lexemes(F.col("description_raw")).alias("d"))
