"""Mapping freely typed values to a reference list.

The entries of one kind, and their aliases, are paths of a trie over lower-case letters without
accents and spaces. From every word of a value a Levenshtein automaton walks the trie and returns all
entries within a distance that depends on their length, as long as the match ends with a word. Digits
are never edited. Of
these the one meant is that which explains most letters, after edits. Every distinct value is
searched once and joined back.

Defined results: null and blank values have no row; a value that is, code point for code point, a
canonical name of its kind has none either; values that mean no entry get -1, as do values of a kind
without entries; entries that tie get the smaller id; values of any length are searched whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.operators.lookup import lookup_join
from jobweave.session import checkpointed

# How words and word pairs are commonly shortened, whatever the list; how symbols are said; makers whose name is often left out.
SHORT_WORDS = {
    "engineer": ["eng", "developer", "dev"], "developer": ["dev", "engineer"], "engineering": ["eng"], "administrator": ["admin"], "manager": ["mgr"], "technical": ["tech"], "database": ["db"], "automation": ["auto"], "security": ["sec"],
    "scientist": ["science"], "frontend": ["front end", "fe"], "backend": ["back end", "be"], "fullstack": ["full stack"], "quality assurance": ["qa"], "machine learning": ["ml"], "site reliability": ["sre"], "user interface": ["ui"],
    "system": ["sys"], "system engineer": ["se"], "javascript": ["js"], "typescript": ["ts"], "tester": ["test"], "specialist": [],
}
SYMBOLS = {"+": " plus", "#": " sharp"}
MAKERS = {"apache", "microsoft", "google", "amazon", "oracle"}
CITY_PREFIX = "tp"
_WORD = re.compile(r"[^\W\d_]+[+#]*|\d+")


def plain(text: str) -> str:
    """Lower case without accents, wide forms made narrow."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if unicodedata.category(c) != "Mn")
    return bare.replace("đ", "d")


def words(text: str) -> list[str]:
    return _WORD.findall(plain(text))


def distance_for(length: int) -> int:
    """The edits allowed for an entry of so many letters."""
    return 0 if length <= 3 else 1 if length <= 11 else 2


class Trie:
    """Entries of one kind as paths; a node is (children, id of the entry that ends here or None, most edits allowed below, most edits of the entry).

    Entries are (id, name) or (id, name, most edits).
    """

    def __init__(self, entries: Iterable[tuple]):
        self.root: list = [{}, None, 0, 0]
        for ref_id, name, *most in entries:
            path = "".join(words(name))
            if not path:
                continue
            node, edits = self.root, min([distance_for(len(path)), *most])
            node[2] = max(node[2], edits)
            for c in path:
                node = node[0].setdefault(c, [{}, None, 0, 0])
                node[2] = max(node[2], edits)
            node[1] = ref_id if node[1] is None else min(node[1], ref_id)
            node[3] = max(edits, node[3])

    def search(self, text: str, ends: frozenset[int]) -> list[tuple[int, int, int, int]]:
        """(id, length of the entry, edits, length in the text) of all entries that begin ``text`` and end at one of ``ends``."""
        found: list[tuple[int, int, int, int]] = []
        n = len(text)
        # a state of the automaton: edits by position in the text; the previous one is kept for swapped letters
        start, i = {0: 0}, 0
        while i < min(self.root[2], n) and not text[i].isdigit():
            i += 1
            start[i] = i
        stack = [(self.root, 0, start, {}, "")]
        while stack:
            node, depth, state, earlier, letter = stack.pop()
            if node[1] is not None and depth:
                most = node[3]
                found += [(node[1], depth, e, p) for p, e in state.items() if e <= most and p in ends]
            for c, child in node[0].items():
                most, then = child[2], {}
                for p, e in state.items():
                    if p < n and text[p] == c:
                        if e < then.get(p + 1, 9):
                            then[p + 1] = e
                    elif e < most and p < n and e + 1 < then.get(p + 1, 9) and not text[p].isdigit():
                        then[p + 1] = e + 1
                    if e < most and e + 1 < then.get(p, 9):
                        then[p] = e + 1
                for p, e in earlier.items():
                    if e < most and p + 1 < n and text[p] == c and text[p + 1] == letter and e + 1 < then.get(p + 2, 9):
                        then[p + 2] = e + 1
                for p in sorted(then):
                    e = then[p]
                    while e < most and p < n and e + 1 < then.get(p + 1, 9) and not text[p].isdigit():
                        p, e = p + 1, e + 1
                        then[p] = e
                if then:
                    stack.append((child, depth + 1, then, state, c))
        return found

    def candidates(self, text: str) -> list[tuple[int, int, str, int]]:
        """(id, edits, the part of the text that matched, its first word) of every entry within its distance, from any word on; per entry its best match."""
        tokens, best = words(text), {}
        for i in range(len(tokens)):
            tail = "".join(tokens[i:])
            ends = frozenset(len("".join(tokens[i:k])) for k in range(i + 1, len(tokens) + 1))
            for ref_id, length, edits, taken in self.search(tail, ends):
                found = (3 * edits - length, edits, i, tail[:taken])
                if ref_id not in best or found < best[ref_id]:
                    best[ref_id] = found
        return [(ref_id, edits, part, i) for ref_id, (_, edits, i, part) in sorted(best.items())]

    def meant(self, text: str) -> int:
        """The id of the entry meant by ``text``, or -1; words turned round a comma ("Manager, Project") are tried in both orders."""
        best = self._best(words(text))
        if best is None and "," in text:
            before, after = (words(x) for x in text.split(",", 1))
            turned = (self._best(after[:k] + before[-m:]) for k in (1, 2, 3) for m in (1, 2, 3) if k <= len(after) and m <= len(before))
            best = max((x for x in turned if x), default=None)
        return -1 if best is None else -best[2]

    def _best(self, tokens: list[str]) -> tuple[int, int, int] | None:
        """(letters explained after edits, -edits, -id) of the best entry."""
        best: tuple[int, int, int] | None = None
        for i in range(len(tokens)):
            tail, ends, at = tokens[i:], [], 0
            for t in tail:
                at += len(t)
                ends.append(at)
            for ref_id, length, edits, taken in self.search("".join(tail), frozenset(ends)):
                score = (length - 3 * edits, -edits, -ref_id)
                if best is None or score > best:
                    best = score
        return best


def generated_forms(name: str, kind: str | None = None) -> set[str]:
    """Short and other forms of one name by rule: shortened words, initials, numeronyms, said symbols, a dropped maker, ending or last word."""
    own = words(name)
    key, forms = " ".join(own), set()
    for long, shorts in SHORT_WORDS.items():
        if re.search(rf"(?<!\S){long}(?!\S)", key):
            forms |= {re.sub(rf"(?<!\S){long}(?!\S)", x, key) for x in shorts}
    for form in list(forms):  # a second word may be shortened too
        for long, shorts in SHORT_WORDS.items():
            if re.search(rf"(?<!\S){long}(?!\S)", form):
                forms |= {re.sub(rf"(?<!\S){long}(?!\S)", x, form) for x in shorts}
    letters = [w for w in own if w.isalpha()]
    if len(letters) > 1:
        initials = "".join(w[0] for w in letters)
        forms |= {initials, f"{CITY_PREFIX} {initials}", *([initials + "c"] if len(letters) > 2 else [])} if kind == "city" else {initials}
        if len(letters) > 2 and kind == "title":
            forms.add(letters[0][:2] + initials[1:])
        forms |= {initials[:i] + x + initials[i + 1:] for i, w in enumerate(letters) for x in SHORT_WORDS.get(w, ()) if len(x) == 2}
        if letters[0] in MAKERS:
            forms |= {" ".join(own[1:]), f"{letters[0]} {initials}"}
        if len(letters) > 2:
            forms.add(" ".join(own[:-1]))
        if len(letters) == 2 and kind == "title" and "/" in name:
            forms |= {" ".join(own[::-1])}
    if "/" in name:
        first, _, rest = name.partition(" ")
        parts = [p for p in first.split("/") if p]
        forms |= {" ".join(parts), f"{'/'.join(parts[::-1])} {rest}", *(f"{p} {rest}" for p in parts)}
    if any(c in name for c in SYMBOLS):
        forms.add("".join(SYMBOLS.get(c, c) for c in name))
    if len(own) == 1 and len(key) > 6 and key.isalpha():
        forms.add(f"{key[0]}{len(key) - 2}{key[-1]}")
    for ending in (".js", "js", "sql", "db", "search"):
        if len(own) <= 2 and name.lower().endswith(ending) and len(name) - len(ending) > 3:
            forms.add(name[:-len(ending)])
    if len(own) == 1 and kind == "skill" and len(key) > 3 and key.isalpha():
        forms.add(key + "js")
    return {f for f in forms if f.strip() and f.strip() != key}


def short_forms_of(reference: Sequence[tuple[int, str, str, Sequence[str] | None]]) -> dict[str, dict[str, list[str]]]:
    """Forms by kind and name, generated; a form that two entries would have, or that is an entry's own name or alias, is left out."""
    owner: dict[tuple[str, str], set[int]] = {}
    own = {(kind, "".join(words(x))) for _, kind, name, aliases in reference for x in (name, *(aliases or ())) if x}
    made = [(ref_id, kind, name, generated_forms(name, kind)) for ref_id, kind, name, _ in reference if name]
    for ref_id, kind, _, forms in made:
        for f in forms:
            owner.setdefault((kind, "".join(words(f))), set()).add(ref_id)
    out: dict[str, dict[str, list[str]]] = {}
    for ref_id, kind, name, forms in made:
        out.setdefault(kind, {})[name] = sorted(f for f in forms if len(owner[kind, "".join(words(f))]) == 1 and (kind, "".join(words(f))) not in own)
    return out


def tries(reference: Sequence[tuple[int, str, str, Sequence[str] | None]], short_forms: dict | None = None) -> dict[str, Trie]:
    """A trie per kind from (ref_id, kind, canonical_name, aliases); ``short_forms`` by kind and name are the caller's, else generated."""
    forms = short_forms_of(reference) if short_forms is None else short_forms
    paths: dict[str, list[tuple]] = {}
    for ref_id, kind, name, aliases in reference:
        paths.setdefault(kind, []).extend((ref_id, path) for path in (name, *(aliases or ())) if path)
        paths[kind].extend((ref_id, path, 1) for path in forms.get(kind, {}).get(name, ()))  # a short form bears one typing error at most
    return {kind: Trie(entries) for kind, entries in paths.items()}


def candidates(values: DataFrame, reference: Sequence[tuple[int, str, str, Sequence[str] | None]], short_forms: dict | None = None) -> DataFrame:
    """(kind, value, times, ref_id, edits, matched): for every distinct of the ``values`` all entries within their distances, not only the one meant."""
    shared = values.sparkSession.sparkContext.broadcast(tries(reference, short_forms))

    @F.pandas_udf("array<struct<ref_id:bigint,edits:int,matched:string,word:int>>")
    def found(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        by = shared.value
        return pd.Series([[dict(zip(("ref_id", "edits", "matched", "word"), x)) for x in by[k].candidates(t)] if k in by else [] for k, t in zip(kinds, texts)])

    distinct = values.where(F.col("value").rlike(r"[^\s\p{Z}\p{C}]")).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("times"))
    distinct = distinct.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "value")
    return distinct.withColumn("c", F.explode(found("kind", "value"))).select("kind", "value", "times", "c.ref_id", "c.edits", "c.matched")


def map_values(values: DataFrame, reference: Sequence[tuple[int, str, str, Sequence[str] | None]], spread: Sequence[str], short_forms: dict | None = None) -> DataFrame:
    """(kind, value, spread, ref_id) of the ``values`` (with ``kind`` and ``value``) that need mapping.

    ``reference`` is a list that does not grow with the data; ``spread`` are the columns that name a row.
    """
    values = values.select("kind", "value", *spread)
    names = values.sparkSession.createDataFrame(sorted({(kind, name) for _, kind, name, _ in reference if kind and name}), "kind string, value string")
    asked = values.where(F.col("value").rlike(r"[^\s\p{Z}\p{C}]")).join(F.broadcast(names), ["kind", "value"], "left_anti")  # a row per entry of the reference list
    shared = values.sparkSession.sparkContext.broadcast(tries(reference, short_forms))

    @F.pandas_udf("bigint")
    def meant(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        by = shared.value
        return pd.Series([by[k].meant(t) if k in by else -1 for k, t in zip(kinds, texts)], dtype="int64")

    distinct = asked.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("times"))
    # a search costs far more than a value's bytes tell, so AQE should not join small partitions here
    distinct = distinct.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "value")
    known = checkpointed(distinct.withColumn("ref_id", meant("kind", "value")))
    return lookup_join(asked, known, ["kind", "value"], F.octet_length("value") + 64, spread)
