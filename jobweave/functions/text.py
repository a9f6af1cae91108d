"""Text functions as column expressions: display forms, comparison keys, redaction, previews, URLs.

All of them give null for null, and null for texts of which nothing is left, unless stated.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Accented letters and their bases, worked out from the Unicode database (U+0080 to U+2FFF)."""
    marked, bases = ["đ", "Đ"], ["d", "D"]
    for code in range(0x80, 0x3000):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            marked.append(c)
            bases.append(base)
    return "".join(marked), "".join(bases)


def display(text: Column) -> Column:
    """Plain punctuation and single spaces; null if blank."""
    plain = F.translate(text, "–—’“”", "--'\"\"")
    return F.nullif(F.trim(F.regexp_replace(plain, r"(?U)\s+", " ")), F.lit(""))


def without_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, *accent_table()), r"\p{Mn}", "")


def comparison_key(text: Column) -> Column:
    """Lower case without accents, one space between words; an underscore is part of a word."""
    folded = F.replace(F.lower(without_accents(display(text))), F.lit("ß"), F.lit("ss"))
    return F.nullif(F.trim(F.regexp_replace(folded, r"(?U)[^\w]+", " ")), F.lit(""))


def tokens(text: Column) -> Column:
    """The words of the comparison key; an empty array where there are none."""
    return F.coalesce(F.split(comparison_key(text), " "), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements as a decimal; 0 where both are empty."""
    either = F.size(F.array_union(a, b))
    share = (F.size(F.array_intersect(a, b)).cast("decimal(10,0)") / F.nullif(either, F.lit(0)).cast("decimal(10,0)")).cast("decimal(18,10)")
    return F.coalesce(share, F.lit(0).cast("decimal(18,10)"))


def unescaped(text: Column) -> Column:
    """Named (the standard's table) and numeric character references read, each once: what they give is not read again."""
    named = F.from_json(F.lit(json.dumps({k.rstrip(";"): v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"), 1))

    def char(e: Column) -> Column:
        code = F.when(F.lower(e).startswith("#x"), F.conv(F.substr(e, F.lit(3)), 16, 10)).otherwise(F.substr(e, F.lit(2))).try_cast("int")
        numeric = F.when(code.between(1, 0xFFFF) & ~code.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 4, "0")), "UTF-16BE"))
        return F.when(e.startswith("#"), F.coalesce(numeric, F.lit("\ufffd"))).otherwise(F.coalesce(F.translate(named[e], "&", "\u0001"), F.concat(F.lit("\u0001"), e, F.lit(";"))))

    def put(t: Column, e: Column) -> Column:
        return F.replace(t, F.concat(F.lit("&"), e, F.lit(";")), F.translate(char(e), "&", "\u0001"))

    return F.when(F.size(found) > 0, F.translate(F.aggregate(found, text, put), "\u0001", "&")).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Text without tags, with e-mail addresses and phone numbers replaced by placeholders."""
    bare = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    bare = unescaped(bare)
    bare = F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))
    bare = F.regexp_replace(bare, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[REDACTED_EMAIL]")
    return F.regexp_replace(bare, r"(?<!\d)(?:\+84|0)(?:[ .-]?\d){8,10}(?!\d)", "[REDACTED_PHONE]")


def preview(text: Column, most: int = 500) -> Column:
    """The beginning of a text without tags; null if nothing is left."""
    return F.nullif(F.left(F.trim(F.regexp_replace(text, r"<[^>]+>", " ")), F.lit(most)), F.lit(""))


def job_id_of(url: Column) -> Column:
    """The last run of digits of the path that follows a hyphen or slash."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.try_element_at(F.regexp_extract_all(path, F.lit(r"[-/](\d+)"), 1), F.lit(-1))


def is_web_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i)https?://[^/?#]+"), F.lit(False))


def title_case(text: Column) -> Column:
    """Every run of letters with a capital first letter."""
    runs = F.regexp_extract_all(text, F.lit(r"(?U)\p{L}+|[^\p{L}]+"), 0)
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))), "")
