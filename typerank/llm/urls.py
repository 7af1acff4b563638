"""URL filter: host rules first, then a weighted vocabulary.

An Aho-Corasick automaton finds all vocabulary terms of a URL in one pass. A hit counts
only between boundaries: the characters before and after it are not letters or digits.
One strict term rejects; soft terms reject when ``soft_limit`` different ones are found.
"""

import functools
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CLASHES = ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")

# This filter's own vocabulary.
STRICT = "porn xxx adult casino hentai escort camgirls warez malware phishing spam".split()
SOFT = (
    "cheap pills free bets bet win bonus poker loan loans viagra cialis dating singles "
    "ads track click farm deal deals promo popup torrent crack keygen replica"
).split()

# The host rules of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class UrlFilter:
    rules: tuple = RULES
    strict: tuple = tuple(STRICT)
    soft: tuple = tuple(SOFT)
    soft_limit: int = 2


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)


#: Terms of a vocabulary table, at most: they travel with each task.
MOST_TERMS = 1_000_000


def from_table(terms: DataFrame, f: UrlFilter = UrlFilter()) -> UrlFilter:
    """``f`` with the vocabulary of a table (term, strict boolean).

    Empty and null terms are left out; a term that is both strict and soft is strict, and a
    null ``strict`` means soft. More than ``MOST_TERMS`` terms are an error.
    """
    folded = F.translate("term", UPPER, LOWER).alias("term")
    rows = terms.where("term <> ''").select(folded, F.coalesce("strict", F.lit(False)).alias("strict"))
    found = rows.groupBy("term").agg(F.max("strict").alias("strict")).limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    strict, soft = (tuple(sorted(r.term for r in found if r.strict == kind)) for kind in (True, False))
    return UrlFilter(f.rules, strict, soft, f.soft_limit)


@functools.lru_cache(maxsize=4)
def _automaton(strict: tuple, soft: tuple):
    """Built once a worker, not once a batch."""
    import ahocorasick

    terms = ahocorasick.Automaton()
    for weight, words in ((1, soft), (2, strict)):
        for word in words:
            terms.add_word(word.translate(_FOLD), (weight, word))
    if len(terms):
        terms.make_automaton()
    return terms


def _hits(urls: pd.Series, f: UrlFilter) -> pd.DataFrame:
    terms = _automaton(f.strict, f.soft)
    if not len(terms):
        return pd.DataFrame({"strict": 0, "soft": 0}, index=urls.index)
    inner = lambda c: "a" <= c <= "z" or "0" <= c <= "9"

    def count(url):
        if not url:
            return 0, 0
        url, found = url.translate(_FOLD), set()
        for end, (weight, word) in terms.iter(url):
            start = end - len(word) + 1
            if not (start and inner(url[start - 1])) and not (end + 1 < len(url) and inner(url[end + 1])):
                found.add((weight, word))
        strict = sum(weight == 2 for weight, _ in found)
        return strict, len(found) - strict

    return pd.DataFrame([count(u) for u in urls], columns=["strict", "soft"], index=urls.index)


def judge_urls(pages: DataFrame, url_col: str = "url", f: UrlFilter = UrlFilter()) -> DataFrame:
    """All columns of ``pages`` and host, path, rule, verdict, strict_hits, soft_hits.

    A rule (verdict, host, path) fits its host and all subdomains if the path of the URL
    starts with the rule's; the longest rule decides, a later one of equal length never
    replaces an earlier one. URLs without a rule get the verdict of the vocabulary. Null
    URLs, empty ones and those without ``://`` have an empty host and path, and a null URL
    is allowed. Terms are looked for in the whole URL, A-Z and a-z alike. Repeated rows
    stay. Columns of the input with a name of a new column are replaced. Rows are judged
    one by one: no shuffle.
    """
    hits = F.pandas_udf(lambda urls: _hits(urls, f), "strict int, soft int")
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    scheme = F.instr(url, "://")
    rest = F.when(scheme > 0, F.substr(url, scheme + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    out = pages.select(
        *(f"`{c}`" for c in pages.columns if c not in _CLASHES),
        F.translate(host, UPPER, LOWER).alias("host"),
        path.alias("path"),
        hits(F.col(f"`{url_col}`")).alias("_hits"),
    )
    rule = verdict = None
    for kind, h, p in sorted(f.rules, key=lambda r: -len(r[1] + r[2])):
        fits = (F.endswith(F.concat(F.lit("."), "host"), F.lit("." + h))) & F.startswith("path", F.lit(p))
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    bad = (F.col("_hits.strict") > 0) | (F.col("_hits.soft") >= f.soft_limit)
    method = F.when(bad, "block").otherwise("allow")
    return out.select(
        *(c for c in out.columns if c != "_hits"),
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (method if verdict is None else verdict.otherwise(method)).alias("verdict"),
        F.col("_hits.strict").alias("strict_hits"),
        F.col("_hits.soft").alias("soft_hits"),
    )
