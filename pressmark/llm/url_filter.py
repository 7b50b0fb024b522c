"""URL filter by a weighted vocabulary and host rules.

One Aho-Corasick pass over the lower-cased address finds all terms of the vocabulary. A term
counts where it is bounded: the characters before and after it are no letters or digits (or
the address ends there). One strict term rejects an address; soft terms reject it when
``Vocabulary.soft_hits`` different ones occur, however often each. Rules for hosts and path
prefixes come first: the longest rule that fits decides.

Defined results: a null address, and one without ``://``, has an empty host and path, fits no
rule and is judged by the terms in it (null: allowed). Repeated rows are judged alike, an empty table
gives an empty result, long addresses are searched whole, other columns are ignored. Rules
of equal length are told apart by their text, the first in order decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Vocabulary:
    """Terms that reject at once, terms that reject together, and how many different ones that takes."""

    strict: tuple[str, ...] = (
        "adult", "ads-track", "betting", "casino", "cheap-pills", "doubleclick", "escort", "free-bets", "gambling", "malware",
        "nude", "phishing", "porn", "poker", "sex", "spam", "spam-farm", "viagra", "warez", "xxx",
    )
    soft: tuple[str, ...] = (
        "ad", "ads", "affiliate", "bet", "bets", "bonus", "buy", "cheap", "click", "coupon", "deal", "discount", "farm", "free",
        "jackpot", "loan", "lottery", "offer", "pills", "popup", "prize", "promo", "slots", "track", "tracking", "win",
        "winner",
    )
    soft_hits: int = 2


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Rules of the given job.
RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


@lru_cache(maxsize=8)
def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for strict, terms in ((False, vocabulary.soft), (True, vocabulary.strict)):
        for term in terms:
            found.add_word(term.lower(), (term.lower(), strict))
    if len(found):
        found.make_automaton()
    return found


def _is_word(character: str) -> bool:
    return "a" <= character <= "z" or "0" <= character <= "9"


def hits(url: str, vocabulary: Vocabulary) -> tuple[int, int]:
    """Different strict and different soft terms of an address."""
    machine, seen = automaton(vocabulary), set()
    if not len(machine):
        return 0, 0
    text = url.translate(str.maketrans(UPPER, LOWER))
    for last, (term, strict) in machine.iter(text):
        first = last - len(term) + 1
        if (first == 0 or not _is_word(text[first - 1])) and (last + 1 == len(text) or not _is_word(text[last + 1])):
            seen.add((term, strict))
    found = sum(strict for _, strict in seen)
    return found, len(seen) - found


def term_hits(url: Column, vocabulary: Vocabulary = Vocabulary()) -> Column:
    """A struct column: numbers of different ``strict`` and ``soft`` terms."""

    @F.arrow_udf("strict int, soft int")
    def of(urls: pa.Array) -> pa.Array:
        counts = [hits(u or "", vocabulary) for u in urls.to_pylist()]
        arrays = [pa.array([c[i] for c in counts], pa.int32()) for i in (0, 1)]
        return pa.StructArray.from_arrays(arrays, names=["strict", "soft"])

    return of(url)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the numbers of terms."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), term_hits(F.col("url"), vocabulary).alias("hits"))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: (-len(r.text), r.text))):  # later ones override
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    rejected = (F.col("hits.strict") > 0) | (F.col("hits.soft") >= vocabulary.soft_hits)
    by_terms = F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_terms).alias("verdict"),
        F.col("hits.strict").alias("strict_terms"), F.col("hits.soft").alias("soft_terms"),
    )


def oracle(rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = Vocabulary()) -> str:
    """The same judgement as DuckDB SQL, with one pattern a term."""
    def count(terms: tuple[str, ...]) -> str:
        tests = [f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::INT" for term in terms]
        return " + ".join(tests)

    fits = [
        (r, f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))")
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    rule = " ".join(f"WHEN {fit} THEN '{r.text}'" for r, fit in fits)
    verdict = " ".join(f"WHEN {fit} THEN '{r.verdict}'" for r, fit in fits)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low FROM pages
), parts AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), counted AS (
  SELECT page_id, host, path, ({count(vocabulary.strict)})::INT AS strict_terms, ({count(vocabulary.soft)})::INT AS soft_terms FROM parts
)
SELECT page_id, host, path, CASE {rule} END AS rule, strict_terms, soft_terms,
       CASE {verdict} WHEN strict_terms > 0 OR soft_terms >= {vocabulary.soft_hits} THEN 'block' ELSE 'allow' END AS verdict
FROM counted"""
