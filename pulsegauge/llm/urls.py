"""Judging pages by their address: a rule table first, then a weighted vocabulary.

The vocabulary is a table of terms with weights, and is searched with an Aho-Corasick
automaton, so the cost of a url does not depend on the number of terms. A term counts
where it stands between characters that are no ASCII letter or digit; the words of a
term of several may have any run of such ASCII characters between them. A url is
rejected when the weights of its distinct terms reach ``LIMIT``: one strict term does
so alone, of soft terms it takes several.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unwrapped, wrapped

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# ASCII characters between words.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Rule(NamedTuple):
    """``verdict`` for the urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

STRICT = ("casino", "hentai", "porn", "porno", "pornhub", "viagra", "warez", "xxx")
SOFT = (
    "adult", "bet", "betting", "cheap", "crack", "dating", "escort", "free", "gambling",
    "keygen", "lottery", "nude", "pharmacy", "pills", "poker", "sex", "slots", "torrent",
)
SOFT_LIMIT = 2
# Weights of distinct terms that reject.
LIMIT = 1.0
# Characters of a vocabulary's terms in all: every Python worker holds its automaton.
MOST_CHARACTERS = 20_000_000


class Term(NamedTuple):
    """A term of a vocabulary; of ``LIMIT`` or more it is strict, below soft."""

    term: str
    weight: float


def vocabulary(
    strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_limit: int = SOFT_LIMIT
) -> tuple[Term, ...]:
    """Terms of two kinds: one strict term rejects, and so do ``soft_limit`` soft ones."""
    return tuple(Term(t, LIMIT) for t in strict) + tuple(Term(t, LIMIT / soft_limit) for t in soft)


def read_vocabulary(table: DataFrame) -> tuple[Term, ...]:
    """Terms of a table with ``term`` and ``weight``, such as a list that is kept in Parquet.

    Terms are compared as urls are: lower-cased, runs of ASCII characters that are no
    letter or digit as one blank. Of one term the largest weight counts. Null and blank
    terms and weights that are null, not finite or not above 0 say nothing. A list of
    more than ``MOST_CHARACTERS`` is refused before it is collected.
    """
    term = F.trim(F.regexp_replace(ascii_lower(F.col("term")), APART, " "))
    weight = F.col("weight").cast("double")
    terms = (
        table.select(term.alias("term"), weight.alias("weight"))
        .filter((F.col("term") != "") & (F.col("weight") > 0) & (F.col("weight") < float("inf")))
        .groupBy("term")
        .agg(F.max("weight").alias("weight"))
    )
    characters = terms.agg(F.sum(F.char_length("term"))).first()[0] or 0
    if characters > MOST_CHARACTERS:
        raise ValueError(f"a vocabulary of {characters} characters, more than {MOST_CHARACTERS}")
    return tuple(Term(r["term"], r["weight"]) for r in terms.orderBy("term").collect())


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules: Iterable[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct; null if none does.

    Of rules of one length the one with the longer host wins, and then ``block``.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r))
    if not ranked:
        return F.lit(None).cast("struct<host:string,path:string,name:string,verdict:string>")
    known = F.array(
        *[
            F.struct(
                F.lit(r.host).alias("host"),
                F.lit(r.path).alias("path"),
                F.lit(r.name).alias("name"),
                F.lit(r.verdict).alias("verdict"),
            )
            for r in ranked
        ]
    )
    fitting = F.filter(
        known,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & F.startswith(path, r["path"]),
    )
    return F.get(fitting, F.lit(0))


def _plain(text: str) -> str:
    return re.sub(APART, " ", text)


@functools.lru_cache(maxsize=4)
def automaton(terms: tuple[Term, ...]) -> ahocorasick.Automaton:
    """One per Python worker. Of a term that is there twice the larger weight counts."""
    found = ahocorasick.Automaton()
    for term, weight in sorted(terms):
        if term := _plain(term).strip(" "):
            found.add_word(term, (term, weight))
    if len(found):
        found.make_automaton()
    return found


def _inside(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at] in LOWER or text[at] in "0123456789")


def weigh(url: str, terms: ahocorasick.Automaton, limit: float = LIMIT) -> tuple[int, int, float]:
    """Distinct strict and distinct soft terms of a lower-cased url, and their weight in all."""
    found: dict[str, float] = {}
    if len(terms):
        url = _plain(url)
        for end, (term, weight) in terms.iter(url):
            if not _inside(url, end + 1) and not _inside(url, end - len(term)):
                found[term] = weight
    strict = sum(w >= limit for w in found.values())
    # Rounded, so that ten terms of a tenth make one.
    return strict, len(found) - strict, round(math.fsum(found.values()), 9)


def vocabulary_hits(url: Column, terms: Iterable[Term], limit: float = LIMIT) -> Column:
    """``struct<strict,soft,weight>`` of distinct terms in a url; none in a null url."""
    known = tuple(terms)

    @F.pandas_udf("struct<strict:int,soft:int,weight:double>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        searched = automaton(known)
        for urls in batches:
            rows = [weigh(u, searched, limit) for u in urls]
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"])

    return hits(F.coalesce(ascii_lower(url), F.lit("")))


def judge(
    pages: DataFrame,
    column: str = "url",
    rules: Iterable[Rule] = RULES,
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    terms: Iterable[Term] | None = None,
    limit: float = LIMIT,
) -> DataFrame:
    """The pages with ``judgement``: host, path, rule, verdict, strict and soft hits, weight.

    The rule decides where one fits, else the vocabulary: ``terms`` with their weights,
    or without them the ``strict`` and ``soft`` ones. A null url and one without
    ``://`` have an empty host and path; its terms are still searched. Every row is
    judged by itself, so repeated rows are repeated; an empty table gives none. A column
    called ``judgement`` is replaced.
    """
    known = vocabulary(strict, soft, soft_limit) if terms is None else terms
    url = F.col(f"row.`{column}`")
    judged = (
        wrapped(pages.drop("judgement") if column != "judgement" else pages)
        .withColumn("host", F.coalesce(host(url), F.lit("")))
        .withColumn("path", F.coalesce(path(url), F.lit("")))
        .withColumn("rule", rule(F.col("host"), F.col("path"), rules))
        .withColumn("hits", vocabulary_hits(url, known, limit))
    )
    rejected = F.col("hits.weight") >= limit
    verdict = F.coalesce(
        F.col("rule.verdict"), F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
    )
    return unwrapped(
        judged.withColumn(
            "judgement",
            F.struct(
                "host",
                "path",
                F.col("rule.name").alias("rule"),
                verdict.alias("verdict"),
                F.col("hits.strict").alias("strict"),
                F.col("hits.soft").alias("soft"),
                F.col("hits.weight").alias("weight"),
            ),
        ),
        "judgement",
    )
