"""Quality rules as a short-circuit cascade.

A document is kept if it breaks no rule, so the rules may be tried in any order, and a
document that breaks one need not be tried against the rest. Each rule is timed and its
rejections are counted on a bounded sample; rules that reject most for their cost go
first. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, settled, unwrapped, wrapped

SYMBOLS = r"[#*$%&|<>]+"
# Documents, about, on which the rules are tried to find their order.
SAMPLE = 2000
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return F.get(
        F.transform(
            F.array(_lines(text)), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
        ),
        F.lit(0),
    ).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, not for each element of a lambda in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def n_repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text, the first included.

    A window's hash and its position are packed into one long, the position in as many
    low bits as the text needs. Sorted, equal windows are neighbours; their words are
    compared too. In a text where neighbours share the rest of the hash and not the
    words, which might part equal ones, windows are sorted by their words instead.
    """

    def of(found: Column) -> Column:
        n = F.size(found)
        return F.when(n < 4, F.lit(0)).otherwise(_let(_mask(n), lambda mask: counted(found, n, mask)))

    def counted(found: Column, n: Column, mask: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))
            .bitwiseAND(F.bitwise_not(mask))
            .bitwiseOR(i.cast("long")),
        )
        return _let(F.sort_array(keys), lambda packed: repeated(found, packed, mask))

    def by_words(found: Column) -> Column:
        # Words hold no blanks, so the text of a window tells its words.
        windows = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(found) - 3),
                lambda i: F.struct(
                    F.concat_ws(" ", *[F.get(found, i + k) for k in range(3)]).alias("w"), i.cast("long").alias("at")
                ),
            )
        )
        text = lambda held, i: F.coalesce(F.get(held, i)["w"], F.lit(""))
        return _let(
            windows,
            lambda held: F.transform(
                F.filter(held, lambda x, i: (text(held, i + 1) == x["w"]) | (text(held, i - 1) == x["w"])),
                lambda x: x["at"],
            ),
        )

    def repeated(found: Column, packed: Column, mask: Column) -> Column:
        def next_one(key: Column, i: Column) -> Column:
            # 1 if the next window has the same words, 2 if only the same rest of the hash.
            after = F.get(packed, i + 1)
            equal = F.lit(True)
            for k in range(3):
                one, other = (F.get(found, x.bitwiseAND(mask).cast("int") + k) for x in (key, after))
                equal = equal & (one == other)
            alike = F.coalesce(key.bitwiseXOR(after).between(0, mask), F.lit(False))
            return F.when(~alike, 0).when(equal, 1).otherwise(2)

        def plain(links: Column) -> Column:
            return F.filter(packed, lambda key, i: (F.get(links, i) == 1) | (F.coalesce(F.get(links, i - 1), F.lit(0)) == 1))

        starts = _let(
            F.transform(packed, next_one),
            lambda links: F.when(F.array_contains(links, 2), by_words(found)).otherwise(
                F.transform(plain(links), lambda key: key.bitwiseAND(mask))
            ),
        )
        starts = F.sort_array(starts)
        # Each start covers three words, fewer where the next start is nearer.
        return F.aggregate(
            starts,
            F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, at: F.struct(
                at.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), at - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    return _let(words, of).cast("long")


def _mask(n: Column) -> Column:
    """As many low bits as it takes to write ``n``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1


# Of a text and its words.
COUNTS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.char_length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: n_symbols(text),
    "n_dup_lines": lambda text, words: n_dup_lines(text),
    "n_repeat_words": lambda text, words: n_repeat_words(words),
}


class Rule(NamedTuple):
    """``test`` of the named counts is true for a text to reject. It is never null."""

    name: str
    counts: tuple[str, ...]
    test: Callable[..., Column]

    def broken(self, text: Column, words: Column) -> Column:
        """By the text, whose words are there, counting just what the rule needs."""
        return self.test(*[COUNTS[count](text, words) for count in self.counts])

    def broken_by(self, counts: Column) -> Column:
        """By counts that are there already."""
        return self.test(*[counts[count] for count in self.counts])


BASE = (
    Rule("few_words", ("n_words",), lambda n: n < LEAST_WORDS),
    Rule(
        "much_repeated",
        ("n_repeat_words", "n_words"),
        lambda repeated, n: 100 * repeated > MOST_REPEATED * n,
    ),
)
RULES = (
    *BASE,
    # More than one symbol for ten words.
    Rule("many_symbols", ("n_symbols", "n_words"), lambda symbols, n: 10 * symbols > n),
    # Words of less than 2 or more than 15 characters on average.
    Rule(
        "odd_words",
        ("word_chars", "n_words"),
        lambda chars, n: (chars < 2 * n) | (chars > 15 * n),
    ),
)


class Estimate(NamedTuple):
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def estimates(
    docs: DataFrame, rules: Sequence[Rule] = RULES, column: str = "text", sample: int = SAMPLE
) -> list[Estimate]:
    """Cost and rejections of each rule on a sample of about ``sample`` documents, best first.

    The words are there before, as all rules share them.
    """
    texts = docs.select(_text(f"`{column}`").alias("text"))
    texts = texts.sample(min(1.0, sample / max(1, docs.count())), seed=0)
    tried = settled(texts.select("text", words(F.col("text")).alias("words")), "quality-sample")
    found = []
    for rule in rules:
        rejections = tried.agg(F.avg(rule.broken(F.col("text"), F.col("words")).cast("int")))
        rejections.first()  # compiled now, so that only the rule is timed
        started = time.perf_counter()
        rejected = rejections.first()[0] or 0.0
        found.append(Estimate(rule, time.perf_counter() - started, rejected))
    return sorted(found, key=lambda e: -e.worth)


def verdict(rules: Sequence[Rule], broken: Callable[[Rule], Column]) -> Column:
    """The name of the first rule broken, null if none. Rules after it aren't tried."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(broken(rule), F.lit(rule.name)).otherwise(found)
    return found


def keep(
    docs: DataFrame, rules: Sequence[Rule] = RULES, column: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """The documents that break no rule, unchanged.

    A null text counts as empty. Repeated rows share their fate; other columns, null or
    not, play no part. An empty table gives none.
    """
    ordered = [e.rule for e in estimates(docs, rules, column, sample)]
    # explode() keeps the words a value that is there, cut out once for all rules.
    held = wrapped(docs)
    text = _text(f"row.`{column}`")
    cut = held.select("row", F.explode(F.array(words(text))).alias("words"))
    return unwrapped(cut.filter(verdict(ordered, lambda rule: rule.broken(text, F.col("words"))).isNull()))


def measures(docs: DataFrame, column: str = "text") -> DataFrame:
    """The documents with ``quality``: the counts the rules work from, for every text.

    A null text has none of anything. A column called ``quality`` is replaced.
    """
    text = F.coalesce(F.col(f"row.`{column}`"), F.lit(""))
    counted = (
        wrapped(docs.drop("quality"))
        .withColumn("_words", words(text))
        .withColumn(
            "quality",
            F.struct(
                *(count(text, F.col("_words")).alias(name) for name, count in COUNTS.items()),
            ),
        )
    )
    return unwrapped(counted, "quality")


def report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the counts of each text, whether it breaks a base rule, and whether it is kept.

    The counts are asked for, so they are worked out for every text; the cascade goes
    over them in the order found on the sample. Nulls, repeats and empty tables as in
    ``keep`` and ``measures``.
    """
    ordered = [e.rule for e in estimates(docs, RULES, sample=sample)]
    counts = F.col("quality")
    failed = F.lit(False)
    for rule in BASE:
        failed = failed | rule.broken_by(counts)
    passes = verdict(ordered, lambda rule: rule.broken_by(counts)).isNull()
    return (
        measures(docs)
        .select("doc_id", "quality.*", failed.alias("base_failed"), passes.alias("_passes"))
        .withColumn("kept", ~F.col("base_failed") & F.col("_passes"))
        .drop("_passes")
    )
