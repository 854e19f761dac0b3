"""Finding and masking personal identifiers: fixed forms, and forms learnt from context.

Emails, addresses, card and phone numbers are found by form. They then serve as seeds: the
two words before the token a seed begins in are a lexical pattern, and whatever follows
the same words elsewhere is a candidate: a token, or groups of digits in a row as one
number. Patterns and candidates make a graph, scored in rounds: a pattern is as good as
the share of all its occurrences that scored instances follow. Only patterns that reach
``CONFIDENT`` vouch, and only for instances with ``LEAST_SHARE`` of all their occurrences
in such patterns; an instance is then as good as these together. Such instances are
seeds of the next round, until no pattern and no instance comes to them, and in the end
are marked wherever they stand.

Of a pattern that isn't confident only counts are needed: what follows it but has no
score adds nothing to its own. So the edges of the graph are those of scored instances,
and of patterns that vouch; what follows all others is counted and never listed.

Everything is built-in expressions. A place in a text is known from the lengths of the
matches and of what lies between them, in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WORD, settled

# Java's possessive quantifiers and looks behind only spare fruitless tries; what is
# found is what the plain forms find.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A group of digits of a number written in several, and one that may be the last.
GROUP = r"^[(+]*[0-9](?:[0-9()./-]*[0-9)])?$"
LAST_GROUP = r"""^[(+]*[0-9][0-9()./-]*[)"'\]>.,;:!?]*$"""
# A token that is part of a fixed form has one of these, or nothing but those.
IN_FORM = r"[0-9@]|^[+().-]+$"
# What every text with a number in several groups has.
GROUPS = r"[0-9)][\x20\x09]+[(+]*[0-9]"
LINE = r"[\x0A-\x0D]"
OPENING = r"""^[("'\[<]+"""
CLOSING = r"""[)"'\]>.,;:!?]+$"""
AROUND = r"""^[("'\[<]+|[)"'\]>.,;:!?]+$"""
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
BLOCK = 256

CONFIDENT = 0.8
# Distinct seeds a pattern must have been met with.
SUPPORT = 5
# Digits of a number in several groups, as many as the longest fixed form has.
MOST_DIGITS = 19
# Of all occurrences of an instance, those that must stand in patterns that vouch for it.
LEAST_SHARE = 0.5
# Flags by which contexts are passed over before they are counted: so many for a pattern, in
# words of 64, and words at most. With fewer flags more is counted, and the counts are the same.
FLAGS = 16
MOST_WORDS = 1 << 17


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_ip(found: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(999)) <= 255)

    return F.forall(F.split(found, r"\."), small)


def _is_card(found: Column) -> Column:
    return F.length(digits(found)).between(16, 19) & F.call_function("luhn_check", digits(found))


def _is_phone(found: Column) -> Column:
    return F.length(digits(found)).between(8, 15)


class Kind(NamedTuple):
    """``hint`` is true for every text with a match, and cheap."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    hint: Callable[[Column], Column]


KINDS = (
    Kind("email", EMAIL, lambda m: F.lit(True), lambda t: F.contains(t, F.lit("@"))),
    Kind("ip", IP, _is_ip, lambda t: t.rlike(r"[0-9]\.[0-9]")),
    Kind("card", CARD, _is_card, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")),
    Kind("phone", PHONE, _is_phone, lambda t: t.rlike(r"\+[0-9]")),
)
NAMES = tuple(k.name for k in KINDS)
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(parts: Column) -> Column:
    """``start`` of each part, whose ``gap`` characters before it and ``size`` are known.

    Sums within blocks, then over blocks, so that long lists stay cheap.
    """
    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<int>").alias("starts"))
    zero = zero.withField("starts", F.array().cast("array<int>"))

    def within(block: Column) -> Column:
        return F.aggregate(
            block,
            zero,
            lambda a, p: F.struct(
                (a["at"] + p["gap"] + p["size"]).alias("at"),
                F.concat(a["starts"], F.array(a["at"] + p["gap"])).alias("starts"),
            ),
        )

    def over(blocks: Column) -> Column:
        ends = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda a, b: F.struct(
                (a["at"] + b["at"]).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts")
            ),
        )["starts"]
        return _let(
            ends,
            lambda known: F.flatten(
                F.transform(blocks, lambda b, i: F.transform(b["starts"], lambda s: s + F.get(known, i)))
            ),
        )

    count = F.floor((F.size(parts) - 1) / BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), count), lambda i: within(F.slice(parts, i * BLOCK + 1, F.lit(BLOCK)))
    )
    return _let(blocks, over)


def matches(text: Column, pattern: str) -> Column:
    """Every match as ``start``, ``end`` and ``value``."""

    def placed(cut: Column) -> Column:
        parts = F.transform(
            cut["found"],
            lambda m, i: F.struct(
                F.char_length(F.get(cut["gaps"], i)).alias("gap"), F.char_length(m).alias("size")
            ),
        )
        return _let(
            _let(parts, _running),
            lambda starts: F.transform(
                cut["found"],
                lambda m, i: F.struct(
                    F.get(starts, i).alias("start"),
                    (F.get(starts, i) + F.char_length(m)).alias("end"),
                    m.alias("value"),
                ),
            ),
        )

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return _let(found, lambda cut: F.when(F.size(cut["found"]) > 0, placed(cut)).otherwise(empty))


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _of_kind(text: Column, kind: Kind) -> Column:
    def named(m: Column) -> Column:
        return F.struct(F.lit(kind.name).alias("kind"), m["start"], m["end"], m["value"]).cast(SPAN)

    valid = F.filter(matches(text, kind.pattern), lambda m: kind.valid(m["value"]))
    return F.when(kind.hint(text), F.transform(valid, named)).otherwise(_none())


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, kind by kind as listed, each in order."""
    return F.concat(*[_of_kind(text, kind) for kind in KINDS])


def places(text: Column, base: Column) -> Column:
    """Every ``token``, its ``context``, what is ``found`` at it, the ``follower`` of the context
    and its ``kind``.

    Found are the token without punctuation around it and the numbers in several groups
    that begin with it, shortest first, unless a span of ``base`` meets them. The follower is
    the first span that starts in the token, or else the longest found; null within a span.
    Only a span has a kind.
    """
    spot = "struct<start:int,end:int,value:string>"

    def of(cut: Column) -> Column:
        sizes = F.transform(
            cut["words"],
            lambda w, i: F.struct(
                F.char_length(F.get(cut["gaps"], i)).alias("gap"), F.char_length(w).alias("size")
            ),
        )
        forms = F.transform(
            cut["words"],
            lambda w: F.when(w.rlike(GROUP), 2).when(w.rlike(LAST_GROUP), 1).otherwise(0),
        )

        def with_forms(form: Column) -> Column:
            # Whether a token goes on with the next one as a number.
            goes_on = F.transform(
                form,
                lambda f, i: F.coalesce(
                    (f == 2)
                    & (F.get(form, i + 1) >= 1)
                    & ~F.get(cut["gaps"], i + 1).rlike(LINE),
                    F.lit(False),
                ),
            )
            return _let(
                goes_on,
                lambda on: _let(
                    _let(sizes, _running),
                    lambda starts: F.transform(cut["words"], lambda w, i: at(w, i, on, starts)),
                ),
            )

        def at(w: Column, i: Column, on: Column, starts: Column) -> Column:
            first, last = F.get(starts, i), F.get(starts, i) + F.char_length(w)
            start = first + F.char_length(w) - F.char_length(F.regexp_replace(w, OPENING, ""))
            bare = F.regexp_replace(w, AROUND, "")
            token = F.struct(
                start.alias("start"), (start + F.char_length(bare)).alias("end"), bare.alias("value")
            ).cast(spot)

            def step(a: Column, k: Column) -> Column:
                group = F.get(cut["words"], k)
                longer = F.concat(a["value"], F.lit(" "), group)
                fits = a["open"] & F.get(on, k - 1) & (F.length(digits(longer)) <= MOST_DIGITS)
                number = F.struct(
                    start.alias("start"),
                    (F.get(starts, k) + F.char_length(F.regexp_replace(group, CLOSING, ""))).alias("end"),
                    F.regexp_replace(longer, AROUND, "").alias("value"),
                ).cast(spot)
                return F.struct(
                    fits.alias("open"),
                    longer.alias("value"),
                    F.when(fits, F.concat(a["found"], F.array(number))).otherwise(a["found"]).alias("found"),
                )

            none = F.array().cast(f"array<{spot}>")
            numbers = F.aggregate(
                F.sequence(i + 1, F.least(i + MOST_DIGITS - 1, F.size(cut["words"]) - 1)),
                F.struct(F.lit(True).alias("open"), w.alias("value"), none.alias("found")),
                step,
                lambda a: a["found"],
            )
            known = F.when(w.rlike(IN_FORM), base).otherwise(_none())
            found = F.filter(
                F.when(F.get(on, i), F.concat(F.array(token), numbers)).otherwise(F.array(token)),
                lambda c: (c["start"] < c["end"])
                & ~F.exists(known, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])),
            )
            begun = F.get(F.filter(known, lambda s: (s["start"] >= first) & (s["start"] < last)), F.lit(0))
            words = F.concat_ws(" ", F.get(cut["words"], i - 2), F.get(cut["words"], i - 1))
            return _let(
                found,
                lambda f: F.struct(
                    w.alias("token"),
                    F.when(i >= 2, F.lower(words)).alias("context"),
                    f.alias("found"),
                    F.coalesce(begun["value"], F.get(f, F.size(f) - 1)["value"]).alias("follower"),
                    begun["kind"].alias("kind"),
                ),
            )

        return _let(forms, with_forms)

    empty = F.array().cast(f"array<struct<token:string,context:string,found:array<{spot}>,follower:string,kind:string>>")
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.split(text, WORD, -1).alias("gaps"),
    )
    return _let(cut, lambda c: F.when(F.size(c["words"]) > 0, of(c)).otherwise(empty))


def _key(text: str | Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def found_in(docs: DataFrame) -> DataFrame:
    """``key``, ``text`` and ``base`` of each distinct text, with or without any."""
    text = F.coalesce("text", F.lit(""))
    distinct = docs.select(text.alias("text")).select(_key("text").alias("key"), "text").dropDuplicates(["key"])
    # explode() keeps what is found a value that is there, rather than an expression that
    # is worked out again for each use of it.
    based = distinct.select("key", "text", F.explode(F.array(base_spans(F.col("text")))).alias("base"))
    return settled(based, "identifiers")


def _places(found: DataFrame) -> DataFrame:
    return found.select("key", F.explode(places(F.col("text"), F.col("base"))).alias("p")).select("key", "p.*")


def _bare(word: str | Column) -> Column:
    return F.regexp_replace(word, AROUND, "")


def _words(found: DataFrame) -> DataFrame:
    words = F.explode(F.split("text", BLANKS)).alias("word")
    return found.select("key", words).filter("word != ''").select("key", _bare("word").alias("first"))


def _with(found: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The texts of these keys; places() is dear, so only they are taken to it."""
    return found.join(settled(keys.select("key").distinct(), name), "key", "left_semi")


def _holding(found: DataFrame, values: DataFrame) -> DataFrame:
    """The texts that hold the first word of a value."""
    firsts = values.select(_bare(F.get(F.split(F.col("value"), " "), F.lit(0))).alias("first")).distinct()
    return _with(found, _words(found).join(firsts, "first", "left_semi"), "texts-with-values")


def _contexts(found: DataFrame) -> DataFrame:
    """``key`` and the two words ``a`` and ``b`` before each token that has two before it."""
    words = F.split(F.btrim("text", F.lit(BLANK_CHARACTERS)), BLANKS)
    held = found.select("key", F.explode(F.array(words)).alias("w"))
    count = F.greatest(F.size("w") - 2, F.lit(0))
    pairs = F.arrays_zip(F.slice("w", F.lit(1), count), F.slice("w", F.lit(2), count))
    return held.select("key", F.inline(pairs.cast("array<struct<a:string,b:string>>")))


def _context() -> Column:
    return F.lower(F.concat_ws(" ", "a", "b")).alias("context")


def _may_be_in(contexts: DataFrame) -> Callable[[Column], Column]:
    """False for nearly all that is not one of the contexts, and true for all of them.

    Their hashes set flags in an array of bounded size.
    """
    needed = FLAGS * contexts.count() // 64
    words = min(1 << needed.bit_length(), MOST_WORDS)

    def word(context: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(F.xxhash64(context), 6), F.lit(words)).cast("int")

    def bit(context: Column) -> Column:
        return F.xxhash64(context).bitwiseAND(F.lit(63)).cast("int")

    mark = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("context")))
    marks = contexts.select(word(F.col("context")).alias("word"), mark.alias("flags"))
    marks = marks.unionByName(contexts.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("flags")))
    marks = marks.groupBy("word").agg(F.bit_or("flags").alias("flags"))
    listed = F.array_sort(F.collect_list(F.struct("word", "flags")))
    flags = settled(marks.agg(listed["flags"].alias("flags")), "flags").scalar()
    return lambda context: F.getbit(F.get(flags, word(context)), bit(context)) == 1


def _occurrences(found: DataFrame, contexts: DataFrame) -> DataFrame:
    """How often each of these contexts stands anywhere, ``all``.

    They are counted before they are joined, so that the join has a row for each and not for
    each occurrence; what the flags rule out is not counted. An inner join, as a semi join
    would be taken below the counting.
    """
    # explode() keeps the context a value that is there.
    held = _contexts(found).select(F.explode(F.array(_context())).alias("context"))
    counted = held.filter(_may_be_in(contexts)(F.col("context"))).groupBy("context").agg(F.count("*").alias("all"))
    return contexts.join(counted, "context")


def _everywhere(found: DataFrame, words: DataFrame, values: DataFrame) -> DataFrame:
    """How often each ``value`` stands anywhere, as a token or as a number in several groups."""
    single = words.join(values, "value", "left_semi")
    several = values.filter(F.contains(F.col("value"), F.lit(" ")))
    grouped = (
        _places(_holding(found.filter(F.col("text").rlike(GROUPS)), several))
        .select(F.explode("found.value").alias("value"))
        .join(several, "value", "left_semi")
        .groupBy("value")
        .agg(F.count("*").alias("everywhere"))
    )
    return single.unionByName(grouped)


def _met(places_: DataFrame) -> DataFrame:
    """``n`` for each context and what follows it."""
    followed = places_.filter("context is not null and follower is not null")
    return followed.groupBy("context", F.col("follower").alias("value")).agg(F.count("*").alias("n"))


def learn(
    found: DataFrame,
    confident: float = CONFIDENT,
    support: int = SUPPORT,
    share: float = LEAST_SHARE,
) -> DataFrame:
    """``value`` and ``kind`` of the candidates that the patterns of seeds vouch for.

    Texts that repeat count once. A pattern is scored only with ``support`` distinct
    seeds of a kind; what else follows its words, identifier or not, counts against it.
    Occurrences of a value anywhere but in confident patterns of the kind count against
    the value. Scores only rise from round to round, so there is a last one.
    """
    seeds = settled(
        found.select(F.explode("base").alias("s")).select("s.value", "s.kind").distinct(), "seeds"
    )
    met = settled(
        _places(found.filter("size(base) > 0"))
        .filter("context is not null and kind is not null")
        .groupBy("context", "kind", F.col("follower").alias("value"))
        .agg(F.count("*").alias("n")),
        "seeds-met",
    )
    patterns = settled(
        met.groupBy("context", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= support),
        "patterns",
    )
    if patterns.isEmpty():
        return patterns.select(F.col("context").alias("value"), "kind")
    supported = patterns.select("context").distinct()
    occurrences = settled(_occurrences(found, settled(supported, "supported")), "pattern-occurrences")
    known = seeds.select("value").distinct()
    scores = seeds.withColumn("score", F.lit(1.0))
    # What scored instances follow, what follows confident patterns, and how often that is anywhere.
    edges = met.groupBy("context", "value").agg(F.sum("n").alias("n")).join(supported, "context", "left_semi")
    followers = everywhere = expanded = words = None
    while True:
        vouching = settled(
            edges.join(scores, "value")
            .groupBy("context", "kind")
            .agg(F.sum(F.col("score") * F.col("n")).alias("scored"))
            .join(patterns.select("context", "kind"), ["context", "kind"])
            .join(occurrences, "context")
            .select("context", "kind", (F.col("scored") / F.col("all")).alias("pattern_score"))
            .filter(F.col("pattern_score") >= confident),
            "confident-patterns",
        )
        fresh = vouching.select("context").distinct()
        if expanded is not None:
            fresh = fresh.join(expanded, "context", "left_anti")
        fresh = settled(fresh, "new-patterns")
        more_patterns = not fresh.isEmpty()
        if more_patterns:
            expanded = fresh if expanded is None else expanded.unionByName(fresh)
            at = _contexts(found).select("key", _context()).join(fresh, "context", "left_semi")
            new = settled(
                _met(_places(_with(found, at, "texts-with-patterns")).join(fresh, "context", "left_semi")).join(
                    known, "value", "left_anti"
                ),
                "followers",
            )
            followers = new if followers is None else followers.unionByName(new)
            values = new.select("value").distinct()
            if everywhere is not None:
                values = values.join(everywhere, "value", "left_anti")
            if words is None:
                counts = _words(found).groupBy(F.col("first").alias("value"))
                words = settled(counts.agg(F.count("*").alias("everywhere")), "words")
            counted = settled(_everywhere(found, words, settled(values, "unseen")), "everywhere")
            everywhere = counted if everywhere is None else everywhere.unionByName(counted)
        if followers is None:
            break
        vouched = (
            followers.join(vouching, "context")
            .groupBy("value", "kind")
            .agg(
                (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("pattern_score"), F.lit(1e-9)))))).alias(
                    "score"
                ),
                F.sum("n").alias("n"),
            )
            .join(everywhere, "value")
            .filter(F.col("n") / F.col("everywhere") >= share)
            .select("value", "kind", "score")
        )
        vouched = settled(vouched, "vouched")
        instances = settled(vouched.join(scores, ["value", "kind"], "left_anti"), "new-instances")
        if instances.isEmpty() and not more_patterns:
            break
        # A value that had a score already is met where it was.
        values = settled(instances.select("value").distinct().join(scores, "value", "left_anti"), "new-values")
        if not values.isEmpty():
            here = _met(_places(_holding(found, values))).join(values, "value", "left_semi")
            edges = settled(edges.unionByName(here.join(supported, "context", "left_semi")), "edges")
        scores = settled(
            scores.unionByName(vouched).groupBy("value", "kind").agg(F.max("score").alias("score")),
            "instance-scores",
        )
    best = scores.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    return best.join(known, "value", "left_anti")


def spans(docs: DataFrame, **options) -> DataFrame:
    """``key``, ``base`` and ``learnt`` spans of each distinct text that has any."""
    found = found_in(docs)
    known = settled(learn(found, **options), "learnt")
    if known.isEmpty():
        return found.select("key", "base", _none().alias("learnt")).filter("size(base) > 0")
    # Of values that begin at one place, the longest.
    learnt = (
        _places(_holding(found, known))
        .select("key", F.explode("found").alias("c"))
        .select("key", "c.*")
        .join(known, "value")
        .groupBy("key", "start")
        .agg(F.max_by(F.struct("kind", "start", "end", "value"), "end").alias("s"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("s")).alias("learnt"))
    )
    return (
        found.select("key", "base")
        .join(learnt, "key", "left")
        .withColumn("learnt", F.coalesce("learnt", _none()))
        .filter("size(base) > 0 or size(learnt) > 0")
    )


def _named(spans: str | Column, name: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == name)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def in_order(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    kinds = [_named(spans, name) for name in NAMES]
    by_start = [
        F.transform(
            F.sort_array(F.transform(k, lambda s: F.struct(s["start"], s["end"], s["kind"]))),
            lambda s: F.struct(s["kind"], s["start"], s["end"]),
        )
        for k in kinds
    ]
    return F.concat(*by_start)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts of the fixed forms, digest of their spans, and all spans.

    A null text is empty and has none. Repeated rows repeat; equal texts have equal
    spans. Learnt spans come after the fixed ones of their kind only by their start. An
    empty table gives none.
    """
    held = spans(docs, **options)
    counts = [
        F.size(_named("base", name)).cast("long").alias(f"n_{name}")
        for name in NAMES
    ]
    summed = held.select(
        "key",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(in_order(F.concat("base", "learnt"))).alias("spans"),
    )
    keyed = docs.select("doc_id", _key("text").alias("key"))
    zero = [F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in NAMES]
    return keyed.join(summed, "key", "left").select(
        "doc_id",
        *zero,
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span as its kind in brackets; spans that overlap become the first."""

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(
                fresh,
                F.concat(
                    a["out"],
                    F.array(
                        F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                    ),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
        )

    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], -s["end"], s["kind"])))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        F.transform(by_start, lambda s: F.struct(s["start"], (-s["col2"]).alias("end"), s["kind"])),
        zero,
        step,
        lambda a: F.concat(
            F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.char_length(text))
        ),
    )
    return done


def mask(docs: DataFrame, **options) -> DataFrame:
    """The documents with their identifiers masked in ``text``, other columns unchanged.

    Documents without any, null texts among them, stay as they are.
    """
    held = spans(docs, **options).select("key", in_order(F.concat("base", "learnt")).alias("found"))
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = plain.withColumn("_key", _key("row.text")).join(
        held, F.col("_key") == F.col("key"), "left"
    )
    text = F.when(F.col("found").isNull(), F.col("row.text")).otherwise(
        masked(F.col("row.text"), F.col("found"))
    )
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")
