import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegauge.llm import identifiers

from . import brute
from .conftest import texts

TRICKY = [
    "a@b.c_d@e.f.g",
    "x@y z@w.q., a@b.c.",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3",
    "9" * 40 + ".1.1.1 0.0.0.255",
    "4532015112830366 4532 0151 1283 0366 4532-0151-1283-0367 4532  015112830366",
    "+1 (555) 010-9999 +123 +1((((( +49 89 123456789012345 ++1 555 010 9999.",
    "é漢🙂 a@b.cd 🙂 +1 555 010 9999",
    "@.@ a@b a@b- a@-.- .@a.b",
    "a" * 3_000 + "@",
    "1" * 3_000,
    "a@" + "b." * 5_000 + "c",
    "+1" + " " * 50_000,
    "a@b.c " * 1_000,
    None,
    "",
]


def test_fixed_forms(spark):
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in identifiers.report(docs).collect()}
    for i, text in enumerate(TRICKY):
        spans = brute.identifiers(text)
        assert found[i]["spans"] == brute.listed(spans), (text or "")[:60]
        assert found[i]["base_sha256"] == brute.sha256(brute.listed(spans))
        assert [found[i][f"n_{k}"] for k in spans] == [len(s) for s in spans.values()]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="aé🙂19 .-@+(_", max_size=40), min_size=40, max_size=60, unique=True))
def test_any_text(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: list(r["s"]) for r in docs.select("doc_id", identifiers.base_spans(docs["text"]).alias("s")).collect()}
    for i, text in enumerate(rows):
        got = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in found[i])
        assert got == brute.listed(brute.identifiers(text)), text


def test_documents_and_odd_rows(spark, documents, odd_documents):
    for docs in (documents, odd_documents):
        found = identifiers.report(docs).collect()
        wanted = sorted(repr((i, brute.listed(brute.identifiers(t)))) for i, t in texts(docs))
        assert sorted(repr((r["doc_id"], r["spans"])) for r in found) == wanted
    assert identifiers.report(odd_documents.limit(0)).count() == 0
    masked = identifiers.mask(odd_documents)
    assert masked.columns == odd_documents.columns and masked.count() == odd_documents.count()
    now = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert now[11] == "mail [EMAIL] now <|endoftext|> [PHONE]" and now[1] is None


def test_context_finds_what_has_no_fixed_form(spark):
    rows = [(i, f"Please call me at +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(20, "so call me at 555-0199 today"), (21, "and 555-0199, again"), (22, "we are at 555-7777 now")]
    # A seed after common words teaches nothing.
    rows += [(30 + i, f"one of the +1 (555) 020-{1000 + i} and one of the many") for i in range(12)]
    rows += [(50, "one of the 1990s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in identifiers.report(docs).collect()}
    assert found[20] == "phone:14:22" and found[21] == "phone:4:12"
    assert found[22] == found[50] == ""
    assert all(re.fullmatch(r"phone:18:35", found[i]) for i in range(12))
    masked = {r["doc_id"]: r["text"] for r in identifiers.mask(docs).collect()}
    assert masked[21] == "and [PHONE], again" and masked[50] == rows[-1][1]


def learnt(spark, lines):
    """Spans of each of the last lines, which are given as a dict, learnt with the others."""
    rows, asked = lines
    docs = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(rows)] + list(asked.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in identifiers.report(docs).collect()}
    return {i: found[i] for i in asked}


def test_weak_or_rare_contexts_do_not_vouch(spark):
    def phone(i):
        return f"+1 (555) 010-{1000 + i}"

    # Fifty contexts with five seeds and a score of 0.1 each, all before the same number.
    rows = []
    for c in range(50):
        rows += [f"w{c} the {phone(5 * c + i)} x" for i in range(5)]
        rows += [f"w{c} the 2024 x {i}" for i in range(5)]
        rows += [f"w{c} the {10_000 + 100 * c + i} x" for i in range(40)]
    # One confident context before a number that mostly stands elsewhere.
    rows += [f"call me at {phone(1000 + i)} x" for i in range(30)]
    rows += ["call me at 1984 x", "call me at 555-0199 x", *[f"so in 1984 it was {i}" for i in range(5)]]
    found = learnt(spark, (rows, {0: "by the year 2024 and", 1: "by the year 1984 and", 2: "or 555-0199 x"}))
    assert found == {0: "", 1: "", 2: "phone:3:11"}


def test_plain_texts_count_against_a_context(spark):
    rows = [f"so write to anna{i}@example.com x" for i in range(20)]
    rows += ["so write to b2b4u x", *["so write to " + "abcdefghij"[i % 10] * (1 + i // 10) + " x" for i in range(100)]]
    assert learnt(spark, (rows, {0: "the b2b4u x"})) == {0: ""}


def test_any_form_after_a_confident_context(spark):
    rows = [f"so mail me at anna{i}@example.com x" for i in range(20)]
    rows += [f"12 ring us on +1 (555) 010-{1000 + i} x" for i in range(20)]
    # The context's own words hold digits.
    rows += [f"on 2024 line4 +1 (555) 020-{1000 + i} x" for i in range(20)]
    asked = {
        0: "mail me at anna[at]example.com, or",
        1: "and (user(at)host) or",
        2: "mail me at user(at)host",
        3: "é🙂 ring us on 555 010 9999, or",
        4: "in 2024 555 010 9999",
        5: "ring us on 0555 010 9999",
        6: "the 0555 ring",
        7: "on 2024 line4 555-0177 x",
        8: "555\n010 9999",
    }
    found = learnt(spark, (rows, asked))
    assert found == {
        0: "email:11:30",
        1: "email:5:17",
        2: "email:11:23",
        3: "phone:14:26",
        4: "phone:8:20",
        5: "phone:11:24",
        6: "",
        7: "phone:14:22",
        8: "",
    }


def chatter(seed, size=400):
    """Lines in which contexts are followed by fixed forms, other forms, numbers in groups and words."""
    rng = random.Random(seed)
    shares = {c: rng.choice([0.3, 0.7, 0.8, 0.9, 0.95]) for c in CONTEXTS}
    other = [f"u{i}(at)host{i}" for i in range(12)] + [f"555 01{i} 99{i}" for i in range(10, 22)]
    other += [f"0{i}-{i}{i}" for i in range(10, 20)]

    def fixed(kind):
        n = rng.randrange(40)
        forms = {
            "email": f"anna{n}@example.com",
            "phone": f"+1 (555) 010-{1000 + n}",
            "ip": f"10.0.{n}.7",
            "card": f"4532 0151 1283 0366 {n}" if n % 7 == 0 else "4532015112830366",
        }
        return forms[kind]

    lines = []
    for i in range(size):
        parts = [rng.choice(FILLER) for _ in range(rng.randrange(3))]
        for _ in range(rng.randrange(1, 4)):
            context = rng.choice(list(CONTEXTS))
            last = rng.choice(other if rng.random() < 0.8 else FILLER)
            if rng.random() < shares[context]:
                last = fixed(CONTEXTS[context])
            around = rng.choice(["{}", "{}", "({})", "{},", "\"{}\"."])
            parts += [rng.choice([context, context.upper()]), around.format(last)]
            parts += [rng.choice(FILLER) for _ in range(rng.randrange(4))]
        if rng.random() < 0.1:
            parts.append(rng.choice(other))
        lines.append(rng.choice([" ", " ", "  ", "\n"]).join(parts))
    return [*lines, *lines[:9], None, ""]


CONTEXTS = {
    "mail me": "email",
    "write to": "email",
    "ring us": "phone",
    "call on": "phone",
    "the host": "ip",
    "paid by": "card",
    "or on": "phone",
    "see 2024": "email",
}
FILLER = "the or on at by and now then x é🙂 we 12 (so) 1984, line4".split()


@pytest.mark.parametrize("seed", [0, 3])
def test_learnt_spans_are_those_of_a_plain_bootstrap(spark, seed):
    rows = chatter(seed)
    learnt_values, wanted = brute.all_identifiers(rows)
    assert learnt_values
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    spans = {r["doc_id"]: r["spans"] for r in identifiers.report(docs).collect()}
    assert [spans[i] for i in range(len(rows))] == wanted


@pytest.mark.parametrize("most", [1, 1 << 17])
def test_occurrences_are_counted_before_they_are_joined(spark, monkeypatch, most):
    """A common pair of words makes one row of the join; so few flags that nothing is ruled out change nothing."""
    monkeypatch.setattr(identifiers, "MOST_WORDS", most)
    texts = [("k1", "Write to a write to b write TO c"), ("k2", "write to d"), ("k3", "x y z x y"), ("k4", "")]
    found = spark.createDataFrame(texts * 50, "key string, text string")
    wanted = spark.createDataFrame([("write to",), ("x y",), ("not there",)], "context string")
    counted = identifiers._occurrences(found, wanted)
    assert {r["context"]: r["all"] for r in counted.collect()} == {"write to": 200, "x y": 50}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [context")
