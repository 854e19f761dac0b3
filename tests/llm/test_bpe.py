import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegauge.llm import bpe
from pulsegauge.llm.catalog import vocabulary

from .conftest import texts

ALPHABET = "abS' theing<|endoftext|>\n\t\x0b\x1c\x85\xa0éßȿɀ½²٣漢🙂́ᾀǅ　​_-.,!?0123"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet=ALPHABET, max_size=60), st.text(max_size=30)))
def test_same_ids_as_the_library(library, text):
    known = bpe.vocabulary(vocabulary())
    ids = library.encode(text, add_special_tokens=False).ids
    assert known.encode(text) == ids
    assert known.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=90), max_size=40))
def test_side_by_side_merges_alike(pieces):
    known = bpe.vocabulary(vocabulary())
    assert known.merge_many(pieces) == [known.merge(p) for p in pieces]


def test_special_tokens_and_broken_bytes(library):
    known = bpe.vocabulary(vocabulary())
    text = "a<|endoftext|> b<|endoftext|><|endoftext"
    assert known.encode(text) == library.encode(text, add_special_tokens=False).ids
    ids = library.encode("🙂", add_special_tokens=False).ids[:1]
    assert known.decode(ids) == library.decode(ids, skip_special_tokens=False)


def digest(values):
    return hashlib.sha256(values.encode()).hexdigest()


def test_documents_and_odd_rows(spark, library, documents, odd_documents, monkeypatch):
    for docs in (documents, odd_documents):
        wanted, ids_of = [], {}
        for i, text in texts(docs):
            ids = library.encode(text or "", add_special_tokens=False).ids
            ids_of[text] = ids
            back = library.decode(ids, skip_special_tokens=False)
            wanted.append((i, len(ids), digest(",".join(map(str, ids))), digest(back)))
        found = bpe.encode_digests(docs, vocabulary()).collect()
        assert sorted(repr(tuple(r)) for r in found) == sorted(map(repr, wanted))
        encoded = bpe.encode(docs, vocabulary())
        rows = bpe.decode(encoded, vocabulary()).collect()
        assert len(rows) == len(wanted)
        for r in rows:
            assert r["token_ids"] == ids_of[r["text"]] and r["decoded"] == (r["text"] or "")
    assert bpe.encode(odd_documents.limit(0), vocabulary()).count() == 0


def test_worker_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 3)
    memory = bpe._Memory(vocabulary(), bpe._as_text)
    monkeypatch.setattr(bpe, "_memory", lambda path, made: memory)
    words = [f"word{i} next" for i in range(20)]
    known = bpe.vocabulary(vocabulary())
    found = [f[1] for f in bpe.digests(iter(words), vocabulary())]
    assert found == [digest(",".join(map(str, known.encode(w)))) for w in words]
    assert len(memory.of) <= 7
