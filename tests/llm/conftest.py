import pytest

CLASHES = (
    "row long, key string, mix long, quality string, size long, words string, kept boolean, "
    "chunk long, judgement string, token_ids string, _key string, _size long, found string"
)
NAMES = [part.split()[0] for part in CLASHES.split(", ")]

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ODD = "é漢 \t x\x0b\x0cy\r\n\n 🙂🙂 a b c d e f g h i j k l m n o p"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and very long texts, ties, repeats, and columns with clashing names."""
    rows = [
        (1, None, None, None, None),
        (None, "", "", "a", 0),
        (None, None, "en", None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, LONG, "en", "b", len(LONG)),
        (5, LONG + " tail", "en", "b", len(LONG) + 5),
        (6, ODD, "de", None, len(ODD)),
        (6, ODD, "de", None, len(ODD)),
        (7, ODD, "de", "a", len(ODD)),
        (8, "one two three", "en", "ä", 13),
        (9, "one two three", "en", "ä", 13),
        (None, "one two three", "en", "B", 13),
        (10, "x" * 300_000, "en", "B", 300_000),
        (11, "mail a.b@c.de now <|endoftext|> +1 (555) 010-9999", "en", "B", 48),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
    rows = [(*r, *([None] * len(NAMES))) for r in rows]
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def documents(spark, tables):
    return spark.read.parquet(tables.replace("sf0.01", "sf0.001") + "/documents.parquet")


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
