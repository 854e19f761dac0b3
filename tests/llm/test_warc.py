import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from pulsegauge.llm import warc
from pulsegauge.session import working_folder


def wanted(pages):
    last, out = {}, []
    for i, _, html in pages:
        data = (html or "").encode()
        if i is not None and len(data) >= 1000:
            last[data] = max(i, last.get(data, i))
    for i, _, html in pages:
        data = (html or "").encode()
        again = data in last and last[data] != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last[data] if again else None))
    return sorted(map(repr, out))


PAGES = [
    (1, "http://a.b/ü", "é" * 600),
    (2, None, "é" * 600),
    (3, "u\r\nWARC-Type: x", "x" * 999),
    (4, "u", "x" * 999),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (None, "u", "é" * 600),
    (None, "u", "é" * 600),
    (8, "u", "y" * 5_000_000),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("no"))
    found = warc.round_trip(pages).collect()
    assert sorted(repr(tuple(r)) for r in found) == wanted(PAGES)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_members_stand_alone(spark, tmp_path):
    raw, members = working_folder(spark, "raw"), working_folder(spark, "members")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write(pages, raw)
    index = warc.normalise(spark, raw, members).collect()
    assert len(index) == len(PAGES)
    for r in index:
        with open(f"{members}/{r['file']}", "rb") as file:
            file.seek(r["offset"])
            record = gzip.decompress(file.read(r["length"]))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: {r['record']}".encode() in record
    by_file = {}
    for r in sorted(index, key=lambda r: r["offset"]):
        assert r["offset"] == by_file.get(r["file"], 0)
        by_file[r["file"]] = r["offset"] + r["length"]


def test_records_are_cut_whatever_the_pieces():
    one = b"WARC/1.1\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n"
    two = b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for size in (1, 2, 3, 7, 100):
        records = warc._Records()
        data = one + two + one
        found = [r for at in range(0, len(data), size) for r in records.add(data[at : at + size])]
        assert found == [one, two, one] and not records.held


def test_a_member_that_is_cut_off_raises():
    whole = gzip.compress(b"one") + gzip.compress(b"two")
    assert b"".join(warc._inflated(whole)) == b"onetwo" and list(warc._inflated(b"")) == []
    for cut in (1, 8, len(gzip.compress(b"two")) - 1):
        with pytest.raises(EOFError):
            list(warc._inflated(whole[:-cut]))
