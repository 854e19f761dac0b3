import pytest

from pulsegauge.llm import urls


def judged(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, judgement string, host string")
    return {r["page_id"]: r["judgement"] for r in urls.judge(pages, **options).collect()}


def test_rules_and_parts(spark):
    cases = [
        ("HTTP://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("x://a.net/es/?y", "a.net", "/es/", "net/es/", "block"),
        ("x://a.net/es", "a.net", "/es", None, "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://a.org#://b.net/fr/", "a.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://ÄB.org/", "Äb.org", "/", None, "allow"),
        ("http://a.org/" + "p/" * 50_000, "a.org", "/" + "p/" * 50_000, None, "allow"),
    ]
    found = judged(spark, [(i, c[0], None, None) for i, c in enumerate(cases)])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert found[i][:4] == (host, path, rule, verdict), cases[i][0][:60]


def test_terms_count_at_boundaries_only(spark):
    cases = [
        ("http://a.org/casino", "block"),
        ("http://a.org/casinos", "allow"),
        ("http://CASINO.org/", "block"),
        ("http://a.org/free", "allow"),
        ("http://a.org/free/free-free", "allow"),
        ("http://a.org/free-bet", "block"),
        ("http://a.org/freebet", "allow"),
        ("http://porno.org/", "block"),
        ("http://a.org/porn0", "allow"),
        ("http://a.com/casino", "allow"),
        ("casino", "block"),
    ]
    found = judged(spark, [(i, c[0], None, None) for i, c in enumerate(cases)])
    assert [found[i]["verdict"] for i in range(len(cases))] == [c[1] for c in cases]


def test_empty_lists_and_tables(spark):
    found = judged(spark, [(1, "http://a.org/casino", None, None)], rules=(), strict=(), soft=())
    assert found[1]["verdict"] == "allow"
    assert judged(spark, []) == {}
    repeated = spark.createDataFrame([(1, "x"), (1, "x")], "page_id long, url string")
    assert urls.judge(repeated).count() == 2


def test_a_vocabulary_of_weights(spark):
    table = spark.createDataFrame(
        [("Online-Casino", 1.0), ("online casino", 0.2), ("slots", 0.6), ("spin", 0.4), ("now", 0.1), ("été", 2.0),
         ("bad", None), ("worse", -1.0), ("worst", float("nan")), (None, 1.0), (" / ", 1.0)],
        "term string, weight double",
    )
    terms = urls.read_vocabulary(table)
    assert dict(terms) == {"online casino": 1.0, "slots": 0.6, "spin": 0.4, "now": 0.1, "été": 2.0}
    cases = [
        ("http://online.casino.org/", "block", (1, 0, 1.0)),
        ("http://a.org/ONLINE_-_casino", "block", (1, 0, 1.0)),
        ("http://a.org/onlinecasino", "allow", (0, 0, 0.0)),
        ("http://a.org/online/x/casino", "allow", (0, 0, 0.0)),
        ("http://a.org/slots/spin", "block", (0, 2, 1.0)),
        ("http://a.org/slots/slots/now", "allow", (0, 2, 0.7)),
        ("http://a.org/l-été-1", "block", (1, 0, 2.0)),
        ("http://a.org/bad/worse/worst", "allow", (0, 0, 0.0)),
    ]
    found = judged(spark, [(i, c[0], None, None) for i, c in enumerate(cases)], terms=terms)
    for i, (url, verdict, hits) in enumerate(cases):
        assert (found[i]["verdict"], (found[i]["strict"], found[i]["soft"], found[i]["weight"])) == (verdict, hits), url
    tenths = [urls.Term(f"t{i}", 0.1) for i in range(10)]
    url = "http://a.org/" + "/".join(t.term for t in tenths)
    assert judged(spark, [(1, url, None, None)], terms=tenths)[1]["verdict"] == "block"
    assert judged(spark, [(1, url, None, None)], terms=tenths, limit=1.1)[1]["verdict"] == "allow"


def test_a_vocabulary_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_CHARACTERS", 3)
    with pytest.raises(ValueError):
        urls.read_vocabulary(spark.createDataFrame([("casino", 1.0)], "term string, weight double"))
    assert urls.read_vocabulary(spark.createDataFrame([], "term string, weight double")) == ()
