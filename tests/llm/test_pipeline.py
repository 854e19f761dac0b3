import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegauge.llm import mixing
from pulsegauge.llm.catalog import vocabulary
from pulsegauge.llm.common import settled

from . import brute
from .conftest import texts


def test_each_stage_works_on_all_that_the_one_before_kept(spark, tables):
    folder = tables.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        seen[name] = docs
        docs = settled(stage(spark, docs, folder), name)
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    start = dict(texts(seen["quality_rules"]))
    good = {i for i, t in start.items() if brute.quality(t)[-1]}
    assert {i for i, _ in texts(seen["near_duplicates"])} == good
    classes = brute.classes([(i, start[i]) for i in sorted(good)])
    unique = texts(seen["personal_data"])
    assert sorted(i for i, _ in unique) == sorted({c for _, c, _, _ in classes})
    for i, text in texts(seen["source_mixing"]):
        wanted = start[i]
        for kind, a, b in sorted(((k, *s) for k, v in brute.identifiers(wanted).items() for s in v), key=lambda s: -s[1]):
            wanted = f"{wanted[:a]}[{kind.upper()}]{wanted[b:]}"
        assert text == wanted
    copies = {r["doc_id"]: r["mix"]["copies"] for r in mixing.mix(seen["source_mixing"]).collect()}
    taken = seen["token_ids"].groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in taken} == {i: c for i, c in copies.items() if c}
    library = Tokenizer.from_file(vocabulary())
    text_of = dict(texts(seen["token_ids"]))
    for r in docs.collect():
        assert r["token_ids"] == library.encode(text_of[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["token_ids"])


def test_odd_rows_pass_through(spark, odd_documents):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_documents.select(columns), odd_documents.select(columns).limit(0)):
        long_enough = docs.withColumn("text", F.concat("text", F.lit(" " + " ".join(f"v{i}" for i in range(60)))))
        for name, stage in pipeline.STAGES:
            long_enough = settled(stage(spark, long_enough, ""), name)
        assert long_enough.columns == ["doc_id", "source", "n_tokens", "token_ids"]
