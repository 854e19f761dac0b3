"""The training-data operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_zone
from . import (
    bpe,
    identifiers,
    mixing,
    near_duplicates,
    negatives,
    neighbours,
    packing,
    passages,
    prefix_trie,
    quality,
    similar,
    urls,
    warc,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(pin_zone(spark), folder)

    REGISTERED[query.__name__] = run
    return run


@registered
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("words"))
    taken = mixing.mix(sized, size="words")
    return taken.select(
        "doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.col("mix.copies") * F.col("mix.size")).alias("taken"),
    )


@registered
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@registered
def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select(
        "page_id", "judgement.host", "judgement.path", "judgement.rule", "judgement.verdict"
    )


@registered
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.report(docs)


@registered
def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return passages.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def vocabulary() -> str:
    """The vocabulary file the queries use; every executor finds it at the same place."""
    return public_tokenizers.path("byte_bpe_50k.json")


@registered
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digests(table(spark, folder, "documents"), vocabulary())


@registered
def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0)


@registered
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar.join(table(spark, folder, "documents").select("doc_id", "text"))


@registered
def op5_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    return identifiers.report(table(spark, folder, "documents").select("doc_id", "text"))


@registered
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # The vocabulary's own id for the end of a text.
    return packing.pack(docs, "text", end=50256, vocabulary=vocabulary())


@registered
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


@registered
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, moved)


@registered
def op13_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
