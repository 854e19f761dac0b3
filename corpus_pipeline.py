"""From documents to token ids: filter, deduplicate, mask, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegauge.llm import bpe, catalog, identifiers, mixing, quality, similar
from pulsegauge.llm.common import settled, table
from pulsegauge.session import pin_zone


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule.

    A null text is empty, and has too few words to stay. Repeated rows share their fate,
    other columns play no part, and an empty table stays empty.
    """
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents that with the smallest doc_id.

    Of repeated rows one stays. Null and empty texts are a class of equal texts; a class
    without any doc_id keeps one of its rows. Other columns, null or not, stay as they are.
    """
    return similar.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers masked; ``n_chars``, where there is one, follows the text.

    Null texts stay null with their own ``n_chars``; repeated rows are masked alike.
    """
    masked = identifiers.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn(
        "n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    ).select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for.

    A null source is one of its own. A document without words takes no part in the sizes
    and may go; copies are whole rows. An empty table stays empty.
    """
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, and the ids of the text; a null or empty text has none.

    Repeated rows repeat, other columns are left out, and an empty table gives none.
    """
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), catalog.vocabulary())
    return encoded.select(
        "doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

# Similarity classes, learnt identifiers and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents; what a stage keeps is written for the next."""
    docs = table(pin_zone(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
