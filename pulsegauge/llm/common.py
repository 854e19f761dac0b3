"""What the operators share: tables, words, and rows that keep their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import working_folder
from ..sources.tables import stored

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared working folder and read back."""
    return stored(rows, working_folder(rows.sparkSession, name))


def wrapped(rows: DataFrame, **more: Column) -> DataFrame:
    """The rows' own columns as one struct ``row``, so that added names cannot clash."""
    return rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def unwrapped(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("row.*", *more)


def row_hash(rows: DataFrame) -> Column:
    """A hash of all of a row that can be hashed, to order rows that tie otherwise."""
    plain = [rows[f"`{c}`"] for c, kind in rows.dtypes if "map<" not in kind and kind != "variant"]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def text_bytes(rows: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows; partition counts are derived from it."""
    return int(rows.agg(F.sum(F.octet_length(column))).first()[0] or 0)
