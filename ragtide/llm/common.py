"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtide.functions.text import let
from ragtide.session import written

__all__ = ["WS", "ascii_lower", "join_on_key", "keyed", "let", "row_key", "rows_of", "table", "text_or_empty",
           "words_of", "written"]

#: ASCII white space as the contracts name it: space and 0x09-0x0D.
WS = " \t\n\x0b\x0c\r"
#: Single characters, which Java looks up in one table (a range it compares).
WS_RUN = "[ \\t\\n\\x0B\\x0C\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between ASCII white space; no empty words, ``[]`` for a blank text."""
    trimmed = F.btrim(text, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WS_RUN))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def row_key(text: str = "text", doc_id: str = "doc_id") -> list[Column]:
    """A key that holds for repeated and null ids: equal keys, equal rows."""
    return [F.col(doc_id).alias("_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h")]


def keyed(docs: DataFrame) -> DataFrame:
    """The whole row as ``_row`` beside its key, so that no column can clash."""
    return docs.select(F.struct("*").alias("_row"), *row_key())


def rows_of(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def join_on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Null-safe join on ``_id, _h``; the right side's keys are dropped."""
    right = right.withColumnsRenamed({"_id": "_rid", "_h": "_rh"})
    on = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_h") == F.col("_rh"))
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_rid", "_rh")
