"""Helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import shared_folder

# Fixed value: what separates words in every contract of this package.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remainder(ids: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; a null id counts as empty text."""
    return F.coalesce(F.crc32(ids.cast("string")), F.lit(0)) % divisor


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
