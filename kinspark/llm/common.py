"""Shared helpers of the text operators: table access, staging, word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.functions.text import bind
from kinspark.session import shared_path, table

__all__ = ["WHITE", "WHITE_RE", "bind", "documents", "pick", "stage", "words"]

#: ASCII white space (space, tab, \n, \v, \f, \r); a word is a run of anything else.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pick(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text), under fixed names and types; whatever else the table has can't clash."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text as an array (no words: empty array)."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RE))
