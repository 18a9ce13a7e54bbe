"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.session import checkpoint_root, shared_path

# words are separated by these bytes only (no other Unicode white space)
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (small tables)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (NULL id: NULL)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
