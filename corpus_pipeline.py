"""Corpus pipeline: documents to a weighted training mixture in five stages.

1. quality: the byte-level classifier, trained on ``labels``; rejected
   documents (score under 0.5) go;
2. near_dedup: one document of each group of near copies stays (five-word
   shingles, similarity 0.8 or more);
3. substring_dedup: passages of 35 words or more that occur more than once in
   what is left are cut out of the texts;
4. decontaminate: documents that hold 80 % of a benchmark item's five-word
   shingles go;
5. mix: sources are drawn to temperature weights whose entropy is 0.95 of the
   largest, within a budget of all tokens.  The result is the mixture: one row
   per drawn copy of a document, with its place and its text.

Every stage but the last returns the columns of ``documents``; ``run`` writes
each stage as Parquet in the shared checkpoint folder and reads it back, which
also cuts the lineage.  Stages accept NULLs in any column, empty tables, ties
and repeated rows; what they do with them is said in their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import decontaminate, minhash, mixing, quality, substring
from featureflow.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from all labelled documents of the stage's input."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("quality_score >= 0.5").drop("quality_score")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group; rows that repeat an id or have none take part."""
    return minhash.keep_one_row(docs, width=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; n_chars counts what is left."""
    cleaned = substring.remove_repeats(docs, window=35)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: (doc_id, source, tokens, epoch, block, place, weight, text) per drawn copy."""
    return mixing.mix(docs, entropy=0.95, with_text=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
]

# the classifier and the mixture after it have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
