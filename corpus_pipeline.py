"""Cleans and mixes the documents in stages; each is written as Parquet and read again by the next.

A stage is a function of (spark, docs, sf_dir). All but the last return rows with the columns of documents; the last one
returns what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import decontam, langid, mixture, neardup, substrings, toxicity
from barwright.llm.ship import ship
from barwright.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from two thirds of the labelled documents."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~langid.held_out(F.col("doc_id"), 3, 1))
    model = toxicity.train(docs.select("doc_id", "text").join(labels.select("doc_id", "toxic"), "doc_id"))
    return toxicity.drop_toxic(docs, model, 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near-duplicates stays."""
    ship(spark)
    return neardup.keep_one(docs, percent=75)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has are cut; the documents stay, with what is left."""
    ship(spark)
    cut = substrings.cut_repeats(docs, window=50)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too much of a benchmark item go."""
    ship(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    ship(spark)
    return mixture.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixture", mix),
]

#: The first stage learns from labels, which SQL can't; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
