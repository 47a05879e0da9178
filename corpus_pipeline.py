"""The text pipeline: toxic documents, near-duplicates, repeated passages, benchmark leaks, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfold.llm.decontaminate import clean_documents
from wayfold.llm.mixing import sample
from wayfold.llm.neardup import distinct_documents
from wayfold.llm.spans import passage_dedup, without_repeats
from wayfold.llm.toxicity import fit, held_out, mild_documents
from wayfold.session import checkpoint

#: Score from which a document counts as toxic; share of tokens that the mix keeps.
TOXIC, KEEP = 0.3, 0.8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the model, learnt without the held-out labels, scores as toxic."""
    labels = _table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    return mild_documents(docs, fit(docs, labels, "toxic"), below=TOXIC)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return distinct_documents(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; n_chars follows the text."""
    return without_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item; of those left, none keeps 50 words that an earlier one has."""
    clean = checkpoint(clean_documents(docs, _table(spark, sf_dir, "benchmark")))
    return passage_dedup(clean, found="_passages").withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources, languages and topics meet their target shares."""
    return sample(docs, keep=KEEP)


STAGES = [("toxicity", toxicity), ("minhash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("decontamination", decontaminate), ("source mixing", mix)]

#: The first stage's model has no SQL form; tests hold the pipeline against its stages and brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
