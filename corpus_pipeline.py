"""From raw documents to packed training sequences: five stages, each one of the operators in tallyloom/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, grouping, repeats, simhash, tokens, toxicity
from tallyloom.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on these documents and ``labels``, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, the document with the smallest doc_id."""
    return simhash.one_of_each(docs, width=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages that a smaller doc_id also has; ``n_chars`` follows the text."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens."""
    return grouping.pack(docs, tokens.default_path(), limit=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: a trained classifier, fingerprints and an evolved packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
