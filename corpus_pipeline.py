"""Corpus cleaning: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, ngram_join, quality_rules, queries, sentencepiece_bpe, toxicity
from tidemark.llm.storage import table_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic, by a lexicon learned from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.clean_documents(docs, toxicity.learn(docs, labels, toxicity.held_out_fifth))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the least id."""
    return ngram_join.distinct_documents(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, number of ids and digests of each document's text."""
    model = queries.tokenizer_file("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(docs.select("doc_id", "text"), model).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip")


STAGES = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("ngram_jaccard_join", distinct),
    ("bm25_decontamination", uncontaminated),
    ("sentencepiece", tokens),
]

#: EM, a learned lexicon and merges can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(path := table_path(spark, name))
            docs = spark.read.parquet(path)
    return docs
