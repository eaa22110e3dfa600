"""The registered query of each operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, html_model, huffman_ids, lattice_dedup, license_scan, ngram_join, quality_rules, sentencepiece_bpe, sharding, toxicity, url_rules, whitening


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is, unless a caller names its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_huffman_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return huffman_ids.round_trip(_table(spark, sf_dir, "documents"), tokenizer or tokenizer_file("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op4_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_model.main_texts(pages, html_model.learn(pages))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(_table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bpe.digests(docs, model or tokenizer_file("piece_bpe_32k.model")).drop("text")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_huffman_ids,
        op2_quality_rules,
        op3_extendible_sharding,
        op4_bm25_decontamination,
        op5_html_extraction,
        op6_url_rules,
        op7_license_scan,
        op8_toxicity,
        op9_ngram_jaccard_join,
        op10_sentencepiece,
        op11_phrase_collocations,
        op12_embedding_whitening,
        op13_lattice_dedup,
    )
}
