"""The registered queries of this folder: name → (spark, sf_dir) → DataFrame, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public 32k-piece model."""
    from persona_engine.llm.encode import encode_documents

    return encode_documents(documents(spark, sf_dir), tokenizer_path())


QUERIES["op9_sentencepiece"] = op9_sentencepiece


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of every document, hosts being the sources."""
    from persona_engine.llm.host_rules import host_rules

    return host_rules(documents(spark, sf_dir)).withColumn("host_rate", F.bround("host_rate", 9))


QUERIES["op5_host_rules"] = op5_host_rules
ORACLES["op5_host_rules"] = oracles.HOST_RULES


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    from persona_engine.llm.mixing import mix_sources

    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES["op7_mixing"] = op7_mixing


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places and labels of every document."""
    from persona_engine.llm.licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir))


QUERIES["op3_license_scan"] = op3_license_scan


def op10_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away, in every document."""
    from persona_engine.llm.private_terms import DisclosurePlan, find_private

    return find_private(documents(spark, sf_dir), DisclosurePlan(everywhere=True)).drop("rid", "text_key", "found")


QUERIES["op10_private_terms"] = op10_private_terms


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of four fifths of them."""
    from persona_engine.llm.toxicity import score_toxicity, train_toxicity

    docs = documents(spark, sf_dir)
    return score_toxicity(docs, train_toxicity(docs, labels(spark, sf_dir)))


QUERIES["op4_toxicity"] = op4_toxicity


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from persona_engine.llm.ngram_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


QUERIES["op2_ngram_jaccard"] = op2_ngram_jaccard


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and class-bigram scores of every document, learned from nine tenths of them."""
    from persona_engine.llm.brown import score_documents

    return score_documents(documents(spark, sf_dir))


QUERIES["op1_brown_lm"] = op1_brown_lm


def op8_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    from persona_engine.llm.neighbours import nearest_neighbours

    return nearest_neighbours(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


QUERIES["op8_multiprobe_lsh"] = op8_multiprobe_lsh


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 400 bytes that start anywhere else too."""
    from persona_engine.llm.repeats import remove_repeats

    return remove_repeats(documents(spark, sf_dir))


QUERIES["op6_repeated_strings"] = op6_repeated_strings


def op11_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by n-gram ranks, learned from four fifths of them."""
    from persona_engine.llm.rank_order import rank_order_language

    return rank_order_language(documents(spark, sf_dir))


QUERIES["op11_rank_order_language"] = op11_rank_order_language
ORACLES["op11_rank_order_language"] = oracles.RANK_ORDER_LANGUAGE


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, a tenth of the documents given a periodic tail first."""
    from persona_engine.llm.periodic import periodic_runs

    return periodic_runs(documents(spark, sf_dir), planted=True)


QUERIES["op12_periodic_runs"] = op12_periodic_runs


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How byte-level and piece tokens overlap in every document, and how common the linked pairs are."""
    from persona_engine.llm.align import token_alignment

    return token_alignment(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path())


QUERIES["op13_token_alignment"] = op13_token_alignment


def base_word_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op1_brown_lm what its base model says; SQL can say that."""
    return op1_brown_lm(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.bround("base_score", 6).alias("base_score"))


QUERIES["base_word_scores"] = base_word_scores
ORACLES["base_word_scores"] = oracles.BASE_WORD_SCORES


def base_license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op3_license_scan the places of the base phrases (-1: none)."""
    first, last = (F.coalesce(c, F.lit(-1)).alias(c) for c in ("first_word", "last_word"))
    return op3_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", first, last, "base_labels")


QUERIES["base_license_places"] = base_license_places
ORACLES["base_license_places"] = oracles.BASE_LICENSE_PLACES


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op7_mixing the sizes and targets."""
    return op7_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.bround("target", 6).alias("target"))


QUERIES["mix_targets"] = mix_targets
ORACLES["mix_targets"] = oracles.MIX_TARGETS
