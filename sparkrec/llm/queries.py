"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkrec.llm import (block_topk, chosen_path, collision_ann, imatch, line_dedup, mixing, pii, prefix_trie, pseudo_lm, ranked_search,
                          secret_links, sentencepiece_bpe, toxicity)
from sparkrec.llm.common import read

MIX_WEIGHTS = {"high": 0.8, "low": 0.1, "toxic": 0.1}


def piece_model() -> str:
    """Path of the public SentencePiece vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.round_trip(read(spark, sf_dir, "documents"), piece_model())


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(read(spark, sf_dir, "documents"), mixing.label_domains(read(spark, sf_dir, "labels")), MIX_WEIGHTS)


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.against_neighbours(read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pseudo_lm.fit_and_score(docs)


def op6_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.scan(read(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(read(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op11_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(read(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(read(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_mixing, op3_imatch, op4_line_dedup, op5_pseudo_likelihood, op6_secret_links, op7_personal_data,
        op8_jaccard_join, op9_block_topk, op10_toxicity, op11_collision_ann, op12_prefix_trie,
        op13_ranked_search)}

ORACLE_SQL: dict[str, str] = {"op4_line_dedup": line_dedup.SQL, "op8_jaccard_join": chosen_path.SQL, "op9_block_topk": block_topk.SQL,
                              "op12_prefix_trie": prefix_trie.SQL, "op13_ranked_search": ranked_search.SQL}
