"""Corpus pipeline: documents without toxic ones, common lines and near copies, mixed to target weights, as token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkrec.llm import chosen_path, line_dedup, mixing, sentencepiece_bpe, toxicity
from sparkrec.llm.common import drop_materialized, materialize, read
from sparkrec.llm.queries import piece_model

#: Token shares after mixing. Every document stays; those of a domain that is short are repeated.
QUALITY_WEIGHTS = {"high": 0.85, "low": 0.15}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 and more go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of five and more documents stay in the largest doc_id only."""
    return line_dedup.without_common_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id."""
    return chosen_path.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, each at least once."""
    return mixing.mixed(docs, mixing.quality_domains(read(spark, sf_dir, "labels")), QUALITY_WEIGHTS, min_rate=1.0)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoding."""
    return sentencepiece_bpe.round_trip(docs, piece_model())


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_common_lines), ("jaccard_join", drop_near_copies), ("mixing", mix),
          ("sentencepiece", tokenize)]

#: SQL can't express the classifiers, the rates and the tokens; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each one's result written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        done = materialize(out, f"stage-{name}")
        drop_materialized(docs)
        docs = done
    return docs
