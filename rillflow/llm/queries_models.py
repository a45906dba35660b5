"""Queries with trained models: toxicity, personal data and language-model scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.sources.tables import table

from . import lm_score, pii, toxicity


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"), "doc_id")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op2_toxicity": op2_toxicity, "op6_pii": op6_pii, "op10_lm_score": op10_lm_score}
ORACLES: dict[str, str] = {}
