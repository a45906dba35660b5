"""A training corpus from raw documents: quality rules, near duplicates, personal data, mixing, encoding.

Each stage works on all that its predecessor kept. All but the last return the columns of documents; other columns are left
out, whatever their names. Null texts are empty to every stage; an empty table passes through all of them. Very long texts are
worked on whole, each by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.llm import bpe, mixing, near_dup, pii, quality
from rillflow.llm.common import remove_tables, stored
from rillflow.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle and least similarity, in percent, of the near-duplicate stage.
SHINGLE, PERCENT = 5, 80


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go; rows that repeat are judged each; null ids are kept."""
    return quality.quality_rules(docs, *COLUMNS[:1], *COLUMNS[2:], whole=True).where("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; documents without an id stay.

    Rows that repeat an id are one group, and the least by text, language, source and size of it stays.
    """
    judged = near_dup.near_duplicates(docs, shingle=SHINGLE, percent=PERCENT)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti").select(*COLUMNS)
    twice = stored(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("__twice")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pipeline-twice")
    if not twice.limit(1).count():
        return left
    again = left.join(twice, F.col("doc_id") == F.col("__twice"), "left_semi")
    least = again.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("least")).select("doc_id", "least.*")
    return left.join(twice, F.col("doc_id") == F.col("__twice"), "left_anti").unionByName(least)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text. Null texts stay null; each row by itself."""
    found = pii.find_pii(docs, "doc_id", "lang", "source", "n_chars", redact=True)
    changed = F.col("spans") != ""
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.when(changed, F.char_length("redacted").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Null sources are one source; rows that repeat an id are taken alike."""
    return mixing.emit(docs).select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of what they decode to; no ids of null and empty ones. Rows that repeat are encoded each."""
    return bpe.encode(docs, "doc_id", "lang", "source", digests=True)


STAGES = [
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]

#: SQL has no zstandard, no HyperMinHash, no semi-Markov field and no byte-level BPE; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written and read again, and its input then removed.

    Tables of the last stages are there until remove_tables(spark) of the common module, once the result is saved.
    """
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        remove_tables(spark, before)  # none but tables of stored()
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
