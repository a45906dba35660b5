"""Queries on tables of documents that need no model: mixing, token counts, sharding, quality, encoding, spellings, secrets and the pipeline."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from rillflow.sources.tables import table

from . import bpe, mixing, quality, secrets, sharding, spelling, token_counts
from .common import own_dir, stored


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    found = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "source")
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three commits over all documents: provisional counts in, words counted, copies of a text out.

    The second commit is sent twice, as after a failure; the totals hold it once.
    """
    words, size = mixing.word_count(F.col("text")), F.coalesce(F.octet_length("text"), F.lit(0))
    # one pass over the texts; all commits see these numbers alone
    docs = stored(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", words.alias("words"), size.cast("long").alias("size"), F.md5("text").alias("key")), "counts-docs")
    rollup = token_counts.TokenRollup(spark, f"{own_dir(spark)}/rollup-{uuid.uuid4().hex}")
    words, size = F.col("words"), F.col("size")
    guess = F.ceil(F.coalesce("n_chars", F.lit(0)) / 6)
    rollup.commit("insert", token_counts.inserts(token_counts.counted(docs, "words-1", guess)), token_counts.inserts(token_counts.counted(docs, "bytes-1", size)))
    for _ in range(2):
        rollup.commit("revise", token_counts.revisions(token_counts.counted(docs, "words-1", words, guess.cast("long").alias("old_tokens"))))
    # a text's copies meet as one row for each source and language, however many they are
    alike = docs.where("key is not null").groupBy("key", "source", "lang", "words", "size").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    place = F.row_number().over(W.partitionBy("key").orderBy("first", F.col("source").asc_nulls_first(), F.col("lang").asc_nulls_first()))
    copies = alike.withColumn("n", F.col("n") - (place == 1).cast("long"))
    rollup.commit("delete", *(copies.select("source", "lang", F.lit(version).alias("tokenizer"), (-F.col("n")).alias("n_docs"), (-F.col("n") * F.col(of)).alias("n_tokens")) for version, of in (("words-1", "words"), ("bytes-1", "size"))))
    return rollup.totals()


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of equal counts, cut from Hilbert order."""
    found = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    return quality.quality_rules(table(spark, sf_dir, "documents"), "doc_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's ids and of what they decode to."""
    return bpe.encode(table(spark, sf_dir, "documents"), "doc_id", ids=False, digests=True)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of all documents."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by a ledger of blobs that starts empty."""
    ledger = secrets.BlobLedger(spark, f"{own_dir(spark)}/ledger-{uuid.uuid4().hex}")
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), ledger)
    of = lambda *rules: F.filter("spans", lambda s: s["kind"].isin(*(r.kind for r in rules)))
    counts = [F.size(of(r)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(secrets.listed(of(*secrets.BASE)), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py, at the top of the repository."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"op9_bpe": op9_bpe, "pipeline": pipeline, "op1_mixing": op1_mixing, "op3_token_counts": op3_token_counts, "op7_sharding": op7_sharding, "op8_quality_rules": op8_quality_rules, "op12_spelling": op12_spelling, "op13_secrets": op13_secrets}
_WORDS = r"len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+'))"
#: The excess is reshared until none is above its cap: in order of cap / weight, the sources whose cap is below the level
#: that the words left would give are capped.
_MIX = f"""d AS (SELECT doc_id, source, {_WORDS} AS size FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN CAST(5 AS DOUBLE) WHEN 1 THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight, CAST(2 * source_size AS DOUBLE) AS cap, (SELECT CAST(sum(source_size) AS DOUBLE) FROM s) * CAST(1.5 AS DOUBLE) AS budget FROM s),
 l AS (SELECT *, (budget - COALESCE(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
 f AS (SELECT level AS v FROM l WHERE cap > level * weight ORDER BY cap / weight LIMIT 1),
 t AS (SELECT source, source_size, least(cap, COALESCE((SELECT v FROM f) * weight, cap)) AS target FROM l),
 r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
 c AS (SELECT d.doc_id, d.size, r.source_size, r.target, CAST(floor(rate) AS BIGINT) + CASE WHEN CAST(('0x' || substr(md5('mix|' || COALESCE(CAST(d.doc_id AS VARCHAR), '\\N')), 1, 13)) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM d JOIN r ON r.source IS NOT DISTINCT FROM d.source)"""
ORACLES: dict[str, str] = {
    "op1_mixing": f"WITH {_MIX} SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM c",
    "op3_token_counts": f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS place FROM documents), u AS (SELECT source, lang, {_WORDS} AS words, octet_length(encode(COALESCE(text, ''))) AS size FROM k WHERE place = 1 OR text IS NULL)
 SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, CAST(sum(words) AS BIGINT) AS n_tokens FROM u GROUP BY 1, 2 UNION ALL SELECT source, lang, 'bytes-1', count(*), CAST(sum(size) AS BIGINT) FROM u GROUP BY 1, 2""",
}
