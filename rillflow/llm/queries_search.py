"""Queries that search or turn vectors: near duplicates, nearest neighbours and whitening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.sources.tables import table

from . import ann, near_dup, whitening


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by two-word shingles at 0.8."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened coordinates of every vector."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op5_ann": op5_ann, "op4_near_dup": op4_near_dup, "op11_whitening": op11_whitening}
_WORDS = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: All links by a prefix filter, which loses none: of two sets that overlap so far, the rarest parts share a shingle.
_NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN list_slice(w, 1, 1) ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
 e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s WHERE len(s) > 0),
 f AS (SELECT g, count(*) AS df FROM e GROUP BY g),
 o AS (SELECT e.doc_id, e.n, e.g, row_number() OVER (PARTITION BY e.doc_id ORDER BY f.df, e.g) AS k FROM e JOIN f ON f.g = e.g),
 p AS (SELECT doc_id, n, g FROM o WHERE k <= n - (80 * n + 99) // 100 + 1),
 c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
 l AS (SELECT c.a, c.b FROM c JOIN e x ON x.doc_id = c.a JOIN e y ON y.doc_id = c.b AND y.g = x.g GROUP BY c.a, c.b, c.na, c.nb HAVING 100 * count(*) >= 80 * (c.na + c.nb - count(*))),
 u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT DISTINCT a AS id, a AS to_id FROM u UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.to_id),
 m AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY id)
 SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, COALESCE(m.component_id, s.doc_id) AS component_id, s.doc_id = COALESCE(m.component_id, s.doc_id) AS kept FROM s LEFT JOIN m ON m.id = s.doc_id"""
ORACLES: dict[str, str] = {"op4_near_dup": _NEAR}
