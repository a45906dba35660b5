"""Mixing sources to target weights, with DataFrame functions only.

Words per source give each source's target; target / words is its repetition rate. A document is emitted floor(rate)
times, and once more with the fraction as probability, decided by a hash of its id: reruns agree, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, stored, unit_hash

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """From (source, source_size), one row per source: target words.

    Sources in code-point order, null last, weigh as `weights` repeating and share `share` times all words. Sharing the
    excess over most * source_size again and again by weight ends where every source has min(cap, level * weight): in order
    of cap / weight, a source is capped while its cap is below what the words left would give it. One row per source is
    all that the ordered windows see. A source without words gets 0.
    """
    n = len(weights)
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (place % n + 1).cast("int"))
    by_level = W.orderBy(F.col("__cap") / F.col("__weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, W.unboundedFollowing)
    all_rows = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        sizes.select("source", "source_size", weight.alias("__weight"), (F.col("source_size") * F.lit(most)).alias("__cap"), (F.sum("source_size").over(all_rows) * F.lit(share)).alias("__budget"))
        .withColumn("__left", F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
        .withColumn("__level", F.col("__left") / F.sum("__weight").over(onward))
        .withColumn("__capped", F.col("__cap") <= F.col("__level") * F.col("__weight"))
        .withColumn("__level", F.min(F.when(~F.col("__capped"), F.struct((F.col("__cap") / F.col("__weight")).alias("k"), F.col("__level").alias("v")))).over(all_rows)["v"])
        .select("source", "source_size", F.least("__cap", F.coalesce(F.col("__level") * F.col("__weight"), F.col("__cap"))).alias("target"))
    )


def rates(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """From rows of (source, size), one row per source: __source, source_size, target, rate (0 where the source has no words).

    Only (source, words) leaves a task, summed before the shuffle, so a source with a third of the rows costs no more than
    another. The table is written: the optimizer knows its size when it is joined back, and broadcasts it only if that is
    below the session's threshold.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = targets(sums, weights, share, most)
    return stored(found.select(F.col("source").alias("__source"), "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate")), "mix-rates")


def copies(rate: Column, doc_id: Column, seed: str) -> Column:
    """floor(rate), and one more with the fraction's probability."""
    return (F.floor(rate) + (unit_hash(seed, doc_id) < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, *keep: str, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **target: object) -> DataFrame:
    """One row per document: `keep`, size, source_size, target, rate and copies, the times it is emitted.

    Null and empty texts have size 0 and are emitted like any other; null sources form one source. Rows that repeat an id
    are decided alike. An empty table gives an empty result. target: weights, share and most of rates().
    """
    sized = docs.select(*(F.col(c) for c in keep), F.col(doc_id).alias("__id"), F.col(source).alias("__of"), word_count(F.col(text)).alias("size"))
    sized = stored(sized, "mix-sized")
    found = rates(sized.select(F.col("__of").alias("source"), "size"), **target)
    return sized.join(found, F.col("__of").eqNullSafe(F.col("__source"))).withColumn("copies", copies(F.col("rate"), F.col("__id"), seed)).drop("__id", "__of", "__source")


def emit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **target: object) -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it, with the columns of docs.

    Words are counted in one pass, texts read again to be emitted. Null and empty texts are emitted like any other, at their
    source's rate; rows that repeat an id are decided alike. docs may have any columns but __source, __rate and __copy.
    """
    if clash := {"__source", "__rate", "__copy"} & set(docs.columns):
        raise ValueError(f"columns of the mix's own names: {sorted(clash)}")
    found = rates(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size")), **target).select(F.col("__source"), F.col("rate").alias("__rate"))
    return (
        docs.join(found, docs[source].eqNullSafe(F.col("__source")))
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies(F.col("__rate"), F.col(doc_id), seed).cast("int"))))
        .select(*docs.columns)
    )
