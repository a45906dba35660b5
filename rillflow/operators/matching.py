"""Evidence-tiered entity resolution: blocking, likeness, tiers, claims."""

from __future__ import annotations

import math
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType

from rillflow import config
from rillflow.session import ship_package


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings; null if either is."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a: Column, b: Column) -> Column:
    """Similarity in [0, 1]. The only likeness that needs Python; use it behind an equality that cuts the pairs."""
    return similarity(a, b)


#: Tasks that share the stems of a block that have one pair of letters.
SALTS = 4


def _letter_pairs(rows: DataFrame, columns: Sequence[str], stem: str, name: str) -> DataFrame:
    """rows with the stem's pairs of neighbouring letters, each with how often it came before: a set that counts repeats."""
    listed = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(stem) - 1, F.lit(1))), lambda i: F.substring(stem, i, F.lit(2)))
    numbered = F.transform(F.col("__listed"), lambda g, i: F.concat(g, F.size(F.filter(F.slice("__listed", 1, i), lambda h: h == g)).cast("string")))
    return rows.where(F.char_length(stem) > 1).select(*columns, listed.alias("__listed")).select(*columns, numbered.alias(name))


def _rarest(rows: DataFrame, key: Sequence[str], stem: str, rare: DataFrame, least: float) -> DataFrame:
    """One row for each of a stem's rarest pairs, all but as many as any partner must share, less one."""
    pairs = rows.columns[-1]
    size = F.char_length(stem)
    share = F.ceil((size + F.ceil(size * (least / (2 - least)) - 1e-9)) * (1.5 * least - 1) - 1 - 1e-9)
    each = rows.withColumn("__t", F.explode(pairs)).join(rare.withColumnRenamed("__t", "__of"), F.col("__t") == F.col("__of")).drop("__of")
    place = F.row_number().over(W.partitionBy(*key).orderBy("__df", "__t"))
    return each.withColumn("__place", place).where(F.col("__place") <= F.size(pairs) - F.greatest(share, F.lit(1)) + 1).drop("__place", "__df")


def blocked_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], stem: str, least: float = config.NAME_OK) -> DataFrame:
    """Pairs within equal blocks: exact stems first; only left rows without an exact partner are compared by likeness.

    Columns of left are prefixed l_, of right r_. score is 1 for exact ones. Distinct stems are compared, each pair once. Of two
    stems of T letters together and a ratio of r, at most (1 - r) * T letters lie outside of what matches, and no more pieces than
    that plus one match, so that they share c = T * (1.5 * r - 1) - 1 pairs of neighbouring letters at least, repeats counted. So only
    stems meet that share one of their rarest pairs, all but c - 1 of them, and of these only those that share c are compared.
    Where c isn't positive, stems are compared with all of the block whose lengths allow the ratio. None is lost.
    """
    ship_package(left.sparkSession)
    a = left.select(*(F.col(c).alias(f"l_{c}") for c in left.columns))
    b = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    on = [F.col(f"l_{c}") == F.col(f"r_{c}") for c in block]
    exact = a.join(b, [*on, F.col(f"l_{stem}") == F.col(f"r_{stem}")]).withColumn("score", F.lit(1.0))
    rest = a.join(exact.select(f"l_{stem}", *(f"l_{c}" for c in block)).distinct(), [f"l_{stem}", *(f"l_{c}" for c in block)], "left_anti").select(*a.columns)
    l, r = f"l_{stem}", f"r_{stem}"
    keys = [f"l_{c}" for c in block]
    mine = rest.select(*keys, l).where(F.col(l).isNotNull()).distinct()
    theirs = b.select(*(F.col(f"r_{c}").alias(f"__{c}") for c in block), r).where(F.col(r).isNotNull()).distinct()
    same = [F.col(f"l_{c}") == F.col(f"__{c}") for c in block]
    # sizes too far apart can't reach the ratio: 2 * min / (sum) bounds it
    x, y = F.char_length(l), F.char_length(r)
    near = 2 * F.least(x, y) >= least * (x + y)
    short = math.floor(1 / (1.5 * least - 1)) if least > 2 / 3 else None
    if short is None:
        pairs = mine.join(theirs, [*same, near])
    else:
        every = _letter_pairs(mine, [*keys, l], l, "__p").unionByName(_letter_pairs(theirs.select(*(F.col(f"__{c}").alias(k) for c, k in zip(block, keys, strict=True)), F.col(r).alias(l)), [*keys, l], l, "__p"))
        rare = every.select(F.explode("__p").alias("__t")).groupBy("__t").agg(F.count(F.lit(1)).alias("__df"))
        few_l = _rarest(_letter_pairs(mine.where(x > short), [*keys, l], l, "__p"), [*keys, l], l, rare, least)
        few_r = _rarest(_letter_pairs(theirs, [*(f"__{c}" for c in block), r], r, "__q"), [*(f"__{c}" for c in block), r], r, rare, least)
        # a pair of letters that very many stems of a block have is met in several tasks
        few_l = few_l.withColumn("__salt", F.pmod(F.xxhash64(l), F.lit(SALTS)).cast("int"))
        few_r = few_r.withColumnRenamed("__t", "__u").withColumn("__turn", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        by_pair = few_l.join(few_r, [*same, F.col("__t") == F.col("__u"), F.col("__salt") == F.col("__turn"), near])
        enough = F.size(F.array_intersect("__p", "__q")) >= (x + y) * (1.5 * least - 1) - 1 - 1e-9
        pairs = by_pair.where(enough).select(*keys, l, r).distinct().unionByName(mine.where(x <= short).join(theirs, [*same, near]).select(*keys, l, r))
    scored = pairs.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(l).alias("__l"), F.col(r).alias("__r")).withColumn("score", ratio(F.col("__l"), F.col("__r"))).where(F.col("score") >= least)
    fuzzy = rest.join(scored, [*(F.col(k) == F.col(f"__{k}") for k in keys), F.col(l) == F.col("__l")]).join(b, [*on, F.col(r) == F.col("__r")])
    return exact.unionByName(fuzzy.select(*exact.columns))


def best_candidate(pairs: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key: the first in the given order."""
    return pairs.withColumn("__place", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("__place = 1").drop("__place")


def resolve_claims(claims: DataFrame, claimed: str, *order: Column) -> tuple[DataFrame, DataFrame]:
    """Each claimed row goes to its best claim; the losers come back as the second frame."""
    placed = claims.withColumn("__place", F.row_number().over(W.partitionBy(claimed).orderBy(*order)))
    return placed.where("__place = 1").drop("__place"), placed.where("__place > 1").drop("__place")


def tier(km: Column, cap_diff: Column, subdistrict: Column, exact: Column, paren: Column) -> Column:
    """A, A-bdy, B, B2, C by what corroborates a match; null if rejected. cap_diff and subdistrict may be null."""
    cap_ok = F.coalesce(cap_diff <= config.CAP_OK, F.lit(False))
    sub_ok = F.coalesce(subdistrict >= config.SUBDISTRICT_OK, F.lit(False))
    none = F.lit(None).cast("string")
    inside = F.when(cap_ok, "A").when(sub_ok, "B").when(exact, "C").otherwise(none)
    return (
        F.when(F.coalesce(paren, F.lit(False)) & ~cap_ok, none)
        .when(km.isNull(), F.when(cap_ok, "B2").otherwise(none))
        .when(km == 0, inside)
        .when((km <= config.NEAR_KM) & cap_ok, "A-bdy")
        .otherwise(none)
    )


def tier_reason(km: Column, cap_diff: Column, paren: Column, found: Column) -> Column:
    """Why a match was rejected; null if it wasn't."""
    cap_ok = F.coalesce(cap_diff <= config.CAP_OK, F.lit(False))
    return (
        F.when(found.isNotNull(), F.lit(None).cast("string"))
        .when(F.coalesce(paren, F.lit(False)) & ~cap_ok, "variant in parentheses, capacity disagrees")
        .when(km.isNull() | (km == 0), "nothing corroborates the match")
        .when(km > config.NEAR_KM, "position contradicts the district")
        .otherwise("near the district's edge, capacity disagrees")
    )


def area_rules(name: Column, index_name: Column, gca: Column, cca: Column, cca2: Column, irrigated: Column, eps: float = 0.01) -> Column:
    """The first rule that a page of areas breaks, else null."""
    from rillflow.functions.text import fold_sounds
    from rillflow.operators.integrity import first_reason

    return first_reason(
        (name.isNull() | (name == ""), "no table"),
        (fold_sounds(name, vowels=True) != fold_sounds(index_name, vowels=True), "table of another name"),
        (gca.isNull() | cca.isNull(), "area missing"),
        ((cca <= 0) | (gca <= 0), "area not positive"),
        (cca > gca, "command exceeds gross area"),
        (F.coalesce(irrigated, F.lit(0.0)) > cca * 1.05, "irrigated exceeds command area"),
        (cca2.isNull(), "only one table has the area"),
        (F.abs(cca - cca2) > eps * F.greatest(cca, F.lit(1.0)), "tables disagree"),
    )


def id_mismatches(rows: DataFrame, names: DataFrame, printed: str, name: str, resolved: str) -> DataFrame:
    """Rows whose printed id isn't the one that their name resolves to, with both; names that resolve to nothing aren't judged."""
    known = names.select(F.col(name).alias("__name"), F.col(resolved).alias("by_name"))
    return rows.join(known, F.col(name) == F.col("__name")).where(~F.col(printed).eqNullSafe(F.col("by_name"))).drop("__name")


def duplicate_tuples(rows: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    """Tuples of values that several rows share (nulls equal), with all their names: every member is suspect."""
    return rows.groupBy(*values).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(name)), ",").alias("names")).where("n > 1")


def assign_in_order(pairs: DataFrame, block: str, left: str, right: str, order: Sequence[str]) -> DataFrame:
    """Sequential assignment within blocks: in `order`, each left row takes its best free right row. Depends on the order,
    so a block is one group: it must be a key of bounded groups (one name key), never a place or a kind of thing."""
    columns = [block, left, right, *[c for c in order if c not in (block, left, right)]]
    kinds = dict(pairs.dtypes)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        taken, given, keep = set(), set(), []
        for row in rows.sort_values(list(order), kind="stable").itertuples():
            a, b = getattr(row, left), getattr(row, right)
            if a not in given and b not in taken:
                given.add(a), taken.add(b), keep.append(row.Index)
        return rows.loc[keep, [block, left, right]]

    ship_package(pairs.sparkSession)
    return pairs.select(*columns).groupBy(block).applyInPandas(walk, f"{block} {kinds[block]}, {left} {kinds[left]}, {right} {kinds[right]}")
