"""Placing entities by a register of points, as one run: candidates by name, distance, corroboration, claims, exclusions.

Each entity ends either placed, with the tier of its evidence, or excluded, with a reason. None is lost between the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rillflow import config
from rillflow.functions import text
from rillflow.operators import integrity, matching, outlines as places
from rillflow.session import written


@dataclass
class Placement:
    """placed: id, source_id, lon, lat, tier, how, score, cap_diff, km, subdistrict_likeness. excluded: id, reason, source_id, km, cap_diff."""

    placed: DataFrame
    excluded: DataFrame


def _named(rows: DataFrame) -> DataFrame:
    split = rows.withColumn("__name", text.split_name(F.col("name")))
    return split.select(*rows.columns, F.col("__name.stem").alias("stem"), F.col("__name.ordinal").alias("ordinal"), F.col("__name.paren").alias("paren"), text.fold_sounds(F.col("__name.stem")).alias("skeleton"))


def candidates(entities: DataFrame, register: DataFrame, least: float) -> DataFrame:
    """(id, source_id, how, score): rows of the register with the same stem and ordinal, or, for entities without any, those
    whose stem or skeleton is alike by `least`, ordinals equal. A letter in parentheses also looks among those without ordinal."""
    a, b = _named(entities), _named(register)
    mine = a.select("id", "stem", "ordinal", "skeleton", "paren")
    theirs = b.select(F.col("id").alias("source_id"), F.col("stem").alias("__stem"), F.col("ordinal").alias("__ordinal"), F.col("skeleton").alias("__skeleton"))
    exact = mine.join(theirs, (F.col("stem") == F.col("__stem")) & (F.col("ordinal") == F.col("__ordinal"))).select("id", "source_id", F.lit("exact").alias("how"), F.lit(1.0).alias("score"))
    if least >= 1:
        return exact
    rest = mine.join(exact.select("id").distinct(), "id", "left_anti")
    looked = rest.unionByName(rest.where("paren").withColumn("ordinal", F.lit("")))
    out = None
    for column in ("stem", "skeleton"):
        left = looked.where(F.col(column) != "").select("id", "ordinal", F.col(column).alias("stem"))
        right = b.where(F.col(column) != "").select(F.col("id").alias("id"), "ordinal", F.col(column).alias("stem"))
        found = matching.blocked_pairs(left, right, ["ordinal"], "stem", least).select(F.col("l_id").alias("id"), F.col("r_id").alias("source_id"), "score")
        out = found if out is None else out.unionByName(found)
    return exact.unionByName(out.groupBy("id", "source_id").agg(F.max("score").alias("score")).select("id", "source_id", F.lit("alike").alias("how"), "score"))


def place(entities: DataFrame, register: DataFrame, shapes: DataFrame, *, box: tuple[float, float, float, float] | None = None, least: float = config.NAME_OK, step: float = places.CELL) -> Placement:
    """Place entities (id, name, parents array, capacity, subdistrict) by a register (id, name, capacity, subdistrict, lon, lat).

    shapes: (name, geometry) of the parents. Rows of the register without a position are no candidates; with `box` (least lon,
    least lat, largest lon, largest lat), one outside of it raises. Of an entity's candidates the best is judged: inside its
    parents first, then by capacity, then by subdistrict, then the least id. Of entities that claim one row the best keeps it.
    """
    located = register.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    if box is not None:
        integrity.require_in_box(located, "id", "lon", "lat", box)
    pairs = written(candidates(entities, located, least), "placement-pairs")
    own = entities.select("id", "parents", F.col("capacity").alias("__c"), F.col("subdistrict").alias("__s"), text.split_name(F.col("name"))["paren"].alias("paren"))
    theirs = located.select(F.col("id").alias("source_id"), "lon", "lat", F.col("capacity").alias("__d"), F.col("subdistrict").alias("__t"))
    full = pairs.join(own, "id").join(theirs, "source_id")
    far = places.km_outside(full, shapes, parents="parents", lon="lon", lat="lat", step=step)
    letters = lambda c: F.regexp_replace(F.lower(c), "[^a-z]", "")
    both = (F.coalesce(F.col("__s"), F.lit("")) != "") & (F.coalesce(F.col("__t"), F.lit("")) != "")
    cap = F.when((F.col("__c") > 0) & (F.col("__d") > 0), F.abs(F.col("__c") - F.col("__d")) / F.greatest("__c", "__d"))
    alike = F.when(both & (letters("__s") == letters("__t")), F.lit(1.0)).when(both, matching.ratio(letters("__s"), letters("__t")))
    judged = far.select("id", "source_id", "how", "score", "lon", "lat", "paren", "km", cap.alias("cap_diff"), alike.alias("subdistrict_likeness"))
    best = matching.best_candidate(judged, "id", F.when(F.col("km") == 0, 0).otherwise(1), F.coalesce("cap_diff", F.lit(9.0)), F.desc(F.coalesce("subdistrict_likeness", F.lit(0.0))), F.col("source_id"))
    tier = matching.tier(F.col("km"), F.col("cap_diff"), F.col("subdistrict_likeness"), F.col("how") == "exact", F.col("paren"))
    told = written(best.withColumn("tier", tier).withColumn("reason", matching.tier_reason(F.col("km"), F.col("cap_diff"), F.col("paren"), F.col("tier"))), "placement-judged")
    kept, lost = matching.resolve_claims(told.where("tier is not null"), "source_id", F.coalesce("cap_diff", F.lit(1e9)), F.desc(F.coalesce("subdistrict_likeness", F.lit(0.0))), F.col("id"))
    why = ["id", "reason", "source_id", "km", "cap_diff"]
    none = entities.select("id").join(told.select("id"), "id", "left_anti").select("id", F.lit("no row of the register found").alias("reason"))
    excluded = told.where("tier is null").select(*why).unionByName(lost.withColumn("reason", F.lit("another has the better claim to its row")).select(*why)).unionByName(none, allowMissingColumns=True)
    return Placement(kept.select("id", "source_id", "lon", "lat", "tier", "how", "score", "cap_diff", "km", "subdistrict_likeness"), excluded)
