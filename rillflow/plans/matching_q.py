"""Queries: cleaning, vocabularies, matching, the composite index, layouts, geometry and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.functions import numeric, text
from rillflow.operators import composite, geo, integrity, matching, model, order
from rillflow.plans.facts import FACT, fact
from rillflow.session import work_dir
from rillflow.sources import daily as sources, layouts
from rillflow.sources.tables import table
from rillflow.streaming import daily

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii")


def vocab_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels cut short, wrapped and misspelt, repaired where one word of the vocabulary fits."""
    text.check_prefix_free(PRIORITIES)
    p = F.col("o_orderpriority")
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, p).when(k == 1, F.substring(p, 1, 4)).when(k == 2, F.concat(F.substring(p, 1, 3), F.lit("\n"), F.expr("substring(o_orderpriority, 4)"))).when(k == 3, F.lit("9-NONE")).otherwise(F.lit(None).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.repair_label(raw, PRIORITIES).alias("r")).select("o_orderkey", "r.value", "r.known", "r.repaired")


def cell_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures with thousands' commas, wraps, percent signs and null tokens, read back."""
    cents = (F.col("o_totalprice") * 100).cast("decimal(18,0)")
    whole, part = F.floor(cents / 100).cast("long"), (cents % 100).cast("int")
    k = F.col("o_orderkey") % 4
    cell = F.when(k == 0, F.concat(F.format_number(whole, 0), F.lit("."), F.lpad(part.cast("string"), 2, "0"))).when(k == 1, F.concat(F.substring(whole.cast("string"), 1, 2), F.lit("\n"), F.expr("substring(cast(o_orderkey as string), 1, 2)"), F.lit("%"))).when(k == 2, F.lit(" NIL ")).otherwise(F.lit("abc"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.to_number(text.clean_number(cell)).alias("v"))


def split_name_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stem, ordinal and skeleton of names in a numbered series."""
    numeral = F.element_at(F.array(*map(F.lit, ROMAN)), (F.col("p_size") % 7 + 1).cast("int"))
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.initcap("p_name"), F.lit(" Dam-"), F.upper(numeral))).otherwise(F.concat(F.upper("p_name"), F.lit(" (b)")))
    parts = table(spark, sf_dir, "part").select("p_partkey", text.split_name(name).alias("s"))
    return parts.select("p_partkey", "s.stem", "s.ordinal", "s.paren", text.fold_sounds(F.col("s.stem")).alias("skeleton"))


def dms_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees, minutes, seconds; sixty carries, more is unreadable."""
    k = F.col("c_custkey")
    line = F.format_string("%d° %d' %d\"", k % 180, k % 63, (k * 7) % 62)
    return table(spark, sf_dir, "customer").select("c_custkey", text.dms_to_degrees(line).alias("degrees"))


def ordinal_block_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers of one number and nation."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.regexp_extract("s_name", r"#0*(\d+)$", 1).alias("k"), F.col("s_nationkey").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.regexp_extract("c_name", r"#0*(\d+)$", 1).alias("k"), (F.col("c_nationkey") % 3).alias("m"))
    return s.withColumn("m", F.col("n") % 3).join(c, ["k", "m"]).select("s_suppkey", "c_custkey")


def one_to_one_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part goes to its best supplier; losers are listed beside."""
    claims = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_extendedprice").alias("price"))
    kept, lost = matching.resolve_claims(claims, "l_partkey", F.desc("price"), F.col("l_suppkey"))
    return kept.withColumn("won", F.lit(True)).unionByName(lost.withColumn("won", F.lit(False)))


def best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's best part by a lexicographic rank."""
    pairs = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_orderkey", "l_linenumber")
    return matching.best_candidate(pairs, "l_suppkey", F.desc("l_quantity"), F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")).select("l_suppkey", "l_partkey", "l_quantity")


def ambiguous_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stand for one part only."""
    parts = table(spark, sf_dir, "part").select("p_partkey", text.squash(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))).alias("name"))
    return model.ambiguous_keys_dropped(parts, "name", "p_partkey")


def duplicate_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of values that several parts share."""
    parts = table(spark, sf_dir, "part").withColumn("name", F.col("p_partkey").cast("string"))
    return matching.duplicate_tuples(parts, ["p_name", "p_type", "p_size"], "name")


def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelt part names matched within their brand by likeness."""
    parts = table(spark, sf_dir, "part").select("p_brand", F.regexp_replace("p_name", " ", "").alias("stem")).distinct()
    left = parts.withColumn("stem", F.when(F.length("stem") % 2 == 0, F.regexp_replace("stem", "^(.)(.)", "$2$1")).otherwise(F.col("stem")))
    return matching.blocked_pairs(left, parts, ["p_brand"], "stem", 0.8)


def sequential_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers take parts of a block of five parts in order, each part once. A block's size doesn't grow with the table."""
    pairs = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_partkey") / 5).alias("block"), F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), "l_quantity").distinct()
    return matching.assign_in_order(pairs, "block", "a", "b", ["l_quantity", "a", "b"])


def match_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier of each customer's match by distance, capacity and sub-district evidence."""
    k = F.col("c_custkey")
    km = F.when(k % 7 != 0, F.greatest((k % 12 - 3).cast("double"), F.lit(0.0)))
    cap, sub, paren = F.when(k % 5 != 0, (k % 40) / 100.0), (k % 100) / 100.0, k % 11 == 0
    rows = table(spark, sf_dir, "customer").select("c_custkey", km.alias("km"), cap.alias("cap"), sub.alias("sub"), (k % 2 == 0).alias("exact"), paren.alias("paren"))
    tier = matching.tier(F.col("km"), F.col("cap"), F.col("sub"), F.col("exact"), F.col("paren"))
    return rows.select("c_custkey", tier.alias("tier"), matching.tier_reason(F.col("km"), F.col("cap"), F.col("paren"), tier).alias("reason"))


def area_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that a row of areas breaks."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    gca, cca = F.when(k % 13 != 0, F.col("p_retailprice")), F.when(k % 17 == 0, F.lit(0.0)).otherwise(F.col("p_size") * 30.0)
    name = F.when(k % 19 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit("other")).otherwise(F.upper("p_name"))
    second = F.when(k % 29 != 0, cca + F.when(k % 31 == 0, cca * 0.02 + 1).otherwise(F.lit(0.0)))
    return p.select("p_partkey", matching.area_rules(name, F.col("p_name"), gca, cca, second, F.when(k % 37 == 0, cca * 2)).alias("reason"))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as units: five sources, an aggregate, a rest, an area."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    o = table(spark, sf_dir, "orders")
    counts = o.groupBy("o_custkey").agg(*(F.count_if(F.col("o_orderpriority") == p).alias(f"s{k}") for k, p in enumerate(PRIORITIES)), F.count_if(F.col("o_orderstatus") == "F").alias("rest"), F.count_if(F.col("o_orderstatus") != "F").alias("irr"))
    return c.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


_UNITS = """u AS (SELECT c_custkey, c_nationkey, c_acctbal, s0, s1, s2, s3, s4, rest, irr FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS s0, count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS s1, count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS s2,
  count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS s3, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS s4, count(*) FILTER (WHERE o_orderstatus = 'F') AS rest, count(*) FILTER (WHERE o_orderstatus <> 'F') AS irr FROM orders GROUP BY 1) x ON o_custkey = c_custkey)"""


def micro(x):
    """Millionths as a whole number: logarithms may differ in their last bits between engines."""
    return F.floor(x * 1e6 + 0.5).cast("long")


def diversity_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy and dominance of a customer's sources; undefined without any."""
    s = [F.col(f"s{k}").cast("double") for k in range(5)]
    return _units(spark, sf_dir).select("c_custkey", micro(numeric.entropy(s)).alias("entropy_micro"), numeric.dominance(s).alias("dominance"))


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.components(_units(spark, sf_dir), "c_custkey", "c_nationkey", [f"s{k}" for k in range(5)], "irr", "rest", "c_acctbal", (3, 7))


def composite_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and index; the source mix is withheld in two groups."""
    c = _components(spark, sf_dir)
    return c.select("c_custkey", "c_diversity", micro(F.col("c_source")).alias("source_micro"), "c_size", micro(composite.index_of()).alias("index_micro"))


def index_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a unit has no index, whether its figures are consistent, and whether it is in the top decile of its group."""
    c = _components(spark, sf_dir).withColumn("index", composite.index_of())
    kind = composite.status(F.col("index"), F.col("c_source"), F.col("c_diversity"), F.col("c_nationkey").isin(3, 7), F.col("irr").isNull())
    mask = composite.integrity_mask((F.col("irr") + F.col("rest")), F.col("irr"), F.col("rest"), F.col("c_acctbal"))
    told = c.select("c_custkey", "c_nationkey", "c_size", kind.alias("status"), mask.alias("integrity_fail"))
    return composite.top_decile(told, "c_custkey", ["c_nationkey"], "c_size", F.col("c_nationkey") < 20).select("c_custkey", "status", "integrity_fail", "top")


def pct_rank_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent rank with averaged ties, nulls kept."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.floor("value")).alias("v"))
    return order.percent_ranks(e, ["user_id"], "v", "rank", "event_id").select("event_id", "rank")


def verdict_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict per nation from one aggregation and exact quartiles."""
    u = _units(spark, sf_dir).withColumn("p", F.when(F.col("irr") + F.col("rest") > 0, F.col("rest") / (F.col("irr") + F.col("rest"))))
    a = u.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count("p").alias("n_defined"), (F.count_if(F.col("p") >= 0.95) / F.count("p")).alias("single"), (F.count_if(F.col("s0") > 3) / F.count(F.lit(1))).alias("failing"))
    q = order.quantiles(u, ["c_nationkey"], "p", {"low": 0.25, "high": 0.75})
    return a.join(q, "c_nationkey", "left").select("c_nationkey", "n", composite.verdict(F.col("n"), F.col("n_defined"), F.col("failing"), F.col("high") - F.col("low"), F.col("single"), 5).alias("verdict"))


def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank correlation of two components."""
    return composite.spearman(_components(spark, sf_dir), "c_diversity", "c_size").select(micro(F.col("spearman")).alias("spearman_micro"), "n")


SCHEMES = {"equal": {"diversity": 1 / 3, "source": 1 / 3, "size": 1 / 3}, "mechanism_only": {"diversity": 1.0}, "mechanism_heavy": {"diversity": 0.7, "source": 0.2, "size": 0.1}, "drop_size": {"diversity": 0.6, "source": 0.4}, "restore_c3": {"diversity": 0.5, "source": 0.25, "constraint": 0.15, "size": 0.1}}


def index_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternative weightings against the base.

    The component that only restore_c3 weighs has a stand-in: one source's share times the part of 24 hours that the group,
    by its number, is without supply; unknown without any source.
    """
    share = F.col("s4") / F.nullif(sum((F.col(f"s{k}") for k in range(1, 5)), F.col("s0")), F.lit(0))
    c = _components(spark, sf_dir).withColumn("c_constraint", share * (1 - F.least(F.col("c_nationkey"), F.lit(24)) / 24))
    found = composite.sensitivity(c, "c_custkey", SCHEMES)
    return found.select("scheme", micro(F.col("spearman")).alias("spearman_micro"), micro(F.col("decile_churn")).alias("churn_micro"))


def crosswalk_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A primary parent and a comma list of others, one row each."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.concat_ws(", ", F.col("p_type"), F.lit(""), F.regexp_replace("p_name", " ", ","), F.col("p_brand")).alias("others"))
    return parts.select("p_partkey", F.explode(geo.parents(F.col("p_brand"), F.col("others"))).alias("parent"))


def band_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether exactly one flagged band holds the value; nothing flagged goes with zero; null for null."""
    bands = ((0, 25), (25, 50), (50, 75), (75, 100))
    v = F.when(F.col("event_type") != "error", F.col("value"))
    flag = (F.floor("value") % 5).cast("int")
    return table(spark, sf_dir, "events").select("event_id", numeric.band_holds(v, [(lo, hi, flag == k) for k, (lo, hi) in enumerate(bands)]).alias("ok"))


def rejected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every broken rule of every row, one row each: the side output that nothing is dropped into."""
    why = integrity.reasons((F.col("l_quantity") > 45, "large"), (F.col("l_discount") == 0, "no discount"), (F.col("l_returnflag") == "R", "returned"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.explode(why).alias("reason"))


def outside_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside a closed vocabulary."""
    return integrity.outside_vocabulary(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES[:2])


def layout_by_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of cells of two layouts in one frame."""
    n = table(spark, sf_dir, "nation")
    cells = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.col("n_nationkey").cast("string"), F.col("n_name"))).otherwise(F.array(F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string"), F.col("n_name")))
    known, _ = layouts.by_width(n.select(cells.alias("cells")), "cells", {2: ("key", "name"), 3: ("key", "region", "name")})
    return known


def grid_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names taken apart into placed characters and put together again by the ruled grid."""
    n = table(spark, sf_dir, "nation")
    chars = n.select("n_regionkey", "n_nationkey", F.posexplode(F.split("n_name", "")).alias("at", "char"))
    x = (F.col("n_nationkey") % 5) * 100.0 + F.col("at") * 3
    y = F.floor(F.col("n_nationkey") / 5) * 20.0
    placed = chars.select(F.lit(1).alias("page"), x.alias("x0"), (x + 2).alias("x1"), y.alias("top"), (y + 8).alias("bottom"), "char")
    return layouts.reassemble(placed, "page", [0, 100, 200, 300, 400, 500], [0, 20, 40, 60, 80, 100]).select("row", "col", "cell")


def headed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines below headings, each with its last heading."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    part = n.groupBy("r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: F.concat(s["n_nationkey"].cast("string"), F.lit(" "), s["n_name"])), "\n").alias("lines"))
    page = part.agg(F.lit(1).alias("page"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_name", "lines"))), lambda s: F.concat(F.lit("Region: "), s["r_name"], F.lit("\n"), s["lines"])), "\n").alias("text"))
    out = layouts.headed_lines(page, "page", "text", r"^Region: (.*)$", r"^(\d+) (.*)$")
    return out.select("owner", "number", "rest")


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages, each target once."""
    return layouts.links(table(spark, sf_dir, "pages"), "page_id", "html")


def html_leaf_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of innermost tables, of pages made of parts: a frame with one table of names and one of sizes in its cells, written
    as carelessly as pages are."""
    p = table(spark, sf_dir, "part")
    row = lambda a, b: F.concat(F.lit("<TR><td>"), a, F.lit("\n<td class='x'> "), b, F.lit("</tr>"))
    one = F.concat(F.lit("<table>"), row(F.col("p_name"), F.col("p_brand")), F.lit("</table>"))
    two = F.concat(F.lit("<TABLE border=1><tr><th>size</th></tr>"), row(F.col("p_size").cast("string"), F.lit("")), F.lit("</TABLE>"))
    html = F.concat(F.lit("<html><body><table><tr><td>outer "), one, F.lit("</td><td>"), two, F.lit("</td></tr></table></body>"))
    found = layouts.table_rows(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")), "page_id", "html")
    return found.select("page_id", "table_no", "row_no", F.array_join("cells", "|").alias("cells"))


def geo_distance_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metres from customers' points to their nation's outline: a square with a square hole, read from GeoJSON features."""
    n = table(spark, sf_dir, "nation")
    west, south = F.col("n_nationkey") % 5 * 10.0, F.floor(F.col("n_nationkey") / 5) * 10.0
    square = lambda lo, hi: F.array(*(F.array(west + x, south + y) for x, y in ((lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo))))
    features = n.select(F.struct("n_name").alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(square(0.0, 8.0), square(3.0, 6.0)).alias("coordinates")).alias("geometry"))
    km = geo.distance_function(spark, geo.outlines_of(features, "n_name"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    lon, lat = west + F.col("c_custkey") % 10, south + F.col("c_custkey") % 9
    return c.select("c_custkey", F.round(km(F.col("n_name"), lon, lat) * 1000, 0).cast("long").alias("metres"))


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir.rstrip('/')}/events*.parquet")


def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts by kind from a stream in complete mode: the same rows as a batch."""
    return daily.landed(daily.daily_counts(_events_stream(spark, sf_dir), "ts", "1 day", "event_type"), f"{work_dir(spark)}/daily-{uuid.uuid4().hex}", "complete")


def stream_daily_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once from a stream that repeats all of them."""
    events = _events_stream(spark, sf_dir).select("event_id", "ts", "user_id")
    return daily.landed(daily.first_seen(events.unionByName(events), "ts", "40 days", "event_id"), f"{work_dir(spark)}/dedup-{uuid.uuid4().hex}").select("event_id", "user_id")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, closed by six hours without an event, from a stream in complete mode."""
    found = daily.sessions(_events_stream(spark, sf_dir).where("ts is not null"), "ts", "6 hours", "1 day", "user_id")
    return daily.landed(found, f"{work_dir(spark)}/sessions-{uuid.uuid4().hex}", "complete").select("user_id", F.unix_micros("started").alias("started_micros"), "n")


def first_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each user and kind, the least in all columns: the batch form of de-duplication."""
    return daily.distinct_keys(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"])


def row_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by their first cell: numbered ones are kept, the others go aside with the reason."""
    k = F.col("p_partkey") % 5
    first = F.when(k == 0, F.lit("Sr. No")).when(k == 1, F.lit(None).cast("string")).when(k == 2, F.lit("--")).otherwise(F.concat(F.lit(" "), F.col("p_partkey").cast("string")))
    good, rest = layouts.valid_rows(table(spark, sf_dir, "part").select("p_partkey", first.alias("cell")), "cell")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(rest).select("p_partkey", "reason")


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches split by a gate: accepted and rejected rows by kind; none is lost."""
    path = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        ok = F.coalesce(F.col("value") >= 10, F.lit(False))
        return batch.where(ok), batch.where(~ok)

    def count(kind: str):
        # a folder for each kind and batch: a batch that is tried again replaces its own rows
        return lambda part, number: part.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/out/kind={kind}/batch={number}")

    daily.gated(_events_stream(spark, sf_dir), split, count("accepted"), count("rejected"), f"{path}/checkpoint").awaitTermination()
    if not sources.exists(spark, f"{path}/out"):
        return spark.createDataFrame([], "kind string, event_type string, n long")
    return spark.read.schema("event_type string, n long, kind string, batch long").parquet(f"{path}/out").groupBy("kind", "event_type").agg(F.sum("n").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        vocab_repair, cell_clean, split_name_fold, dms_parse, ordinal_block_match, one_to_one_claims, best_candidates, ambiguous_name_join, duplicate_triples, fuzzy_match, sequential_assignment, match_tiers, area_rules, diversity_entropy, composite_index, index_status, pct_rank_avg,
        verdict_ladder, spearman, index_sensitivity, crosswalk_explode, band_consistency, rejected_fields, outside_vocabulary, layout_by_width, grid_reassembly, headed_lines, html_links, html_leaf_tables, geo_distance_tiers, stream_sessions, first_of_key, row_validity, stream_daily_counts, stream_daily_dedup, stream_gate,
    )
}


def _fold_sql(x: str) -> str:
    from rillflow.functions.names import SOUNDS

    for a, b in SOUNDS:
        x = f"replace({x}, '{a}', '{b}')"
    for c in "abcdefghijklmnopqrstuvwxyz":
        x = f"regexp_replace({x}, '{c}+', '{c}', 'g')"
    return f"regexp_replace({x}, '[aeiou]', '', 'g')"


_P = "CASE WHEN irr + rest > 0 THEN CAST(rest AS DOUBLE) / CAST(irr + rest AS DOUBLE) END"
_TOTAL = "CAST(s0 + s1 + s2 + s3 + s4 AS DOUBLE)"
_H = "-(" + " + ".join(f"CASE WHEN s{k} > 0 THEN s{k} / {_TOTAL} * ln(s{k} / {_TOTAL}) ELSE 0 END" for k in range(5)) + ")"
_RANK = "CASE WHEN {v} IS NOT NULL THEN (rank() OVER (PARTITION BY {p} ({v} IS NULL) ORDER BY {v}) + (count(*) OVER (PARTITION BY {p} {v}) - 1) / CAST(2.0 AS DOUBLE)) / count(*) OVER (PARTITION BY {p} ({v} IS NULL)) END"
_COMP = f"""{_UNITS}, comp AS (SELECT *, CASE WHEN irr + rest > 0 THEN 4 * ({_P}) * (1 - ({_P})) END AS c_diversity, CASE WHEN c_nationkey IN (3, 7) OR s0 IS NULL THEN NULL WHEN {_TOTAL} > 0 THEN {_H} / ln(5) ELSE 0 END AS c_source, {_RANK.format(v='c_acctbal', p='c_nationkey,')} AS c_size FROM u)"""
_INDEX = "(CAST(0.5 AS DOUBLE) * c_diversity + CAST(0.35 AS DOUBLE) * c_source + CAST(0.15 AS DOUBLE) * c_size)"
_LINK = r"""(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""
ORACLES = {
    "vocab_repair": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderpriority WHEN 1 THEN o_orderpriority WHEN 2 THEN o_orderpriority WHEN 3 THEN '9-NONE' END AS value, o_orderkey % 5 <= 2 AS known, o_orderkey % 5 = 1 AND length(replace(o_orderpriority, ' ', '')) > 4 AS repaired FROM orders",
    "cell_clean": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN CAST(substr(CAST(CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) AS VARCHAR), 1, 2) || substr(CAST(o_orderkey AS VARCHAR), 1, 2) AS DOUBLE) END AS v FROM orders",
    "split_name_fold": f"WITH s AS (SELECT p_partkey, replace(p_name, ' ', '') AS stem, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size % 7 + 1 AS VARCHAR) ELSE 'b' END AS ordinal, p_partkey % 2 = 1 AS paren FROM part) SELECT *, {_fold_sql('stem')} AS skeleton FROM s",
    "dms_parse": "WITH x AS (SELECT c_custkey, CAST(c_custkey % 180 AS DOUBLE) AS d, CAST(c_custkey % 63 AS DOUBLE) AS m, CAST((c_custkey * 7) % 62 AS DOUBLE) AS s FROM customer), y AS (SELECT *, m + CASE WHEN s = 60 THEN 1 ELSE 0 END AS mm, CASE WHEN s = 60 THEN 0 ELSE s END AS ss FROM x) SELECT c_custkey, CASE WHEN m <= 60 AND s <= 60 AND mm <= 60 THEN round(d + mm / 60 + ss / 3600, 6) END AS degrees FROM y",
    "ordinal_block_match": "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON c_custkey = s_suppkey AND c_nationkey % 3 = s_nationkey % 3",
    "one_to_one_claims": "WITH c AS (SELECT l_partkey, l_suppkey, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2) SELECT l_partkey, l_suppkey, price, row_number() OVER (PARTITION BY l_partkey ORDER BY price DESC, l_suppkey) = 1 AS won FROM c",
    "best_candidates": "SELECT l_suppkey, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey, l_orderkey, l_linenumber) AS k FROM lineitem) z WHERE k = 1",
    "ambiguous_name_join": "WITH n AS (SELECT lower(replace(p_name || p_brand || p_type || CAST(p_size AS VARCHAR), ' ', '')) AS name, p_partkey FROM part) SELECT name, min(p_partkey) AS p_partkey FROM n GROUP BY name HAVING count(DISTINCT p_partkey) = 1",
    "duplicate_triples": "SELECT p_name, p_type, p_size, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY CAST(p_partkey AS VARCHAR)) AS names FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1",
    "match_tiers": """WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN greatest(CAST(c_custkey % 12 - 3 AS DOUBLE), 0) END AS km, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 40 AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS cap, CAST(c_custkey % 100 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS sub, c_custkey % 2 = 0 AS ex, c_custkey % 11 = 0 AS paren FROM customer),
 y AS (SELECT *, COALESCE(cap <= CAST(0.10 AS DOUBLE), FALSE) AS cok, COALESCE(sub >= CAST(0.85 AS DOUBLE), FALSE) AS sok FROM x),
 z AS (SELECT *, CASE WHEN paren AND NOT cok THEN NULL WHEN km IS NULL THEN CASE WHEN cok THEN 'B2' END WHEN km = 0 THEN CASE WHEN cok THEN 'A' WHEN sok THEN 'B' WHEN ex THEN 'C' END WHEN km <= 7 AND cok THEN 'A-bdy' END AS tier FROM y)
 SELECT c_custkey, tier, CASE WHEN tier IS NOT NULL THEN NULL WHEN paren AND NOT cok THEN 'variant in parentheses, capacity disagrees' WHEN km IS NULL OR km = 0 THEN 'nothing corroborates the match' WHEN km > 7 THEN 'position contradicts the district' ELSE 'near the district''s edge, capacity disagrees' END AS reason FROM z""",
    "area_rules": """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_retailprice END AS gca, CASE WHEN p_partkey % 17 = 0 THEN CAST(0 AS DOUBLE) ELSE p_size * CAST(30 AS DOUBLE) END AS cca FROM part), y AS (SELECT *, CASE WHEN p_partkey % 29 <> 0 THEN cca + CASE WHEN p_partkey % 31 = 0 THEN cca * CAST(0.02 AS DOUBLE) + 1 ELSE 0 END END AS c2, CASE WHEN p_partkey % 37 = 0 THEN cca * 2 ELSE 0 END AS irr FROM x)
 SELECT p_partkey, CASE WHEN p_partkey % 19 = 0 THEN 'no table' WHEN p_partkey % 23 = 0 THEN 'table of another name' WHEN gca IS NULL OR cca IS NULL THEN 'area missing' WHEN cca <= 0 OR gca <= 0 THEN 'area not positive' WHEN cca > gca THEN 'command exceeds gross area' WHEN irr > cca * CAST(1.05 AS DOUBLE) THEN 'irrigated exceeds command area' WHEN c2 IS NULL THEN 'only one table has the area' WHEN abs(cca - c2) > CAST(0.01 AS DOUBLE) * greatest(cca, 1) THEN 'tables disagree' END AS reason FROM y""",
    "diversity_entropy": f"WITH {_UNITS} SELECT c_custkey, CASE WHEN {_TOTAL} > 0 THEN CAST(floor(({_H}) * 1e6 + 0.5) AS BIGINT) END AS entropy_micro, CASE WHEN {_TOTAL} > 0 THEN greatest(s0, s1, s2, s3, s4) / {_TOTAL} END AS dominance FROM u",
    "composite_index": f"WITH {_COMP} SELECT c_custkey, c_diversity, CAST(floor(c_source * 1e6 + 0.5) AS BIGINT) AS source_micro, c_size, CAST(floor({_INDEX} * 1e6 + 0.5) AS BIGINT) AS index_micro FROM comp",
    "index_status": f"""WITH {_COMP}, r AS (SELECT *, {_RANK.format(v='c_size', p='c_nationkey,')} AS rk FROM comp) SELECT c_custkey, CASE WHEN {_INDEX} IS NOT NULL THEN 'issued' WHEN irr IS NULL THEN 'no_land_use_data' WHEN c_diversity IS NULL THEN 'no_mechanism_component' WHEN c_source IS NULL AND c_nationkey IN (3, 7) THEN 'withheld_source_data_unreliable' ELSE 'issued' END AS status,
 COALESCE(irr + rest = 0, FALSE) OR irr IS NULL OR rest IS NULL OR COALESCE(c_acctbal = 0, FALSE) OR COALESCE(irr > c_acctbal, FALSE) OR COALESCE(irr + rest > c_acctbal, FALSE) AS integrity_fail, CASE WHEN c_nationkey < 20 AND c_size IS NOT NULL THEN CASE WHEN rk >= CAST(0.9 AS DOUBLE) THEN 1 ELSE 0 END END AS top FROM r""",
    "pct_rank_avg": f"WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN floor(value) END AS v FROM events) SELECT event_id, {_RANK.format(v='v', p='user_id,')} AS rank FROM e",
    "verdict_ladder": f"""WITH {_UNITS}, a AS (SELECT c_nationkey, count(*) AS n, count({_P}) AS nd, quantile_cont({_P}, 0.75) - quantile_cont({_P}, 0.25) AS iqr, CAST(count(*) FILTER (WHERE {_P} >= CAST(0.95 AS DOUBLE)) AS DOUBLE) / nullif(count({_P}), 0) AS single, CAST(count(*) FILTER (WHERE s0 > 3) AS DOUBLE) / count(*) AS failing FROM u GROUP BY 1)
 SELECT c_nationkey, n, CASE WHEN n < 5 THEN 'TOO FEW ROWS' WHEN nd = 0 THEN 'NO DATA' WHEN failing > CAST(0.05 AS DOUBLE) THEN 'SOURCE DATA UNRELIABLE' WHEN iqr < CAST(0.05 AS DOUBLE) THEN 'MECHANISM ABSENT' WHEN iqr < CAST(0.15 AS DOUBLE) THEN 'MECHANISM WEAK' WHEN single > CAST(0.7 AS DOUBLE) THEN 'FAILS' ELSE 'PASSES' END AS verdict FROM a""",
    "spearman": f"WITH {_COMP}, b AS (SELECT c_diversity AS a, c_size AS b FROM comp WHERE c_diversity IS NOT NULL AND c_size IS NOT NULL), r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / CAST(2.0 AS DOUBLE) AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / CAST(2.0 AS DOUBLE) AS rb FROM b) SELECT CAST(floor(corr(ra, rb) * 1e6 + 0.5) AS BIGINT) AS spearman_micro, count(*) AS n FROM r",
    "crosswalk_explode": "WITH x AS (SELECT p_partkey, p_brand AS parent FROM part UNION SELECT p_partkey, p_type FROM part UNION SELECT p_partkey, unnest(string_split(p_name, ' ')) FROM part) SELECT p_partkey, parent FROM x WHERE parent <> ''",
    "band_consistency": "WITH b AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v, CAST(floor(value) AS INT) % 5 AS f FROM events) SELECT event_id, CASE WHEN v IS NULL THEN NULL WHEN f = 4 THEN v = 0 WHEN f = 0 THEN v <= 25 ELSE v > f * 25 AND v <= f * 25 + 25 END AS ok FROM b",
    "rejected_fields": "SELECT l_orderkey, l_linenumber, 'large' AS reason FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT l_orderkey, l_linenumber, 'no discount' FROM lineitem WHERE l_discount = 0 UNION ALL SELECT l_orderkey, l_linenumber, 'returned' FROM lineitem WHERE l_returnflag = 'R'",
    "outside_vocabulary": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR o_orderpriority IS NULL GROUP BY 1",
    "layout_by_width": "SELECT CAST(n_nationkey AS VARCHAR) AS key, CASE WHEN n_nationkey % 2 = 1 THEN CAST(n_regionkey AS VARCHAR) END AS region, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 3 END AS source_layout FROM nation",
    "grid_reassembly": "SELECT CAST(n_nationkey // 5 AS INT) AS row, CAST(n_nationkey % 5 AS INT) AS col, n_name AS cell FROM nation",
    "headed_lines": "SELECT r_name AS owner, CAST(n_nationkey AS VARCHAR) AS number, n_name AS rest FROM nation JOIN region ON r_regionkey = n_regionkey",
    "html_links": f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS href, unnest(regexp_extract_all(html, '{_LINK}', 2)) AS label, unnest(generate_series(1, len(regexp_extract_all(html, '{_LINK}', 1)))) AS pos FROM pages), k AS (SELECT *, row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS r FROM l)
 SELECT page_id, href, trim(regexp_replace(regexp_replace(label, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS label FROM k WHERE r = 1""",
    "sequential_assignment": """WITH RECURSIVE p AS (SELECT DISTINCT l_partkey // 5 AS block, l_suppkey AS a, l_partkey AS b, l_quantity FROM lineitem),
 o AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY l_quantity, a, b) AS k FROM p),
 r AS (SELECT DISTINCT block, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS ga, CAST([] AS BIGINT[]) AS gb, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b FROM p
   UNION ALL SELECT o.block, o.k, CASE WHEN list_contains(r.ga, o.a) OR list_contains(r.gb, o.b) THEN r.ga ELSE list_append(r.ga, o.a) END, CASE WHEN list_contains(r.ga, o.a) OR list_contains(r.gb, o.b) THEN r.gb ELSE list_append(r.gb, o.b) END,
     CASE WHEN list_contains(r.ga, o.a) OR list_contains(r.gb, o.b) THEN NULL ELSE o.a END, o.b FROM r JOIN o ON o.block = r.block AND o.k = r.k + 1)
 SELECT block, a, b FROM r WHERE a IS NOT NULL""",
    "html_leaf_tables": "SELECT p_partkey AS page_id, 0 AS table_no, 0 AS row_no, p_name || '|' || p_brand AS cells FROM part UNION ALL SELECT p_partkey, 1, 0, 'size' FROM part UNION ALL SELECT p_partkey, 1, 1, CAST(p_size AS VARCHAR) || '|' FROM part",
    "geo_distance_tiers": """WITH c AS (SELECT c_custkey, CAST(c_custkey % 10 AS DOUBLE) AS x, CAST(c_custkey % 9 AS DOUBLE) AS y, (n_nationkey // 5) * 10 + c_custkey % 9 AS lat FROM customer JOIN nation ON n_nationkey = c_nationkey),
 k AS (SELECT *, 111.32 * cos(radians(lat)) AS kx, 110.57 AS ky FROM c)
 SELECT c_custkey, CAST(round(1000 * CASE WHEN x > 8 THEN sqrt(((x - 8) * kx) ** 2 + (greatest(y - 8, 0) * ky) ** 2) WHEN x > 3 AND x < 6 AND y > 3 AND y < 6 THEN least((x - 3) * kx, (6 - x) * kx, (y - 3) * ky, (6 - y) * ky) ELSE 0 END) AS BIGINT) AS metres FROM k""",
    "index_sensitivity": f"""WITH {_COMP}, cc AS (SELECT *, CASE WHEN {_TOTAL} <> 0 THEN s4 / {_TOTAL} * (1 - least(c_nationkey, 24) / CAST(24 AS DOUBLE)) END AS c_constraint FROM comp),
 b AS (SELECT c_custkey, {_INDEX} AS base, c_diversity AS d, c_source AS s, c_size AS z, c_constraint AS k FROM cc),
 l AS (SELECT 'equal' AS scheme, base, (d + s + z) / 3 AS alt FROM b UNION ALL SELECT 'mechanism_only', base, d FROM b UNION ALL SELECT 'mechanism_heavy', base, CAST(0.7 AS DOUBLE) * d + CAST(0.2 AS DOUBLE) * s + CAST(0.1 AS DOUBLE) * z FROM b
   UNION ALL SELECT 'drop_size', base, CAST(0.6 AS DOUBLE) * d + CAST(0.4 AS DOUBLE) * s FROM b UNION ALL SELECT 'restore_c3', base, CAST(0.5 AS DOUBLE) * d + CAST(0.25 AS DOUBLE) * s + CAST(0.15 AS DOUBLE) * k + CAST(0.1 AS DOUBLE) * z FROM b),
 m AS (SELECT scheme, round(base, 12) AS base, round(alt, 12) AS alt FROM l WHERE base IS NOT NULL AND alt IS NOT NULL),
 r AS (SELECT scheme, {_RANK.format(v='base', p='scheme,')} AS rb, {_RANK.format(v='alt', p='scheme,')} AS ra FROM m)
 SELECT scheme, CAST(floor(corr(rb, ra) * 1e6 + 0.5) AS BIGINT) AS spearman_micro, CAST(floor(CAST(count(*) FILTER (WHERE rb >= CAST(0.9 AS DOUBLE) AND ra < CAST(0.9 AS DOUBLE)) AS DOUBLE) / nullif(count(*) FILTER (WHERE rb >= CAST(0.9 AS DOUBLE)), 0) * 1e6 + 0.5) AS BIGINT) AS churn_micro FROM r GROUP BY scheme""",
    "stream_sessions": """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events WHERE ts IS NOT NULL), s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
 SELECT user_id, epoch_us(min(ts)) AS started_micros, count(*) AS n FROM s GROUP BY user_id, k""",
    "first_of_key": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) z WHERE k = 1",
    "row_validity": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'header' WHEN 1 THEN 'no first cell' WHEN 2 THEN 'not a number' END AS reason FROM part",
    "stream_daily_counts": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_daily_dedup": "SELECT event_id, user_id FROM events",
    "stream_gate": "SELECT CASE WHEN value >= 10 THEN 'accepted' ELSE 'rejected' END AS kind, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
