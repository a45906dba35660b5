"""Sharding by Hilbert-curve order, with DataFrame functions only.

Several metadata dimensions are quantised to a few bits each, rows are sorted by their index along a Hilbert curve, and
the sorted rows are cut into runs of equal count. Rows near each other in all dimensions lie in few shards, so that the
minima and maxima of a file's columns prune for filters on any of the dimensions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from .common import stored


def hilbert_index(dims: Sequence[Column], bits: int) -> Column:
    """Index along the Hilbert curve of non-negative integer columns below 2**bits, as a long (len(dims) * bits <= 62).

    Skilling's transform, folded over bit planes and dimensions by higher-order functions on one small array.
    """
    n = len(dims)
    if not 1 <= n * bits <= 62:
        raise ValueError("dimensions times bits must be from 1 to 62")
    axes = F.sequence(F.lit(0), F.lit(n - 1))

    def at(x: Column, i: Column) -> Column:
        return F.element_at(x, (i + 1).cast("int"))

    def per_axis(x: Column, i: Column, q: Column) -> Column:
        """One axis of one bit plane: invert the low bits of the first axis, or exchange them with this axis."""
        low = q - 1
        swap = at(x, F.lit(0)).bitwiseXOR(at(x, i)).bitwiseAND(low)
        set_bit = at(x, i).bitwiseAND(q) != 0
        return F.when(set_bit, F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))).otherwise(
            F.transform(x, lambda v, j: F.when((i != 0) & ((j == 0) | (j == i)), v.bitwiseXOR(swap)).otherwise(v))
        )

    planes = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda k: F.element_at(F.array(*(F.lit(1 << (bits - 1 - b)).cast("long") for b in range(bits))), (k + 1).cast("int")))
    start = F.array(*(d.cast("long") for d in dims))
    turned = F.aggregate(F.filter(planes, lambda q: q > 1), start, lambda x, q: F.aggregate(axes, x, lambda y, i: per_axis(y, i, q)))
    gray = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), turned, lambda x, i: F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(at(x, i - 1))).otherwise(v))) if n > 1 else turned

    def finish(x: Column) -> Column:
        flip = F.aggregate(planes, F.lit(0).cast("long"), lambda t, q: F.when((q > 1) & (at(x, F.lit(n - 1)).bitwiseAND(q) != 0), t.bitwiseXOR(q - 1)).otherwise(t))
        done = F.transform(x, lambda v: v.bitwiseXOR(flip))
        bit = lambda y, q: F.aggregate(axes, F.lit(0).cast("long"), lambda t, i: t * 2 + (at(y, i).bitwiseAND(q) != 0).cast("long"))
        return F.aggregate(planes, F.lit(0).cast("long"), lambda t, q: t * (1 << n) + bit(done, q))

    return F.element_at(F.transform(F.array(gray), finish), 1)


def place_of_values(docs: DataFrame, column: str, bits: int) -> DataFrame:
    """For each value of a column (null last): its place among the rows in the values' order, in 2**bits steps.

    Values are counted before the shuffle; the ordered window sees one row per distinct value.
    """
    counted = docs.groupBy(F.col(column).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    order = W.orderBy(F.col("__value").asc_nulls_last())
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    middle = F.sum("__n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("__n") / 2
    step = F.least(F.floor(middle / F.sum("__n").over(every) * (1 << bits)), F.lit((1 << bits) - 1)).cast("long")
    return counted.select(F.col("__value").alias(f"__{column}_value"), step.alias(f"__{column}_step"))


def ranked(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """rows with __rank (from 0, gapless, in `order`) and __total, without one task that sees all rows.

    Rows are dealt by range, and the deal is written down before anything is counted: what executors lose is read again,
    not dealt anew. Then each partition numbers its own rows from the sum of the counts before it, one row a partition.
    """
    dealt = stored(rows.repartitionByRange(*(F.col(c).asc_nulls_last() for c in order)).withColumn("__part", F.spark_partition_id()), label)
    counted = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    ahead = W.orderBy("__part")
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = counted.select("__part", F.coalesce(F.sum("__n").over(ahead.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"), F.sum("__n").over(every).alias("__total"))
    within = W.partitionBy("__part").orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return (
        dealt.withColumn("__own", F.row_number().over(within))
        .join(stored(starts, f"{label}-starts"), "__part")
        .withColumn("__rank", (F.col("__start") + F.col("__own") - 1).cast("long"))
        .drop("__part", "__start", "__own")
    )


def shard(docs: DataFrame, shards: int = 40, *, doc_id: str = "doc_id", text: str = "text", by: Sequence[str] = ("source", "lang"), bits: int = 5) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, hilbert, shard (from 0) and slot (gapless from 0 in its shard).

    Dimensions of the curve: the columns `by` (places among their values, weighted by rows), the text's size (steps of its
    logarithm) and the id (steps of its place between the least and the largest). Counts of two shards differ by one at
    most. Null texts have size 16 and crc 0; null ids and null values of `by` come last. Rows alike in index, crc and id
    may exchange slots, which no column shows. Texts aren't shuffled, only the numbers above.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), *(F.col(c).alias(f"__{c}") for c in by), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    base = stored(base, "shard-base")  # texts are read once; all that follows sees these numbers alone
    steps = base
    for c in by:
        steps = steps.join(stored(place_of_values(base, f"__{c}", bits), f"place-{c}"), F.col(f"__{c}").eqNullSafe(F.col(f"____{c}_value"))).drop(f"____{c}_value", f"__{c}").withColumnRenamed(f"____{c}_step", f"__{c}_step")
    top = (1 << bits) - 1
    bounds = stored(base.agg(F.min("doc_id").cast("double").alias("__lo"), F.max("doc_id").cast("double").alias("__hi")), "bounds")
    steps = steps.crossJoin(F.broadcast(bounds))  # one row
    by_size = F.least(F.floor(F.log2(F.col("size").cast("double")) * 2) - 8, F.lit(top))
    by_id = F.when(F.col("doc_id").isNull() | (F.col("__hi") <= F.col("__lo")), F.lit(top)).otherwise(F.least(F.floor((F.col("doc_id").cast("double") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * (top + 1)), F.lit(top)))
    curve = hilbert_index([*(F.col(f"__{c}_step") for c in by), F.greatest(by_size, F.lit(0)).cast("long"), by_id.cast("long")], bits)
    numbered = ranked(stored(steps.select("doc_id", "size", "text_crc32", curve.alias("hilbert")), "shard-curve"), ["hilbert", "text_crc32", "doc_id"], "shard")
    of = F.expr(f"cast(__rank * {shards} div __total as int)")
    first = F.expr(f"(shard * __total + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", of).withColumn("slot", (F.col("__rank") - first).cast("long")).drop("__rank", "__total")


#: Rows of one file of a shard; a large shard has many, written by many tasks.
FILE_ROWS = 1 << 17


def write_shards(docs: DataFrame, path: str, shards: int = 40, *, doc_id: str = "doc_id", text: str = "text", by: Sequence[str] = ("source", "lang"), bits: int = 5) -> None:
    """Write the rows of docs, with shard, slot and size, to a new folder: each shard files of FILE_ROWS rows at most, each
    a run of the curve's order, and beside them a table of each file's count and its minima and maxima of `by`, size and id.

    Rows alike in id, size and crc are numbered on both sides, so that none is lost or doubled. Columns of docs must not be
    called shard, slot or size.
    """
    if clash := {"shard", "slot", "size"} & set(docs.columns):
        raise ValueError(f"columns of the shards' own names: {sorted(clash)}")
    body = F.coalesce(F.col(text), F.lit(""))
    whole = stored(docs, "shard-docs")
    alike = ["__id", "__size", "__crc"]
    left = whole.withColumn("__id", F.col(doc_id)).withColumn("__size", (F.octet_length(body) + 16).cast("long")).withColumn("__crc", F.crc32(body))
    left = left.withColumn("__k", F.row_number().over(W.partitionBy(*alike).orderBy(*alike)))
    found = shard(whole, shards, doc_id=doc_id, text=text, by=by, bits=bits).select(F.col("doc_id").alias("__id2"), F.col("size"), F.col("text_crc32").alias("__crc2"), "shard", "slot")
    right = found.withColumn("__k2", F.row_number().over(W.partitionBy("__id2", "size", "__crc2").orderBy("shard", "slot")))
    same = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__size") == F.col("size")) & (F.col("__crc") == F.col("__crc2")) & (F.col("__k") == F.col("__k2"))
    rows = left.join(right, same).select(*docs.columns, "size", "slot", "shard")
    run = F.floor(F.col("slot") / FILE_ROWS)
    rows.repartition("shard", run).sortWithinPartitions("shard", "slot").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("shard").parquet(f"{path}/rows")
    spark = docs.sparkSession
    spark.createDataFrame([(rows.schema.json(),)], "schema string").write.parquet(f"{path}/schema")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    limits = [f(c).alias(f"{name}_{c}") for c in dict.fromkeys([*by, "size", doc_id]) for name, f in (("min", F.min), ("max", F.max))]
    of_file = F.regexp_extract(F.input_file_name(), "[^/]+$", 0).alias("file")
    written.groupBy("shard", of_file).agg(F.count(F.lit(1)).alias("n"), *limits).coalesce(1).write.parquet(f"{path}/bounds")


def read_shards(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows of write_shards() with low <= column <= high, from those files alone whose bounds allow it."""
    schema = StructType.fromJson(json.loads(spark.read.parquet(f"{path}/schema").first()["schema"]))
    hit = spark.read.parquet(f"{path}/bounds").where((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high)).select("shard", "file").orderBy("shard", "file").collect()
    if not hit:
        return spark.createDataFrame([], schema)
    files = [f"{path}/rows/shard={r['shard']}/{r['file']}" for r in hit]
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*files).where(F.col(column).between(low, high))
