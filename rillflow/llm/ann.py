"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes of 64 bits are signs of rotated principal components (the rotation learned on a bounded sample so that signs lose
little). A code is four substrings of 16 bits, each with an index of its own: a table of cells, a cell being a substring's
number and the high bits of its value. Two codes within a Hamming radius agree within radius // 4 in at least one substring,
so that probing the cells near the query's substrings retrieves every code within the radius; those are ranked by the vectors
themselves.

The radius is each query's own. A first probe of the nearest cells finds k neighbours; their angle bounds that of the true
ones, and the radius is the Hamming distance that codes at such an angle have, with a margin. Where vectors have close
neighbours, few cells are probed; where all are far apart, no index spares much.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from .common import arrow_pass, stored

PARTS, PART_BITS = 4, 16
BITS = PARTS * PART_BITS
#: Rows of a cell that a task holds, queries that it meets them with at once, and queries of a cell for one task.
BLOCK, TOGETHER, QUERIES = 4096, 32, 1 << 16
#: Reach of the first probe in each substring, and margin of the radius in standard deviations of the distance.
FIRST, MARGIN = 1, 1.25


@dataclass
class Rotation:
    """Codes of vectors: signs of (x / |x| - mean) @ axes."""

    mean: np.ndarray
    axes: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        """PARTS numbers of PART_BITS bits for each vector."""
        unit = x / np.sqrt((x * x).sum(1, keepdims=True))
        return np.packbits((unit - self.mean) @ self.axes > 0, axis=1).view(">u2").astype(np.uint16)


def learn(sample: np.ndarray, rounds: int = 30, seed: int = 5) -> Rotation:
    """Principal axes, turned by iterative quantisation; fewer than 64 dimensions are turned several times over."""
    unit = sample / np.sqrt((sample * sample).sum(1, keepdims=True))
    mean = unit.mean(0)
    x, d = unit - mean, sample.shape[1]
    _, vectors = np.linalg.eigh(x.T @ x)
    main, rng, axes = vectors[:, ::-1][:, : min(d, BITS)], np.random.default_rng(seed), []
    z = x @ main
    while sum(a.shape[1] for a in axes) < BITS:
        turn = np.linalg.qr(rng.normal(size=(main.shape[1], main.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
            turn = (u @ w).T
        axes.append(main @ turn)
    return Rotation(mean, np.hstack(axes)[:, :BITS])


def reaches(radius: np.ndarray) -> np.ndarray:
    """Reach in each substring that finds every code within the radius: of r = 4 * s + t, s for the first t + 1, s - 1 for the others."""
    each, over = np.divmod(np.asarray(radius)[:, None], PARTS)
    return each - (np.arange(PARTS) > over)


def _routes(bits: int):
    """From (query, code, x, radius, most): one row for each cell that the query's radius reaches, with part and cell."""
    cells = np.arange(1 << bits, dtype=np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, PARTS)
            reach = reaches(batch.column(3).to_numpy())
            for p in range(PARTS):
                high = (code[:, p].astype(np.uint32) >> (PART_BITS - bits)).astype(np.uint16)
                row, cell = np.nonzero(np.bitwise_count(high[:, None] ^ cells) <= np.maximum(reach[:, p], -1)[:, None].astype(np.int64))
                keep = reach[row, p] >= 0
                row, cell = row[keep], cell[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), p, np.int32)), pa.array(cell.astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)], names=["part", "cell", *batch.schema.names])

    return run


def best_of(ids: np.ndarray, uids: np.ndarray, x: np.ndarray, codes: np.ndarray, part: int, queries: np.ndarray, q: np.ndarray, query_codes: np.ndarray, radius: np.ndarray, most: np.ndarray, k: int) -> Iterator[tuple[int, int, int, float]]:
    """(query, row, vector, cosine) of the k best of a cell's rows for each query, other than itself.

    A row counts in the first substring alone that brings it within reach: other cells leave it out.
    """
    near, norms = np.bitwise_count(query_codes[:, None, :] ^ codes[None]), np.sqrt((x * x).sum(1))
    within = near <= reaches(radius)[:, None, :]
    seen = within[:, :, part] & ~within[:, :, :part].any(2) & (near.sum(2, dtype=np.int64) <= most[:, None]) & (ids[None] != queries[:, None])
    rough = np.where(seen, (q @ x.T) / norms, -np.inf)
    for i in np.nonzero(seen.any(1))[0].tolist():
        if len(ids) > k:
            least = np.partition(rough[i], len(ids) - k)[len(ids) - k]
            rows = np.nonzero(seen[i] & (rough[i] >= least - 1e-9 * abs(least)))[0]
        else:
            rows = np.nonzero(seen[i])[0]
        # row by row: equal rows have equal sums wherever they stand
        scores = (x[rows] * q[i]).sum(1) / (norms[rows] * math.sqrt(float((q[i] * q[i]).sum())))
        for at in np.lexsort((ids[rows], -scores))[:k].tolist():
            yield int(queries[i]), int(uids[rows[at]]), int(ids[rows[at]]), float(scores[at])


def _cells(k: int, dims: int):
    """From rows (part, cell, salt, turn, kind, uid, id, code, x, radius, most), in order: the rows of a cell (kind 0), which are
    held, then its queries (kind 1), which pass by in small numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, block = None, [], None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in range(5)], 1)
            starts = np.r_[0, np.nonzero((where[1:] != where[:-1]).any(1))[0] + 1, len(where)]
            out: list[tuple] = []
            for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False):
                now, part = tuple(where[a, :4].tolist()), batch.slice(a, b - a)
                if now != of:
                    of, held, block = now, [], None
                columns = part.column(5).to_numpy(), part.column(6).to_numpy(), np.frombuffer(b"".join(part.column(8).to_pylist()), np.float64).reshape(-1, dims), np.frombuffer(b"".join(part.column(7).to_pylist()), np.uint16).reshape(-1, PARTS)
                if where[a, 4] == 0:
                    held.append(columns)
                    continue
                if not held:
                    continue
                if block is None:
                    block = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                uids, ids, x, codes = block
                _, queries, q, query_codes = columns
                radius, most = part.column(9).to_numpy(), part.column(10).to_numpy()
                for s in range(0, b - a, TOGETHER):
                    t = slice(s, s + TOGETHER)
                    out += best_of(ids, uids, x, codes, now[0], queries[t], q[t], query_codes[t], radius[t], most[t], k)
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "uid", "vec_id", "score"])

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    """The k first of each query, of rows found once or more; partitions cut to k rows a query before they are dealt."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "uid")
    return found.dropDuplicates(["query_id", "uid"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def probe(index: DataFrame, queries: DataFrame, *, bits: int, dims: int, k: int) -> DataFrame:
    """(query_id, uid, vec_id, score): of each cell's blocks the k best of each query (id, code, x, radius, most) that probes it; stored.

    Rows of the index are dealt to the cells of their four substrings, queries to the cells that they probe. A cell of many
    rows is dealt to several blocks, one of many queries to several turns of the same blocks; a task holds one block.
    """
    routed = stored(arrow_pass(queries.select("id", "code", "x", "radius", "most"), _routes(bits), "part int, cell int, id long, code binary, x binary, radius long, most long"), "ann-routed")
    value = lambda p: F.conv(F.hex(F.reverse(F.substring("code", 2 * p + 1, 2))), 16, 10).cast("int")
    parts = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), F.shiftright(value(p), PART_BITS - bits).alias("cell")) for p in range(PARTS))))
    placed = index.select(parts.alias("at"), "uid", "id", "code", "x").select("at.*", "uid", "id", "code", "x")
    loads = routed.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("turns"))
    sizes = placed.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts"))
    cells = stored(sizes.join(loads, ["part", "cell"]), "ann-cells")
    turn = lambda of, n, by: F.pmod(F.xxhash64(of, F.lit(by)), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(cells, ["part", "cell"]).select("part", "cell", turn("uid", "salts", 1).alias("salt"), all_of("turns").alias("turn"), F.lit(0).alias("kind"), "uid", "id", "code", "x", F.lit(0).cast("long").alias("radius"), F.lit(0).cast("long").alias("most"))
    right = routed.join(cells, ["part", "cell"]).select("part", "cell", all_of("salts").alias("salt"), turn("id", "turns", 2).alias("turn"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("uid"), "id", "code", "x", "radius", "most")
    at = ["part", "cell", "salt", "turn"]
    met = left.unionByName(right).repartition(*at).sortWithinPartitions(*at, "kind")
    return stored(arrow_pass(met, _cells(k, dims), "query_id long, uid long, vec_id long, score double", 2048), "ann-found")


def nearest(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = 5, sample: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by `every`, among all other rows.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids and vectors of another
    length than most have. Ties go to the smaller id; rows that repeat an id are one vector's copies and never answer it,
    and of different vectors of a query's id the least asks. Every vector is indexed; only the rotation is learned on a
    sample (least md5 of the id, at most `sample`). A query with fewer than k neighbours in its first probe looks at all
    rows. Without usable vectors the result is empty.
    """
    spark = vectors.sparkSession
    good = F.col(embedding).isNotNull() & F.forall(embedding, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(0.0)))) & F.exists(embedding, lambda c: c != 0)
    usable = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("x")).where(F.col("id").isNotNull() & F.coalesce(F.expr("size(`" + embedding + "`) > 0"), F.lit(False)) & F.coalesce(good, F.lit(False)))
    sizes = usable.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("queries")).orderBy(F.desc("n"), "d").first()
    if sizes is None or not sizes["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = sizes["d"]
    usable = usable.where(F.size("x") == dims)
    learned = usable.orderBy(F.md5(F.col("id").cast("string")), "id", "x").limit(sample).select("x").toArrow()
    rotation = learn(np.asarray(learned["x"].combine_chunks().flatten(), np.float64).reshape(-1, dims))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in rotation.codes(x)], pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())], names=["id", "code", "x"])

    index = stored(arrow_pass(usable, coded, "id long, code binary, x binary", 4096).withColumn("uid", F.monotonically_increasing_id()), "ann-index")
    bits = min(PART_BITS, max(0, round(math.log2(max(1.0, sizes["n"] / BLOCK)))))
    queries = stored(index.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("x", "code")).alias("v")).select("id", "v.x", "v.code"), "ann-queries")
    how = {"bits": bits, "dims": dims, "k": k}
    whole = F.lit(BITS).cast("long")
    first = probe(index, queries.withColumn("radius", F.lit(FIRST * PARTS + PARTS - 1).cast("long")).withColumn("most", whole), **how)
    kth = best(first, k).groupBy(F.col("query_id").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("cosine")).where(F.col("n") >= k)
    share = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cosine")))) / math.pi
    radius = F.least(whole, F.coalesce(F.ceil(BITS * share + MARGIN * F.sqrt(BITS * share * (1 - share))), whole)).cast("long")
    asked = queries.join(kth, F.col("id") == F.col("of"), "left").withColumn("radius", radius).withColumn("most", F.col("radius"))
    found = best(first.unionByName(probe(index, asked, **how)), k)
    return found.select("query_id", "rank", "vec_id", "score")
