"""Near duplicates by HyperMinHash: compressed registers, banding, collision-corrected estimates, exact verification.

Each register keeps, of a hash's minimum over the text's shingles, the count of leading zeros (6 bits) and the next bits
as a mantissa (10 bits). Every register has a hash of its own over the whole set: splitting one hash's values among the
registers would leave most of them empty for short texts. Four registers are one band, exactly a 64-bit key; texts that
share a band are candidates. Estimates from the registers, corrected for registers that agree by chance, sort out most
candidates; the rest are compared by their full sets of shingles, and only that makes a link.

Two passes look at the candidates. Stars compare each text with the least ids of its buckets, which finds most links with
few pairs. Then every pair of a bucket that is still in different components is judged in tiles: a task holds two groups of
a bucket's rows with their texts, verifies the pairs between them on full sets, and joins what it links on the spot. No pairs
leave a tile but links between components, one fewer than its components at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import arrow_pass, salted, stored

BANDS, ROWS, MANTISSA = 32, 4, 10
REGISTERS = BANDS * ROWS
#: Candidates below the threshold less this are not verified: over five standard deviations of 128 registers at 0.8.
SLACK = 0.2
#: Least ids that a text is compared with in stars (tiles meet all others), and rows of one run that a task holds.
STARS, HOT_RUN = 4, 1 << 20
#: Rows and shingles of a bucket that meet in one tile, of each side; a single text can have more.
TILE, TILE_SHINGLES = 2048, 1 << 18
#: Pairs of rows that are compared at once.
PAIRS = 1 << 15
#: Tasks that share the rows of one hub or one component.
SALTS = 16
#: Ids that are broadcast to pick the texts to verify.
BROADCAST_IDS = 1_000_000
#: Bytes of the words whose hashes a worker remembers.
_CACHE = 16 << 20


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words of a whole text, A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return raw.lower().split()  # of bytes: lowers A-Z alone and splits at the six white-space bytes alone


def shingle_set(words: list[bytes], size: int) -> set:
    """Distinct runs of `size` words; fewer words are one run, none is the empty set."""
    if not words:
        return set()
    if len(words) <= size:
        return {tuple(words)}
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def linked(a: set, b: set, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union; empty sets link with nothing."""
    if not a or not b:
        return False
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], size: int, known: dict[bytes, int]) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted. known: hashes of words seen before, for speed; b"" has their bytes."""
    if known.get(b"", 0) > _CACHE:
        known.clear()
    get, digest, new = known.get, xxhash.xxh64_intdigest, 0
    out = []
    for w in words:
        h = get(w)
        if h is None:
            h = known[w] = digest(w)
            new += len(w) + 64
        out.append(h)
    known[b""] = known.get(b"", 0) + new
    h = np.array(out, np.uint64)
    width = min(size, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(total)


@lru_cache(maxsize=1)
def _keys() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240917)
    return rng.integers(0, 1 << 64, REGISTERS, np.uint64), rng.integers(0, 1 << 64, REGISTERS, np.uint64) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a non-empty set, as 16-bit numbers."""
    flips, odd = _keys()
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 512):
        np.minimum(low, ((hashes[k : k + 512, None] ^ flips) * odd).min(0), out=low)
    _, exponent = np.frexp((low >> np.uint64(11)).astype(np.float64))  # exact: 53 bits
    zeros = np.minimum(53 - exponent, 62).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of these sizes agree: the sum over cells of both minima's densities."""
    n, m = np.asarray(n, np.float64), np.asarray(m, np.float64)
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(60):
        high = 2.0**-zeros
        low = high / 2
        total += low * 2.0**-MANTISSA * n * m / (n + m) * (np.exp(-(n + m) * low) - np.exp(-(n + m) * high))
    return total


def estimate(agree: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of registers that agree, less what agrees by chance."""
    c = chance(n, m)
    return (agree - c) / (1 - c)


def sketches(docs: DataFrame, *, doc_id: str, text: str, shingle: int) -> DataFrame:
    """id, n_shingles, and of non-empty sets set_key (sha256 of the sequence of words) and registers; in one pass, stored.

    Sizes are of full sets. Equal keys mean equal sequences of words, and so equal sets, as far as sha256 goes; texts whose
    sets alone are equal agree in all registers and are verified like any others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(raw)
                if not words:
                    sizes.append(0), keys.append(None), sigs.append(None)
                    continue
                sizes.append(len(shingle_set(words, shingle))), keys.append(hashlib.sha256(b" ".join(words)).digest())
                sigs.append(registers(shingle_hashes(words, shingle, known)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "n_shingles", "set_key", "registers"])

    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("__text"))
    return stored(arrow_pass(plain, run, f"id {dict(plain.dtypes)['id']}, n_shingles long, set_key binary, registers binary"), "dup-sketches")


@lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    """What sets apart the keys of the bands."""
    return _mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, registers): rows (key, id), one for each band; the key is the band's four registers, mixed with its number."""
    for batch in batches:
        n = batch.num_rows
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(n, BANDS) ^ _numbers()
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS), pa.int64())], names=["key", "id"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, id) in order: the rows of keys that come twice, with the least id of the run. A partition's first and last
    run can go on elsewhere, so their rows come out even if alone."""
    key, ids, first = np.zeros(0, np.int64), np.zeros(0, np.int64), True

    def out(end: int, last: bool) -> pa.RecordBatch:
        nonlocal first
        k, i = key[:end], ids[:end]
        start = np.r_[True, k[1:] != k[:-1]] if end else np.zeros(0, bool)
        run = np.cumsum(start) - 1
        size = np.bincount(run, minlength=1)
        good = size > 1
        if first and end:
            good[0] = True
        if last:
            good[-1] = True
        first = first and not end
        keep = good[run] if end else np.zeros(0, bool)
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (k, i, i[start][run] if end else i)], names=["key", "id", "least"])

    for batch in batches:
        key, ids = (np.concatenate([x, batch.column(c).to_numpy()]) for c, x in enumerate((key, ids)))
        if len(key) and key[0] != key[-1]:
            # all but the last run, which the next batch may carry on
            end = int(np.searchsorted(key, key[-1]))
            yield out(end, False)
            key, ids = key[end:], ids[end:]
        elif len(key) > HOT_RUN:
            # a run without end: its rows leave with their least id, which stays behind for those to come
            yield pa.RecordBatch.from_arrays([pa.array(key[1:]), pa.array(ids[1:]), pa.array(np.full(len(ids) - 1, ids[0]))], names=["key", "id", "least"])
            key, ids, first = key[:1], ids[:1], True
    yield out(len(key), True)


def _close(percent: int):
    """From (a, b, n_a, n_b, registers_a, registers_b): pairs worth verifying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            good = estimate((x == y).mean(1), n, m) >= percent / 100 - SLACK
            good &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)  # sizes too far apart can't reach it
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good)) for k in (0, 1)], names=["a", "b"])

    return run


def _verified(shingle: int, percent: int):
    """From (a, b, text_a, text_b), sorted by a: linked pairs, by full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first = None, set()
        for batch in batches:
            good = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if (a, x) != before:
                    before, first = (a, x), shingle_set(words_of(x), shingle)
                good.append(linked(first, shingle_set(words_of(y), shingle), percent))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], names=["a", "b"])

    return run


def crowded(reps: DataFrame) -> DataFrame:
    """(key, id, least) of bands whose bucket has two members or more, from one sort by range; stored.

    Rows are dealt by key and id, so that many tasks share a hot bucket: `least` is the least id of the part that a task
    saw, and starts() links the parts.
    """
    rows = arrow_pass(reps.select("id", "registers"), _bands, "key long, id long").repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return stored(arrow_pass(rows, _runs, "key long, id long, least long", 10_000), "dup-crowded")


def candidates(rows: DataFrame) -> DataFrame:
    """Pairs (a < b) from crowded(): each member with those least ids that it shares most buckets with, STARS of them at
    most, and the least ids of a bucket's parts with each other's least."""
    star = rows.where("id > least").groupBy(F.col("least").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    best = star.withColumn("place", F.row_number().over(W.partitionBy("b").orderBy(F.desc("n"), "a"))).where(F.col("place") <= STARS).select("a", "b")
    parts = rows.where("id = least").select("key", "id").distinct()
    least = parts.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return best.unionByName(parts.join(least, "key").where("id > a").select("a", F.col("id").alias("b"))).distinct()


def named_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, component) of crowded() rows; stored."""
    return stored(rows.select("key", "id").join(labels.withColumnRenamed("id", "l"), F.col("id") == F.col("l"), "left").select("key", "id", F.coalesce("component", "id").alias("component")), "dup-named", rows.count())


def hopeful(left: np.ndarray, right: np.ndarray, key: np.ndarray, component: np.ndarray, n: np.ndarray, regs: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows shall be verified in the bucket `key` of the left one: components differ, sizes allow it, no earlier
    band is shared (the pair is met there), and the estimate is high enough."""
    good = np.nonzero((component[left] != component[right]) & (100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])))[0]
    bands = regs.view(np.uint64)
    same = bands[left[good]] == bands[right[good]]
    first = same.argmax(1)
    met = same.any(1) & ((bands[left[good], first] ^ _numbers()[first]) == key[left[good]].view(np.uint64))
    good = good[met]
    agree = (regs[left[good]] == regs[right[good]]).mean(1)
    good, agree = good[agree >= percent / 100 - SLACK], agree[agree >= percent / 100 - SLACK]  # estimates are never above it
    return good[estimate(agree, n[left[good]], n[right[good]]) >= percent / 100 - SLACK]


def _partners(k: int, p: int, q: int, side: np.ndarray) -> np.ndarray:
    """Rows that row k of side p meets in the tile (p, q): all of side q, or, of one group alone, those after k."""
    r = np.nonzero(side == q)[0]
    return r[r > k] if p == q else r


def _tile_pairs(tile: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs that meet in the tiles of these rows (key, p, q in order), some PAIRS at a time, whatever the tiles' sizes."""
    starts = np.r_[0, np.nonzero((tile[1:] != tile[:-1]).any(1))[0] + 1, len(tile)]
    lefts, rights, held = [], [], 0
    for x, y in zip(starts.tolist(), starts[1:].tolist(), strict=False):
        _, p, q = tile[x].tolist()
        a, b = (x + np.nonzero(side[x:y] == s)[0] for s in (p, q))
        step = max(1, PAIRS // max(1, len(b)))
        for at in range(0, len(a), step):
            some = a[at : at + step]
            left, right = np.repeat(some, len(b)), np.tile(b, len(some))
            if p == q:
                left, right = left[right > left], right[right > left]
            lefts.append(left), rights.append(right)
            held += len(left)
            if held >= PAIRS:
                yield np.concatenate(lefts), np.concatenate(rights)
                lefts, rights, held = [], [], 0
    if held:
        yield np.concatenate(lefts), np.concatenate(rights)


def _by_tile(batches: Iterator[pa.RecordBatch], judge, names: list[str]) -> Iterator[pa.RecordBatch]:
    """From (key, p, q, ...), ordered by these three: judge((key, p, q), columns) of each tile, as rows of longs."""
    waiting: list = []
    of = None

    def out() -> pa.RecordBatch:
        got = judge(of, pa.Table.from_batches(waiting).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in got], names=names)

    for batch in batches:
        tile = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        starts = np.r_[0, np.nonzero((tile[1:] != tile[:-1]).any(1))[0] + 1, len(tile)]
        for x, y in zip(starts.tolist(), starts[1:].tolist(), strict=False):
            now = tuple(tile[x].tolist())
            if waiting and now != of:
                yield out()
                waiting = []
            of = now
            waiting.append(batch.slice(x, y - x))
    if waiting:
        yield out()


def _matrix(tile: pa.Table) -> tuple[np.ndarray, ...]:
    """side, id, component, n_shingles and registers of a tile's rows."""
    regs = np.frombuffer(b"".join(tile["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
    return *(tile[c].to_numpy() for c in ("side", "id", "component", "n_shingles")), regs


def _needed(percent: int):
    """Rows (key, p, q, side, id) of tiles that have anything to verify: what _joined() needs the texts of.

    Most tiles are small, so that those of a whole batch are judged at once; a tile that goes on in the next batch waits for it.
    """

    def judge(rows: pa.Table) -> pa.RecordBatch:
        tile = np.stack([rows[c].to_numpy() for c in ("key", "p", "q")], 1)
        side, ids, component, n, regs = _matrix(rows)
        want = np.zeros(len(ids), bool)
        for left, right in _tile_pairs(tile, side):
            good = hopeful(left, right, tile[:, 0], component, n, regs, percent)
            want[left[good]] = want[right[good]] = True
        return pa.RecordBatch.from_arrays([pa.array(c[want]) for c in (*(np.ascontiguousarray(c) for c in tile.T), side, ids)], names=["key", "p", "q", "side", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in range(3))
            same = np.logical_and.reduce([batch.column(k).to_numpy() == last[k] for k in range(3)])
            end = int(np.argmax(same))  # where the batch's last tile starts
            if end:
                yield judge(pa.Table.from_batches([*waiting, batch.slice(0, end)]).combine_chunks())
                waiting = []
            elif waiting and tuple(waiting[-1].column(k)[0].as_py() for k in range(3)) != last:
                yield judge(pa.Table.from_batches(waiting).combine_chunks())
                waiting = []
            waiting.append(batch.slice(end))
        if waiting:
            yield judge(pa.Table.from_batches(waiting).combine_chunks())

    return run


def _joined(shingle: int, percent: int):
    """Links (a, b) between components of a tile's rows, verified on full sets.

    Pairs whose rows are linked already, directly or by others of the tile, need no look. Shingles are numbered by
    themselves, not by hashes.
    """

    def judge(of: tuple[int, int, int], tile: pa.Table) -> tuple[np.ndarray, ...]:
        key, p, q = of
        side, ids, component, n, regs = _matrix(tile)
        component, keys, number, sets = component.copy(), np.full(len(ids), key, np.int64), {}, []
        for raw in tile["t"].to_pylist():
            sets.append(np.fromiter((number.setdefault(g, len(number)) for g in shingle_set(words_of(raw), shingle)), np.int64))
        sizes, there, links = np.array([len(s) for s in sets]), np.zeros(len(number) + 1, np.int64), []
        for k in np.nonzero(side == p)[0].tolist():
            r = _partners(k, p, q, side)
            r = r[(component[r] != component[k]) & (sizes[r] > 0)]
            if len(r):
                r = r[hopeful(np.full(len(r), k), r, keys, component, n, regs, percent)]
            if not len(r) or not sizes[k]:
                continue
            there[sets[k]] = 1
            # in steps, so that a row with many partners holds few of their sets at once
            for at in range(0, len(r), 256):
                part = r[at : at + 256]
                part = part[component[part] != component[k]]
                if not len(part):
                    continue
                both = np.add.reduceat(there[np.concatenate([sets[x] for x in part])], np.r_[0, np.cumsum(sizes[part])[:-1]])
                for x in part[100 * both >= percent * (sizes[part] + sizes[k] - both)].tolist():
                    if component[x] != component[k]:
                        links.append((min(ids[k], ids[x]), max(ids[k], ids[x])))
                        component[component == component[x]] = component[k]
            there[sets[k]] = 0
        both = np.array(links, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    return lambda batches: _by_tile(batches, judge, ["a", "b"])


def remaining(rows: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, *, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """Links (a < b) that join all components which any pair of any bucket links; stored.

    Every pair of a bucket whose rows lie in different components, and whose estimate is high enough, is verified. Rows of a
    bucket's largest component, which need no comparison among themselves, are dealt to groups of TILE rows and TILE_SHINGLES
    shingles about, the other rows to groups of their own; each tile is a pair of groups, so hot buckets are shared by tasks
    and no task holds more than two groups of rows. Texts go to those tiles alone that have something to verify.
    """
    named = named_rows(rows, labels).distinct().join(reps.select(F.col("id").alias("r"), "n_shingles"), F.col("id") == F.col("r")).drop("r")
    sizes = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("m")).groupBy("key").agg(F.max(F.struct("n", "component", "m")).alias("main"), F.sum("n").alias("all"), F.sum("m").alias("every"))
    groups = lambda n, m: F.greatest(F.ceil(n / TILE), F.ceil(m / TILE_SHINGLES)).cast("int")
    mixed = sizes.where(F.col("all") > F.col("main.n")).select("key", F.col("main.component").alias("main"), groups(F.col("main.n"), F.col("main.m")).alias("gm"), groups(F.col("all") - F.col("main.n"), F.col("every") - F.col("main.m")).alias("go"))
    is_main = F.col("component") == F.col("main")
    dealt = F.xxhash64("id", F.lit(1))
    side = F.when(is_main, F.pmod(dealt, F.col("gm"))).otherwise(F.col("gm") + F.pmod(dealt, F.col("go"))).cast("long")
    partner = F.explode(F.when(is_main, F.sequence(F.col("gm"), F.col("gm") + F.col("go") - 1)).otherwise(F.sequence(F.lit(0), F.col("gm") + F.col("go") - 1)))
    placed = named.join(mixed, "key").withColumn("side", side).withColumn("partner", partner).withColumn("p", F.least("side", "partner").cast("long")).withColumn("q", F.greatest("side", "partner").cast("long"))
    sketch = reps.select(F.col("id").alias("r"), "registers")
    first = placed.select("key", "p", "q", "side", "id", "component", "n_shingles").join(sketch, F.col("id") == F.col("r")).drop("r")
    need = stored(arrow_pass(first.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q"), _needed(percent), "key long, p long, q long, side long, id long", 4096), "dup-needed")
    named_once = labels.select(F.col("id").alias("l"), "component")
    texts = texts_of(docs, need.select("id"), doc_id=doc_id, text=text).select(F.col("id").alias("d"), "t")
    full = (
        need.join(named_once, F.col("id") == F.col("l"), "left").withColumn("component", F.coalesce("component", "id")).drop("l")
        .join(reps.select(F.col("id").alias("r"), "n_shingles", "registers"), F.col("id") == F.col("r")).drop("r")
        .join(texts, F.col("id") == F.col("d")).drop("d")
    )
    found = arrow_pass(full.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q"), _joined(shingle, percent), "a long, b long", 64)
    return stored(found.distinct(), "dup-more", need.count())


def texts_of(docs: DataFrame, ids: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """(id, t) of the documents with these ids; stored."""
    wanted = stored(ids.distinct(), "dup-wanted", ids.count())
    if wanted.count() <= BROADCAST_IDS:  # eight bytes each; with more of them, texts are shuffled to meet their ids
        wanted = F.broadcast(wanted)
    return stored(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).join(wanted, "id", "left_semi"), "dup-texts")


def verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, *, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """The pairs that are links: estimated by registers, then compared by full sets; stored."""
    left, right = (reps.select(F.col("id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("registers").alias(f"r_{k}")) for k in "ab")
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")
    near = stored(arrow_pass(near, _close(percent), "a long, b long"), "dup-near", pairs.count())
    texts = texts_of(docs, near.select(F.col("a").alias("id")).union(near.select("b")), doc_id=doc_id, text=text)
    both = near.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b").select("a", "b", "ta", "tb")
    return stored(arrow_pass(both.sortWithinPartitions("a"), _verified(shingle, percent), "a long, b long"), "dup-links")


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(id, component) of every id in the links (a, b), component being the least id reachable. most: a bound of the links, if known.

    Labels spread to neighbours and jump along labels until nothing changes; each round is written, so no lineage grows and
    nothing is collected but a count. Hubs and large components are met by partial minima, and the rows of each are dealt to
    SALTS tasks when labels are joined to them.
    """
    edges = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "dup-edges", None if most is None else 2 * most)
    n = edges.count()  # no fewer than the ids
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "dup-labels", n)
    while True:
        heard = salted(edges, "b", "a", labels, "id", SALTS).groupBy("a").agg(F.min("component").alias("heard"))
        spread = labels.join(heard, F.col("id") == F.col("a"), "left").select("id", F.col("component").alias("before"), F.least("component", F.coalesce("heard", "component")).alias("component"))
        spread = stored(spread, "dup-spread", n)
        named = spread.select(F.col("component").alias("c")).distinct()
        jump = spread.join(named, F.col("id") == F.col("c"), "left_semi").select(F.col("id").alias("j"), F.col("component").alias("further"))
        new = stored(salted(spread, "component", "id", jump, "j", SALTS, "left").select("id", "before", F.least("component", F.coalesce("further", "component")).alias("component")), "dup-labels", n)
        changed = new.where("component <> before").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def with_links(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels of components() after more links (a, b): only the components that these join are looked at again."""
    added = more.count()
    if not added:
        return labels
    known = labels.select(F.col("id").alias("l"), "component")
    of = lambda rows, end: rows.join(known.withColumnRenamed("component", f"c_{end}"), F.col(end) == F.col("l"), "left").drop("l").withColumn(end, F.coalesce(f"c_{end}", end))
    between = of(of(more.select("a", "b"), "a"), "b").select("a", "b")
    alone = more.select(F.col("a").alias("id")).union(more.select("b")).distinct().join(labels.select("id"), "id", "left_anti").select("id", F.col("id").alias("component"))
    found = components(between, added).select(F.col("id").alias("l"), F.col("component").alias("now"))
    every = labels.select("id", "component").union(alone)
    return stored(salted(every, "component", "id", found, "l", SALTS, "left").select("id", F.coalesce("now", "component").alias("component")), "dup-labels", labels.count() + 2 * added)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Texts of equal words are one class, whatever its size, and only classes' least ids are sketched into bands. Texts without
    words are alone; very long texts are held whole by the task that has them. Rows with a null id keep a null component and are kept; rows that repeat an id are one document, whose links
    are those of any of its texts. Ids are integers. Other columns aren't read.
    """
    found = sketches(docs, doc_id=doc_id, text=text, shingle=shingle)
    usable = found.where("id is not null and set_key is not null")
    classes = usable.groupBy("set_key").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.count(F.lit(1)).alias("n"))
    n = found.count()
    classes = stored(classes, "dup-classes", n)
    reps = classes.select(F.col("rep").cast("long").alias("id"), "n_shingles", "registers")
    how = {"doc_id": doc_id, "text": text, "shingle": shingle, "percent": percent}
    rows = crowded(reps)
    links = verify(stored(candidates(rows), "dup-pairs", rows.count()), reps, docs, **how)
    of_class = components(links, links.count())
    of_class = with_links(of_class, remaining(rows, of_class, reps, docs, **how))
    copies = usable.join(classes.where("n > 1").select("set_key", "rep"), "set_key").where("id <> rep").select(F.col("id").cast("long").alias("a"), F.col("rep").cast("long").alias("b"))
    label = copies.join(of_class, F.col("b") == F.col("id"), "left").select(F.col("a").alias("id"), F.coalesce("component", "b").alias("component"))
    every = label.union(of_class)
    # an id with several texts can be in several classes
    twice = stored(every.groupBy("id").agg(F.min("component").alias("component"), F.max("component").alias("other")), "dup-members", n)
    odd = twice.where("component <> other").select(F.col("component").alias("a"), F.col("other").alias("b"))
    if odd.limit(1).count():
        joined = components(every.select(F.col("id").alias("a"), F.col("component").alias("b")))
        twice = joined
    member = twice.select(F.col("id").alias("__member"), "component")
    out = found.select("id", "n_shingles").join(member, F.col("id") == F.col("__member"), "left")
    component = F.coalesce(F.col("component"), F.col("id").cast("long"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
