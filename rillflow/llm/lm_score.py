"""Language-model scores by prediction by partial matching over bytes, beside exact unigram scores.

Contexts of up to four bytes form a trie with the counts of the byte that follows, gathered from all training texts. A
byte unseen in a context costs an escape (method C: distinct / (seen + distinct)) to the next shorter context, in which
the bytes that the longer one has seen are excluded. The blended distributions of the most frequent contexts are resolved
once, on the driver, into a table of log probabilities that travels with the tasks; places in all other contexts are met by
joins with the counts of their contexts, so that the model has every context of the training texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, crc_of_id, salted, stored

#: Stands before and after each text; no UTF-8 text holds it.
END = 0xFF
#: Bytes of the longest context, and the longest contexts that travel with the tasks, the most frequent ones; those of all
#: other contexts are joined.
ORDER, CACHED = 4, 65_536
#: Tasks that share the contexts of one ending.
SALTS = 16
#: Words whose counts travel with the tasks, the most frequent ones of so many bytes at most; the counts of all others are joined.
HOT_WORDS, HOT_BYTES = 65_536, 64
#: Bytes of text looked at together; distinct keys, and bytes of text whose words, a task holds before it passes them on.
SLICE, HELD, HELD_BYTES = 1 << 21, 400_000, 1 << 26


def framed(raw: bytes) -> np.ndarray:
    """The bytes of a text with ORDER marks before and one after it."""
    return np.frombuffer(b"\xff" * ORDER + raw + b"\xff", np.uint8)


def packed(a: np.ndarray, width: int, skip: int = 0) -> np.ndarray:
    """Runs of `width` bytes as numbers, one for each place of a framed text from its ORDER marks on, `skip` bytes later."""
    n = len(a) - ORDER
    x = a.astype(np.int64)
    out = np.zeros(n, np.int64)
    for k in range(width):
        out = out << 8 | x[skip + k : skip + k + n]
    return out


def gram_counts(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ORDER + 1 bytes within the framed texts, as numbers, and their counts."""
    return np.unique(np.concatenate([packed(a, ORDER + 1) for a in parts]), return_counts=True)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (is training, text): rows (gram, word, n) with either a gram or a word, summed as far as memory allows."""
    words: Counter = Counter()
    grams: dict[int, int] = {}
    waiting: list[np.ndarray] = []
    size = ends = read = 0

    def rows(table: dict, of_words: bool) -> pa.RecordBatch:
        keys, nothing = list(table), pa.nulls(len(table), pa.int64() if of_words else pa.binary())
        return pa.RecordBatch.from_arrays([nothing if of_words else pa.array(keys, pa.int64()), pa.array(keys, pa.binary()) if of_words else nothing, pa.array(list(table.values()), pa.int64())], names=["gram", "word", "n"])

    def fold() -> None:
        for key, n in zip(*(x.tolist() for x in gram_counts(waiting)), strict=True):
            grams[key] = grams.get(key, 0) + n
        waiting.clear()

    for batch in batches:
        for training, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if not training:
                continue
            raw = (raw or b"").lower()  # of bytes: A-Z alone
            ends += 1
            words.update(raw.split())
            read += len(raw)
            whole = framed(raw)
            for k in range(0, len(raw) + 1, SLICE):  # a long text in parts that overlap by the context
                waiting.append(whole[k : k + SLICE + ORDER])
                size += len(waiting[-1])
                if size >= SLICE:
                    fold()
                    size = 0
            if len(grams) > HELD:
                yield rows(grams, False)
                grams.clear()
            if len(words) > HELD or read > HELD_BYTES:
                yield rows(words, True)
                words.clear()
                read = 0
    if waiting:
        fold()
    yield rows(grams, False)
    yield rows(words, True)
    yield rows({b"\n": ends}, True)  # no word holds a line feed: the count of ends


@dataclass
class Model:
    """table[row, column[byte]]: log10 probability. Rows: 256 contexts of one byte, then `contexts` of two, of three, ...

    Bytes that no training text holds share one column: no context tells them apart. one: counts by byte and the byte after.
    """

    table: np.ndarray
    column: np.ndarray
    contexts: dict[int, np.ndarray]
    one: np.ndarray


class Finder:
    """The row of the longest context of the model that ends at a place: an array over three bytes, a hash table beyond."""

    def __init__(self, model: Model):
        self.flat, self.column, self.width = model.table.reshape(-1), model.column.astype(np.int64), model.table.shape[1]
        two, three = model.contexts[2], model.contexts[3]
        self.longest = 256 + len(two) + len(three)  # rows from here on are of the longest contexts
        self.rows = np.broadcast_to(np.arange(256, dtype=np.int32), (1 << 16, 256)).copy().reshape(-1)
        self.rows.reshape(256, 1 << 16)[:, two] = 256 + np.arange(len(two), dtype=np.int32)
        self.rows[three] = 256 + len(two) + np.arange(len(three), dtype=np.int32)
        four = model.contexts[4]
        self.bits = max(8, int(len(four) * 8).bit_length())
        self.keys, self.at, self.reach = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32), 0
        slots = self.slot(four)
        for k, (key, slot) in enumerate(zip(four.tolist(), slots.tolist(), strict=True)):
            step = 0
            while self.keys[(slot + step) & ((1 << self.bits) - 1)] >= 0:
                step += 1
            place = (slot + step) & ((1 << self.bits) - 1)
            self.keys[place], self.at[place], self.reach = key, 256 + len(two) + len(three) + k, max(self.reach, step)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def row(self, a: np.ndarray) -> np.ndarray:
        """For each byte of a framed text after the marks."""
        out = self.rows[packed(a, 3, 1)].astype(np.int64)
        four = packed(a, 4)
        slot, left = self.slot(four), None
        for step in range(self.reach + 1):
            where = slot if left is None else (slot[left] + step) & ((1 << self.bits) - 1)
            key, want = self.keys[where], four if left is None else four[left]
            hit, open_ = key == want, (key != want) & (key >= 0)
            out[hit if left is None else left[hit]] = self.at[where[hit]]
            left = np.nonzero(open_)[0] if left is None else left[open_]
            if not len(left):
                break
        return out


def blend(levels: list[np.ndarray]) -> np.ndarray:
    """Probabilities of 256 bytes, for each row: levels[0] has the counts in the longest context, the last those of the empty one."""
    n = len(levels[0])
    out, left, free = np.zeros((n, 256)), np.ones((n, 1)), np.ones((n, 256), bool)
    for counts in levels:
        own = np.where(free, counts, 0)
        seen, kinds = own.sum(1, keepdims=True), (own > 0).sum(1, keepdims=True)
        rest = free.sum(1, keepdims=True) > kinds  # something to escape to
        base = np.where(seen > 0, seen + kinds * rest, 1)
        out += left * own / base
        left = np.where(seen > 0, left * kinds * rest / base, left)
        free &= ~(own > 0)
    count = free.sum(1, keepdims=True)
    return out + np.where(free, left / np.maximum(count, 1), 0)


def resolve(pairs: dict[int, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of (context * 256 + byte, count) pairs for contexts of each length from one to ORDER."""
    one = np.zeros((256, 256))
    for key, n in zip(*(np.asarray(x).tolist() for x in pairs[1]), strict=True):
        one[key >> 8, key & 255] = n
    seen = np.nonzero(one.sum(0))[0]
    column = np.full(256, len(seen), np.uint8 if len(seen) < 256 else np.int16)
    column[seen] = np.arange(len(seen))
    width = min(len(seen) + 1, 256)
    shown = np.append(seen, np.setdiff1d(np.arange(256), seen)[:1]).astype(int)  # one byte stands for all unseen ones
    empty = one.sum(0, keepdims=True)
    counts: dict[int, np.ndarray] = {1: one}
    contexts: dict[int, np.ndarray] = {1: np.arange(256)}
    for k in range(2, ORDER + 1):
        keys, n = np.asarray(pairs[k][0], np.int64), np.asarray(pairs[k][1], np.float64)
        contexts[k], row = np.unique(keys >> 8, return_inverse=True)
        sparse = np.zeros((len(contexts[k]), width), np.float32)
        sparse[row, column[keys & 255]] = n
        counts[k] = sparse
    table = np.empty((sum(map(len, contexts.values())), width), np.float32)

    def level(k: int, ends: np.ndarray) -> np.ndarray:
        """Counts in the contexts of k bytes that these end with; none where the model lacks the context."""
        if k == 0:
            return np.repeat(empty, len(ends), 0)
        own = ends & ((1 << 8 * k) - 1)
        if k == 1:
            return one[own]
        at = np.searchsorted(contexts[k], own)
        at[at == len(contexts[k])] = 0
        out = np.zeros((len(ends), 256))
        if len(contexts[k]):
            there = contexts[k][at] == own
            out[np.ix_(there, seen)] = counts[k][at[there]][:, : len(seen)]
        return out

    at = 0
    for k in range(1, ORDER + 1):
        for start in range(0, len(contexts[k]), 1024):
            ends = contexts[k][start : start + 1024]
            table[at : at + len(ends)] = np.log10(blend([level(j, ends) for j in range(k, -1, -1)]))[:, shown]
            at += len(ends)
    return Model(table, column, {k: c for k, c in contexts.items() if k > 1}, one)


def log10_probability(raw: bytes, finder: Finder) -> tuple[float, np.ndarray, np.ndarray]:
    """Of a lower-cased text and its end: the sum over places whose longest context the finder has, then the runs of
    ORDER + 1 bytes of all other places and how often they come (those of each SLICE by themselves)."""
    a, total, keys, times = framed(raw), 0.0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(a) - ORDER, SLICE):
        part = a[k : k + SLICE + ORDER]
        row = finder.row(part)
        there = row >= finder.longest
        total += float(finder.flat[(row * finder.width + finder.column[part[ORDER:]])[there]].sum(dtype=np.float64))
        if not there.all():
            key, n = np.unique(packed(part, ORDER + 1)[~there], return_counts=True)
            keys.append(key), times.append(n)
    return total, np.concatenate(keys), np.concatenate(times)


def gather(docs: DataFrame, text: str, training) -> tuple[DataFrame, DataFrame]:
    """Tables of all training texts, written: grams (gram, n) and words (word, n); the word of one line feed has the count of texts.

    Each task sums what it can; sums meet by key, which no text and no source can make hot.
    """
    plain = docs.select(training.alias("__training"), F.col(text).alias("__text"))
    found = stored(arrow_pass(plain, _statistics, "gram long, word binary, n long"), "lm-partial")
    grams = found.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    words = found.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(grams, "lm-grams"), stored(words, "lm-words")


def _keyed(grams: DataFrame, width: int) -> DataFrame:
    """(context, key, n) of contexts of `width` bytes, key being context * 256 + byte."""
    keyed = grams.groupBy(F.col("gram").bitwiseAND((1 << 8 * (width + 1)) - 1).alias("key")).agg(F.sum("n").alias("n"))
    return keyed.select(F.shiftright("key", 8).alias("context"), "key", "n")


def model_of(grams: DataFrame) -> Model:
    """Collects the counts of the CACHED most frequent longest contexts and of the shorter ones that these end with, which are
    all that their distributions need."""
    spark, pairs, ends = grams.sparkSession, {}, None
    for width in range(ORDER, 0, -1):
        keyed = _keyed(grams, width)
        if width == ORDER:
            best = keyed.groupBy("context").agg(F.sum("n").alias("m")).orderBy(F.desc("m"), "context").limit(CACHED)
            ends = best.select("context").toArrow()["context"].to_numpy()
        if width > 1:
            ends = np.unique(ends & ((1 << 8 * width) - 1))
            keyed = keyed.join(F.broadcast(spark.createDataFrame(pa.table({"context": pa.array(ends, pa.int64())}))), "context")
        got = keyed.select("key", "n").toArrow()
        pairs[width] = got["key"].to_numpy(), got["n"].to_numpy()
    return resolve(pairs)


def _resolved(one: np.ndarray):
    """From (context, bytes, of 4, of 3, of 2: lists of (byte, n) or null): (gram, value), the log10 probability of each byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            context = batch.column(0).to_numpy()
            rows = lambda column: np.repeat(np.arange(n), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))  # noqa: B023, E731
            levels = []
            for k in range(2, 2 + ORDER - 1):
                column, counts = batch.column(k), np.zeros((n, 256))
                flat = column.flatten()
                counts[rows(column), flat.field(0).to_numpy()] = flat.field(1).to_numpy()
                levels.append(counts)
            levels += [one[context & 255], np.repeat(one.sum(0, keepdims=True), n, 0)]
            at, byte = rows(batch.column(1)), batch.column(1).flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(context[at] << 8 | byte), pa.array(np.log10(blend(levels)[at, byte]))], names=["gram", "value"])

    return run


def resolved(wanted: DataFrame, grams: DataFrame, one: np.ndarray) -> DataFrame:
    """(gram, value) of each wanted gram, from the counts of all contexts that it ends with; stored."""
    need = wanted.select("gram").distinct().groupBy(F.shiftright("gram", 8).alias("context")).agg(F.collect_list(F.col("gram").bitwiseAND(255)).alias("bytes"))
    for width in range(ORDER, 1, -1):
        of = _keyed(grams, width).groupBy(F.col("context").alias(f"c{width}")).agg(F.collect_list(F.struct(F.col("key").bitwiseAND(255).alias("byte"), "n")).alias(f"v{width}"))
        need = need.withColumn("ends", F.col("context").bitwiseAND((1 << 8 * width) - 1))
        if width == 2:  # very many contexts end with the same two bytes, of which there are 65,536 at most
            need = salted(need, "ends", "context", of, "c2", SALTS, "left")
        else:
            need = need.join(of, F.col("ends") == F.col(f"c{width}"), "left")
        need = need.drop("ends", f"c{width}")
    found = arrow_pass(need.select("context", "bytes", *(f"v{k}" for k in range(ORDER, 1, -1))), _resolved(one), "gram long, value double")
    return stored(found, "lm-resolved")


def lm_scores(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", mod: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Null texts are empty: one token, the end. Rows that repeat are scored each; null ids train. Without training texts
    no token is known, base scores are 0 and the model gives each byte 1/256. Other columns aren't read.
    """
    spark = docs.sparkSession
    remainder = F.coalesce(F.pmod(crc_of_id(F.col(doc_id)), F.lit(mod)), F.lit(-1))
    grams, words = gather(docs, text, remainder != held)
    local = model_of(grams)
    model = spark.sparkContext.broadcast(local)
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count_if(F.col("n") > 0).alias("V"), F.coalesce(F.max(F.when(F.col("word") == F.lit(b"\n"), F.col("n"))), F.lit(0)).alias("ends")).first()
    total, distinct, ends = sums["N"], sums["V"], sums["ends"]
    real = words.where(F.col("word") != F.lit(b"\n"))
    short = real.where(F.octet_length("word") <= HOT_BYTES)
    hot = spark.sparkContext.broadcast(dict(map(tuple, short.orderBy(F.desc("n"), "word").limit(HOT_WORDS).select(F.col("word"), "n").toArrow().to_pandas().itertuples(index=False))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, place, row = {w: math.log10(n + 1) for w, n in hot.value.items()}, None, TaskContext.get().partitionId() << 36
        for batch in batches:
            if place is None:
                place = Finder(model.value)
            cols = [[] for _ in range(9)]
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                raw = (raw or b"").lower()
                tokens = raw.split()
                counts, base, sure, rare, times = Counter(tokens), math.log10(ends + 1), int(ends > 0), [], []
                for w, n in counts.items():
                    if (value := known.get(w)) is not None:
                        base += n * value
                        sure += n
                    else:
                        rare.append(w)
                        times.append(n)
                for c, v in zip(cols, (row, len(tokens) + 1, sure, base, rare, times, *log10_probability(raw, place)), strict=True):
                    c.append(v)
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["id", "row", "n_tokens", "known", "base", "rare", "times", "score", "grams", "gram_times"])

    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("__text"))
    scored = stored(arrow_pass(plain, score, f"id {dict(plain.dtypes)['id']}, row long, n_tokens long, known long, base double, rare array<binary>, times array<long>, score double, grams array<long>, gram_times array<long>"), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    found = rare.join(real, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_base"), F.sum("times").alias("rare_known"))
    missed = scored.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select("row", F.col("g.grams").alias("gram"), F.col("g.gram_times").alias("times"))
    values = missed.join(resolved(missed, grams, local.one), "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("missed_score"))
    whole = F.lit(math.log10(total + distinct + 1))
    return (
        scored.select("id", "row", "n_tokens", "known", "base", "score")
        .join(found, "row", "left")
        .join(values, "row", "left")
        .select(
            F.col("id").alias("doc_id"),
            (F.coalesce(F.pmod(crc_of_id(F.col("id")), F.lit(mod)), F.lit(-1)) == held).alias("held_out"),
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
            (F.col("score") + F.coalesce("missed_score", F.lit(0.0))).alias("score"),
        )
    )
