"""Spelling variants: words that differ by one letter inserted, deleted or replaced, grouped without pairs.

Replacements: a word of n letters is in n wildcard groups, one for each place, named by the place and by what stands before
and after it. A group holds one word for each letter at most, so it never grows with the data. It keeps its size and its two
best words, and gives each member its neighbours' number and the best that isn't itself. Insertions and deletions: each word
less one letter is looked up in the vocabulary, which has it once at most. What all these give a word is added up; the best
wins. No step emits the pairs of a group.

Words travel as numbers in code-point order, so that ties need no text. What names the groups of very long words are hashes of
the parts before and after, since the parts themselves would take the square of the length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import arrow_pass, stored

#: Code points from which on parts of words are named by hashes.
LONG = 64
#: Words that one task takes apart.
TOGETHER = 1 << 16
#: Words, and their bytes, whose counts a task holds before it hands them on.
HELD, HELD_BYTES = 200_000, 32 << 20
_MODULUS = (1 << 127) - 1


def run_pattern(least: int) -> re.Pattern:
    """Maximal runs of letters, of `least` at least, in texts whose A-Z are small letters."""
    return re.compile(rf"(?<![a-zÀ-ÿ])[a-zÀ-ÿ]{{{least},}}+")


def typed(run: bytes, seed: int, letters: int, every: int) -> str:
    """What a run became: less the letter at h % letters, if `every` divides h, the crc32 of the id, a colon and the run."""
    h = zlib.crc32(run, seed)
    word = run.decode()
    if h % every:
        return word
    at = h % letters
    return word[:at] + word[at + 1 :]


def counted_words(docs: DataFrame, *, doc_id: str, text: str, least: int, every: int, times: int) -> DataFrame:
    """(word, n) of the words of `least` code points and `times` occurrences at least; one pass, and one shuffle of summed counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held, size = run_pattern(least), Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not raw:
                    continue
                seed = None if key is None else zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs.findall(raw.lower().decode("utf-8", "replace"))).items():
                    now = word if seed is None else typed(word.encode(), seed, len(word), every)
                    if len(now) >= least:
                        size += 0 if now in held else len(now)
                        held[now] += n
                if len(held) >= HELD or size >= HELD_BYTES:
                    yield out()
                    held, size = Counter(), 0
        if held:
            yield out()

    found = arrow_pass(docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("t")), run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def prefix_hashes(word: str) -> list[int]:
    """Polynomial hashes of all beginnings of a word, of 127 bits."""
    out = [0]
    for c in word:
        out.append((out[-1] * _BASE + ord(c) + 1) % _MODULUS)
    return out


_BASE = int.from_bytes(xxhash.xxh3_128_digest(b"spelling variants"), "big") % _MODULUS


def name_of(word: str) -> str:
    """What a whole word is looked up by: itself, or for long words its length and hash."""
    return word if len(word) <= LONG else f"{len(word)}#{prefix_hashes(word)[-1]:x}"


def parts(word: str) -> Iterator[tuple[int, str, str, str | None]]:
    """(place, before, after, name of the word less that letter) for each letter.

    Of equal letters in a row only the first gives a name: without any of them the word is the same.
    """
    n = len(word)
    if n <= LONG:
        for i in range(n):
            yield i, word[:i], word[i + 1 :], None if i and word[i] == word[i - 1] else word[:i] + word[i + 1 :]
        return
    before, after, power = prefix_hashes(word), 0, 1
    rows = []
    for i in range(n - 1, -1, -1):
        less = None
        if not i or word[i] != word[i - 1]:
            less = word[:i] + word[i + 1 :] if n - 1 <= LONG else f"{n - 1}#{(before[i] * power + after) % _MODULUS:x}"
        rows.append((i, f"#{before[i]:x}", f"{n}#{after:x}", less))
        after, power = (after + (ord(word[i]) + 1) * power) % _MODULUS, power * _BASE % _MODULUS
    yield from reversed(rows)


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (wid, word, n): one row for each letter of each word."""
    for batch in batches:
        rows: list[tuple] = []
        for wid, word, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            for part in parts(word):
                rows.append((wid, n, *part))
                if len(rows) >= 1 << 16:
                    yield _part_rows(rows)
                    rows = []
        yield _part_rows(rows)


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["wid", "n", "place", "before", "after", "less"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (wid, word, n): what a word is looked up by."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([name_of(w) for w in batch.column(1).to_pylist()], pa.string())], names=["to", "m", "name"])


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(wid, n_near, best) of the words (wid, word, n) that have a neighbour; best is (-n, wid) of the most frequent, least in order."""
    # a word makes some ten rows: what is one small file is work for several tasks
    dealt = vocabulary.repartition(-(-vocabulary.count() // TOGETHER) or 1, "wid")
    rows = stored(arrow_pass(dealt, _parted, "wid long, n long, place int, before string, after string, less string", 4096), "spell-parts")
    group = W.partitionBy("place", "before", "after")
    best = group.orderBy(F.desc("n"), "wid").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rank = lambda n, wid: F.struct((-F.col(n)).alias("less"), F.col(wid).alias("wid"))
    # a group holds no more words than there are letters
    replaced = (
        rows.select("place", "before", "after", "n", "wid", rank("n", "wid").alias("own"))
        .withColumn("size", F.count(F.lit(1)).over(group)).withColumn("first", F.first("own").over(best)).withColumn("second", F.nth_value("own", 2).over(best))
        .where("size > 1")
        .select("wid", (F.col("size") - 1).alias("near"), F.when(F.col("first.wid") == F.col("wid"), F.col("second")).otherwise(F.col("first")).alias("best"))
    )
    names = arrow_pass(vocabulary, _named, "to long, m long, name string", 4096)
    shorter = rows.where("less is not null").select("wid", "n", "less").join(names, F.col("less") == F.col("name"))
    # each row tells either word of the other
    either = F.explode(F.array(F.struct(F.col("wid").alias("wid"), rank("m", "to").alias("best")), F.struct(F.col("to").alias("wid"), rank("n", "wid").alias("best"))))
    moved = shorter.select(either.alias("of")).select("of.wid", F.lit(1).cast("long").alias("near"), "of.best")
    return replaced.unionByName(moved).groupBy("wid").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(wid, root) of the words that have a form (wid, form): the end of the way from form to form.

    From the ends backwards, one step a round. Each step multiplies the count by `ratio` at least, so rounds are few; no more
    words share a form than it has neighbours.
    """
    level = stored(forms.join(forms.select(F.col("wid").alias("__has")), F.col("form") == F.col("__has"), "left_anti").select("wid", F.col("form").alias("root")), "spell-roots")
    every = level
    while level.limit(1).count():
        up = level.select(F.col("wid").alias("__to"), "root")
        level = stored(forms.join(up, F.col("form") == F.col("__to")).select("wid", "root"), "spell-roots")
        every = every.unionByName(level)
    return every


def spelling_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 7, times: int = 2, ratio: int = 10, every: int = 31) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `least` code points and `times` occurrences at least.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in small letters; in one of `every` pairs of a document and a run, by
    crc32, the run loses a letter. A word's form is its most frequent near word (ties: the first in code-point order), if it
    comes `ratio` times as often or more (above 1). A null text has no words; runs of a row without an id stay as they are.
    Rows that repeat count each. Texts of any length are worked on whole, and words of any length: those of more than LONG
    code points meet by hashes of 127 bits of their parts. Without words the result is empty. Other columns aren't read.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent: ratio must be 2 at least")
    counted = counted_words(docs, doc_id=doc_id, text=text, least=least, every=every, times=times)
    # numbers that rise with the word: partitions are ranges of words
    vocabulary = stored(counted.orderBy("word").withColumn("wid", F.monotonically_increasing_id()).select("wid", "word", "n"), "spell-words")
    near = stored(neighbours(vocabulary), "spell-near")
    own = vocabulary.join(near.withColumnRenamed("wid", "__wid"), F.col("wid") == F.col("__wid"), "left").drop("__wid")
    fits = -F.col("best.less") >= ratio * F.col("n")
    own = stored(own.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.wid")).alias("form_id"), F.when(fits, -F.col("best.less")).alias("form_n")), "spell-own")
    of = roots(own.where("form_id is not null").select("wid", F.col("form_id").alias("form"))).select(F.col("wid").alias("__wid"), F.col("root").alias("root_id"))
    text_of = lambda name: vocabulary.select(F.col("wid").alias(f"__{name}"), F.col("word").alias(name))
    out = own.join(of, F.col("wid") == F.col("__wid"), "left").join(text_of("form"), F.col("form_id") == F.col("__form"), "left").join(text_of("root"), F.col("root_id") == F.col("__root"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
