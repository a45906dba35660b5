"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Spark's higher-order functions fold the ranked merges over the bytes of distinct words, with the ranks as arrays. An
Arrow pass splits texts and numbers their words, new ones listed, a row for each batch of texts; Spark joins that with the one
row of the ranks and folds what is listed; a second Arrow pass puts the ids in the words' places. A dictionary of frequent words, folded alike, spares most repetitions. Decoding concatenates the binary
pieces of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import arrow_pass, stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words in the dictionary, texts it is chosen from, and words a worker remembers beside it. None of these changes an id.
DICTIONARY, DICTIONARY_TEXTS, REMEMBERED = 262_144, 32_768, 400_000
#: Words of more code points are cut where no piece of the vocabulary crosses; parts of more bytes are folded by rounds.
LONG, ROUNDS = 64, 128
#: Code points that a task remembers, and places of words that it turns into ids at once.
_REMEMBERED_CHARS, _PLACES = 1 << 24, 1 << 20
#: Groups of the dictionary's words, and rows of one Arrow batch of their counts.
_PACKS, _SLICE = 1024, 1 << 16
#: Places of the table of pairs for each of them, those that are tried at once, and what free ones hold; buckets of the table of whole words.
_PLACES_EACH, _TRIES, _FREE, _WHOLE = 4, 1 << 16, 1 << 62, 16_384
#: Ids have 20 bits; the highest of them is no rank.
_SHIFT, _NO_RANK = 1 << 20, (1 << 20) - 1


#: Arrays that rank_map() makes of the ranks.
_KINDS = "begins array<bigint>, rows array<bigint>, two array<bigint>, whole array<array<string>>, ids array<array<int>>"


@lru_cache(maxsize=4)
def ranks(path: str | None = None) -> dict[bytes, int]:
    """Ranks of byte pieces, from a local file of the driver."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _placed(pairs: dict[int, dict[int, int]]) -> tuple[list[int | None], np.ndarray]:
    """Where the row of each left id begins, and the rows laid over each other: at begin + right is left << 20 | rank.

    Rows are put where none of their places is taken, longest first; free places hold what is no entry of any row.
    """
    size = _PLACES_EACH * max(sum(map(len, pairs.values())), 1)
    rows, begins = np.full(2 * size + max(map(max, pairs.values()), default=0), _FREE, np.int64), [None] * (1 + max(pairs, default=0))
    for left, row in sorted(pairs.items(), key=lambda r: (-len(r[1]), r[0])):
        rights, values = np.fromiter(row.keys(), np.int64, len(row)), np.fromiter(row.values(), np.int64, len(row))
        start, tries = left * 7919 % size, 16
        while not (free := (rows[np.arange(start, start + tries)[:, None] + rights] == _FREE).all(1)).any():
            start, tries = start + tries, max(16, min(2 * tries, _TRIES // len(rights)))
        begins[left] = start + int(free.argmax())
        rows[begins[left] + rights] = (left << 20) | values
    rows = rows[: np.flatnonzero(rows != _FREE).max(initial=0) + 1]
    return begins, rows


def rank_map(table: dict[bytes, int]) -> pa.Table:
    """The ranks as one row: of pairs of neighbours by their ids, of pairs of bytes, and of whole words by their bytes."""
    if table and max(table.values()) >= _NO_RANK:
        raise ValueError("ranks are too large")
    pairs: dict[int, dict[int, int]] = {}
    whole: list[list[str]] = [[] for _ in range(_WHOLE)]
    ids: list[list[int]] = [[] for _ in range(_WHOLE)]
    for piece, rank in table.items():
        part = zlib.crc32(piece) % _WHOLE
        whole[part].append(piece.hex().upper())
        ids[part].append(rank)
        for at in range(1, len(piece)):
            left, right = table.get(piece[:at]), table.get(piece[at:])
            if left is not None and right is not None:
                pairs.setdefault(left, {})[right] = rank
    begins, rows = _placed(pairs)
    bytes_ = [table.get(bytes([k])) for k in range(256)]
    # by two bytes, 256 for none: the first state of the first; the edge's is last
    two = [None if bytes_[k] is None else table.get(bytes([k, n]) if n < 256 else b"", _NO_RANK) << 40 | bytes_[k] for k in range(256) for n in range(257)]
    found = {"begins": pa.array(begins, pa.int64()), "rows": pa.array(rows), "two": pa.array(two, pa.int64()), "whole": pa.array(whole, pa.list_(pa.string())), "ids": pa.array(ids, pa.list_(pa.int32()))}
    return pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in found.items()})


def fold_merges(word: Column, table: Column | pa.Table, whole: Column | None = None) -> Column:
    """Ids of one word's UTF-8 bytes: the ranked merges, folded by higher-order functions. Null for null, empty for "".

    State: a number for each piece so far, from its highest bits: the rank of the pair with the next piece, which is the id of
    the joined one, where it begins, and its id. A step joins the pair of the least number, so the leftmost of the least rank;
    a word of n bytes takes n - 1 steps at most. In words of more than ROUNDS bytes a step joins all pairs of the least rank,
    wherever that comes to the same; their state has ids and ranks as two arrays.
    table: a struct with the columns of rank_map(), or what rank_map() returns, which becomes a literal.
    whole: false where the word is part of a longer one, so that it isn't an id only because it is in the vocabulary.
    """
    if isinstance(table, pa.Table):
        table = F.from_json(F.lit(json.dumps(table.to_pylist()[0])), _KINDS)
    return F.element_at(fold_all(F.array(word), table, lambda w: w, lambda w: F.lit(True) if whole is None else whole), 1)


def fold_all(words: Column, table: Column, word: Callable[[Column], Column], whole: Callable[[Column], Column]) -> Column:
    """fold_merges() of each of an array's elements; `word` and `whole` say what of an element is which."""
    # each array of the table is bound once, for all words
    def bound(names: list[str], arrays: dict[str, Column]) -> Column:
        if names:
            return _let(table[names[0]], lambda c: bound(names[1:], {**arrays, names[0]: c}))
        return F.transform(words, lambda x: _folded(word(x), arrays, whole(x)))

    return bound(["begins", "rows", "two", "whole", "ids"], {})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _folded(word: Column, table: dict[str, Column], whole: Column) -> Column:
    big = lambda x: F.lit(x).cast("bigint")
    piece = lambda x: x.bitwiseAND(big(_SHIFT - 1))

    def rank(left: Column, right: Column) -> Column:
        """Of a pair, _NO_RANK for none: what is there for another left id differs from this one above the bits of a rank."""
        there = F.get(table["rows"], F.get(table["begins"], left) + right)
        return F.least(there.bitwiseXOR(F.shiftleft(left, 20)), big(_NO_RANK))

    def some(found: Column) -> Column:
        return _let(found, lambda r: F.when(r < _NO_RANK, r))

    def state(pieces: Column, pairs: Column) -> Column:
        return F.struct(pieces.alias("p"), pairs.alias("r"))

    def step(so_far: Column, _: Column) -> Column:
        def join(least: Column) -> Column:
            new, low = F.shiftright(least, 40), lambda x: x.bitwiseAND(big((1 << 40) - 1))
            first = F.shiftright(least, 20).bitwiseAND(big(_SHIFT - 1)).cast("int")

            def at(j: Column) -> Column:
                here = lambda i: F.shiftleft(rank(new, piece(F.get(so_far, i + 2))), 40).bitwiseOR(F.shiftleft(i.cast("bigint"), 20)).bitwiseOR(new)
                before = lambda x: F.shiftleft(rank(piece(x), new), 40).bitwiseOR(low(x))
                gone = big(-1)
                return F.array_remove(F.transform(so_far, lambda x, i: F.when(i > j + 1, x - big(_SHIFT)).when(i < j - 1, x).when(i == j, here(i)).when(i < j, before(x)).otherwise(gone)), gone)

            return _let(first, at)

        return _let(F.array_min(so_far), lambda m: F.when(m < big(_NO_RANK << 40), join(m)).otherwise(so_far))

    def all_at_once(so_far: Column, _: Column) -> Column:
        pieces, pairs = so_far["p"], so_far["r"]

        def joined(least: Column, here: Column) -> Column:
            marked = F.transform(pieces, lambda x, i: F.when(F.get(here, i), least).when(F.coalesce(F.get(here, i - 1), F.lit(False)), big(-1)).otherwise(x))
            return _let(F.filter(marked, lambda x: x >= 0), lambda p: state(p, neighbours(p)))

        def round_(least: Column) -> Column:
            # of pairs that overlap, the first, third and so on
            marks = F.array_join(F.transform(pairs, lambda r: F.when(r == least, F.lit("1")).otherwise(F.lit("0"))), "")
            every = F.transform(F.split(F.regexp_replace(marks, "11", "10"), ""), lambda c: c == "1")

            def checked(here: Column) -> Column:
                # one by one it comes to the same unless a join makes a pair of lower rank, be it for a while
                between = F.array_min(F.transform(here, lambda h, i: F.when(h, some(rank(least, F.get(pieces, i + 2))))))
                first = F.array_position(pairs, least).cast("int") - 1
                alike = lambda new: F.coalesce(F.least(between, F.array_min(new["r"])) > least, F.lit(True))
                return _let(joined(least, here), lambda new: F.when(alike(new), new).otherwise(joined(least, F.transform(pairs, lambda _, i: i == first))))

            return _let(every, checked)

        # once there is nothing to join, no later step looks at the pieces
        ended = state(pieces, F.array().cast("array<bigint>"))
        return F.when(F.size(pairs) == 0, so_far).otherwise(_let(F.array_min(pairs), lambda m: F.when(m.isNull(), ended).otherwise(round_(m))))

    def neighbours(pieces: Column) -> Column:
        return F.transform(pieces, lambda x, i: some(rank(x, F.get(pieces, i + 1))))

    def start(raw: Column) -> Column:
        steps = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
        # each byte as one character, so that strings are split by bytes
        codes = F.transform(F.split(F.decode(raw, "iso-8859-1"), ""), F.ascii)
        two = lambda c, x, i: F.get(table["two"], x * 257 + F.coalesce(F.get(c, i + 1), F.lit(256)))
        row = lambda c, edge: F.transform(c, lambda x, i: two(c, x, i).bitwiseOR(F.shiftleft((i + edge).cast("bigint"), 20)))
        short = _let(codes, lambda c: F.aggregate(steps, row(c, 0), step, lambda s: F.transform(s, piece)))
        long = _let(_let(codes, lambda c: F.transform(c, lambda x: piece(F.get(table["two"], x * 257)))), lambda p: F.aggregate(steps, state(p, neighbours(p)), all_at_once, lambda s: s["p"]))
        part = F.crc32(raw) % _WHOLE
        known = F.get(F.get(table["ids"], part), F.array_position(F.get(table["whole"], part), F.hex(raw)).cast("int") - 1)
        folded = F.when(n <= ROUNDS, short).otherwise(long).cast("array<int>")
        return _let(F.when(whole, known), lambda k: F.when(k.isNotNull(), F.array(k)).otherwise(folded))

    n = F.octet_length(word)
    return F.when(word.isNull(), F.lit(None)).when(n == 0, F.array().cast("array<int>")).otherwise(_let(F.encode(word, "utf-8"), start))


def _pieces(table: dict[bytes, int]) -> list[str]:
    """Pieces by id, as digits."""
    pieces = sorted(table.items(), key=lambda p: p[1])
    if [r for _, r in pieces] != list(range(len(pieces))):
        raise ValueError("ranks have gaps")
    return [p.hex() for p, _ in pieces]


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of an array of ids, concatenated from their pieces by a literal table. Unknown ids raise."""
    return _let(F.from_json(F.lit(json.dumps(_pieces(ranks(path)))), "array<string>"), lambda t: _decoded(ids, t))


def _decoded(ids: Column, pieces: Column) -> Column:
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1)), ""))


def merged(piece: bytes, table: dict[bytes, int]) -> list[int]:
    """Ids of a piece of text by the same fold in plain Python, to compare with; encode() doesn't use it."""
    if (whole := table.get(piece)) is not None:
        return [whole]
    parts = [piece[k : k + 1] for k in range(len(piece))]
    none = 1 << 30
    pairs = [table.get(piece[k : k + 2], none) for k in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) < none:
        at = pairs.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = table.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = table.get(parts[at] + parts[at + 1], none)
    return [table[p] for p in parts]


def cut(word: str, table: dict[bytes, int], longest: int) -> list[str]:
    """The word in parts such that no piece of the vocabulary that occurs in it lies in two of them: no merge crosses a cut."""
    raw, parts, begun, clear = word.encode(), [], 0, 0
    for at in range(len(raw)):
        if at and at >= clear and raw[at] & 0xC0 != 0x80:
            parts.append(raw[begun:at].decode())
            begun = at
        # pieces that start here reach to clear at most
        clear = max(clear, next((at + n for n in range(min(longest, len(raw) - at), 1, -1) if raw[at : at + n] in table), 0))
    return [*parts, raw[begun:].decode()]


class Numbers(dict):
    """Words by number. A word that isn't there gets the next one and is listed in `fresh`, to be folded; parts of long words are 1-tuples."""

    def __init__(self, known: dict[str, int], table: dict[bytes, int]):
        super().__init__(known)
        self.known, self.table, self.longest = known, table, max(map(len, table), default=1)
        self.fresh, self.chars, self.long = [], 0, False

    def __missing__(self, word: str | tuple[str]) -> int:
        if len(word) > LONG:
            self.long = True
            return 0
        return self.add(word)

    def add(self, word: str | tuple[str]) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        self.chars += len(word[0] if isinstance(word, tuple) else word)
        return number

    def full(self) -> bool:
        return len(self) >= len(self.known) + REMEMBERED or self.chars >= _REMEMBERED_CHARS

    def forget(self) -> None:
        """Only the known words, once others are many: between texts."""
        if self.full():
            self.clear()
            self.update(self.known)
            self.chars = 0

    def places(self, words: list[str]) -> list[int]:
        self.long = False
        found = list(map(self.__getitem__, words))
        if not self.long:
            return found
        found = []
        for word in words:
            parts = cut(word, self.table, self.longest) if len(word) > LONG and word not in self else [word]
            if len(parts) > 1:
                found += [self[p] if p in self else self.add(p) for p in ((p,) for p in parts)]
            else:
                found.append(self[word] if word in self else self.add(word))
        return found


class Folded:
    """Ids by the number of their word, as they come from the fold."""

    def __init__(self, known: list[bytes] | pa.ListArray):
        if not isinstance(known, pa.ListArray):
            known = pa.array([np.frombuffer(k, "<i4") for k in known], pa.list_(pa.int32()))
        self.ids, self.ends = known.flatten().to_numpy().copy(), np.cumsum(np.concatenate([[0], pc.list_value_length(known).to_numpy()]))
        self.n, self.size = len(known), len(self.ids)

    def put(self, at: int, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The next words, of which the first has number `at`; what had this number or a higher one is gone."""
        if at > self.n:
            raise ValueError("words are missing")
        self.n, self.size = at, int(self.ends[at])
        if self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.size], np.empty(self.size + 2 * len(ids) + 1024, "<i4")])
        if self.n + len(sizes) >= len(self.ends):
            self.ends = np.concatenate([self.ends[: self.n + 1], np.empty(self.n + 2 * len(sizes) + 1024, np.int64)])
        self.ids[self.size : self.size + len(ids)] = ids
        self.ends[self.n + 1 : self.n + 1 + len(sizes)] = self.size + np.cumsum(sizes)
        self.n, self.size = self.n + len(sizes), self.size + len(ids)

    def look(self, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words, one after the other, and where each row's begin and end; `rows` says that for places."""
        starts = self.ends[places]
        ends = np.concatenate([[0], np.cumsum(self.ends[places + 1] - starts)])
        sizes = np.diff(ends)
        return self.ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])], ends[rows]


@lru_cache(maxsize=2)
def _splitter(pattern: str):
    return regex.compile(pattern).findall


def _rank_row(spark: SparkSession, table: dict[bytes, int], pieces: bool = False) -> DataFrame:
    """One row with the ranks (__ranks), and with `pieces` those by id (__pieces), written: plans that join it hold neither."""
    found = spark.createDataFrame(rank_map(table))
    columns = [F.struct(*found.columns).alias("__ranks")]
    if pieces:
        found = found.crossJoin(spark.createDataFrame(pa.table({"__pieces": [_pieces(table)]})))
        columns.append(F.col("__pieces"))
    return stored(found.select(*columns), "bpe-ranks", 1)


def dictionary(docs: DataFrame, text: str, ranks_: DataFrame, pattern: str) -> pa.Table:
    """Frequent words (w) and their ids, folded by Spark: at most DICTIONARY of them, counted in about DICTIONARY_TEXTS texts.

    They are all words of some count or a higher one, the least count at which they aren't too many.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = _splitter(pattern), Counter()

        def listed() -> Iterator[pa.RecordBatch]:
            found = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["w", "n"])
            yield from (found.slice(k, _SLICE) for k in range(0, found.num_rows, _SLICE))
            counts.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(w for w in find(t) if len(w) <= LONG)
                if len(counts) >= REMEMBERED:
                    yield from listed()
        yield from listed()

    spark = docs.sparkSession
    share = min(1.0, DICTIONARY_TEXTS / max(docs.count(), 1))
    texts = docs.select(F.col(text).alias("t")).where("t is not null")
    seen = arrow_pass(texts.sample(False, share, 1) if share < 1 else texts, count, "w string, n long")
    counts = stored(seen.where("octet_length(w) between 2 and 64").groupBy("w").agg(F.sum("n").alias("n")), "bpe-words")
    least, total = None, 0
    for r in sorted(counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["n"]):
        total += r["words"]
        if total > DICTIONARY:
            break
        least = r["n"]
    best = counts.where(F.col("n") >= F.lit(least)) if least is not None else counts.limit(0)
    # a row for some hundred words, since each row is joined with the ranks; dealt by number, for one task would fold all
    packs = best.withColumn("b", F.pmod(F.xxhash64("w"), F.lit(_PACKS))).repartition(4 * spark.sparkContext.defaultParallelism, "b").groupBy("b").agg(F.collect_list("w").alias("w"))
    folded = packs.crossJoin(F.broadcast(ranks_.select("__ranks"))).select("w", fold_all(F.col("w"), F.col("__ranks"), lambda w: w, lambda w: F.lit(True)).alias("ids")).toArrow()
    return pa.table({"w": folded["w"].combine_chunks().flatten(), "ids": folded["ids"].combine_chunks().flatten()})


def encode(docs: DataFrame, *keep: str, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN, ids: bool = True, digests: bool = False) -> DataFrame:
    """`keep` and n_tokens of each row; with ids the ids, with digests ids_sha256 and decoded_sha256 of the decoded ids.

    Null and empty texts have no tokens. Each match of the pattern is encoded by itself, over the whole text, without
    special tokens. Rows are encoded each for itself, without a shuffle. Columns not in `keep` don't matter.
    """
    spark: SparkSession = docs.sparkSession
    table = ranks(path)
    ranks_ = _rank_row(spark, table, digests)
    sent = spark.sparkContext.broadcast((dictionary(docs, text, ranks_, pattern), table))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = sent.value
        numbers, find = Numbers({w: k for k, w in enumerate(known["w"].to_pylist())}, own), _splitter(pattern)

        def row(texts: pa.RecordBatch, places: list[list[int]], first: int) -> pa.RecordBatch:
            at = np.cumsum([0, *map(len, places)])
            flat = np.fromiter(chain.from_iterable(places), np.int32, int(at[-1]))
            rows = [*texts.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))]
            message = pa.RecordBatch.from_arrays(rows, names=[*texts.schema.names[: len(keep)], "__places"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, message.schema) as out:
                out.write_batch(message)
            fresh = [(w[0], False) if isinstance(w, tuple) else (w, True) for w in numbers.fresh]
            columns = [pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([first], pa.int32()), pa.array([fresh], pa.list_(pa.struct([("w", pa.string()), ("whole", pa.bool_())])))]
            return pa.RecordBatch.from_arrays(columns, names=["__texts", "__first", "__fresh"])

        for batch in batches:
            begun, places, n = 0, [], 0
            for k, t in enumerate([*batch.column(len(keep)).to_pylist(), ""]):
                if k == batch.num_rows or n >= _PLACES or numbers.full():
                    if places:
                        yield row(batch.slice(begun, k - begun), places, first)
                    begun, places, n = k, [], 0
                if not places:
                    numbers.forget()
                    numbers.fresh, first = [], len(numbers)
                places.append(numbers.places(find(t)) if t else [])
                n += len(places[-1])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = Folded(sent.value[0]["ids"].combine_chunks())
        for batch in batches:
            for k in range(batch.num_rows):
                rows = pa.ipc.open_stream(batch.column(0)[k].as_buffer()).read_next_batch()
                words = batch.column(2).slice(k, 1).flatten()
                values = words.flatten()
                if words.null_count or values.null_count:
                    raise ValueError("the vocabulary lacks a byte")
                folded.put(batch.column(1)[k].as_py(), values.to_numpy(), pc.list_value_length(words).to_numpy())
                places = rows.column(len(keep))
                found, at = folded.look(places.values.to_numpy(), places.offsets.to_numpy())
                columns, names = [pa.array(np.diff(at), pa.int64())], ["n_tokens"]
                if ids or digests:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found, pa.int32())))
                    names.append("ids")
                if digests:
                    columns.append(pa.array([hashlib.sha256(found[i:j]).hexdigest() for i, j in pairwise(at)], pa.string()))
                    names.append("ids_sha256")
                columns, names = [*rows.columns[: len(keep)], *columns], [*rows.schema.names[: len(keep)], *names]
                if digests:  # still one row, which the pieces are joined with
                    columns, names = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), pa.StructArray.from_arrays(columns, names=names))], ["__rows"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    plain = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    kept = [f"`{f.name}`: {f.dataType.simpleString()}" for f in plain.schema[:-1]]
    # a row for each batch of texts, which is joined with the row of the ranks
    cut_up = arrow_pass(plain, split, "__texts binary, __first int, __fresh array<struct<w:string,whole:boolean>>")
    fold = fold_all(F.col("__fresh"), F.col("__ranks"), lambda x: x["w"], lambda x: x["whole"])
    fields = [*kept, "n_tokens: long"] + ["ids: array<int>"] * (ids or digests) + ["ids_sha256: string"] * digests
    schema = f"__rows array<struct<{', '.join(fields)}>>" if digests else ", ".join(fields)
    found = arrow_pass(cut_up.crossJoin(F.broadcast(ranks_.select("__ranks"))).select("__texts", "__first", fold.alias("__fresh")), join, schema)
    if not digests:
        return found
    digest = lambda x: x.withField("decoded_sha256", F.sha2(_decoded(x["ids"], F.col("__pieces")), 256))
    found = found.crossJoin(F.broadcast(ranks_.select("__pieces"))).select(F.inline(F.transform("__rows", digest)))
    return found if ids else found.drop("ids")
