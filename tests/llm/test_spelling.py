"""Spelling groups against all edits of every word, pair by pair, and on odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillflow.llm import queries_tables, spelling
from rillflow.sources.tables import table

LETTERS = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]


def words_of(rows):
    """Counts of all words, by the contract's letter."""
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def edits(word):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in LETTERS}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in LETTERS} | {word[:i] + word[i + 1 :]}
    return out - {word}


def brute(n):
    """Rows by word, from all edits of it."""
    near = {w: [v for v in edits(w) if v in n] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]])
    return out


def rows_of(frame):
    got = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


def test_query_equals_all_edits(spark):
    folder = "/root/testdata/sf0.01"
    n = words_of([(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()])
    got = queries_tables.op12_spelling(spark, folder)
    assert [f.dataType.simpleString() for f in got.select("word", "form", "root", "n", "n_near", "form_n").schema] == ["string", "string", "string", "bigint", "bigint", "bigint"]
    got = rows_of(got)
    assert got == brute(n) and sum(f is not None for f, *_ in got.values()) > 5


def made(seed):
    """Texts of words that are near each other in all ways, chains of forms, ties, doubled letters and accents."""
    rng = random.Random(seed)
    stems = ["spelling", "spellling", "speling", "aaaaaaa", "aaaaaaaa", "aabbaabb", "éclairés", "eclaires", "ÿÿÿÿÿÿÿ", "bookkeeper", "bokkeeper"]
    bag = []
    for stem in stems:
        bag += [stem] * rng.choice([2, 3, 30, 400])
        for _ in range(12):
            i, c = rng.randrange(len(stem)), rng.choice("abeéÿ")
            bag += [rng.choice([stem[:i] + c + stem[i:], stem[:i] + stem[i + 1 :], stem[:i] + c + stem[i + 1 :]])] * rng.choice([1, 2, 3, 20, 40])
    bag += ["chainlike"] * 3 + ["chainlikee"] * 45 + ["chainlikeee"] * 1500
    rng.shuffle(bag)
    return [(k, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in bag[k::37])) for k in range(37)]


@pytest.mark.parametrize("seed", range(3))
def test_near_words_forms_and_roots(spark, seed):
    rows = made(seed)
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert got == brute(words_of(rows)) and any(f and r != f for f, r, *_ in got.values())  # with a way of two steps


def test_long_words(spark, monkeypatch):
    """Words beyond LONG letters meet by hashes, also one that a letter less brings below."""
    monkeypatch.setattr(spelling, "LONG", 9)  # the driver's, and so that of the local workers, who start after it
    rng = random.Random(5)
    stems = ["".join(rng.choice("abc") for _ in range(k)) for k in (8, 9, 10, 11, 40)]
    bag = [s for s in stems for _ in range(30)] + [w for s in stems for i in range(len(s)) for w in (s[:i] + s[i + 1 :], s[:i] + "d" + s[i:], s[:i] + "e" + s[i + 1 :]) for _ in range(2)]
    n = Counter(bag)
    for word in n:
        whole = {spelling.name_of(word[:i] + word[i + 1 :]) for i in range(len(word))}
        assert {less for *_, less in spelling.parts(word) if less is not None} == whole
    named, grouped = {}, {}
    for word in n:
        named.setdefault(spelling.name_of(word), set()).add(word)
        for place, before, after, _ in spelling.parts(word):
            grouped.setdefault((place, before, after), set()).add(word)
    assert all(len(w) == 1 for w in named.values())
    assert all(len({(w[:p], w[p + 1 :]) for w in members}) == 1 for (p, _, _), members in grouped.items())


def test_very_long_words(spark):
    word = "ab" * 4000
    rows = [(None, f"{word} " * 20), (None, f"{word[:-1]} {word[:-1]} {word[:77]}c{word[78:]} {word[:77]}c{word[78:]} tiny tiny")]
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {word: (None, word, 20, 2, None), word[:-1]: (word, word, 2, 1, 20), word[:77] + "c" + word[78:]: (word, word, 2, 1, 20)}


def test_odd_rows(spark):
    rows = [(None, "spelling spelling"), (1, None), (2, ""), (3, "spelling×÷spelling"), (3, "spelling×÷spelling"), (4, "tiny words only"), (5, "SPELLİNG \U0001f600spelling"), (5, "once upon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "form", "wid", "root")})
    got = rows_of(spelling.spelling_groups(docs))
    assert got == brute(words_of(rows)) and got["spelling"][2] == 3
    assert spelling.spelling_groups(docs.limit(0)).collect() == [] and spelling.spelling_groups(docs.where("doc_id = 4")).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_groups(docs, ratio=1)


def test_counts_are_handed_on_in_portions(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 2)
    rows = made(9)
    frame = spelling.counted_words(spark.createDataFrame(rows, "doc_id long, text string"), doc_id="doc_id", text="text", least=7, every=31, times=2)
    assert {r["word"]: r["n"] for r in frame.collect()} == words_of(rows)
