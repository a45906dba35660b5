"""Mixing, token counts, sharding, quality rules and encoding against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rillflow.llm import bpe, mixing, quality, sharding, token_counts
from rillflow.sources.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WS = " \t\n\v\f\r"


def words(text):
    out, word = [], ""
    for c in text or "":
        if c in WS:
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out + [word] * bool(word)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and long texts, null sources and ids, repeated rows."""
    texts = [None, "", " \n ", "one", "a b c", "x" * 60_000, "w " * 30_000, "same text here", "same text here", "é ü 漢字"]
    rows = [(k, t, "en", "s" if k % 3 else None, 1) for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], (None, "no id at all", None, "", None)], SCHEMA)


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """The excess reshared by weight until none is above its cap, as the contract tells it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_mixing(spark, sf, odd, which):
    docs = odd if which == "odd" else table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(docs, "doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(words(r["text"]))
        sizes[r["source"]] += r["size"]
    want = expected_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in (int(r["rate"] + 1e-12), int(r["rate"] + 1e-12) + 1) and r["copies"] * r["size"] <= 2 * r["size"]
    again = mixing.mix(docs.repartition(7), "doc_id", "text", "source").collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    emitted = Counter(r["doc_id"] for r in mixing.emit(docs).collect())
    taken = Counter()
    for r in rows:
        taken[r["doc_id"]] += r["copies"]
    assert emitted == +taken
    if which == "documents":
        total = sum(r["copies"] * r["size"] for r in rows)
        assert total == pytest.approx(1.5 * sum(sizes.values()), rel=0.03)


def test_mixing_beside_its_own_names(spark, odd):
    clash = odd.selectExpr("*", "1 as size", "2 as rate", "3 as target", "4 as copies", "5 as source_size")
    assert Counter(map(tuple, mixing.emit(clash).select(odd.columns).collect())) == Counter(map(tuple, mixing.emit(odd).collect()))
    assert Counter(map(tuple, mixing.mix(clash, "doc_id").collect())) == Counter(map(tuple, mixing.mix(odd, "doc_id").collect()))
    with pytest.raises(ValueError):
        mixing.emit(odd.selectExpr("*", "1 as __rate"))


def test_mixing_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty, "doc_id").count() == 0 and mixing.emit(empty).count() == 0


def test_rollup_commits_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "en", "v1", 5), ("a", "en", "v1", None), (None, "en", "v1", 7)], "source string, lang string, tokenizer string, tokens long")
    rollup = token_counts.TokenRollup(spark, f"{tmp_path}/r")
    assert rollup.totals().count() == 0
    assert rollup.commit("1", token_counts.inserts(rows)) and not rollup.commit("1", token_counts.inserts(rows))
    assert rollup.commit("2", token_counts.revisions(rows.where("tokens = 5").withColumn("old_tokens", F.lit(5)).withColumn("tokens", F.lit(9))))
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v1", 2, 9), (None, "en", "v1", 1, 7)}
    assert rollup.commit("3", token_counts.deletes(rows.where("source is null")))
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v1", 2, 9)}
    assert token_counts.TokenRollup(spark, f"{tmp_path}/r").committed() == ["1", "2", "3"]
    assert rollup.commit("4", token_counts.inserts(rows.limit(0))) and not rollup.commit("4", token_counts.inserts(rows))
    clash = rows.selectExpr("*", "9 as n_docs", "9 as n_tokens", "'x' as batch")
    assert rollup.commit("5", token_counts.inserts(clash), token_counts.deletes(clash))
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v1", 2, 9)}
    with pytest.raises(ValueError):
        rollup.commit("../x", token_counts.inserts(rows))


def test_of_two_writers_of_a_batch_one_commits(spark, tmp_path, monkeypatch):
    """The second looks before the first has committed, and moves its file after it."""
    rows = spark.createDataFrame([("a", "en", "v1", 5)], "source string, lang string, tokenizer string, tokens long")
    first, second = (token_counts.TokenRollup(spark, f"{tmp_path}/r") for _ in range(2))
    claim, done = second._claim, []

    def late(batch, folder):
        done.append(first.commit(batch, token_counts.inserts(rows)))
        return claim(batch, folder)

    monkeypatch.setattr(second, "_claim", late)
    assert not second.commit("1", token_counts.inserts(rows)) and done == [True]
    assert {tuple(r) for r in first.totals().collect()} == {("a", "en", "v1", 1, 5)}
    assert len(list((tmp_path / "r" / "data").iterdir())) == 1


def curve_index(point, bits):
    """Place along the Hilbert curve, one bit plane after another (Skilling's inverse undone step by step)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ t) >> b & 1)
    return out


def test_compaction_changes_no_total(spark, tmp_path, monkeypatch):
    """Before and after, with batches that come meanwhile, of two writers, and committing a covered batch again."""
    rows = lambda k: spark.createDataFrame([("s", "en", "t", 1, k), ("s", None, "t", -1, k)], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
    first, second = (token_counts.TokenRollup(spark, f"{tmp_path}/r") for _ in range(2))
    told = lambda rollup: sorted(map(str, rollup.totals().collect()))
    assert not first.compact() and told(first) == []
    for k in range(4):
        first.commit(f"b{k}", rows(k))
    want = told(first)
    assert first.compact() and told(first) == told(second) == want and not second.compact()
    assert not second.commit("b1", rows(9)) and told(first) == want  # covered, and still committed
    first.commit("b4", rows(4))
    assert told(second) != want
    real, want = second._summed, told(second)

    def meanwhile():
        out = real()
        if not meant:
            meant.append(first.commit("b5", rows(5)))
        return out

    meant: list = []
    monkeypatch.setattr(second, "_summed", meanwhile)
    assert second.compact()  # b5 came after its list was made: it is read beside the sum
    monkeypatch.setattr(second, "_summed", real)
    assert meant == [True] and first.committed() == [f"b{k}" for k in range(6)]
    assert {(r["lang"], r["n_docs"], r["n_tokens"]) for r in first.totals().collect()} == {("en", 6, 15), (None, -6, 15)}
    put = second._put
    monkeypatch.setattr(second, "_put", lambda *a: (first.compact(), put(*a))[1])
    assert first.commit("b6", rows(0)) and not second.compact() and {(r["lang"], r["n_docs"], r["n_tokens"]) for r in second.totals().collect()} == {("en", 7, 15), (None, -7, 15)}


def test_rows_of_the_sharding_query(spark, sf, odd):
    """All columns of op7's rows by plain Python."""
    import math
    import zlib

    docs = table(spark, sf, "documents").selectExpr("*", "1 as shard", "2 as hilbert", "3 as __source", "4 as __part")
    rows = docs.collect()
    ids = [r["doc_id"] for r in rows]

    def places(values):
        count, before, out = Counter(values), 0, {}
        for v in sorted(count, key=lambda v: (v is None, (v or "").encode())):
            out[v] = min(math.floor((before + count[v] - count[v] / 2) / len(values) * 32), 31)
            before += count[v]
        return out

    source, lang = places([r["source"] for r in rows]), places([r["lang"] for r in rows])
    lo, hi = min(ids), max(ids)
    keyed = []
    for r in rows:
        size, crc = len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())
        point = [source[r["source"]], lang[r["lang"]], max(0, min(math.floor(math.log2(size) * 2) - 8, 31)), min(math.floor((r["doc_id"] - lo) / (hi - lo) * 32), 31)]
        keyed.append((curve_index(point, 5), crc, r["doc_id"], size))
    keyed.sort()
    want, n = set(), len(keyed)
    for rank, (h, crc, i, size) in enumerate(keyed):
        s = rank * 40 // n
        want.add((i, size, crc, h, s, rank - (s * n + 39) // 40))
    got = sharding.shard(docs, 40).select("doc_id", "size", "text_crc32", "hilbert", "shard", "slot").collect()
    assert {tuple(r) for r in got} == want and len(got) == n


def test_hilbert_steps_to_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        cells = spark.range(1 << n * bits).select(*(F.shiftright("id", k * bits).bitwiseAND((1 << bits) - 1).alias(f"x{k}") for k in range(n)))
        rows = sorted((r["h"], [r[f"x{k}"] for k in range(n)]) for r in cells.select("*", sharding.hilbert_index([F.col(f"x{k}") for k in range(n)], bits).alias("h")).collect())
        assert [h for h, _ in rows] == list(range(1 << n * bits))
        assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for (_, x), (_, y) in zip(rows, rows[1:], strict=False))


def test_shards_are_even_and_gapless(spark, sf, odd):
    import zlib

    for docs in (odd, table(spark, sf, "documents")):
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        rows = sharding.shard(docs, 7).collect()
        assert len(rows) == docs.count()
        counts = Counter(r["shard"] for r in rows)
        assert max(counts.values()) - min(counts[s] for s in range(7)) <= 1
        for s in range(7):
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
        assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    assert sharding.shard(spark.createDataFrame([], SCHEMA), 7).count() == 0


def test_written_shards_are_skipped_by_filters(spark, sf, odd, tmp_path):
    docs = table(spark, sf, "documents").unionByName(odd)
    sharding.write_shards(docs, f"{tmp_path}/s", 16)
    files = sorted((tmp_path / "s" / "rows").glob("shard=*/*.parquet"))
    assert len(files) == 16 and len({f.parent for f in files}) == 16
    back = spark.read.parquet(f"{tmp_path}/s/rows")
    assert Counter(map(tuple, back.select(*docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    for file in files:
        assert (slots := [r["slot"] for r in spark.read.parquet(str(file)).collect()]) == list(range(len(slots)))
    for column, low, high in (("source", "src3", "src3"), ("doc_id", 10, 30), ("size", 5000, 10**9)):
        some = sharding.read_shards(spark, f"{tmp_path}/s", column, low, high)
        assert len(some.inputFiles()) < 16
        assert sorted(r["slot"] for r in some.collect()) == sorted(r["slot"] for r in back.where(F.col(column).between(low, high)).collect())
    assert sharding.read_shards(spark, f"{tmp_path}/s", "doc_id", -9, -1).count() == 0
    sharding.write_shards(docs.limit(0), f"{tmp_path}/none", 16)
    assert sharding.read_shards(spark, f"{tmp_path}/none", "doc_id", 0, 9).count() == 0


def repeats(text, k=8):
    w = words(text)
    seen = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return len({j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)})


def test_quality_counts(spark, sf, odd):
    rng = random.Random(3)
    for text in [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(200)]:
        assert quality.repeated_words(text.encode().split()) == repeats(text)
    docs = odd.unionByName(table(spark, sf, "documents").limit(60))
    for r in quality.quality_rules(docs.withColumn("kept", F.lit(1)), "doc_id", whole=True).collect():
        t = r["text"] or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), repeats(t))
        assert r["base_failed"] == (len(w) < 20 or 100 * repeats(t) > 30 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_bands():
    rng = random.Random(5)
    bands = quality.Bands()
    packer = __import__("zstandard").ZstdCompressor(level=bands.level)
    prose = " ".join("".join(rng.choice(["ba", "ke", "li", "mo", "nu", "the", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(900)).encode()
    noise = bytes(rng.randint(33, 126) for _ in range(6000))
    loop = b"one line again and again; " * 300
    verdict = lambda raw: quality.in_band(len(raw), *quality.ratios(raw, bands, packer), bands)
    assert verdict(prose) and not verdict(noise) and not verdict(loop) and not verdict(b"")


def test_quality_rejects_incompressible_words():
    rng, bands = random.Random(9), quality.Bands()
    packer = __import__("zstandard").ZstdCompressor(level=bands.level)
    verdict = lambda raw: quality.in_band(len(raw), *quality.ratios(raw, bands, packer), bands)
    cut = lambda raw, k=10: b" ".join(raw[j : j + k] for j in range(0, len(raw), k))
    base64 = lambda n: cut(__import__("base64").b64encode(rng.randbytes(n))[:n])
    prose = lambda n: " ".join("".join(rng.choice(["ba", "ke", "li", "mo", "nu", "the", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(n)).encode()[:n]
    printable = lambda n: cut(bytes(rng.randint(33, 126) for _ in range(n)))
    for n in (120, 150, 200, 300, 450, 600, 700, 1200, 2000, 3000, 7000, 15_000, 40_000):
        assert not verdict(base64(n)) and not verdict(printable(n))
        assert n < 300 or verdict(prose(n))
        assert n < 700 or not verdict(prose(3 * n // 10) + b" " + printable(7 * n // 10))
    assert not verdict(prose(2048) + printable(1500))  # noise in the last partial chunk alone


def test_quality_verdict_by_another_road(spark, sf, odd):
    """Bands and chunks of the query's rows, written out; an empty table gives none."""
    import zstandard

    b, pack = quality.Bands(), zstandard.ZstdCompressor(level=3).compress
    band = lambda n: sum(n >= e for e in b.edges)
    for r in quality.quality_rules(odd.unionByName(table(spark, sf, "documents")), "doc_id", whole=True).collect():
        raw = (r["text"] or "").encode()
        good = bool(raw) and b.low[band(len(raw))] <= len(pack(raw)) / len(raw) <= b.high[band(len(raw))]
        if len(raw) >= 2048:
            odd_bytes = 0
            for k in range(0, len(raw), 2048):
                part = raw[k : k + 2048]
                low, high = (0.12, 0.70) if len(part) == 2048 else (b.low[band(len(part))], b.high[band(len(part))])
                odd_bytes += len(part) * (not low <= len(pack(part)) / len(part) <= high)
            good = good and 5 * odd_bytes <= len(raw)
        assert r["kept"] == (good and not r["base_failed"])
    assert quality.quality_rules(odd.limit(0), "doc_id").count() == 0


def test_bpe(spark, odd):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(), special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab '’stréüß漢字🙂  \u0085\n\t\r 12٣.!-") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["a" * 5000, "=-" * 700, "don't<|endoftext|>"]
    docs = odd.unionByName(spark.createDataFrame([(1000 + k, t, "en", "s", 1) for k, t in enumerate(texts)], SCHEMA))
    for r in bpe.encode(docs.selectExpr("*", "1 as ids", "2 as n_tokens", "3 as __text"), "doc_id", "text", digests=True).collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.encode(spark.createDataFrame([], SCHEMA), "doc_id").count() == 0


@pytest.mark.parametrize(("name", "value"), [("DICTIONARY", 8), ("DICTIONARY_TEXTS", 4)])
def test_words_outside_the_dictionary_are_folded_alike(spark, monkeypatch, name, value):
    """A dictionary of eight words, and one from a sample of four texts: most words are folded where they are met."""
    monkeypatch.setattr(bpe, name, value)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(), special_tokens={})
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = bpe.encode(docs, "doc_id", digests=True).collect()
    assert len(got) == len(texts)
    for r in got:
        assert list(r["ids"]) == encoding.encode_ordinary(texts[r["doc_id"]]) and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_every_word_is_folded_by_spark(spark, monkeypatch):
    """With a table of single bytes for the fold, all ids are of single bytes: no other code makes ids."""
    bytes_ = {k: v for k, v in bpe.ranks().items() if len(k) == 1}
    whole = bpe.rank_map
    monkeypatch.setattr(bpe, "rank_map", lambda table: whole(bytes_))
    monkeypatch.setattr(bpe, "DICTIONARY", 8)
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(50)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    for r in bpe.encode(docs, "doc_id").collect():
        assert list(r["ids"]) == [bytes_[bytes([b])] for b in texts[r["doc_id"]].encode()]


def test_long_words_are_cut_and_folded_alike(spark):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(), special_tokens={})
    rng = random.Random(2)
    words = ["a" * 50_000, " " * 3001 + "x", "=-" * 2000, "na" * 1500] + ["".join(rng.choice(a) for _ in range(3000)) for a in ("acgt", "abcdefghijklmnopqrstuvwxyz", "éèçàù", "漢字語文本日", "=-#*")]
    docs = spark.createDataFrame([(k, f"{w} {w[:200]} end") for k, w in enumerate([*words, *words])], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.encode(docs, "doc_id", digests=True).collect():
        assert list(r["ids"]) == encoding.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    parts = bpe.cut(words[5], bpe.ranks(), 33)
    assert "".join(parts) == words[5] and len(parts) > 10 and [i for p in parts for i in bpe.merged(p.encode(), bpe.ranks())] == encoding.encode_ordinary(words[5])


def test_words_that_a_task_forgets_are_numbered_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    table_, rng = bpe.ranks(), random.Random(3)
    of = lambda words: [np.array(bpe.merged(w.encode(), table_), "<i4") for w in words]
    known = ["the", " zq"]
    numbers, folded = bpe.Numbers({w: k for k, w in enumerate(known)}, table_), bpe.Folded([i.tobytes() for i in of(known)])
    firsts = []
    for _ in range(200):
        words = [rng.choice(["the", " zq", "xyzzy", " plugh", "qqq", "wvw", "b", "zz zz"]) for _ in range(rng.randint(1, 6))]
        numbers.forget()
        numbers.fresh = []
        firsts.append(len(numbers))
        places = numbers.places(words)
        fresh = of(numbers.fresh)
        folded.put(firsts[-1], np.concatenate([np.empty(0, "<i4"), *fresh]), np.array([len(f) for f in fresh], np.int64))
        found, at = folded.look(np.array(places), np.array([0, len(places)]))
        assert found.tolist() == np.concatenate(of(words)).tolist() and at.tolist() == [0, len(found)]
    assert firsts.count(2) > 5 and max(firsts) < 12


def test_large_shards_are_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "FILE_ROWS", 100)
    docs = spark.range(1500).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "if(id % 3 = 0, 'a', 'b') AS source", "1L AS n_chars")
    sharding.write_shards(docs, f"{tmp_path}/s", 3)
    bounds = spark.read.parquet(f"{tmp_path}/s/bounds").collect()
    assert len(bounds) >= 15 and all(r["n"] <= 100 for r in bounds) and sum(r["n"] for r in bounds) == 1500
    for r in bounds:
        slots = [x["slot"] for x in spark.read.parquet(f"{tmp_path}/s/rows/shard={r['shard']}/{r['file']}").collect()]
        assert slots == sorted(slots)
    some = sharding.read_shards(spark, f"{tmp_path}/s", "doc_id", 10, 20)
    assert sorted(r["doc_id"] for r in some.collect()) == list(range(10, 21)) and len(some.inputFiles()) < len(bounds)


def test_bpe_by_higher_order_functions(spark):
    frame = spark.createDataFrame([("",), ("a",), (" the",), ("héllo",), ("漢字漢字",), ("antiontion",), (None,)], "w string")
    ids = bpe.fold_merges(F.col("w"), bpe.rank_map(bpe.ranks()))
    for r in frame.select("w", ids.alias("ids")).withColumn("back", bpe.decode(F.col("ids"))).collect():
        if r["w"] is None:
            assert r["ids"] is None and r["back"] is None
        else:
            assert r["ids"] == (bpe.merged(r["w"].encode(), bpe.ranks()) if r["w"] else []) and bytes(r["back"]) == r["w"].encode()


def test_ranks_of_pairs_are_found_in_one_look(spark):
    """Rows of left ids laid over each other: a rank where there is a pair, and more than any rank where there is none."""
    rng = random.Random(4)
    pairs = {left: {right: rng.randrange(1 << 20) for right in rng.sample(range(900), rng.choice([1, 2, 300]))} for left in rng.sample(range(900), 200)}
    begins, rows = bpe._placed(pairs)
    for left in range(len(begins)):
        for right in range(900):
            if begins[left] is None:
                assert left not in pairs
            else:
                found = int(rows[begins[left] + right]) ^ (left << 20) if begins[left] + right < len(rows) else 1 << 20
                assert found == pairs[left][right] if right in pairs[left] else found >= 1 << 20
    # neither compared by a change of case, which took a seventh of the fold, nor verified by a second array
    plan = str(bpe.fold_merges(F.col("w"), F.col("t")))
    assert "lower(" not in plan and "keys" not in plan


def test_the_dictionary_is_all_words_of_a_count(spark, monkeypatch):
    """As many counts as fit, whole, from the most frequent on; folded in many tasks, to the ids of the plain fold."""
    monkeypatch.setattr(bpe, "DICTIONARY", 5)
    texts = ["ab cd ef gh"] * 3 + [" ef gh ij kl"] * 4 + ["mn"] * 9 + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = bpe.dictionary(docs, "text", bpe._rank_row(spark, bpe.ranks()), public_tokenizers.PATTERN)
    assert set(got["w"].to_pylist()) == {"mn", " ef", " gh", " ij", " kl"}  # with "ab" and " cd" there would be seven
    assert all(ids == bpe.merged(w.encode(), bpe.ranks()) for w, ids in zip(got["w"].to_pylist(), got["ids"].to_pylist(), strict=True))
    monkeypatch.setattr(bpe, "DICTIONARY", 0)
    assert bpe.dictionary(docs, "text", bpe._rank_row(spark, bpe.ranks()), public_tokenizers.PATTERN).num_rows == 0
