"""Near duplicates and nearest neighbours against all pairs; the pipeline from end to end."""

import random
from collections import Counter

import numpy as np
import pytest

from rillflow.llm import ann, near_dup
from rillflow.sources.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, shingle, percent):
    """Components and set sizes by comparing all pairs."""
    sets = [(i, near_dup.shingle_set(near_dup.words_of(t), shingle)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and near_dup.linked(a, b, percent):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def corpus(seed, groups=12):
    """Texts with chains of copies that drift away from their first."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    out = []
    for _ in range(groups):
        text = [word() for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, 8)):
            out.append(" ".join(text))
            for _ in range(rng.randint(0, max(1, len(text) // 15))):
                text[rng.randrange(len(text))] = word()
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(spark, shingle):
    texts = corpus(shingle) + [None, "", " \n", "one", "One", "one two", "ONE TWO", "É é", "é é", "x " * 20_000]
    rows = [(3 * k % 1009, t) for k, t in enumerate(texts)]
    rows += [rows[0], (None, texts[1]), (None, texts[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).withColumnRenamed("lang", "id").withColumnRenamed("source", "component_id")
    got = near_dup.near_duplicates(docs, shingle=shingle).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, shingle, 80)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_no_pair_of_a_bucket_is_left_out(spark):
    """Each text has one true link (0.802) among 299 look-alikes just under the threshold (0.786) that share its buckets."""
    core = [f"core{k}" for k in range(88)]
    rows = [(k, " ".join([*core, f"pair{k % 150}", *(f"own{k}-{j}" for j in range(11))])) for k in range(300)]
    got = near_dup.near_duplicates(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA), shingle=1).collect()
    want = brute(rows, 1, 80)
    assert len({c for _, _, c in want}) == 150
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_boilerplate_loses_no_link(spark):
    """2,000 texts of shared boilerplate: each is linked with one other (0.81), all the rest lie just below (0.78)."""
    core, n = [f"core{k}" for k in range(262)], 2000
    rows = [(k, " ".join([*core, *(f"p{k % (n // 2)}-{j}" for j in range(6)), *(f"own{k}-{j}" for j in range(31))])) for k in range(n)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k % (n // 2) for k in range(n)}


def test_drifting_chains_stay_whole(spark):
    """Two chains of 1,000 texts, each made from the one before by one new word of 40: only neighbours are linked."""
    rng, rows = random.Random(5), []
    ids = list(range(2000))
    rng.shuffle(ids)
    for chain in range(2):
        words = [f"c{chain}w{k}" for k in range(40)]
        for step in range(1000):
            words[step % 40] = f"c{chain}s{step}"
            rows.append((ids[chain * 1000 + step], " ".join(words)))
    near, far = (near_dup.shingle_set(near_dup.words_of(rows[k][1]), 2) for k in (1, 40))
    assert near_dup.linked(near_dup.shingle_set(near_dup.words_of(rows[0][1]), 2), near, 80) and not near & far
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == min(ids[chain * 1000 : chain * 1000 + 1000]) for chain in range(2) for i in ids[chain * 1000 : chain * 1000 + 1000])


def test_tiles_of_a_hot_bucket(spark, monkeypatch):
    """Groups of seven rows: pairs of different groups meet as well as pairs of one."""
    monkeypatch.setattr(near_dup, "TILE", 7)
    core = [f"core{k}" for k in range(88)]
    rows = [(k, " ".join([*core, f"pair{k % 30}", *(f"own{k}-{j}" for j in range(11))])) for k in range(60)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k % 30 for k in range(60)}


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_an_id_with_two_texts_joins_their_classes(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, a), (2, b), (7, a), (7, b), (9, b)]
    got = near_dup.near_duplicates(spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA)).collect()
    assert {r["component_id"] for r in got} == {1}


def test_estimates_are_corrected():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.3, 0.8, 1.0):
        errors = []
        for _ in range(30):
            common, own = int(300 * share), 300 - int(300 * share)
            pool = rng.integers(0, 1 << 63, common + 2 * own).astype(np.uint64)
            a, b = np.unique(pool[: common + own]), np.unique(np.r_[pool[:common], pool[common + own :]])
            agree = (near_dup.registers(a) == near_dup.registers(b)).mean()
            errors.append(float(near_dup.estimate(agree, len(a), len(b))) - common / (common + 2 * own))
        assert abs(np.mean(errors)) < 0.02


def test_runs_across_batches():
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(3).integers(0, 60, 200))
    ids = np.arange(200)
    batches = [pa.record_batch([pa.array(keys[k : k + 17]), pa.array(ids[k : k + 17])], names=["key", "id"]) for k in range(0, 200, 17)]
    out = [tuple(x.values()) for b in near_dup._runs(iter(batches)) for x in b.to_pylist()]
    first = {int(k): int(ids[keys == k].min()) for k in keys}
    size = Counter(keys.tolist())
    want = {(int(k), int(i), first[int(k)]) for k, i in zip(keys, ids, strict=True) if size[int(k)] > 1 or k in (keys[0], keys[-1])}
    assert set(out) == want and len(out) == len(want)


def exact(ids, x, every, k):
    norm = np.sqrt((x * x).sum(1))
    for q in np.nonzero(ids % every == 0)[0]:
        s = (x * x[q]).sum(1) / (norm * norm[q])
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        yield int(ids[q]), [(int(ids[i]), float(s[i])) for i in order]


def test_probes_hold_every_code_within_the_radius():
    """Cells of each number of bits, against all distances; each pair is met in one substring."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    codes, x = rng.integers(0, 1 << 16, (400, ann.PARTS), np.uint16), rng.normal(size=(400, 3))
    codes[::3] ^= np.uint16(1) << rng.integers(0, 16, (134, ann.PARTS)).astype(np.uint16)
    ids = np.arange(400)
    for radius in (0, 3, 8, 15, 22, 28, 64):
        want = set(np.nonzero(np.bitwise_count(codes ^ codes[7]).sum(1) <= radius)[0].tolist()) - {7}
        for bits in (0, 3, 16):
            asked = pa.record_batch([pa.array([7]), pa.array([codes[7].tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([radius]), pa.array([radius])], names=["id", "code", "x", "radius", "most"])
            met = []
            for routed in ann._routes(bits)(iter([asked])):
                for part, cell in zip(routed.column(0).to_pylist(), routed.column(1).to_pylist(), strict=True):
                    rows = np.nonzero(codes[:, part].astype(int) >> (16 - bits) == cell)[0]
                    if len(rows):
                        met += [r[2] for r in ann.best_of(ids[rows], ids[rows], x[rows], codes[rows], part, np.array([7]), x[7:8], codes[7:8], np.array([radius]), np.array([radius]), 400)]
            assert len(met) == len(set(met)) and set(met) == want


def test_recall(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in ann.nearest(vectors).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for q, best in exact(ids, x, 50, 5):
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hits += len({i for i, _ in best} & {i for i, _ in got[q].values()})
        total += 5
    assert hits / total >= 0.9


def test_hot_cells_and_ties(spark, monkeypatch):
    """A third of the rows is one vector; cells of many blocks and turns; ids that repeat with different vectors."""
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERIES", 3)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8))
    x[100:200] = x[100]
    rows = [(int(i), [float(v) for v in x[i]]) for i in rng.permutation(300)] + [(100, [1.0] * 8), (100, [-1.0] * 8)]
    got = {}
    for frame in (rows, rows[::-1]):
        for r in ann.nearest(spark.createDataFrame(frame, "vec_id long, embedding array<double>"), every=20).collect():
            got.setdefault((r["query_id"], r["rank"]), set()).add((r["vec_id"], r["score"]))
    assert all(len(v) == 1 for v in got.values())  # whatever the order of rows
    same = [next(iter(got[120, rank]))[0] for rank in range(1, 6)]
    assert same == [100, 101, 102, 103, 104]  # ties to the smaller id
    hits = sum(len({i for i, _ in want} & {next(iter(got[q, r]))[0] for r in range(1, 6)}) for q, want in exact(np.arange(300), x, 20, 5) if q not in (100, 120, 140, 160, 180))
    assert hits >= 0.9 * 5 * 10


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (50, [-1.0, 0.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann.nearest(frame).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0), (0, 4, 50, -1.0), (50, 1, 3, 0.0), (50, 2, 0, -1.0), (50, 3, 0, -1.0), (50, 4, 1, -1.0), (50, 5, 2, -1.0)]
    assert ann.nearest(frame.limit(0)).count() == 0
