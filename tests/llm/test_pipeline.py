"""The pipeline's stages against brute force, and on odd rows."""

import hashlib
from collections import Counter

import pytest
from test_search import SCHEMA, brute

import corpus_pipeline
from rillflow.llm import bpe, pii
from rillflow.sources.tables import table


@pytest.fixture(scope="module")
def odd(spark):
    line = " ".join(f"word{k}" for k in range(40))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, line, "en", None, 1), (4, line, "en", "s", 1), (4, line, "en", "s", 1), (None, line + " x", "en", "s", 1), (5, "again and again " * 4000, "en", "s", 1), (6, line + " mail a.b@c.de", "de", "t", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_stages(spark, sf, odd, which):
    docs = odd if which == "odd" else table(spark, sf, "documents")
    names = dict(corpus_pipeline.STAGES)
    good = names["quality rules"](spark, docs, sf)
    assert good.columns == corpus_pipeline.COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert all(len((t or "").encode().split()) >= 20 for _, t in rows)

    alone = names["near duplicates"](spark, good, sf)
    left = Counter(r["doc_id"] for r in alone.collect())
    want = {i for i, _, c in brute(rows, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT) if i == c}
    assert {i for i in left if i is not None} == {i for i in want if i is not None}
    assert all(n == 1 for i, n in left.items() if i is not None) and left[None] == sum(i is None for i, _ in rows)

    clean = names["personal data"](spark, alone, sf)
    before = {r["doc_id"]: r for r in alone.collect()}
    for r in clean.collect():
        old = before[r["doc_id"]]["text"]
        assert r["text"] == (None if old is None else pii.redacted(old, pii.all_spans(old, pii.trained())[1]))
        assert not any(pii.base_spans(r["text"] or ""))
    assert clean.columns == corpus_pipeline.COLUMNS and clean.count() == alone.count()

    mixed = names["mixing"](spark, clean, sf)
    assert mixed.columns == corpus_pipeline.COLUMNS and set(r["doc_id"] for r in mixed.select("doc_id").collect()) <= set(before)

    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in names["encoding"](spark, mixed, sf).collect():
        back = {v: k for k, v in bpe.ranks().items()}
        assert b"".join(back[i] for i in r["ids"]).decode() == (texts[r["doc_id"]] or "")


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_tables_go_when_they_are_done_with(spark, sf):
    from rillflow.llm import common

    kept = common.stored(spark.range(3), "kept")
    gone = common.stored(spark.range(3), "gone")
    common.remove_tables(spark, gone)
    assert kept.count() == 3
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(common.own_dir(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = lambda: {s.getPath().getName().rsplit("-", 1)[0] for s in files.listStatus(path)}
    assert "kept" in names() and "gone" not in names()
    common.remove_tables(spark, spark.read.parquet(f"{sf}/region.parquet"))
    assert spark.read.parquet(f"{sf}/region.parquet").count() == 5  # never what others wrote


def test_nothing_passes_through(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        if "text" in docs.columns:
            assert docs.count() == 0


def test_the_least_of_rows_that_repeat_an_id_stays(spark, sf):
    """Not whichever comes first: reruns over other partitions keep the same text."""
    line = " ".join(f"word{k}" for k in range(40))
    rows = [(1, f"{line} {k} {'x ' * k}", "en", None if k == 3 else "s", k) for k in range(9)] + [(2, line[::-1], "en", "s", 1)]
    keep = dict(corpus_pipeline.STAGES)["near duplicates"]
    for parts in (1, 5):
        got = {r["doc_id"]: r["text"] for r in keep(spark, spark.createDataFrame(rows, SCHEMA).repartition(parts), sf).collect()}
        assert got == {1: min(r[1] for r in rows[:9]), 2: line[::-1]}


def test_encoding_stage_folds_every_word_in_spark(spark, sf, monkeypatch):
    """With a table of single bytes for the fold, all ids of the stage are of single bytes."""
    bytes_ = {k: v for k, v in bpe.ranks().items() if len(k) == 1}
    whole = bpe.rank_map
    monkeypatch.setattr(bpe, "rank_map", lambda table: whole(bytes_))
    monkeypatch.setattr(bpe, "DICTIONARY", 1)
    docs = spark.createDataFrame([(1, "unwonted words, unwonted", "en", "s", 24), (2, None, "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.encode_texts(spark, docs, sf).collect()}
    assert list(got[1]) == [bytes_[bytes([b])] for b in b"unwonted words, unwonted"] and list(got[2]) == []


def test_encoding_stage_decodes_its_ids(spark, sf):
    texts = [(1, "unwonted words, 漢字"), (2, None), (3, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts], SCHEMA)
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.encode_texts(spark, docs, sf).collect()}
    assert got == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in texts}


def test_plans_of_the_encoder_hold_no_ranks(spark, sf):
    """The driver keeps the text of plans; the literal of the ranks is megabytes of it."""
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10)], SCHEMA)
    assert len(bpe.encode(docs, "doc_id")._jdf.queryExecution().toString()) < 100_000


def test_plans_of_the_encoding_stage_hold_no_pieces(spark, sf):
    """Nor, with decoding, the pieces that ids are decoded to: they are a joined row too."""
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10)], SCHEMA)
    assert len(corpus_pipeline.encode_texts(spark, docs, sf)._jdf.queryExecution().toString()) < 100_000
