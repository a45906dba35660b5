"""Toxicity: a factorization machine over hashed terms.

Each term has a weight and a short vector; the score adds the weights of a text's terms and the products of the vectors of
each pair of them, so that an insult beside a mention of a group can weigh more than the two apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, crc_of_id, stored

BUCKETS = 1 << 20
_LETTERS = re.compile(r"[^\W\d_]+")
#: Beginnings of words are terms too, for languages that compound and inflect.
PREFIXES = (4, 5, 6)
#: Words whose terms a worker remembers before it starts anew, and characters of such a word.
CACHE, CACHED_LENGTH = 400_000, 64


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word's terms: the word and its beginnings."""
    terms = [word.encode(), *((word[:n] + "-").encode() for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(t) % BUCKETS for t in terms)


def text_words(text: str | None) -> set[str]:
    """Distinct lower-case words of the whole text."""
    return set(_LETTERS.findall(text.lower())) if text else set()


@dataclass
class Machine:
    """bias, and for each bucket in `slot` a weight and a vector."""

    bias: float
    slot: dict[int, int]
    weights: np.ndarray
    vectors: np.ndarray

    def margin(self, at: np.ndarray) -> float:
        """Log odds of a text with terms at these slots."""
        if not len(at):
            return self.bias
        v = self.vectors[at]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v * v).sum(0)).sum())
        return self.bias + float(self.weights[at].sum()) + pairs

    def score(self, at: np.ndarray) -> float:
        """Probability of label 1."""
        return float(1 / (1 + np.exp(-np.clip(self.margin(at), -30, 30))))


def fit(rows: list[tuple[np.ndarray, int]], *, terms: int = 4096, rank: int = 8, epochs: int = 16, rate: float = 0.1, decay: float = 2e-4, drop: float = 0.1, seed: int = 11) -> Machine:
    """Train on (distinct buckets, label) rows, in the order given, by AdaGrad on the log loss.

    Of the buckets, the `terms` whose presence goes furthest with or against the label are kept (G statistic); the rest
    would only add noise to long texts. In each epoch a share `drop` of a text's terms is left out at random, so that one
    insult learns to tell without the others. Without both labels the machine gives the label's share, or 0 without rows.
    """
    labels = np.array([y for _, y in rows], np.float64)
    n, positive = len(rows), float(labels.sum()) if len(rows) else 0.0
    if not n or positive in (0.0, float(n)):
        return Machine(30.0 if n and positive == n else -30.0, {}, np.zeros(0), np.zeros((0, rank)))
    seen, seen1 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at, y in rows:
        seen[at] += 1
        if y:
            seen1[at] += 1

    def part(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    share = positive / n
    g = part(seen1, seen * share) + part(seen - seen1, seen * (1 - share)) + part(positive - seen1, (n - seen) * share) + part(n - seen - positive + seen1, (n - seen) * (1 - share))
    g[seen < 4] = 0
    best = np.lexsort((np.arange(BUCKETS), -g))[:terms]
    best = np.sort(best[g[best] > 5.0])
    slot_of = np.full(BUCKETS, -1, np.int64)
    slot_of[best] = np.arange(len(best))
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(best)), rng.normal(0, 0.02, (len(best), rank)), float(np.log(share / (1 - share)))
    gw, gv, gb = np.full(len(best), 1e-2), np.full((len(best), rank), 1e-2), 1.0
    examples = [(slot_of[at][slot_of[at] >= 0], y) for at, y in rows]
    for _ in range(epochs):
        for k in rng.permutation(n):
            at, y = examples[k]
            if len(at) > 1:
                kept = at[rng.random(len(at)) >= drop]
                at = kept if len(kept) else at
            rows_v = v[at]
            total = rows_v.sum(0)
            margin = bias + w[at].sum() + 0.5 * (total @ total - (rows_v * rows_v).sum())
            d = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
            gb += d * d
            bias -= rate * d / np.sqrt(gb)
            if len(at):
                step = d + decay * w[at]
                gw[at] += step * step
                w[at] -= rate * step / np.sqrt(gw[at])
                step = d * (total - rows_v) + decay * rows_v
                gv[at] += step * step
                v[at] -= 0.3 * rate * step / np.sqrt(gv[at])
    return Machine(bias, {int(b): k for k, b in enumerate(best)}, w, v)


def training_rows(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, bound: int) -> list[tuple[np.ndarray, int]]:
    """Distinct buckets and label of at most `bound` labelled documents, those with the least md5 of the id.

    The sample's ids are bounded by `bound`, and so is what is broadcast. Of several texts of an id the one with the least md5
    teaches, so that the rows that come to the driver are bounded too.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    chosen = stored(usable.where(F.pmod(crc_of_id(F.col("__id")), F.lit(4)) != 2).orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(bound), "toxic-sample")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sorted({b for w in text_words(t) for b in word_buckets(w)}) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["id", "label", "at"])

    all_near = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    near = all_near.groupBy("__id", "__label").agg(F.min_by("__text", F.md5("__text")).alias("__text"))
    found = arrow_pass(near, buckets, f"id {dict(near.dtypes)['__id']}, label int, at array<int>").toArrow()
    rows = sorted(zip(found["id"].to_pylist(), found["label"].to_pylist(), (np.asarray(x.values, np.int64) for x in found["at"]), strict=True), key=lambda r: (r[0], r[1], len(r[2])))
    return [(at, y) for _, y, at in rows]


def score_texts(docs: DataFrame, machine: Machine, *keep: str, text: str = "text") -> DataFrame:
    """`keep` and score of each row: whole texts in one pass without a shuffle. Null and empty texts have no terms and get the bias."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        slot = machine.slot
        for batch in batches:
            scores = []
            for value in batch.column(len(keep)).to_pylist():
                at: set[int] = set()
                for w in text_words(value):
                    slots = known.get(w)
                    if slots is None:
                        if len(known) >= CACHE:
                            known.clear()
                        slots = tuple(slot[b] for b in word_buckets(w) if b in slot)
                        if len(w) <= CACHED_LENGTH:
                            known[w] = slots
                    if slots:
                        at.update(slots)
                scores.append(machine.score(np.array(sorted(at), np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], names=[*batch.schema.names[: len(keep)], "score"])

    plain = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[:-1]), "score double"])
    return arrow_pass(plain, run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = 12_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Learns from labelled documents whose crc32(id) mod 4 is not 2, at most `bound` of them; other columns of docs and
    labels, clashing names included, are not read. Labels other than 0 and 1 and null ids teach nothing; of several
    labels of an id the largest counts. Equal texts get equal scores.
    """
    machine = fit(training_rows(docs, labels, doc_id=doc_id, text=text, label=label, bound=bound))
    held = F.coalesce(F.pmod(crc_of_id(F.col(doc_id)), F.lit(4)) == 2, F.lit(False))
    return score_texts(docs, machine, doc_id, text=text).select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
