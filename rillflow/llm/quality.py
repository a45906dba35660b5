"""Quality rules: compression bands over whole documents and fixed chunks, beside exact text counts.

A text that repeats itself compresses far better than prose of its length, and noise compresses far worse. The limits
depend on the length, since short texts carry the frame's fixed cost and offer little history.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, rows_pass

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Limits of the compressed share of a text, by its UTF-8 length.

    edges: lengths at which the next limits start; low and high have one entry more. high lies between prose and base64 words
    of the length. A full chunk is out of its band below chunk_low or above chunk_high, a last partial one outside the limits
    of its length; a text with more than chunk_share of its bytes in chunks out of band is rejected.
    """

    edges: tuple[int, ...] = (80, 160, 240, 320, 480, 640, 960, 1280, 2048, 5120, 20480)
    low: tuple[float, ...] = (0.0, 0.0, 0.30, 0.30, 0.25, 0.25, 0.22, 0.22, 0.17, 0.17, 0.12, 0.08)
    high: tuple[float, ...] = (1.15, 0.97, 0.925, 0.83, 0.79, 0.76, 0.735, 0.71, 0.70, 0.70, 0.67, 0.65)
    level: int = 3
    chunk: int = 2048
    chunk_low: float = 0.12
    chunk_high: float = 0.70
    chunk_share: float = 0.2


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words (a power of two) that is found at two places or more."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    width, distinct = 1, len(ids)
    while width < window:  # names of windows twice as wide from pairs of names: exact, without hashes
        pair = rank[:-width] * distinct + rank[width:]
        values, rank = np.unique(pair, return_inverse=True)
        width, distinct = 2 * width, len(values)
        if distinct == len(pair):
            return 0
    twice = np.bincount(rank, minlength=distinct)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    edge[: len(twice)] += twice
    edge[window : window + len(twice)] -= twice
    return int((np.cumsum(edge[:n]) > 0).sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; a null text has none of them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # splits bytes at exactly the six white-space bytes of the contract
    blanks = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text or "") - blanks, sum(raw.count(c.encode()) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def ratios(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float | None, float | None]:
    """Compressed share of the whole text (None if empty), and the share of its bytes in chunks out of their band (None if no chunk is full)."""
    if not raw:
        return None, None
    whole = len(packer.compress(raw)) / len(raw)
    if len(raw) < bands.chunk:
        return whole, None
    view, out = memoryview(raw), 0
    for i in range(0, len(raw), bands.chunk):
        part = view[i : i + bands.chunk]
        share, k = len(packer.compress(part)) / len(part), bisect_right(bands.edges, len(part))
        low, high = (bands.chunk_low, bands.chunk_high) if len(part) == bands.chunk else (bands.low[k], bands.high[k])
        out += len(part) * (share < low or share > high)
    return whole, out / len(raw)


def in_band(length: int, whole: float | None, odd_chunks: float | None, bands: Bands) -> bool:
    """The method's verdict: an empty text is out of band."""
    if whole is None:
        return False
    k = bisect_right(bands.edges, length)
    return bands.low[k] <= whole <= bands.high[k] and (odd_chunks is None or odd_chunks <= bands.chunk_share)


def quality_rules(docs: DataFrame, *keep: str, text: str = "text", bands: Bands = Bands(), whole: bool = False) -> DataFrame:
    """One row per document: the columns `keep`, exact counts, ratios and the verdict; with `whole`, the text too.

    Null and empty texts count nothing and fail the base rule. Repeated rows are judged each for itself; columns of docs
    other than `keep` and `text` don't matter, whatever their names. One pass without a shuffle.
    """

    def judge(value: str | None) -> tuple:
        packer = zstandard.ZstdCompressor(level=bands.level)
        raw = (value or "").encode("utf-8", "surrogatepass")
        n, chars, symbols, lines, repeats = counts(value)
        whole, odd = ratios(raw, bands, packer)
        failed = n < 20 or 100 * repeats > 30 * n
        return n, chars, symbols, lines, repeats, whole, odd, failed, not failed and in_band(len(raw), whole, odd, bands)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "zstd_ratio", "odd_chunk_share", "base_failed", "kept"]
    types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
    plain = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[:-1]), *(f"{n} {t}" for n, t in zip(names, ["long"] * 5 + ["double"] * 2 + ["boolean"] * 2, strict=True))])
    if not whole:
        return arrow_pass(plain, rows_pass(judge, names, types, len(keep)), schema)
    plain = plain.withColumnRenamed("__text", text).withColumn("__text", F.col(text))
    first = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[:-1])
    return arrow_pass(plain, rows_pass(judge, names, types, len(keep) + 1), first + schema[schema.index(", n_words") :])
