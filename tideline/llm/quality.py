"""Quality rules with compression bands (operator 6).

Besides a few counts, a text is judged by its zstandard ratio (compressed by
raw bytes), of the whole text and of fixed chunks. Repetitive text compresses
too well, noise hardly at all; what is usual depends on the length, so each
length band has limits of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import SPACE, U64, mix, prefix_hash, powers, row_counts, shingles, word_hashes


class Band(NamedTuple):
    """Least and greatest ratio for texts of ``min_bytes`` bytes or more."""

    min_bytes: int
    low: float
    high: float


# Fixed limits, about three quarters of the least ratio that ordinary prose
# of that length has, and well over its greatest.
BANDS = (Band(0, 0.0, 99.0), Band(200, 0.40, 1.00), Band(400, 0.38, 0.95), Band(800, 0.34, 0.90),
         Band(1600, 0.31, 0.85), Band(4096, 0.29, 0.85), Band(16384, 0.26, 0.85), Band(65536, 0.24, 0.85))
CHUNK_BYTES = 4096
CHUNK_BAND = Band(1024, 0.28, 0.85)  # a shorter last chunk isn't judged
MAX_BAD_CHUNKS = 0.3  # share of the judged chunks
LEVEL = 3
MIN_WORDS = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80

FIELDS = [T.StructField(n, T.LongType()) for n in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("n_chunks", T.LongType()),
    T.StructField("n_bad_chunks", T.LongType())]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    c = np.append(0, np.cumsum(flags, dtype=np.int64))
    return c[offsets[1:]] - c[offsets[:-1]]


def repeat_words(words: np.ndarray, row: np.ndarray, n: int, k: int = 3) -> np.ndarray:
    """Words per row that lie in a ``k``-word window found twice or more in the row."""
    h, r = shingles(words, row, n, k, short=False)
    if not len(h):
        return np.zeros(n, np.int64)
    h = h ^ mix(r.astype(U64) + U64(1))
    o = np.argsort(h)
    s = h[o]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    # index of each window's first word: windows of a row start at its first words
    cnt = row_counts(row, n)
    first = np.cumsum(cnt) - cnt
    wins = np.maximum(cnt - (k - 1), 0)
    at = np.arange(len(h)) - np.repeat(np.cumsum(wins) - wins, wins) + np.repeat(first, wins)
    hit = at[o[twice]]
    mark = np.zeros(len(words), bool)
    for i in range(k):
        mark[hit + i] = True
    return np.bincount(row[mark], minlength=n).astype(np.int64)


def dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines per row that hold a word and equal an earlier line of the row."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    nl = np.flatnonzero(data == 10)
    start = np.union1d(offsets[:-1], nl + 1)
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 10)
    row = np.searchsorted(offsets, start, "right") - 1
    words = np.append(0, np.cumsum(~SPACE[data], dtype=np.int64))
    keep = words[end] > words[start]
    start, end, row = start[keep], end[keep], row[keep]
    cum = prefix_hash(data)
    _, inv = powers(len(data) + 1)
    h = mix((cum[end] - cum[start]) * inv[start]) ^ mix(row.astype(U64) + U64(1))
    o = np.argsort(h, kind="stable")
    same = np.append(False, h[o][1:] == h[o][:-1])
    return np.bincount(row[o[same]], minlength=n).astype(np.int64)


def compression(text: bytes, bands: Sequence[Band] = BANDS, c=None) -> tuple[float, int, int, bool]:
    """(ratio, chunks judged, chunks outside their band, verdict) of one text; ratio 0 if empty."""
    c = c or zstandard.ZstdCompressor(level=LEVEL)
    n = len(text)
    if not n:
        return 0.0, 0, 0, True
    ratio = len(c.compress(text)) / n
    band = max((b for b in bands if b.min_bytes <= n), key=lambda b: b.min_bytes)
    bad = judged = 0
    for i in range(0, n, CHUNK_BYTES):
        part = text[i:i + CHUNK_BYTES]
        if len(part) < CHUNK_BAND.min_bytes:
            continue
        judged += 1
        r = ratio if len(part) == n else len(c.compress(part)) / len(part)
        bad += not CHUNK_BAND.low <= r <= CHUNK_BAND.high
    return ratio, judged, bad, band.low <= ratio <= band.high and bad <= MAX_BAD_CHUNKS * judged


def judged(batch: pa.RecordBatch, col: str, bands: Sequence[Band]) -> list[pa.Array]:
    """The columns of FIELDS for the texts of a batch."""
    c = zstandard.ZstdCompressor(level=LEVEL)
    cols: list[list] = [[] for _ in FIELDS]
    for lo, hi, offs, data in text_slices(batch, col):
        n = hi - lo
        words, row, _, _ = word_hashes(data, offs, lower=False)
        n_words, rep = row_counts(row, n), repeat_words(words, row, n)
        failed = (n_words < MIN_WORDS) | (100 * rep > 50 * n_words)
        raw = data.tobytes()
        z = [compression(raw[offs[i]:offs[i + 1]], bands, c) for i in range(n)]
        kept = ~failed & np.array([x[3] for x in z], bool)
        for have, more in zip(cols, (n_words, _per_row(_LEAD[data] & ~SPACE[data], offs),
                                     _per_row(_SYMBOL[data], offs), dup_lines(data, offs), rep, failed, kept,
                                     *[np.array([x[i] for x in z], t) for i, t in ((0, float), (1, np.int64), (2, np.int64))])):
            have.append(more)
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
    return [pa.array(np.concatenate(x), k) if x else pa.array([], k) for x, k in zip(cols, kinds)]


def quality(docs: DataFrame, bands: Sequence[Band] = BANDS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, counts, base_failed, kept, ratio, n_chunks, n_bad_chunks.

    A null text counts as empty: no words, so base_failed and not kept.
    Repeated rows and rows with a null id are judged like any other; other
    columns are ignored. An empty table gives no rows.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *FIELDS])

    def run(it):
        for b in it:
            yield out(schema.names, column(b, "_id"), *judged(b, "_text", bands))

    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .transform(arrow_map, run, schema))


def keep_quality(docs: DataFrame, bands: Sequence[Band] = BANDS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns unchanged."""
    def run(it):
        for b in it:
            kept = judged(b, text_col, bands)[6]
            yield b.filter(kept)

    return docs.transform(arrow_map, run, docs.schema)
