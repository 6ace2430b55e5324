"""Benchmark decontamination by greedy string tiling (operator 2).

1. Seeds: the 5-word shingles of the benchmark items. A Bloom filter of them
   (a bitmap of ``MAX_BITS`` at most, whatever the benchmark's size) tells
   each document's task which of its shingles may be seeds. Of a document only
   the words under such shingles go on, as they alone can lie in a tile.
2. The possible seeds are joined with the items' seeds, which gives the pairs
   (text, item) with a shared seed; false positives of the filter end here.
3. Each pair is tiled (running Karp-Rabin greedy string tiling): the longest
   common runs of words not yet marked are marked first, down to ``TILE``
   words, so moved or reordered parts of an item count too. A document is
   contaminated by an item of which its tiles cover ``coverage`` of the words.

Documents with equal words under seeds are tiled once.
"""

from __future__ import annotations

from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import U64, row_counts, shingles, word_hashes
from tideline.llm.scratch import Scratch

TILE = 5
COVERAGE = 0.5
MAX_BITS = 1 << 24
BITS_PER_SEED = 24
FIRST_SEARCH = 20
PRIME = (1 << 61) - 1
BASE = 1_000_003


# ---- tiling -------------------------------------------------------------

def _windows(x: list[int], marked: list[bool], s: int):
    """(start, Karp-Rabin hash) of every unmarked window of s tokens; 0 is a border."""
    top = pow(BASE, s, PRIME)
    h = run = 0
    for i, v in enumerate(x):
        if marked[i] or not v:
            h = run = 0
            continue
        h, run = (h * BASE + v) % PRIME, run + 1
        if run > s:
            h = (h - x[i - s] * top) % PRIME
        if run >= s:
            yield i - s + 1, h


def _scan(p, t, pm, tm, s):
    """Maximal unmarked matches of s tokens or more as (length, p start, t start); stops early past 2 s."""
    at = defaultdict(list)
    for j, h in _windows(t, tm, s):
        at[h].append(j)
    found = []
    for i, h in _windows(p, pm, s):
        for j in at.get(h, ()):
            if i and j and not pm[i - 1] and not tm[j - 1] and t[j - 1] and p[i - 1] == t[j - 1]:
                continue  # not the start of its match
            k = 0
            while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not pm[i + k] and not tm[j + k]:
                k += 1
            if k > 2 * s:
                return k, []
            if k >= s:  # a hash match may be false
                found.append((k, i, j))
    return max((k for k, _, _ in found), default=0), found


def tiles(p: list[int], t: list[int], least: int = TILE) -> list[tuple[int, int, int]]:
    """Tiles (length, start in p, start in t) of greedy string tiling; tokens 0 in t never match."""
    pm, tm = [False] * len(p), [False] * len(t)
    res, s = [], max(least, FIRST_SEARCH)
    while True:
        longest, found = _scan(p, t, pm, tm, s)
        if longest > 2 * s:
            s = longest
            continue
        queue = defaultdict(list)
        for m in found:
            queue[m[0]].append(m)
        n = longest
        while n >= s:
            for k, i, j in sorted(queue.pop(n, ())):
                free = [not pm[i + x] and not tm[j + x] for x in range(k)]
                if all(free):
                    res.append((k, i, j))
                    for x in range(k):
                        pm[i + x] = tm[j + x] = True
                    continue
                x = 0  # partly taken: what is left may still be long enough
                while x < k:
                    y = x
                    while y < k and free[y]:
                        y += 1
                    if y - x >= s:
                        queue[y - x].append((y - x, i + x, j + x))
                    x = y + 1
            n = n if queue.get(n) else n - 1
        if s == least:
            return res
        s = max(least, s // 2) if s > 2 * least else least


# ---- seeds --------------------------------------------------------------

def item_words(bench: DataFrame, id_col: str, text_col: str, coverage: float) -> tuple[DataFrame, DataFrame]:
    """(item_id, words binary, n_words) and (seed, item_id, joined) of items with TILE words or more.

    The tiles of a contaminated text hold a seed at coverage * words / TILE
    places of an item at least, so the seeds that most items have need not be
    joined (``joined`` false) while all their places in the item are fewer;
    a phrase common to many items then does not pair every text with every
    item.
    """
    rows = bench.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null")

    def run(it):
        for b in it:
            for lo, hi, offs, data in text_slices(b, "text"):
                words, row, _, _ = word_hashes(data, offs)
                ends = np.cumsum(row_counts(row, hi - lo))
                h, r = shingles(words, row, hi - lo, TILE, short=False)
                cuts = np.cumsum(row_counts(r, hi - lo))
                seeds, places = zip(*(np.unique(x, return_counts=True) for x in np.split(h, cuts[:-1])))
                text = [x.tobytes() for x in np.split(words, ends[:-1])]
                yield out(["item_id", "words", "n_words", "seeds", "places"], column(b, "item_id").slice(lo, hi - lo), pa.array(text, pa.binary()),
                          pa.array([len(x) // 8 for x in text], pa.int64()),
                          pa.array([x.view(np.int64).tolist() for x in seeds], pa.list_(pa.int64())),
                          pa.array([x.tolist() for x in places], pa.list_(pa.int64())))

    items = rows.transform(arrow_map, run, "item_id long, words binary, n_words long, seeds array<long>, places array<long>").where("size(seeds) > 0")
    items = items.dropDuplicates(["item_id", "words"])
    each = items.select("item_id", "words", "n_words", F.explode(F.arrays_zip("seeds", "places")).alias("at"))
    each = each.select("item_id", "words", "n_words", F.col("at.seeds").alias("seed"), F.col("at.places").alias("places"))
    common = each.groupBy("seed").agg(F.count(F.lit(1)).alias("n_items"))
    spare = F.ceil(F.col("n_words") * coverage / TILE) - 1
    upto = F.sum("places").over(Window.partitionBy("item_id", "words").orderBy(F.desc("n_items"), "seed")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seeds = each.join(common, "seed").select("seed", "item_id", (upto > spare).alias("joined"))
    return items.select("item_id", "words", "n_words"), seeds


def bitmap(seeds: DataFrame, n: int) -> np.ndarray:
    """Bloom filter of ``seeds.seed``, two bits each, in ``MAX_BITS`` bits at most."""
    bits = min(MAX_BITS, max(64, 1 << (n * BITS_PER_SEED - 1).bit_length())) if n else 64
    both = F.explode(F.array(F.pmod("seed", F.lit(bits)), F.pmod(F.shiftrightunsigned("seed", 32), F.lit(bits))))
    words = (seeds.select(both.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")))
    res = np.zeros(bits // 64, np.int64)
    for r in words.toLocalIterator():  # at most MAX_BITS / 64 rows
        res[r["word"]] = r["mask"]
    return res.view(U64)


def may_be(filt: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = U64(len(filt) * 64)
    res = np.ones(len(h), bool)
    for v in (h % bits, (h >> U64(32)) % bits):
        res &= (filt[(v >> U64(6)).astype(np.int64)] >> (v & U64(63)) & U64(1)).astype(bool)
    return res


def covered(words: np.ndarray, hit: np.ndarray, most: int) -> np.ndarray:
    """The words under hit shingles, runs parted by 0; at most ``most`` runs of equal words."""
    mark = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + TILE, -1)
    on = np.cumsum(mark)[:-1] > 0
    start = np.flatnonzero(on & ~np.append(False, on[:-1]))
    end = np.flatnonzero(on & ~np.append(on[1:], False)) + 1
    seen: dict[bytes, int] = defaultdict(int)
    parts = []
    for a, b in zip(start, end):
        seen[key := words[a:b].tobytes()] += 1
        if seen[key] <= most:
            parts += [words[a:b], np.zeros(1, U64)]
    return np.concatenate(parts)


def suspects(rows: DataFrame, filt: np.ndarray, most: int) -> DataFrame:
    """(doc_id, cls, seeds, words) per row of (doc_id, text); nulls without a possible seed."""
    shared = rows.sparkSession.sparkContext.broadcast(filt)

    def run(it):
        filt = shared.value
        for b in it:
            for lo, hi, offs, data in text_slices(b, "text"):
                n = hi - lo
                words, row, _, _ = word_hashes(data, offs)
                h, r = shingles(words, row, n, TILE, short=False)
                hit = may_be(filt, h)
                cls, seeds, text = [None] * n, [None] * n, [None] * n
                w_end, h_end = np.cumsum(row_counts(row, n)), np.cumsum(row_counts(r, n))
                for i in np.unique(r[hit]).tolist():
                    a, z = (h_end[i - 1] if i else 0), h_end[i]
                    w = words[(w_end[i - 1] if i else 0):w_end[i]]
                    text[i] = covered(w, np.append(hit[a:z], np.zeros(TILE - 1, bool)), most).tobytes()
                    seeds[i] = np.unique(h[a:z][hit[a:z]]).view(np.int64).tolist()
                    cls[i] = blake2b(text[i], digest_size=16).digest()
                yield out(["doc_id", "cls", "seeds", "words"], column(b, "doc_id").slice(lo, n), pa.array(cls, pa.binary()),
                          pa.array(seeds, pa.list_(pa.int64())), pa.array(text, pa.binary()))

    return rows.transform(arrow_map, run, "doc_id long, cls binary, seeds array<long>, words binary")


def tile_pairs(pairs: DataFrame) -> DataFrame:
    """(cls, item_id, n_words, matched, n_tiles) of rows with words and item_words."""
    def run(it):
        for b in it:
            matched, count = [], []
            for p, t in zip(column(b, "item_words"), column(b, "words")):
                p, t = (np.frombuffer(x.as_buffer(), U64) for x in (p, t))
                t = np.where(np.isin(t, p), t, U64(0))
                keep = (t != 0) | np.append(False, t[:-1] != 0)  # one border between runs
                found = tiles(p.tolist(), t[keep].tolist())
                matched.append(sum(k for k, _, _ in found))
                count.append(len(found))
            yield out(["cls", "item_id", "n_words", "matched", "n_tiles"], column(b, "cls"), column(b, "item_id"),
                      column(b, "n_words"), pa.array(matched, pa.int64()), pa.array(count, pa.int64()))

    return (pairs.select("cls", "item_id", "n_words", "item_words", "words")
            .transform(arrow_map, run, "cls binary, item_id long, n_words long, matched long, n_tiles long"))


def contamination(docs: DataFrame, bench: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_items, item_id, matched, n_words, n_tiles, coverage, kept) per document.

    Words are runs of other bytes than space and \\t..\\r, A-Z lower-cased.
    n_items counts the benchmark items of which tiles of TILE words or more
    cover ``coverage``; the other columns tell of the item covered most (ties:
    least item_id). kept is n_items = 0. A document that shares no seed has
    0, nulls, coverage 0.0 and is kept; so has one without text. Items with
    fewer than TILE words, no text or no id match nothing. Every row gives
    one row, also repeated ones and those with a null id; other columns are
    ignored.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items, seeds = item_words(bench, item_col, item_text, coverage)
    items, seeds = scratch.keep(items), scratch.keep(seeds)
    n, longest = seeds.count(), items.agg(F.max("n_words")).first()[0] or 0
    filt = bitmap(seeds, n)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = scratch.keep(suspects(rows, filt, max(1, longest // TILE)))
    texts = scratch.keep(found.where("cls is not null").groupBy("cls").agg(F.first("seeds").alias("seeds"), F.first("words").alias("words")))
    pairs = scratch.keep(texts.select("cls", F.explode("seeds").alias("seed")).join(seeds.where("joined"), "seed")
                         .select("cls", "item_id").distinct())
    both = pairs.join(texts.select("cls", "words"), "cls").join(
        items.select("item_id", "n_words", F.col("words").alias("item_words")), "item_id")
    tiled = scratch.keep(tile_pairs(both))
    share = F.col("matched") / F.col("n_words")
    best = F.max(F.struct(share.alias("coverage"), (-F.col("item_id")).alias("least"), "matched", "n_words", "n_tiles"))
    per = scratch.keep(tiled.groupBy("cls").agg(
        F.countDistinct(F.when(share >= coverage, F.col("item_id"))).alias("n_items"), best.alias("best")))
    return (found.select("doc_id", "cls").join(per, "cls", "left")
            .select("doc_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), (-F.col("best.least")).alias("item_id"),
                    "best.matched", "best.n_words", "best.n_tiles", F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"),
                    (F.coalesce("n_items", F.lit(0)) == 0).alias("kept")))
