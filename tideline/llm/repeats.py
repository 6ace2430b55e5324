"""Removal of byte strings that an earlier document also has (operator 10).

A depth-limited distributed suffix sort over a sample of positions with the
difference-cover property: every window of ``length`` bytes holds a sample
whose offset in it depends on the window's bytes alone, so two equal windows
have equal samples at equal offsets. (The sample is chosen by content, the
least hash among the window's ``GRAM``-byte strings, instead of by position
modulo 3; it keeps 2 in 37 positions rather than 2 in 3. See the README for
why.) Names are hash values: any order that puts equal strings side by side
serves to find repeats.

1. Sampled suffixes are sorted by the name of their first GRAM bytes. Windows
   whose sample occurs in one text only can't repeat and are dropped.
2. A window holds, besides its sample's GRAM bytes, half of its other bytes on
   one side of them at least. So the same is done with the names of a sample
   and that much before it, or after it.
3. Recursion on names: the stretch that all windows of one sample cover gets
   a name of its own; where the same stretch occurs in an earlier document,
   all its windows repeat there, and need not be sorted any more.
4. The remaining windows are sorted by name and neighbours compared; those
   that also start in an earlier document are marked.

Sorting happens in blocks: a task gathers names of up to ``FLUSH`` positions,
drops those it can decide itself (of equal names only the texts with the least
key go on), and
deals the rest by name to ``parts`` tasks, which sort them and send back the
names of each text that were found elsewhere. A string common to a third of
all documents thus reaches its task once per block.

Documents with equal texts are settled beforehand: all but the one with the
least id are removed whole, if they have ``length`` bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import U64, mix, powers, prefix_hash
from tideline.llm.scratch import Scratch

GRAM = 16
POS_BITS = 28
FLUSH = 1 << 18
SLICE = 1 << 18  # bytes of text worked on at once
PART_BYTES = 32 << 20  # text per part
LAST = (1 << 63) - 1  # order of rows with a null id: after all others

BLOCK = ("part int, kind int, cls binary, key binary, cnt binary, n1 binary, n2 binary, many binary")
REPLY = "cls long, names binary"


# ---- names --------------------------------------------------------------

def sampled(data: np.ndarray, offsets: np.ndarray, length: int):
    """(window starts, sample position of each, prefix hash) over the rows of a slice."""
    n = len(data)
    cum = prefix_hash(data)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), cum
    _, inv = powers(n + 1)
    g = mix((cum[GRAM:] - cum[:-GRAM]) * inv[:n - GRAM + 1])
    key = (g >> U64(POS_BITS) << U64(POS_BITS)) | np.arange(len(g), dtype=U64)
    width, have = length - GRAM + 1, 1
    while have < width:  # least key of windows of have, then up to twice as many grams
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    edge = np.zeros(n + 1, np.int64)
    lens = np.diff(offsets)
    long = lens >= length
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(edge)[:n - length + 1] > 0)
    return start, (key[start] & U64((1 << POS_BITS) - 1)).astype(np.int64), cum


def span_names(cum: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits naming the bytes from a to b."""
    _, inv = powers(len(cum))
    h = (cum[b] - cum[a]) * inv[a]
    n = (b - a).astype(U64)
    return mix(h + n), (mix(h ^ (n * U64(0xD6E8FEB86659FD93)) ^ U64(0xA0761D6478BD642F)) >> U64(32)).astype(np.uint32)


def row_of(pos: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, pos, "right") - 1


def sample_names(data, offsets, length):
    """Step 1: (name, 0, row) of every sampled suffix."""
    start, at, cum = sampled(data, offsets, length)
    at = np.unique(at)
    n1, _ = span_names(cum, at, at + GRAM)
    return n1, np.zeros(len(at), np.uint32), row_of(at, offsets)


def runs_of(start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of neighbouring windows with one sample."""
    new = np.append(True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)) if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(at)) - 1 if len(first) else first


LEFT = U64(0x2545F4914F6CDD1D)  # tells names of the left half from those of the right


def half_names(data, offsets, length):
    """Step 2: (name, row) of each run of windows with one sample, left and right halves; and the runs.

    A half is (names, runs that have it); the name covers the sample and half
    of the rest of a window on that side.
    """
    start, at, cum = sampled(data, offsets, length)
    first, last = runs_of(start, at)
    rest = length - GRAM
    side = (rest + 1) // 2
    s = at[first]
    left = np.flatnonzero(s - start[first] >= side)
    right = np.flatnonzero(rest - (s - start[last]) >= side)
    l1, _ = span_names(cum, s[left] - side, s[left] + GRAM)
    r1, _ = span_names(cum, s[right], s[right] + GRAM + side)
    return (l1 ^ LEFT, left), (r1, right), row_of(start[first], offsets), (start, at, first, last, rest, side)


def stretch_names(data, offsets, length):
    """Step 3: names of the stretch of each run of windows with one sample, and what it covers."""
    start, at, cum = sampled(data, offsets, length)
    first, last = runs_of(start, at)
    a, b = start[first], start[last] + length
    n1, n2 = span_names(cum, a, b)
    return n1, n2, row_of(a, offsets), (start, first, last, cum)


# ---- sort in blocks -----------------------------------------------------

def _replies(cls: np.ndarray, names: np.ndarray):
    """(cls, names binary) with one row per text."""
    o = np.argsort(cls, kind="stable")
    cls, names = cls[o], names[o]
    first = np.flatnonzero(np.append(True, cls[1:] != cls[:-1])) if len(cls) else np.empty(0, np.int64)
    ends = np.append(first[1:], len(cls))
    return cls[first], [names[a:b].tobytes() for a, b in zip(first, ends)]


def _decide(n1, n2, cls, key, many, later: bool):
    """Sort by name; (order, to go on, found elsewhere) of the sorted rows.

    Of rows with one name the first goes on; with ``later``, every text that
    has the least key of it (rows of one id, or without, may differ in text).
    """
    o = np.lexsort((cls, key, n2, n1) if later else (key, n2, n1))
    s1, s2 = n1[o], n2[o]
    new = np.append(True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) if len(o) else np.empty(0, bool)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    if later:  # neighbours with the same name and a smaller key before them
        k, c = key[o], cls[o]
        hit = k > k[first][group]
        new |= ~hit & np.append(True, c[1:] != c[:-1]) if len(o) else new
    else:
        c = cls[o]
        other = (c != c[first][group]) | many[o]
        hit = np.bincount(group, other, minlength=len(first))[group] > 0
    return o, new, hit


def find_names(rows: DataFrame, names_of: Callable[[pa.RecordBatch], Iterator[tuple]], later: bool, parts: int) -> DataFrame:
    """(cls, names): the names of each text that other texts have too.

    ``names_of`` yields (n1, n2, cls, key) arrays for a batch of ``rows``.
    With ``later``, only names that a text with a smaller key has count.
    """
    def deal(it):
        held: list[tuple] = []
        n = turn = 0

        def flush():
            nonlocal turn
            n1, n2, cls, key = (np.concatenate(x) for x in zip(*held))
            o, new, hit = _decide(n1, n2, cls, key, np.zeros(len(n1), bool), later)
            go = o[new]
            own = o[hit]
            if len(own):
                c, names = _replies(cls[own], n1[own])
                cnt = np.array([len(x) // 8 for x in names], np.uint32)
                turn += 1
                yield turn * 7919 % parts, 1, c.tobytes(), b"", cnt.tobytes(), b"".join(names), b"", b""
            part = (n1[go] % U64(parts)).astype(np.int64)
            p = np.lexsort((cls[go], part))
            go, part, many = go[p], part[p], hit[new][p]
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(go))):
                g = go[a:b]
                c = cls[g]
                f = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
                cnt = np.diff(np.append(f, len(g))).astype(np.uint32)
                yield (int(part[a]), 0, c[f].tobytes(), key[g][f].tobytes() if later else b"", cnt.tobytes(), n1[g].tobytes(),
                       n2[g].tobytes() if later else b"", b"" if later else np.packbits(many[a:b]).tobytes())

        def batch_out(found):
            cols = list(zip(*found))
            kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 6
            return out(["part", "kind", "cls", "key", "cnt", "n1", "n2", "many"], *[pa.array(c, k) for c, k in zip(cols, kinds)])

        for b in it:
            for x in names_of(b):
                if len(x[0]):
                    held.append(x)
                    n += len(x[0])
                if n >= FLUSH:
                    yield batch_out(list(flush()))
                    held, n = [], 0
        if n:
            yield batch_out(list(flush()))

    def settle(it):
        held: list[tuple] = []
        for b in it:
            for r in b.to_pylist():
                cnt = np.frombuffer(r["cnt"], np.uint32)
                cls, n1 = np.frombuffer(r["cls"], np.int64), np.frombuffer(r["n1"], U64)
                if r["kind"] == 1:  # decided where it was found
                    ends = np.cumsum(cnt.astype(np.int64))
                    yield out(["cls", "names"], pa.array(cls), pa.array([n1[e - k:e].tobytes() for e, k in zip(ends, cnt)], pa.binary()))
                    continue
                k = np.frombuffer(r["key"], np.int64) if later else np.zeros(len(cls), np.int64)
                n2 = np.frombuffer(r["n2"], np.uint32) if later else np.zeros(len(n1), np.uint32)
                many = np.zeros(len(n1), bool) if later else np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(n1)).astype(bool)
                held.append((n1, n2, np.repeat(cls, cnt), np.repeat(k, cnt), many))
        if held:
            cols = [list(x) for x in zip(*held)]
            held.clear()
            n1, n2, cls, key, many = (np.concatenate(cols.pop(0)) for _ in range(5))
            o, _, hit = _decide(n1, n2, cls, key, many, later)
            c, names = _replies(cls[o[hit]], n1[o[hit]])
            for lo in range(0, len(c), 10_000):
                yield out(["cls", "names"], pa.array(c[lo:lo + 10_000]), pa.array(names[lo:lo + 10_000], pa.binary()))

    return rows.transform(arrow_map, deal, BLOCK).repartitionById(parts, F.col("part")).transform(arrow_map, settle, REPLY)


def merged(replies: DataFrame, name: str) -> DataFrame:
    """All names of each text in one array (they are names of that text only)."""
    return replies.groupBy("cls").agg(F.collect_list("names").alias(name))


# ---- the passes ---------------------------------------------------------

def _names(value) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(value or []), U64))


def _in(x: np.ndarray, row: np.ndarray, names: list[np.ndarray]) -> np.ndarray:
    """Which of x is among the names of its row (rows ascending)."""
    res = np.zeros(len(x), bool)
    cuts = np.searchsorted(row, np.arange(len(names) + 1))
    for i, s in enumerate(names):
        a, b = cuts[i], cuts[i + 1]
        if b > a and len(s):
            j = np.minimum(np.searchsorted(s, x[a:b]), len(s) - 1)
            res[a:b] = s[j] == x[a:b]
    return res


def _ids(b: pa.RecordBatch, lo: int, hi: int, name: str) -> np.ndarray:
    return column(b, name).slice(lo, hi - lo).to_numpy(zero_copy_only=False)


def _pieces(b: pa.RecordBatch, lo: int, hi: int, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(borders of the regions of a slice of texts, text of each region)."""
    cuts = column(b, "cut").slice(lo, hi - lo).to_pylist()
    return (np.concatenate([[0], *[o + np.asarray(c, np.int64) for o, c in zip(offs, cuts)]]),
            np.repeat(np.arange(hi - lo), [len(c) for c in cuts]))


def zipped(df: DataFrame) -> DataFrame:
    """``df`` with its column ``text`` as zstandard, to be shuffled."""
    kind = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in df.schema])

    def run(it):
        z = zstandard.ZstdCompressor(level=1)
        for b in it:
            i = b.schema.get_field_index("text")
            yield b.set_column(i, "text", pa.array([z.compress(x.as_py()) for x in b.column(i).cast(pa.large_binary())], pa.binary()))

    return df.transform(arrow_map, run, kind)


def unzipped(b: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of ``zipped`` with its texts as bytes."""
    z, i = zstandard.ZstdDecompressor(), b.schema.get_field_index("text")
    return b.set_column(i, "text", pa.array([z.decompress(x.as_py()) for x in b.column(i)], pa.large_binary()))


REGION = "sha string, cls long, key long, at array<long>, cut array<long>, text binary"


def regions_out(b: pa.RecordBatch, lo: int, hi: int, data: np.ndarray, a: np.ndarray, z: np.ndarray, row: np.ndarray,
                at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per text with regions a to z of a slice: their places ``at`` in the text, their ends in ``text``, their bytes."""
    raw, one = data.tobytes(), np.unique(row)
    own = [slice(*x) for x in zip(np.searchsorted(row, one), np.searchsorted(row, one, "right"))]
    yield out(["sha", "cls", "key", "at", "cut", "text"], column(b, "sha").slice(lo, hi - lo).take(pa.array(one)), pa.array(_ids(b, lo, hi, "cls")[one]), pa.array(_ids(b, lo, hi, "key")[one]),
              pa.array([at[x].tolist() for x in own], pa.list_(pa.int64())),
              pa.array([np.cumsum((z - a)[x]).tolist() for x in own], pa.list_(pa.int64())),
              pa.array([b"".join(raw[i:j] for i, j in zip(a[x], z[x])) for x in own], pa.binary()))


def repeated_spans(rows: DataFrame, least: DataFrame, length: int, parts: int, scratch: Scratch) -> DataFrame:
    """(sha, spans) of the byte runs to remove from each text: int64 pairs, in order.

    ``rows`` has (sha, cls, key, n_bytes, text), ``least`` the least key of
    each text; a run is covered by ``length``-byte strings that a text with a
    smaller key also has.
    """
    def first_names(b):
        for lo, hi, offs, data in text_slices(b, "text", SLICE):
            n1, n2, row = sample_names(data, offs, length)
            cls = _ids(b, lo, hi, "cls")
            _, one = np.unique(n1 ^ mix(row.astype(U64) + U64(1)), return_index=True)
            yield n1[one], n2[one], cls[row[one]], np.zeros(len(one), np.int64)

    common = scratch.keep(merged(find_names(rows.where(F.col("n_bytes") >= length).select("cls", "text"), first_names, False, parts), "common")
                          .join(least, "cls").select("sha", F.col("least").alias("key"), "common"), large=True)

    def cut(it):
        """Regions: runs of windows whose sample occurs in another text."""
        for b in map(unzipped, it):
            for lo, hi, offs, data in text_slices(b, "text", SLICE):
                start, at, cum = sampled(data, offs, length)
                row = row_of(start, offs)
                n1, _ = span_names(cum, at, at + GRAM)
                hit = _in(n1, row, [_names(x) for x in column(b, "common").slice(lo, hi - lo).to_pylist()])
                s, r = start[hit], row[hit]
                if not len(s):
                    continue
                f = np.flatnonzero(np.append(True, (s[1:] > s[:-1] + 1) | (r[1:] != r[:-1])))
                a, z, r = s[f], s[np.append(f[1:], len(s)) - 1] + length, r[f]
                yield from regions_out(b, lo, hi, data, a, z, r, a - offs[r])

    regions = scratch.keep(zipped(rows.select("sha", "cls", "key", "text")).join(common, ["sha", "key"]).select("sha", "cls", "key", "text", "common").transform(arrow_map,
        cut, REGION), large=True)

    def both_halves(b):
        for lo, hi, offs, data in text_slices(b, "text", SLICE):
            inner, row_at = _pieces(b, lo, hi, offs)
            (l1, left), (r1, right), piece, _ = half_names(data, inner, length)
            n1, row = np.concatenate([l1, r1]), row_at[piece[np.concatenate([left, right])]]
            _, one = np.unique(n1 ^ mix(row.astype(U64) + U64(1)), return_index=True)
            yield n1[one], np.zeros(len(one), np.uint32), _ids(b, lo, hi, "cls")[row[one]], np.zeros(len(one), np.int64)

    halves = scratch.keep(merged(find_names(regions.select("cls", "cut", "text"), both_halves, False, parts), "halves"), large=True)

    def narrow(it):
        """Regions: runs of windows of which a half occurs in another text."""
        for b in it:
            for lo, hi, offs, data in text_slices(b, "text", SLICE):
                inner, row_at = _pieces(b, lo, hi, offs)
                (l1, left), (r1, right), piece, (start, at, first, last, rest, side) = half_names(data, inner, length)
                names = [_names(x) for x in column(b, "halves").slice(lo, hi - lo).to_pylist()]
                hit = np.zeros((2, len(first)), bool)
                hit[0, left] = _in(l1, row_at[piece[left]], names)
                hit[1, right] = _in(r1, row_at[piece[right]], names)
                n = last - first + 1
                before = at - start
                keep = np.repeat(hit[0], n) & (before >= side) | np.repeat(hit[1], n) & (rest - before >= side)
                s, q = start[keep], np.repeat(piece, n)[keep]
                if not len(s):
                    continue
                f = np.flatnonzero(np.append(True, (s[1:] > s[:-1] + 1) | (q[1:] != q[:-1])))
                places = np.concatenate([np.asarray(x, np.int64) for x in column(b, "at").slice(lo, hi - lo).to_pylist()])
                yield from regions_out(b, lo, hi, data, s[f], s[np.append(f[1:], len(s)) - 1] + length, row_at[q[f]],
                                       s[f] + (places - inner[:-1])[q[f]])

    wide = regions
    regions = scratch.keep(wide.join(halves, "cls").transform(arrow_map, narrow, REGION), large=True)
    scratch.drop(common, wide, halves)

    def second_names(b):
        for lo, hi, offs, data in text_slices(b, "text", SLICE):
            inner, row_at = _pieces(b, lo, hi, offs)
            n1, n2, piece, _ = stretch_names(data, inner, length)
            yield n1, n2, _ids(b, lo, hi, "cls")[row_at[piece]], _ids(b, lo, hi, "key")[row_at[piece]]

    whole = scratch.keep(merged(find_names(regions.drop("at"), second_names, True, parts), "whole"), large=True)
    part = regions.join(whole, "cls", "left")

    def open_windows(b, lo, hi, offs, data):
        """Windows of a slice: starts, regions, texts, whether their stretch repeats; and the prefix hash."""
        inner, row_at = _pieces(b, lo, hi, offs)
        n1, _, piece, (start, first, last, cum) = stretch_names(data, inner, length)
        hit = _in(n1, row_at[piece], [_names(x) for x in column(b, "whole").slice(lo, hi - lo).to_pylist()])
        n = last - first + 1
        piece = np.repeat(piece, n)
        return start, piece, row_at[piece], np.repeat(hit, n), cum, inner

    def third_names(b):
        for lo, hi, offs, data in text_slices(b, "text", SLICE):
            start, _, row, done, cum, _ = open_windows(b, lo, hi, offs, data)
            s, row = start[~done], row[~done]
            n1, n2 = span_names(cum, s, s + length)
            yield n1, n2, _ids(b, lo, hi, "cls")[row], _ids(b, lo, hi, "key")[row]

    single = scratch.keep(merged(find_names(part.drop("at"), third_names, True, 4 * parts), "single"), large=True)

    def mark(it):
        for b in it:
            for lo, hi, offs, data in text_slices(b, "text", SLICE):
                start, piece, row, done, cum, inner = open_windows(b, lo, hi, offs, data)
                n1, _ = span_names(cum, start, start + length)
                done |= _in(n1, row, [_names(x) for x in column(b, "single").slice(lo, hi - lo).to_pylist()])
                s, q = start[done], piece[done]
                if not len(s):
                    continue
                f = np.flatnonzero(np.append(True, (s[1:] > s[:-1] + length) | (q[1:] != q[:-1])))
                at = np.concatenate([np.asarray(x, np.int64) for x in column(b, "at").slice(lo, hi - lo).to_pylist()])
                base = (at - inner[:-1])[q[f]]
                a, z, r = s[f] + base, s[np.append(f[1:], len(s)) - 1] + length + base, row[done][f]
                one = np.unique(r)
                own = zip(np.searchsorted(r, one), np.searchsorted(r, one, "right"))
                yield out(["sha", "spans"], column(b, "sha").slice(lo, hi - lo).take(pa.array(one)),
                          pa.array([np.stack([a[i:j], z[i:j]], axis=1).tobytes() for i, j in own], pa.binary()))

    spans = scratch.keep(part.join(single, "cls", "left").select("sha", "at", "cut", "text", "whole", "single")
                        .transform(arrow_map, mark, "sha string, spans binary").dropDuplicates(["sha"]), large=True)  # a row can be there twice
    scratch.drop(regions, whole, single)
    return spans


def union_spans(spans) -> list[tuple[int, int]]:
    """Sorted (a, z) runs, overlapping or touching ones joined."""
    res: list[list[int]] = []
    for a, z in spans:
        if res and a <= res[-1][1]:
            res[-1][1] = max(res[-1][1], z)
        else:
            res.append([a, z])
    return [tuple(x) for x in res]


def with_spans(docs: DataFrame, length: int, id_col: str, text_col: str, *carried) -> DataFrame:
    """(doc_id, key, text, least, spans, and the ``carried`` columns) of every row; text is zipped."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    scratch = Scratch(docs.sparkSession, "repeats")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carried)
            .withColumn("key", F.coalesce("doc_id", F.lit(LAST)))
            .withColumn("sha", F.sha2("text", 256)).withColumn("cls", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))
            .withColumn("n_bytes", F.octet_length("text").cast("long")))
    least = scratch.keep(rows.where(F.col("n_bytes") >= length).groupBy("sha", "cls")
                         .agg(F.min("key").alias("least"), F.first("n_bytes").alias("n")))
    total = least.agg(F.sum("n")).first()[0] or 0
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(12, floor), -(-total // PART_BYTES))
    spans = repeated_spans(rows, least, length, parts, scratch)
    settled = scratch.keep(least.join(spans, "sha", "left").select("sha", "least", "spans"))
    scratch.drop(least, spans)
    return zipped(rows.drop("cls", "n_bytes")).join(settled, "sha", "left").drop("sha")


def cuts_of(length: int, key: int, least: int | None, spans: bytes | None) -> list[tuple[int, int]]:
    """Runs to remove from a text of ``length`` bytes: all of a copy, else its spans."""
    if least is not None and key > least:
        return [(0, length)]
    return union_spans(np.frombuffer(spans or b"", np.int64).reshape(-1, 2).tolist())


def without_cuts(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, z in cuts:
        parts.append(text[at:a])
        at = z
    return b"".join([*parts, text[at:]])


def cut_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, their texts without what ``remove_repeats`` removes.

    A character that loses a byte goes whole. Rows of whose text nothing is
    left go; texts that were null or empty before stay as they are. Other
    columns are unchanged, whatever their names.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = with_spans(docs, length, id_col, text_col,
                      F.struct(F.col(f"`{text_col}`").isNull().alias("no_text"), *others).alias("row"))
    names, at = list(docs.columns), docs.columns.index(text_col)

    def run(it):
        z = zstandard.ZstdDecompressor()
        for b in it:
            none, *cols = column(b, "row").flatten()
            texts, keep = [], []
            key, least, spans = (column(b, c) for c in ("key", "least", "spans"))
            for i, t in enumerate(column(b, "text")):
                t = z.decompress(t.as_py())
                cuts = cuts_of(len(t), key[i].as_py(), least[i].as_py(), spans[i].as_py())
                left = without_cuts(t, cuts).decode("utf-8", "ignore")
                texts.append(None if none[i].as_py() else left)
                keep.append(not cuts or left != "")
            cols.insert(at, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep, pa.bool_()))

    return rows.select("row", "text", "key", "least", "spans").transform(arrow_map, run, docs.schema)


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).

    Removed is every byte covered by a ``length``-byte string that also starts
    in a document with a smaller id, judged on the input; ``kept`` is the
    rest, which may cut a UTF-8 character. A null text is empty. Rows of one
    id never remove from each other; rows with a null id count as last and
    remove from nothing but lose what others have. Texts shorter than
    ``length`` lose nothing. Other columns are ignored.
    """
    both = with_spans(docs, length, id_col, text_col)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]

    def apply(it):
        z = zstandard.ZstdDecompressor()
        for b in it:
            found, size = [], 0
            doc, key, least, spans = (column(b, c) for c in ("doc_id", "key", "least", "spans"))
            for i, text in enumerate(column(b, "text")):
                text = z.decompress(text.as_py())
                cuts = cuts_of(len(text), key[i].as_py(), least[i].as_py(), spans[i].as_py())
                kept = without_cuts(text, cuts)
                found.append((doc[i].as_py(), len(text), len(text) - len(kept), len(cuts), sha256(kept).hexdigest(), kept))
                size += len(kept)
                if size >= 1 << 22 or i + 1 == b.num_rows:
                    yield out(names, *[pa.array(c, k) for c, k in zip(zip(*found), kinds)])
                    found, size = [], 0

    schema = T.StructType([*[T.StructField(n, T.LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    return both.select("doc_id", "key", "text", "least", "spans").transform(arrow_map, apply, schema)
