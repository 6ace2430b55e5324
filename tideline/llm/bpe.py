"""Byte-level BPE encoding and decoding (operator 1).

A piece (one match of the pattern) that is itself in the vocabulary is one
id. Any other piece is merged by a segment tree over its byte positions: leaf
``i`` holds ``rank << SHIFT | i`` for the pair that starts at live position
``i`` (or INF), an inner node the minimum of its children, so the root is the
leftmost pair of lowest rank. A merge changes three leaves (the merged
position, its dead right half, its live left neighbour), each a logarithmic
point update. Pieces of up to ``BATCH_LEN`` bytes are merged many at a time,
one row of a 2-d tree each; longer pieces have a tree of their own.

Distinct pieces repeat a lot, so each worker keeps the ids of pieces it has
seen, up to ``memo_size`` of them (then it starts anew).
"""

from __future__ import annotations

import base64
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.arrow import arrow_map, column, out
from tideline.llm.memo import MEMO_SIZE, Memo, batches_of

SHIFT = 32
INF = np.int64(1) << np.int64(62)
BATCH_LEN = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Merger:
    """Merge tables of one rank file, and the encoding of pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, made = [], [], []
        for tok, r in ranks.items():
            for i in range(1, len(tok)):
                a = ranks.get(tok[:i])
                if a is not None:
                    b = ranks.get(tok[i:])
                    if b is not None:
                        left.append(a)
                        right.append(b)
                        made.append(r)
        key = np.array(left, np.int64) << SHIFT | np.array(right, np.int64)
        o = np.argsort(key)
        self.pair_key = np.append(key[o], INF)
        self.pair_rank = np.append(np.array(made, np.int64)[o], -1)
        self.pairs = dict(zip(zip(left, right), made))

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; -1 where the pair is no token (or an id is -1)."""
        k = a << SHIFT | b
        i = np.searchsorted(self.pair_key, k)
        return np.where((self.pair_key[np.minimum(i, len(self.pair_key) - 1)] == k) & (a >= 0) & (b >= 0),
                        self.pair_rank[np.minimum(i, len(self.pair_key) - 1)], -1)

    def encode_one(self, piece: bytes) -> list[int]:
        """One piece, by a segment tree of its own."""
        n = len(piece)
        if n == 1:
            return [int(self.byte_id[piece[0]])]
        size = 1 << (n - 1).bit_length()
        ids = [int(x) for x in self.byte_id[np.frombuffer(piece, np.uint8)]]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        inf = int(INF)
        pairs = self.pairs.get

        def leaf(i: int) -> int:
            j = nxt[i]
            r = pairs((ids[i], ids[j])) if j < n else None
            return inf if r is None else r << SHIFT | i

        tree = [inf] * (2 * size)
        tree[size:size + n] = [leaf(i) for i in range(n)]
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, v: int) -> None:
            i += size
            tree[i] = v
            while i > 1:
                m = min(tree[i], tree[i ^ 1])
                i >>= 1
                if tree[i] == m:
                    break
                tree[i] = m

        while tree[1] < inf:
            p = tree[1] & ((1 << SHIFT) - 1)
            ids[p] = tree[1] >> SHIFT
            q = nxt[p]
            nxt[p] = nxt[q]
            if nxt[p] < n:
                prv[nxt[p]] = p
            nxt[q] = -1
            put(q, inf)
            put(p, leaf(p))
            if prv[p] >= 0:
                put(prv[p], leaf(prv[p]))
        res, i = [], 0
        while i < n:
            res.append(ids[i])
            i = nxt[i]
        return res

    def encode_batch(self, pieces: list[bytes]) -> list[list[int]]:
        """Pieces of 2 to BATCH_LEN bytes, each in a row of a common tree array."""
        w = len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, w)
        size = 1 << int(int(lens.max()) - 1).bit_length()
        flat = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((w, size + 1), -1, np.int64)  # one spare column: "no neighbour"
        pos = np.arange(size)
        inside = pos[None, :] < lens[:, None]
        ids[:, :size][inside] = flat
        nxt = np.broadcast_to(np.arange(1, size + 2), (w, size + 1)).copy()
        nxt = np.where(nxt < lens[:, None], nxt, size)
        prv = np.broadcast_to(np.arange(-1, size), (w, size + 1)).copy()
        prv[:, 0] = size
        tree = np.full((w, 2 * size), INF)
        r = self.rank_of(ids[:, :size], ids[:, 1:])
        tree[:, size:] = np.where(r >= 0, r << SHIFT | pos, INF)
        step = size
        while step > 1:
            tree[:, step // 2:step] = np.minimum(tree[:, step:2 * step:2], tree[:, step + 1:2 * step:2])
            step //= 2
        live = np.flatnonzero(tree[:, 1] < INF)

        def put(rows: np.ndarray, i: np.ndarray, v: np.ndarray) -> None:
            i = i + size
            tree[rows, i] = v
            while i[0] > 1:  # all leaves are at one depth
                m = np.minimum(tree[rows, i], tree[rows, i ^ 1])
                i = i >> 1
                tree[rows, i] = m

        def refresh(rows: np.ndarray, i: np.ndarray) -> None:
            rank = self.rank_of(ids[rows, i], ids[rows, nxt[rows, i]])
            put(rows, i, np.where(rank >= 0, rank << SHIFT | i, INF))

        while len(live):
            root = tree[live, 1]
            p = root & ((1 << SHIFT) - 1)
            ids[live, p] = root >> SHIFT
            q = nxt[live, p]
            after = nxt[live, q]
            nxt[live, p] = after
            prv[live, after] = p  # the spare column takes writes past the end
            ids[live, q] = -1
            put(live, q, np.full(len(live), INF))
            refresh(live, p)
            before = prv[live, p]
            has = before < size
            if has.any():
                refresh(live[has], before[has])
            live = live[tree[live, 1] < INF]
        keep = ids[:, :size] >= 0
        flat_ids = ids[:, :size][keep].tolist()
        ends = np.cumsum(keep.sum(axis=1)).tolist()
        return [flat_ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        res: list[list[int] | None] = [None] * len(pieces)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for i, p in enumerate(pieces):
            b = p.encode()
            r = self.ranks.get(b)
            if r is not None:
                res[i] = [r]
            elif len(b) > BATCH_LEN:
                res[i] = self.encode_one(b)
            else:
                groups.setdefault((len(b) - 1).bit_length(), []).append((i, b))
        for g in groups.values():
            for lo in range(0, len(g), 20_000):
                part = g[lo:lo + 20_000]
                for (i, _), ids in zip(part, self.encode_batch([b for _, b in part])):
                    res[i] = ids
        return res


_mergers: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    if path not in _mergers:
        _mergers[path] = Merger(load_ranks(path))
    return _mergers[path]


def piece_encoder(path: str, pattern: str):
    """Encode texts: every match of the pattern by itself."""
    find, m = regex.compile(pattern).findall, merger(path)

    def encode(texts: list[str]) -> list[list[int]]:
        found = [find(t) for t in texts]
        pieces = list({p for f in found for p in f})
        ids = dict(zip(pieces, m.encode_pieces(pieces)))
        return [[i for p in f for i in ids[p]] for f in found]

    return encode


_memos: dict[tuple, Memo] = {}


def bpe_memo(path: str, pattern: str, size: int) -> Memo:
    """Texts are cut into words for the pattern whose matches are known to start there; others get them whole."""
    key = (path, pattern, size)
    if key not in _memos:
        whole = pattern != public_tokenizers.PATTERN
        _memos[key] = Memo(piece_encoder(path, pattern), size, lambda text: whole)
    return _memos[key]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", memo_size: int = MEMO_SIZE) -> DataFrame:
    """(``id_col``, ids binary) per row: token ids as little-endian uint32.

    Every match of ``pattern`` is encoded by itself, whatever the pattern. No
    special tokens. A null or empty text has no ids; every row of the
    input gives one row, also repeated ones and those with a null id. Other
    columns are ignored whatever their names.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("ids", T.BinaryType())])

    def run(it):
        memo = bpe_memo(rank_file, pattern, memo_size)
        for b in it:
            ids = [x for part in batches_of(column(b, "_text").to_pylist()) for x in memo.encode_texts(part)]
            yield out([id_col, "ids"], column(b, "_id"), pa.array(ids, pa.binary()))

    return _source(docs, id_col, text_col).transform(arrow_map, run, schema)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def decode_bytes(ids: bytes, table: np.ndarray, offsets: np.ndarray) -> bytes:
    """Bytes of the tokens of little-endian uint32 ids."""
    i = np.frombuffer(ids, "<u4").astype(np.int64)
    n = offsets[i + 1] - offsets[i]
    ends = np.cumsum(n)
    where = np.repeat(offsets[i] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)
    return table[where].tobytes()


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def decode_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All token bytes one after the other, and where each id starts."""
    if path not in _tables:
        m = merger(path)
        top = max(m.bytes_of) + 1
        toks = [m.bytes_of.get(i, b"") for i in range(top)]
        _tables[path] = (np.frombuffer(b"".join(toks), np.uint8),
                         np.append(0, np.cumsum([len(t) for t in toks])).astype(np.int64))
    return _tables[path]


def decode(encoded: DataFrame, rank_file: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, data binary) from the rows of ``encode``; null ids give empty bytes."""
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType),
                           T.StructField("data", T.BinaryType())])

    def run(it):
        table, offs = decode_table(rank_file)
        for b in it:
            data = [decode_bytes(x or b"", table, offs) for x in column(b, "ids").to_pylist()]
            yield out([id_col, "data"], column(b, id_col), pa.array(data, pa.binary()))

    return encoded.select(id_col, "ids").transform(arrow_map, run, schema)


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", memo_size: int = MEMO_SIZE, keep_ids: bool = False) -> DataFrame:
    """Encode each text, decode the ids, and digest both in one pass.

    Returns (``id_col``, n_tokens, ids_sha256, decoded_sha256), with
    ``keep_ids`` also ids binary. ids_sha256 is of the decimal ids joined by
    one space. Nulls, empty texts and repeated rows as in ``encode``.
    """
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(it):
        memo = bpe_memo(rank_file, pattern, memo_size)
        table, offs = decode_table(rank_file)
        decimal = [str(i) for i in range(len(offs) - 1)]
        for b in it:
            n, a, d, raw = [], [], [], []
            for part in batches_of(column(b, "_text").to_pylist()):
                for ids in memo.encode_texts(part):
                    n.append(len(ids) // 4)
                    a.append(sha256(" ".join([decimal[i] for i in memoryview(ids).cast("I")]).encode()).hexdigest())
                    d.append(sha256(decode_bytes(ids, table, offs)).hexdigest())
                    if keep_ids:
                        raw.append(ids)
            cols = [column(b, "_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
            yield out([f.name for f in fields], *cols, *[pa.array(raw, pa.binary())] * keep_ids)

    return _source(docs, id_col, text_col).transform(arrow_map, run, T.StructType(fields))
