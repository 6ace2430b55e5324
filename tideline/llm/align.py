"""Alignment of the tokens of two tokenizers over the same bytes (operator 12).

A is a byte-level BPE of the tokenizers library, fed space + text; B is a
sentencepiece BPE, fed the text (it adds the space itself). Both cover the same
bytes, so every token is a byte range. All tokens of both sides are sorted by
start (``lexsort``), the ends are accumulated to a running maximum, and a group
begins where a start reaches it: those are the offsets where tokens of both
sides end. Within groups the overlapping pairs of A and B are expanded, by
binary search, so a token meets only its neighbours; ``links`` says which of
them count.

Texts are cut at single spaces between visible characters. No token of either
side reaches over such a place (A's split pattern starts a match there, and B
has no piece with a space mark inside; both are checked when the files are
loaded, other tokenizers get their texts whole). So the alignment of a text is
that of its words, one after the other, and a shard of about ``SHARD_BYTES`` of
text aligns each distinct word once.

The counts of id pairs are taken over the corpus: every shard sends its
distinct pairs with their counts, they are summed by pair, the highest count of
each B id is found, and the shards get their pairs back. A pair that is in
every text is sent once per shard.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import U64, mix, powers, prefix_hash
from tideline.llm.memo import ranges, space_cuts
from tideline.llm.scratch import Scratch

SHARD_BYTES = 4 << 20
CHUNK_BYTES = 1 << 15  # words encoded together
BLOCK_WORDS = 1 << 14  # words aligned together
MARK = "▁"
SHARD = ("shard long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
         "groups_sha256 array<string>, doc_words binary, doc_ends binary, word_links binary, word_ends binary, "
         "a array<int>, b array<int>, n array<long>")


# ---- tokenizers ---------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: visible Latin-1 ones stand for themselves, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Side:
    """One tokenizer: ids of texts, the bytes of each id, and whether texts may be cut at single spaces."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.length = np.array([len(b) for b in token_bytes], np.int64)

    def covers(self, ids: list[int], raw: bytes) -> bool:
        return b"".join([self.bytes[i] for i in ids]) == raw


class ByteSide(Side):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                     and pre.get("use_regex", True) and not conf.get("normalizer") and not conf.get("truncation"))
        self.added = [a["content"] for a in conf.get("added_tokens", []) if not a.get("special")]
        byte = byte_alphabet()
        vocab = self.lib.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            table[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        super().__init__(table)

    def encode(self, raws: list[bytes]) -> list[list[int]]:
        """Ids of space + text each."""
        return [e.ids for e in self.lib.encode_batch_fast([r.decode() for r in raws], add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.lib.serialized_model_proto())
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        norm = model.normalizer_spec
        self.cuts = (norm.name == "identity" and norm.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix
                     and not any(MARK in p.lstrip(MARK) for p in pieces)
                     and model.trainer_spec.model_type == model.trainer_spec.BPE)
        super().__init__([bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else p.replace(MARK, " ").encode()
                          for i, p in enumerate(pieces)])

    def encode(self, raws: list[bytes]) -> list[list[int]]:
        """Ids of space + text each, from the text."""
        return self.lib.encode([r[1:].decode() for r in raws], num_threads=1)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    return ByteSide(path_a), PieceSide(path_b)


# ---- groups and links ---------------------------------------------------

def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group of each in that order) of intervals: a group ends where a start reaches the running maximum end."""
    order = np.lexsort((ends, starts))
    if not len(order):
        return order, np.zeros(0, np.int64)
    reach = np.maximum.accumulate(ends[order])
    new = np.append(False, starts[order][1:] >= reach[:-1])
    return order, np.cumsum(new)


def overlaps(a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all intervals a_i, b_j that share a byte; each side is sorted and has no overlap in itself."""
    lo, hi = np.searchsorted(b1, a0, "right"), np.searchsorted(b0, a1, "left")
    n = np.maximum(hi - lo, 0)
    return np.repeat(np.arange(len(a0)), n), ranges(lo, n)


@dataclass
class Words:
    """The alignment of words laid end to end; per word: token, group and link counts, its groups as text."""
    bad: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[bytes]
    link_word: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _tokens(side: Side, words: list[bytes], joint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, word of each id, words whose tokens don't give their bytes); ``joint`` words may be encoded together."""
    ids, owner, bad = [], [], np.zeros(len(words), bool)
    run, size, runs = [], 0, []
    for i in np.flatnonzero(joint).tolist():
        run.append(i)
        size += len(words[i])
        if size >= CHUNK_BYTES:
            runs.append(run)
            run, size = [], 0
    runs += [run] if run else []
    single = np.flatnonzero(~joint).tolist()
    for part, found in zip(runs, side.encode([b"".join([words[i] for i in r]) for r in runs]) if runs else []):
        if not side.covers(found, b"".join([words[i] for i in part])):
            single += part
            continue
        found = np.array(found, np.int64)
        ends = np.cumsum([len(words[i]) for i in part])
        ids.append(found)
        owner.append(np.array(part)[np.searchsorted(ends, np.cumsum(side.length[found]), "left")])
    for i, found in zip(single, side.encode([words[i] for i in single]) if single else []):
        if side.covers(found, words[i]):
            ids.append(np.array(found, np.int64))
            owner.append(np.full(len(found), i))
        else:
            bad[i] = True
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return ids[order], owner[order], bad


def align_words(a: Side, b: Side, words: list[bytes], joint: np.ndarray, links: str) -> Words:
    """Align each word; those whose tokens don't cover them on both sides are bad and have none."""
    parts = [_align_block(a, b, words[lo:lo + BLOCK_WORDS], joint[lo:lo + BLOCK_WORDS], links)
             for lo in range(0, max(1, len(words)), BLOCK_WORDS)]
    for i, p in enumerate(parts):
        p.link_word += i * BLOCK_WORDS
    joined = {f: np.concatenate([getattr(p, f) for p in parts]) for f in Words.__dataclass_fields__ if f != "groups"}
    return Words(groups=[g for p in parts for g in p.groups], **joined)


def _align_block(a: Side, b: Side, words: list[bytes], joint: np.ndarray, links: str) -> Words:
    n = len(words)
    ids_a, own_a, bad_a = _tokens(a, words, joint)
    ids_b, own_b, bad_b = _tokens(b, words, joint)
    bad = bad_a | bad_b
    ids_a, own_a = ids_a[~bad[own_a]], own_a[~bad[own_a]]
    ids_b, own_b = ids_b[~bad[own_b]], own_b[~bad[own_b]]
    end_a, end_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
    start_a, start_b = end_a - a.length[ids_a], end_b - b.length[ids_b]
    order, group = coalesce(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]))
    m = len(ids_a)
    of = np.empty(len(order), np.int64)
    of[order] = group
    first_a = np.append(True, of[:m][1:] != of[:m][:-1])[:m]
    n_groups = np.bincount(own_a[first_a], minlength=n)
    # the groups as text: every token with what stands before it, sorted by group, then side
    new_word = first_a & np.append(True, own_a[1:] != own_a[:-1])[:m]
    first_b = np.append(True, of[m:][1:] != of[m:][:-1])[:len(ids_b)]
    before = np.concatenate([np.where(new_word, 3, np.where(first_a, 2, 0)), np.where(first_b, 1, 0)])
    sep = (",", "|", ";", "\n")
    text = [sep[s] + str(i) for s, i in zip(before.tolist(), np.concatenate([ids_a, ids_b]).tolist())]
    side = np.repeat([0, 1], [m, len(ids_b)])
    joined = "".join([text[i] for i in np.lexsort((np.arange(len(of)), side, of)).tolist()]).encode().split(b"\n")[1:]
    groups = [b""] * n
    for w, g in zip(own_a[new_word].tolist(), joined):
        groups[w] = g
    i, j = overlaps(start_a, end_a, start_b, end_b)
    if links == "end":
        same = end_a[i] == end_b[j]
        i, j = i[same], j[same]
    return Words(bad, np.bincount(own_a, minlength=n), np.bincount(own_b, minlength=n), n_groups, groups,
                 own_a[i], ids_a[i], ids_b[j])


# ---- shards -------------------------------------------------------------

def _spaced(offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space before each that is not empty."""
    some = np.diff(offs) > 0
    wide = np.insert(data, offs[:-1][some], 32)
    return offs + np.append(0, np.cumsum(some)), wide


def joinable(words: list[bytes], added: list[bytes]) -> np.ndarray:
    """Words that others may stand next to: cuts on both sides of them, and no added token inside."""
    length = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(length + 3) - length - 2
    cut = space_cuts(np.frombuffer(b"".join([b"." + w + b" ." for w in words]), np.uint8))
    ok = cut[first] & cut[first + length] if len(words) else np.zeros(0, bool)
    return ok & ~np.array([any(x in w for x in added) for w in words], bool) if added else ok


class _Shard:
    def __init__(self):
        self.ids, self.words, self.ends, self.size, self.n = [], [], [], 0, 0
        self.seen: dict[bytes, int] = {}

    def add(self, ids: pa.Array, offs: np.ndarray, data: np.ndarray, cuts: bool, added: list[bytes]) -> None:
        offs, data = _spaced(offs, data)
        begin = space_cuts(data) if cuts else np.zeros(len(data), bool)
        for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()) if added else []:
            raw = data[lo:hi].tobytes()
            if any(x in raw for x in added):
                begin[lo:hi] = False
        begin[offs[:-1][np.diff(offs) > 0]] = True
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(data))[:len(first)]
        cum = prefix_hash(data)
        _, inv = powers(len(data) + 1)
        _, one, back = np.unique(mix((cum[last] - cum[first]) * inv[first] + (last - first).astype(U64)),
                                 return_index=True, return_inverse=True)
        number = np.array([self.seen.setdefault(data[i:j].tobytes(), len(self.seen))
                           for i, j in zip(first[one].tolist(), last[one].tolist())], np.int64)
        self.ids.append(ids)
        self.words.append(number[back].astype(np.int32))
        self.ends.append(np.searchsorted(first, offs[1:], "left") + self.n)
        self.n += len(first)
        self.size += len(data)

    def row(self, number: int, a: Side, b: Side, links: str, cuts: bool, added: list[bytes]) -> pa.RecordBatch:
        words, ends = np.concatenate(self.words), np.concatenate(self.ends)
        begins = np.append(0, ends[:-1])
        names = list(self.seen)
        found = align_words(a, b, names, joinable(names, added) if cuts else np.zeros(len(names), bool), links)
        # texts with a bad word have no tokens
        harm = np.append(0, np.cumsum(found.bad[words]))
        good = harm[ends] == harm[begins]
        size = np.where(good, ends - begins, 0)
        words = words[ranges(begins, size)]
        ends = np.cumsum(size)
        begins = ends - size
        total = lambda per: np.diff(np.append(0, np.cumsum(per[words]))[np.append(0, ends)])
        n_links = np.bincount(found.link_word, minlength=len(names))
        used = np.bincount(words, minlength=len(names))
        pair, back = np.unique(found.link_a << 32 | found.link_b, return_inverse=True)
        count = np.zeros(len(pair), np.int64)
        np.add.at(count, back, used[found.link_word])
        order = np.argsort(found.link_word, kind="stable")
        pack = zstandard.ZstdCompressor(level=1).compress
        planes = lambda x: pack(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
        digest = [sha256(b";".join([found.groups[w] for w in words[i:j].tolist()])).hexdigest() if j > i else ""
                  for i, j in zip(begins.tolist(), ends.tolist())]
        one = lambda x, t: pa.array([x], pa.list_(t))
        return out(["shard", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "doc_words", "doc_ends",
                    "word_links", "word_ends", "a", "b", "n"],
                   pa.array([number], pa.int64()), one(pa.concat_arrays(self.ids).to_pylist(), pa.int64()),
                   one(total(found.n_a), pa.int64()), one(total(found.n_b), pa.int64()),
                   one(total(found.n_groups), pa.int64()), one(total(n_links), pa.int64()), one(digest, pa.string()),
                   pa.array([planes(words)], pa.binary()),
                   pa.array([pack(ends.astype("<i8").tobytes())], pa.binary()),
                   pa.array([planes(back[order])], pa.binary()),
                   pa.array([pack(np.cumsum(n_links).astype("<i8").tobytes())], pa.binary()),
                   one((pair >> 32).astype(np.int32), pa.int32()), one((pair & 0xFFFFFFFF).astype(np.int32), pa.int32()),
                   one(count, pa.int64()))


def shards(docs: DataFrame, path_a: str, path_b: str, links: str = "end", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard of the rows (_id, _text): per document what needs no corpus counts, and the id pairs."""
    def run(it):
        from pyspark import TaskContext
        a, b = sides(path_a, path_b)
        cuts, added = a.cuts and b.cuts, [x.encode() for x in a.added]
        part, n, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in it:
            for lo, hi, offs, data in text_slices(batch, "_text"):
                shard.add(column(batch, "_id").slice(lo, hi - lo), offs, data, cuts, added)
                if shard.size >= shard_bytes:
                    yield shard.row(part << 32 | n, a, b, links, cuts, added)
                    n, shard = n + 1, _Shard()
        if shard.ids:
            yield shard.row(part << 32 | n, a, b, links, cuts, added)

    return docs.transform(arrow_map, run, SHARD)


def pair_counts(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shard, at, a, b, n) of the shards' pairs, and (a, b, count, best) over all of them.

    best: whether the count is the highest of all pairs with that B id.
    """
    pairs = (table.select("shard", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "p"))
             .select("shard", "at", "p.a", "p.b", "p.n").where("n > 0"))
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = total.groupBy("b").agg(F.max("count").alias("top"))
    return pairs, total.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def _unpack(raw: bytes, planes: bool = False) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return flat.reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64) if planes else flat.view("<i8")


DOC = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DOC.split(", ")]
    for batch in it:
        for k in range(batch.num_rows):
            get = lambda c: column(batch, c)[k]  # noqa: E731,B023
            words, ends = _unpack(get("doc_words").as_py(), True), _unpack(get("doc_ends").as_py())
            links, last = _unpack(get("word_links").as_py(), True), _unpack(get("word_ends").as_py())
            at = column(batch, "at")[k].values
            at = np.zeros(0, np.int64) if at is None else at.to_numpy()
            count = np.zeros(int(links.max()) + 1 if len(links) else 0, np.int64)
            best = count.copy()
            if len(at):
                count[at], best[at] = get("count").values.to_numpy(), get("best").values.to_numpy()

            def per_doc(per_pair):
                word = np.diff(np.append(0, np.cumsum(per_pair[links]))[np.append(0, last)])
                return np.diff(np.append(0, np.cumsum(word[words]))[np.append(0, ends)])

            yield out(names, *[get(c).values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                      pa.array(per_doc(best)), pa.array(per_doc(count)), get("groups_sha256").values)


def align(docs: DataFrame, path_a: str, path_b: str, links: str = "end", id_col: str = "doc_id",
          text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Per document its alignment (columns of ``DOC``), and the id pairs (a, b, count, best) of the corpus.

    Links are the overlapping pairs of an A and a B token (``links="overlap"``)
    or those of them that end at the same byte (``"end"``). n_best counts a
    document's links whose pair has the highest corpus count of its B id
    (ties included), count_sum sums the counts of its links; groups_sha256 is
    the digest of the groups as ``a1,a2|b1;a3|b2,b3``. A null or empty text, or
    one whose tokens on either side don't give back the bytes of space + text,
    has zeros and ''. Strings of special tokens are plain text. Repeated rows
    count each; rows keep null ids; an empty table gives no row. Other columns
    are ignored.
    """
    if links not in ("end", "overlap"):
        raise ValueError(links)
    keep = Scratch(docs.sparkSession, "align").keep
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    table = keep(shards(rows, path_a, path_b, links, shard_bytes))
    pairs, counts = pair_counts(table)
    counts = keep(counts)
    known = (pairs.join(counts, ["a", "b"])
             .groupBy("shard").agg(F.collect_list(F.struct("at", "count", F.col("best").cast("long").alias("best"))).alias("p"))
             .select("shard", F.col("p.at").alias("at"), F.col("p.count").alias("count"), F.col("p.best").alias("best")))
    # written first: where its files are small Spark sends it to the table's tasks, else both sides are dealt by shard
    full = table.drop("a", "b", "n").join(keep(known), "shard", "left").drop("shard")
    return full.transform(arrow_map, _finish, DOC), counts
