"""Language-model scores by online logistic context mixing (operator 8).

A text is its words (A-Z lower-cased) and an end. Word counts over all
training texts give every word a class, the bit length of its count (0: not
seen), and a rank among the words of its class. A word is coded by six bits of
class, then the bits of its rank, so every word has a code of its own. Each
bit is predicted from several contexts (counts of both outcomes over all
training texts); the predictions are mixed in the logistic domain by weights
picked by a gate, and the result is refined by an adaptive map. Weights and
map are learned online, bit by bit, anew for every segment of ``SEGMENT``
tokens. The events are the base model's: the seen words and one "unseen".

1. Texts are written as shards of token streams over a vocabulary of their
   own, so that a word is counted and looked up once per shard.
2. Vocabularies are dealt by word hash; counts are summed there and sent back
   to the shards that hold the word.
3. With the counts, shards become streams of classes and ranks. Counts in
   contexts of classes are summed over all training texts in tables of fixed
   size.
4. Every shard's distinct (context, word) pairs, the context being the word
   before or the two words before, are dealt by context and summed there; the
   counts along the word's code come back, each once. Contexts of very common
   words are dealt by parts of the code as well.
5. Segments are scored side by side, one token of each at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import U64, mix, row_counts, word_hashes
from tideline.llm.scratch import Scratch

SHARD_TOKENS = 1 << 20
SEGMENT = 512
DEPTH = 6
CLASSES = 1 << DEPTH
CONTEXT_BITS = (0, 6, 12, 15, 16)  # order 0; last class; last two; last word; last word and the class before
N_CTX = len(CONTEXT_BITS)
BASE = np.cumsum([0, *[CLASSES << b for b in CONTEXT_BITS]])
END = np.uint64(0x5851F42D4C957F2D)
RANK_BITS = 32
MIDDLE = 8  # bits of a rank that a common context's second entry codes
HOT_CLASS = 21  # contexts whose words all have this class or more are dealt by parts of the code
PAIR_TOKENS = 1 << 20  # tokens per part of the (context, word) pairs
EXACT = 2  # contexts by whole words
NONE = U64((CLASSES - 1) << RANK_BITS)  # before the first word of a text
STATES, RANK_DEPTH = 3, 16
RATE, MAP_RATE, MAP_SIZE, CLAMP = 0.015, 0.02, 33, 11.0


def crc_held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def squeezed(x: np.ndarray) -> bytes:
    """An array as zstandard over its byte planes (low bytes first)."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def spread(raw: bytes, kind) -> np.ndarray:
    """The array of ``squeezed``."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).reshape(-1).view(kind)


# ---- shards and counts --------------------------------------------------

SHARD = ("shard long, doc_ids array<long>, held array<boolean>, n_tokens array<long>, n_bytes array<long>, "
         "vocab binary, train binary, cuts binary, tokens binary, recent binary")


def shards(rows: DataFrame, parts: int) -> DataFrame:
    """Token streams of (doc_id, held, text) rows, about SHARD_TOKENS tokens each.

    vocab has the distinct word hashes, by part (hash modulo ``parts``, where
    ``cuts`` says where each part ends) and hash; train their counts over the
    shard's training texts; tokens indexes vocab. All but vocab are squeezed.
    """
    def run(it):
        from pyspark import TaskContext
        task, seq = TaskContext.get().partitionId(), 0
        held: list = []
        n = 0

        def close():
            ids, ho, cnt, size, hs = zip(*held)
            ids, ho = [y for x in ids for y in x], [y for x in ho for y in x]
            cnt, size, h = np.concatenate(cnt), np.concatenate(size), np.concatenate(hs)
            u, inv = np.unique(h, return_inverse=True)
            part = (u % U64(parts)).astype(np.int64)
            o = np.argsort(part, kind="stable")
            back = np.empty(len(o), np.uint32)
            back[o] = np.arange(len(o), dtype=np.uint32)
            tokens = back[inv]
            learn = np.repeat(~np.array(ho, bool), cnt)
            train = np.bincount(tokens[learn], minlength=len(u)).astype(np.uint32)
            cuts = np.searchsorted(part[o], np.arange(parts), "right").astype(np.uint32)
            recent = (mix(u[o]) >> U64(40)).astype(np.uint16)
            return out(["shard", "doc_ids", "held", "n_tokens", "n_bytes", "vocab", "train", "cuts", "tokens", "recent"],
                       pa.array([task << 32 | seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([ho], pa.list_(pa.bool_())),
                       pa.array([cnt.tolist()], pa.list_(pa.int64())), pa.array([size.tolist()], pa.list_(pa.int64())),
                       pa.array([u[o].tobytes()], pa.binary()),
                       *[pa.array([squeezed(x)], pa.binary()) for x in (train, cuts, tokens, recent)])

        for b in it:
            for lo, hi, offs, data in text_slices(b, "text"):
                words, row, _, _ = word_hashes(data, offs)
                cnt = row_counts(row, hi - lo)
                words[words == END] ^= U64(1)
                at = np.cumsum(cnt)
                held.append((column(b, "doc_id").slice(lo, hi - lo).to_pylist(), column(b, "held").slice(lo, hi - lo).to_pylist(),
                             cnt + 1, np.diff(offs), np.insert(words, at, END)))
                n += len(words) + hi - lo
                if n >= SHARD_TOKENS:
                    yield close()
                    held, n, seq = [], 0, seq + 1
        if held:
            yield close()

    return rows.transform(arrow_map, run, SHARD)


def counted(texts: DataFrame, parts: int) -> DataFrame:
    """(shard, part, counts binary, ranks binary) of each word a shard has; shard -1 - part has totals.

    Counts are over all shards, ranks among the part's seen words of the
    class. Totals are the distinct words seen, then the tokens of each class,
    then the distinct words of each.
    """
    def deal(it):
        for b in it:
            for r in b.to_pylist():
                v, c, ends = np.frombuffer(r["vocab"], U64), spread(r["train"], np.uint32), spread(r["cuts"], np.uint32)
                a = np.append(0, ends[:-1])
                yield out(["shard", "part", "v", "c"], pa.array([r["shard"]] * parts, pa.int64()), pa.array(range(parts), pa.int32()),
                          pa.array([v[i:j].tobytes() for i, j in zip(a, ends)], pa.binary()),
                          pa.array([squeezed(c[i:j]) for i, j in zip(a, ends)], pa.binary()))

    def total(it):
        rows = [r for b in it for r in b.to_pylist()]
        for part in sorted({r["part"] for r in rows}):
            own = [r for r in rows if r["part"] == part]
            v = np.concatenate([np.frombuffer(r["v"], U64) for r in own])
            c = np.concatenate([spread(r["c"], np.uint32) for r in own]).astype(np.int64)
            u, inv = np.unique(v, return_inverse=True)
            n = np.zeros(len(u), np.int64)
            np.add.at(n, inv, c)
            ends = np.cumsum([len(r["v"]) // 8 for r in own])
            cls = bit_length(n)
            types = np.bincount(cls, n > 0, minlength=CLASSES).astype(np.int64)
            o = np.argsort(cls, kind="stable")
            rank = np.empty(len(n), np.uint32)
            rank[o] = np.arange(len(n)) - np.searchsorted(cls[o], np.arange(CLASSES))[cls[o]]
            rank[n == 0] = 0
            back, ranks = np.split(n[inv], ends[:-1]), np.split(rank[inv], ends[:-1])
            tot = np.concatenate([[(n > 0).sum()], np.bincount(cls, n, minlength=CLASSES), types]).astype(np.int64)
            yield out(["shard", "part", "counts", "ranks"], pa.array([r["shard"] for r in own] + [-1 - part], pa.int64()),
                      pa.array([part] * (len(own) + 1), pa.int32()), pa.array([squeezed(x) for x in [*back, tot]], pa.binary()),
                      pa.array([*map(squeezed, ranks), None], pa.binary()))

    return (texts.select("shard", "vocab", "train", "cuts").transform(arrow_map, deal, "shard long, part int, v binary, c binary")
            .repartitionById(parts, F.col("part")).transform(arrow_map, total, "shard long, part int, counts binary, ranks binary"))


def bit_length(n: np.ndarray) -> np.ndarray:
    """Class of a count: 0 for none, else its bit length (63 at most)."""
    return np.minimum(np.frexp(n.astype(np.float64))[1], CLASSES - 1).astype(np.int64)


# ---- class streams and contexts -----------------------------------------

STREAM = ("shard long, doc_ids array<long>, held array<boolean>, n_tokens array<long>, n_bytes array<long>, n_known array<long>, "
          "base array<double>, classes binary, ranks binary, recent binary, tokens binary")


def streams(texts: DataFrame, counts: DataFrame, n_train: int, n_types: int, before: np.ndarray) -> DataFrame:
    """Per shard: base score and known words of each text, and its words with their classes and ranks.

    Words are in descending order of class and rank (ranks as differences), so
    that frequent ones have small places; tokens has the place of each.
    ``before`` has the words of each class in earlier parts, by part.
    """
    each = counts.where("shard >= 0").groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("part", "counts", "ranks"))).alias("counts"))

    def run(it):
        for b in it:
            for r in b.to_pylist():
                own = [spread(x["counts"], np.int64) for x in r["counts"]]
                c = np.concatenate(own)
                tok = spread(r["tokens"], np.uint32)
                cls = bit_length(c)
                rank = np.concatenate([spread(x["ranks"], np.uint32) for x in r["counts"]])
                rank = np.where(c > 0, rank + before[np.repeat([x["part"] for x in r["counts"]], [len(x) for x in own]), cls], 0)
                cnt = np.array(r["n_tokens"], np.int64)
                first = np.cumsum(cnt) - cnt
                base = np.log10((c + 1) / (n_train + n_types + 1))
                per = lambda x: np.add.reduceat(x[tok], first)  # noqa: E731  every text has its end token
                o = np.argsort(cls << RANK_BITS | rank)[::-1]
                back = np.empty(len(o), np.uint32)
                back[o] = np.arange(len(o), dtype=np.uint32)
                yield out([c.split()[0] for c in STREAM.split(", ")], pa.array([r["shard"]], pa.int64()),
                          pa.array([r["doc_ids"]], pa.list_(pa.int64())), pa.array([r["held"]], pa.list_(pa.bool_())),
                          pa.array([r["n_tokens"]], pa.list_(pa.int64())), pa.array([r["n_bytes"]], pa.list_(pa.int64())),
                          pa.array([per((c > 0).astype(np.int64)).tolist()], pa.list_(pa.int64())),
                          pa.array([per(base).tolist()], pa.list_(pa.float64())),
                          pa.array([squeezed(cls.astype(np.uint8)[o])], pa.binary()),
                          pa.array([squeezed(np.diff(rank.astype(np.uint32)[o], prepend=np.uint32(0)))], pa.binary()),
                          pa.array([squeezed(spread(r["recent"], np.uint16)[o])], pa.binary()),
                          pa.array([squeezed(back[tok])], pa.binary()))

    return (texts.select("shard", "doc_ids", "held", "n_tokens", "n_bytes", "tokens", "recent").join(each, "shard")
            .transform(arrow_map, run, STREAM))


def by_token(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, rank and hash of every token of a row of ``streams`` (of columns that the row has)."""
    tok = spread(row["tokens"], np.uint32)
    return (spread(row["classes"], np.uint8)[tok].astype(np.int64),
            np.cumsum(spread(row["ranks"], np.uint32), dtype=np.uint32)[tok] if "ranks" in row else None,
            spread(row["recent"], np.uint16)[tok] if "recent" in row else None)


def contexts(cls: np.ndarray, recent: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Hashed context of every token, per predictor; ``start`` marks the first token of a text."""
    one = np.append(0, cls[:-1]).astype(np.uint32)
    one[start] = CLASSES - 1
    two = np.append(0, one[:-1]).astype(np.uint32)
    two[start] = CLASSES - 1
    word = np.append(0, recent[:-1]).astype(np.uint32)
    word[start] = 0
    mixed = (word * np.uint32(0x9E3779B1) + two * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return [np.zeros(len(cls), np.uint32), one, one << np.uint32(6) | two, word >> np.uint32(1), mixed]


def slots(ctx: list[np.ndarray]) -> list[np.ndarray]:
    """Table place of the root node of each token's code, per predictor."""
    return [(c.astype(np.int64) << DEPTH) + BASE[i] for i, c in enumerate(ctx)]


def code_nodes(cls: np.ndarray):
    """(node, bit) along the six-bit code of each class, most significant bit first."""
    node = np.ones(len(cls), np.int64)
    for d in range(DEPTH - 1, -1, -1):
        bit = (cls >> d) & 1
        yield node, bit
        node = 2 * node + bit


def context_counts(stream: DataFrame, parts: int) -> DataFrame:
    """(part, counts binary): uint64 counts of both outcomes for a range of table places."""
    size = int(BASE[-1])
    width = -(-size // parts)

    def count(it):
        table = np.zeros((size, 2), np.uint32)
        flat, one, seen = table.reshape(-1), np.uint32(1), 0
        for b in it:
            for r in b.to_pylist():
                cls, _, recent = by_token(r)
                cnt = np.array(r["n_tokens"], np.int64)
                first = np.cumsum(cnt) - cnt
                learn = np.flatnonzero(np.repeat(~np.array(r["held"], bool), cnt))
                at = slots(contexts(cls, recent, first))
                for node, bit in code_nodes(cls[learn]):
                    for a in at:
                        np.add.at(flat, ((a[learn] + node) << 1) + bit, one)
                seen += len(learn)
                if seen >= 1 << 31:  # before a count can overflow
                    yield from emit(table)
                    table[:], seen = 0, 0
        if seen:
            yield from emit(table)

    def emit(table):
        for p in range(parts):
            block = table[p * width:(p + 1) * width]
            at = np.flatnonzero(block.any(axis=1)).astype(np.uint32)
            if len(at):
                yield out(["part", "at", "n"], pa.array([p], pa.int32()), pa.array([squeezed(np.diff(at, prepend=np.uint32(0)))], pa.binary()),
                          pa.array([squeezed(block[at].reshape(-1))], pa.binary()))

    def total(it):
        tables: dict[int, np.ndarray] = {}
        for b in it:
            for r in b.to_pylist():
                t = tables.setdefault(r["part"], np.zeros((width, 2), np.uint64))
                t[np.cumsum(spread(r["at"], np.uint32), dtype=np.int64)] += spread(r["n"], np.uint32).reshape(-1, 2)
        for p, t in tables.items():
            yield out(["part", "guess"], pa.array([p], pa.int32()), pa.array([stretched(t).tobytes()], pa.binary()))

    return (stream.select("classes", "recent", "tokens", "n_tokens", "held").transform(arrow_map, count, "part int, at binary, n binary")
            .repartitionById(parts, F.col("part")).transform(arrow_map, total, "part int, guess binary"))


def stretched(n: np.ndarray) -> np.ndarray:
    """ln(p / (1 - p)) of outcome 1, from counts of both; 0 for an unseen place."""
    return np.clip(np.log((n[:, 1] + 0.4) / (n[:, 0] + 0.4)), -CLAMP, CLAMP).astype(np.float32)


# ---- contexts of whole words --------------------------------------------

def rank_bits(types: np.ndarray) -> np.ndarray:
    """Bits of a rank, by class."""
    return np.where(types > 1, bit_length(np.maximum(types - 1, 0)), 0)


def codes(cls: np.ndarray, rank: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Class and rank of every token as one number, the rank's first bit highest."""
    return cls.astype(U64) << U64(RANK_BITS) | rank.astype(U64) << (RANK_BITS - bits[cls]).astype(U64)


def reach(code: np.ndarray, kind: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bit and end of what an entry codes: all, the class, the first bits of the rank, the rest."""
    end = DEPTH + bits[(code >> U64(RANK_BITS)).astype(np.int64)]
    middle = np.minimum(end, DEPTH + MIDDLE)
    return np.array([0, 0, DEPTH, DEPTH + MIDDLE])[kind], np.select([kind == 1, kind == 2], [DEPTH, middle], end)


def word_ids(code: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Codes as numbers below ``id_room``, in the order of the codes."""
    start = np.cumsum(1 << bits) - (1 << bits)
    cls = (code >> U64(RANK_BITS)).astype(np.int64)
    return (start[cls] + ((code & U64((1 << RANK_BITS) - 1)) >> (RANK_BITS - bits[cls]).astype(U64)).astype(np.int64)).astype(U64)


def id_room(bits: np.ndarray) -> int:
    """Bits that hold every word id and one number more."""
    return int((1 << bits).sum() + 1).bit_length()


def context_keys(one: np.ndarray, two: np.ndarray, room: int) -> np.ndarray:
    """Distinct pairs of ids of ``room`` bits as distinct keys spread evenly over 64 bits, of which only the highest 2 * room are used."""
    width, half, low = 2 * room, U64(room), U64((1 << 2 * room) - 1)
    x = one << half | two
    for odd in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):  # each step can be undone
        x ^= x >> half
        x = x * U64(odd) & low
    return (x ^ x >> half) << U64(64 - width)


def entries(code: np.ndarray, first: np.ndarray, bits: np.ndarray, parts: int, hot: int):
    """Distinct (context, word) entries of a shard, by context.

    Returns context, code, kind and end of each part; the entry of every
    token, by context and third of the code (class, first bits of the rank,
    rest; -1: none); and (entry, token) of all places. A context with an
    unseen word has no entry, as no training text has it.
    """
    one = np.append(NONE, code[:-1])
    one[first] = NONE
    two = np.append(NONE, one[:-1])
    two[first] = NONE
    n, cls, room = len(code), (code >> U64(RANK_BITS)).astype(np.int64), id_room(bits)
    ids = word_ids(code, bits)
    none = word_ids(np.array([NONE]), bits)
    last = np.append(none, ids[:-1])
    last[first] = none
    before = np.append(none, last[:-1])
    before[first] = none
    no_word = np.full(n, (1 << bits).sum(), U64)
    found = []  # context, code, kind, token, order and thirds of the code
    for order, (ctx, least) in enumerate([(context_keys(last, no_word, room), one), (context_keys(last, before, room), np.minimum(one, two))]):
        least = (least >> U64(RANK_BITS)).astype(np.int64)
        few, many = np.flatnonzero((least > 0) & (least < hot)), np.flatnonzero(least >= hot)
        found.append((ctx[few], code[few], 0, few.astype(np.int32), order, (0, 1, 2)))
        for kind, keep, above in ((1, RANK_BITS, 64), (2, RANK_BITS - MIDDLE, RANK_BITS), (3, 0, RANK_BITS - MIDDLE)):
            i = many[bits[cls[many]] > (kind - 2) * MIDDLE] if kind > 1 else many
            own = mix(ctx[i] + U64(kind)) if above == 64 else mix(mix(ctx[i] + U64(kind)) + (code[i] >> U64(above)))
            found.append((own | U64(1), code[i] >> U64(keep) << U64(keep), kind, i.astype(np.int32), order, (kind - 1,)))
    del one, two, ids, last, before, no_word, ctx, least
    ctx, value, token = (np.concatenate([x[j] for x in found]) for j in (0, 1, 3))
    kind = np.repeat(np.array([x[2] for x in found], np.uint8), [len(x[0]) for x in found])
    found = [x[3:] for x in found]
    o = np.argsort(ctx >> U64(room) << U64(room) | word_ids(value, bits))  # by context, its last bits aside, and word
    ctx, value = ctx[o], value[o]
    new = np.append(True, (ctx[1:] != ctx[:-1]) | (value[1:] != value[:-1]))[:len(o)]
    entry = np.empty(len(o), np.int32)
    entry[o] = np.cumsum(new, dtype=np.int32) - 1
    ctx, value, kind = ctx[new], value[new], kind[o[new]]
    part = ((ctx >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)  # ascending, as the contexts' first 32 bits are
    at, a = np.full((EXACT, 3, n), -1, np.int32), 0
    for tokens, order, thirds in found:
        for third in thirds:
            at[order, third, tokens] = entry[a:a + len(tokens)]
        a += len(tokens)
    return ctx, value, kind, np.searchsorted(part, np.arange(parts), "right"), at, entry, token


def along(code: np.ndarray, ctx: np.ndarray, kind: np.ndarray, n: np.ndarray, bits: np.ndarray):
    """What the counts ``n`` of all of a context tell of the bits of its entries.

    Returns (entry of each row given, its count, how many bits it has, per bit
    the count of the other outcome). An entry has the bits before only it has
    counts; ``whole`` makes the predictions.
    """
    o = np.argsort(ctx)
    own = np.empty(len(o), U64)
    own[o] = np.cumsum(np.append(False, ctx[o[1:]] != ctx[o[:-1]]))
    key = own << U64(DEPTH + RANK_BITS) | code
    o = np.argsort(key)
    key = key[o]
    new = np.append(True, key[1:] != key[:-1])
    inv = np.empty(len(o), np.int64)
    inv[o] = np.cumsum(new) - 1
    pick, key = o[new], key[new]
    total = np.bincount(inv, n, minlength=len(key)).astype(np.int64)
    lo, hi = reach(code[pick], kind[pick], bits)
    size, found = np.zeros(len(key), np.int64), []
    for kinds in np.unique(lo):  # entries of one context begin at the same bit
        s = np.flatnonzero(lo == kinds)
        for d in range(int(kinds), int(hi[s].max())):
            s = s[hi[s] > d]
            k, t = key[s], total[s]
            shift = U64(DEPTH + RANK_BITS - 1 - d)
            node = k >> shift + U64(1)
            runs = np.flatnonzero(np.append(True, node[1:] != node[:-1])[:len(s)])
            if not len(runs):
                break
            width = np.diff(runs, append=len(s))
            both = np.repeat(np.add.reduceat(t, runs), width)
            side = k >> shift
            half = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
            toward = np.repeat(np.add.reduceat(t, half), np.diff(half, append=len(s)))
            shared = both > t
            found.append((s[shared], d - int(kinds), (both - toward)[shared]))
            size[s[shared]] += 1
            s = s[np.repeat(width, width) > 1]  # an entry alone shares no bit any more
    start = np.cumsum(size) - size
    other = np.zeros(int(size.sum()), np.int64)
    for s, d, m in found:
        other[start[s] + d] = m
    return inv, total, size, other


def whole(code: np.ndarray, kind: np.ndarray, bits: np.ndarray, n: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """All predictions of the entries, of bits that only an entry's own count tells as well."""
    lo, hi = reach(code, kind, bits)
    long, size = hi - lo, size.astype(np.int64)
    start, upto = np.cumsum(long) - (hi - lo), np.cumsum(size)
    rest = np.append(np.cumsum(other[::-1])[::-1], 0)  # of a bit and all after it, in all entries
    toward = rest[1:] + np.repeat(n - rest[upto], size)
    res = np.repeat(guessed(n, np.zeros(len(n), np.int64)) * (n > 0), long)
    res[np.arange(len(other)) + np.repeat(start - (upto - size), size)] = guessed(toward, other)
    d = np.arange(len(res), dtype=U64) - np.repeat(start.astype(U64), long)
    one = np.repeat(code << (64 - DEPTH - RANK_BITS + lo).astype(U64), long) << d >> U64(63)
    res.view(np.uint16)[:] ^= (one ^ U64(1)).astype(np.uint16) << 15  # the sign of bits that are 0
    return res


def guessed(toward: np.ndarray, other: np.ndarray) -> np.ndarray:
    """ln(p / (1 - p)) of an outcome, from the counts of it and the other."""
    return np.clip(logs(toward) - logs(other), -CLAMP, CLAMP).astype(np.float32).astype(np.float16)


def sent(ctx: np.ndarray, code: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the bits that entries have, by bit and entry, and which of them in that order are new.

    The bits an entry begins with like the one before, in the same context,
    have the counts they have there.
    """
    size = size.astype(np.int64)
    alike = DEPTH + RANK_BITS - bit_length((code[1:] ^ code[:-1]).astype(np.int64))
    alike = np.append(0, np.where(ctx[1:] == ctx[:-1], np.minimum(alike - lo[1:], size[:-1]), 0))
    d = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    order = np.argsort(d.astype(np.uint8), kind="stable")
    return order, (d >= np.repeat(alike, size))[order]


LOGS = np.log(np.arange(1 << 12) + 0.4)


def logs(n: np.ndarray) -> np.ndarray:
    """ln(n + 0.4)."""
    res = LOGS[np.minimum(n, len(LOGS) - 1)]
    big = np.flatnonzero(n >= len(LOGS))
    res[big] = np.log(n[big] + 0.4)
    return res


def small(n: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as bytes, and those of 255 or more."""
    return squeezed(np.minimum(n, 255).astype(np.uint8)), squeezed(n[n >= 255])


def grown(few: bytes, more: bytes) -> np.ndarray:
    """The counts of ``small``."""
    n = spread(few, np.uint8).astype(np.int64)
    n[n == 255] = spread(more, np.int64)
    return n


def word_guesses(stream: DataFrame, bits: np.ndarray, parts: int) -> DataFrame:
    """(shard, part, size, few, more, all binary): ``along`` of a shard's entries, in order; few and more hold the counts, then those ``sent``."""
    hot = HOT_CLASS

    def deal(it):
        for b in it:
            for r in b.to_pylist():
                (cls, rank, _), cnt = by_token(r), np.array(r["n_tokens"], np.int64)
                code = codes(cls, rank, bits)
                ctx, value, kind, ends, _, entry, token = entries(code, np.cumsum(cnt) - cnt, bits, parts, hot)
                learn = np.repeat(~np.array(r["held"], bool), cnt)
                n = np.bincount(entry, learn[token], minlength=len(ctx)).astype(np.uint32)
                for p, (i, j) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                    if j > i:
                        new = np.flatnonzero(np.append(True, ctx[i + 1:j] != ctx[i:j - 1]))
                        step, run = np.diff(ctx[i:j][new], prepend=U64(0)), np.diff(new, append=j - i).astype(np.uint32)
                        yield out(["shard", "part", "step", "run", "code", "kind", "n"], pa.array([r["shard"]], pa.int64()), pa.array([p], pa.int32()),
                                  *[pa.array([squeezed(x)], pa.binary()) for x in (step, run, value[i:j], kind[i:j], n[i:j])])

    def total(it):
        rows = [r for b in it for r in b.to_pylist()]
        for part in sorted({r["part"] for r in rows}):
            own = [r for r in rows if r["part"] == part]
            ctx = [np.repeat(np.cumsum(spread(r["step"], U64)), spread(r["run"], np.uint32)) for r in own]
            sizes, ctx = [len(x) for x in ctx], np.concatenate(ctx)
            code, kind, n = (np.concatenate([spread(r[c], t) for r in own]) for c, t in (("code", U64), ("kind", np.uint8), ("n", np.uint32)))
            inv, count, have, other = along(code, ctx, kind, n, bits)
            start, lo = np.cumsum(have) - have, reach(code, kind, bits)[0]
            a = 0
            for r, k in zip(own, sizes):
                e = inv[a:a + k]
                size = have[e]
                upto = np.cumsum(size)
                pick = np.repeat(start[e] - (upto - size), size) + np.arange(upto[-1])
                order, new = sent(ctx[a:a + k], code[a:a + k], lo[a:a + k], size)
                few, more = small(np.concatenate([count[e], other[pick[order[new]]]]))
                a += k
                yield out(["shard", "part", "size", "few", "more"], pa.array([r["shard"]], pa.int64()), pa.array([part], pa.int32()),
                          *[pa.array([x], pa.binary()) for x in (squeezed(size.astype(np.uint8)), few, more)])

    return (stream.select("shard", "classes", "ranks", "tokens", "n_tokens", "held")
            .transform(arrow_map, deal, "shard long, part int, step binary, run binary, code binary, kind binary, n binary")
            .repartitionById(parts, F.col("part")).transform(arrow_map, total, "shard long, part int, size binary, few binary, more binary"))


# ---- scoring ------------------------------------------------------------

def mix_segments(guess: np.ndarray, cls: np.ndarray, at: list[np.ndarray], first: np.ndarray, length: np.ndarray,
                 words: tuple | None = None) -> np.ndarray:
    """log10 probability of each segment (``length`` tokens from ``first``): its classes and, given ``words``, their words.

    ``words`` has every token's rank, the bits of it and the words of its
    class, then the predictions in contexts of whole words and where those of
    a token begin, by context and third of the code.

    The gate that picks a weight set is the bit's depth and, for classes,
    whether the word before was seen, for ranks, how many contexts predict;
    the map is picked by depth or that number. A rank's first input is the
    share of each half in the words left; a bit that only one half allows
    costs nothing.
    """
    n, inputs = len(first), N_CTX + (EXACT if words else 0)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    depths = np.arange(DEPTH)[:, None]
    grid = np.linspace(-CLAMP, CLAMP, MAP_SIZE, dtype=np.float32)
    start = 1 / (1 + np.exp(-grid))
    w = np.full((2, DEPTH, inputs, n), 0.35, np.float32)  # segments last: one bit of all of them lies together
    fine = np.tile(np.repeat(start, n), DEPTH)
    total = np.zeros(n)
    prev = np.zeros(n, bool)
    at = np.stack([a.astype(np.int32) for a in at])
    if words:
        rank, size, types, flat, begin = words
        w[:, :, :N_CTX], w[:, :, N_CTX:] = 0.2, 0.4
        v = [np.full(RANK_DEPTH * STATES * n, 0.5, np.float32) for _ in range(EXACT + 1)]
        split = bool((begin[:, 1] != begin[:, 2]).any())
        sharp = np.tile(np.repeat(start, n), STATES)
    for t in range(int(length[0]) if n else 0):
        k = int(np.searchsorted(-length, -t, "left"))  # segments longer than t
        i = first[:k] + t
        c = cls[i]
        # the class: its bits have weights and a map of their own by depth, so all are done at once
        x = np.empty((DEPTH, inputs, k), np.float32)
        x[:, :N_CTX] = guess.take(at.take(i, axis=1) + ((c | CLASSES) >> (DEPTH - depths))[:, None])
        if words:
            x[:, N_CTX:] = flat.take(begin[:, 0, i] + depths[:, None])
        bit = c >> (DEPTH - 1 - depths) & 1 == 1
        dot = (w[1, :, :, :k] * x).sum(axis=1)
        new = np.flatnonzero(~prev[:k])
        if len(new):
            dot[:, new] = (w[0][:, :, new] * x[:, :, new]).sum(axis=1)
        p, cell = squashed(dot)
        cell = (depths * MAP_SIZE + cell) * n + np.arange(k)
        q = fine.take(cell)
        total[:k] += told(p, q, bit).sum(axis=0, dtype=np.float64)
        fine[cell] = q + np.float32(MAP_RATE) * (bit - q)
        x *= (np.float32(RATE) * (bit - p))[:, None]
        if len(new):
            w[0][:, :, new] += x[:, :, new]
            x[:, :, new] = 0
        w[1, :, :, :k] += x
        prev[:k] = c > 0
        if not words:
            continue
        # the rank: (bit, segment) pairs, by bit
        long = size[i]
        d, row = np.nonzero(np.arange(int(long.max()))[:, None] < long)
        shift = long.take(row) - 1 - d
        head, half = rank[i].take(row) >> shift, np.int64(1) << shift
        left = types[i].take(row) - (head >> 1 << shift + 1)
        two = left > half  # words in both halves
        d, row, half, left, bit = d[two], row[two], half[two], left[two], head[two] & 1 == 1
        ratio = np.zeros(len(d), np.float32)
        part = np.flatnonzero(left < 2 * half)
        ratio[part] = np.log((left[part] - half[part]) / half[part])
        x, state = [ratio], np.zeros(len(d), np.int64)
        for middle, rest in zip(begin[:, 1, i], begin[:, 2, i]):
            place = np.where(d < MIDDLE, middle.take(row), rest.take(row)) if split else middle.take(row)
            known = flat.take(place + (DEPTH + d))
            x.append(known.astype(np.float32))
            state += known != 0
        own = (np.minimum(d, RANK_DEPTH - 1) * STATES + state) * n + row
        ends = np.searchsorted(d, np.arange(int(long.max()) + 1))
        p, q, cell = np.empty(len(d), np.float32), np.empty(len(d), np.float32), np.empty(len(d), np.int64)
        depth = min(RANK_DEPTH, len(ends) - 1)
        for a, b in zip([0, *ends[depth:-1]], ends[depth:]):  # bits of other weights at once
            if a < b:
                o, xs = own[a:b], [y[a:b] for y in x]
                wk = [y.take(o) for y in v]
                p[a:b], cell[a:b] = squashed(sum(y * z for y, z in zip(wk, xs)))
                step = np.float32(RATE) * (bit[a:b] - p[a:b])
                for y, now, z in zip(v, wk, xs):
                    y[o] = now + step * z
        cell = (state * MAP_SIZE + cell) * n + row
        for a, b in zip(ends[:-1], ends[1:]):  # one map for all bits
            here = cell[a:b]
            q[a:b] = sharp.take(here)
            sharp[here] = q[a:b] + np.float32(MAP_RATE) * (bit[a:b] - q[a:b])
        total[:k] += np.bincount(row, told(p, q, bit), minlength=k)
    res = np.empty(n)
    res[order] = total
    return res


def squashed(dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of outcome 1 and cell of the map, from the weighted sum."""
    dot = np.clip(dot, -CLAMP, CLAMP)
    return 1 / (1 + np.exp(-dot)), np.rint((dot + CLAMP) * np.float32((MAP_SIZE - 1) / (2 * CLAMP))).astype(np.int64)


def told(p: np.ndarray, q: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """log10 of the probability given to ``bit`` by the mixture and the map."""
    fin = 0.5 * (p + q)
    return np.log10(np.where(bit, fin, 1 - fin))


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, bits_per_byte double")


def scored(stream: DataFrame, guess: np.ndarray, words: DataFrame, bits: np.ndarray, types: np.ndarray, parts: int, n_train: int,
           buckets: int) -> DataFrame:
    """One row per text of the class streams, by SCORES; ``words`` are the ``word_guesses`` of ``parts`` parts.

    The streams are in ``buckets`` buckets by shard, to which the words are dealt.
    """
    each = words.repartition(buckets, "shard").groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("part", "size", "few", "more"))).alias("words"))
    hot = HOT_CLASS
    shared = stream.sparkSession.sparkContext.broadcast(guess)  # a table of fixed size

    def run(it):
        guess = shared.value
        for b in it:
            for r in b.to_pylist():
                cls, rank, recent = by_token(r)
                rank = rank.astype(np.int64)
                cnt = np.array(r["n_tokens"], np.int64)
                start = np.cumsum(cnt) - cnt
                ctx, value, kind, ends, place, _, _ = entries(codes(cls, rank, bits), start, bits, parts, hot)
                lo, hi = reach(value, kind, bits)
                upto = np.append(0, np.cumsum(hi - lo))
                flat = np.zeros(upto[-1] + DEPTH + RANK_BITS, np.float16)  # the last are for no entry
                for x in r.pop("words") or []:
                    i, j = ends[x["part"] - 1] if x["part"] else 0, ends[x["part"]]
                    have, told = spread(x["size"], np.uint8), grown(x["few"], x["more"])
                    order, new = sent(ctx[i:j], value[i:j], lo[i:j], have)
                    other = np.empty(len(order), np.int64)
                    other[order] = told[j - i:][np.cumsum(new) - 1]
                    flat[upto[i]:upto[j]] = whole(value[i:j], kind[i:j], bits, told[:j - i], have, other)
                upto[:-1] -= lo
                begin = upto.astype(np.int32 if len(flat) < 1 << 31 else np.int64)[place]
                del ctx, value, kind, lo, hi, upto, place
                segs = -(-cnt // SEGMENT)
                doc = np.repeat(np.arange(len(cnt)), segs)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(segs) - segs, segs)
                first = start[doc] + nth * SEGMENT
                length = np.minimum(cnt[doc] - nth * SEGMENT, SEGMENT)
                score = np.bincount(doc, mix_segments(
                    guess, cls, slots(contexts(cls, recent, start)), first, length, (rank, bits[cls], types[cls], flat, begin)), minlength=len(cnt))
                size = np.array(r["n_bytes"], np.float64)
                bpb = np.where(size > 0, -score * np.log2(10) / np.maximum(size, 1), 0.0)
                yield out([c.split()[0] for c in SCORES.split(", ")], pa.array(r["doc_ids"], pa.int64()), pa.array(r["held"], pa.bool_()),
                          pa.array(r["n_tokens"], pa.int64()), pa.array(r["n_known"], pa.int64()),
                          pa.array([n_train] * len(cnt), pa.int64()), pa.array(r["base"], pa.float64()), pa.array(score), pa.array(bpb))

    return stream.join(each, "shard", "left").transform(arrow_map, run, SCORES)


def score_texts(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per document.

    Words are runs of other bytes than space and \\t..\\r, A-Z lower-cased;
    each text ends with a token of its own. Texts that are not ``held_out``
    (by default ``crc_held_out``) are learned from. base_score is the sum of
    log10((c + 1) / (N + V + 1)), score the mixed model's log10 probability.
    A null or empty text has only its end; bits_per_byte is 0 for it. Every
    row gives one row and counts as a text of its own, also repeated ones and
    those with a null id (which are learned from); other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    parts = max(12, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = crc_held_out(F.col(id_col)) if held_out is None else held_out
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), F.col(text_col).alias("text"))
    texts = scratch.keep(shards(rows, parts))
    counts = scratch.keep(counted(texts, parts), large=True)
    totals, before = np.zeros(2 * CLASSES + 1, np.int64), np.zeros((parts, CLASSES), np.int64)
    for r in counts.where("shard < 0").select("part", "counts").toLocalIterator():  # a row per part
        own = spread(r["counts"], np.int64)
        totals += own
        before[r["part"]] = own[CLASSES + 1:]
    before = np.cumsum(before, axis=0) - before
    n_train, types = int(totals[1:CLASSES + 1].sum()), totals[CLASSES + 1:]
    bits = rank_bits(types)
    buckets = max(parts, texts.count())
    stream = scratch.bucketed(streams(texts, counts, n_train, int(totals[0]), before), "shard", buckets, large=True)
    scratch.drop(texts, counts)
    n = int(BASE[-1])
    guess = np.zeros((parts, -(-n // parts)), np.float32)
    for r in scratch.keep(context_counts(stream, parts)).toLocalIterator():  # BASE[-1] numbers in all
        guess[r["part"]] = np.frombuffer(r["guess"], np.float32)
    n_tokens = stream.select(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    pair_parts = max(parts, -(-n_tokens // PAIR_TOKENS))
    words = word_guesses(stream, bits, pair_parts)  # not kept: their shuffle to the shards is the one copy
    return scored(stream, guess.ravel()[:n], words, bits, types, pair_parts, n_train, buckets)
