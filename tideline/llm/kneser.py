"""Quality by Kneser-Ney perplexity (operator 7).

An interpolated modified Kneser-Ney model of byte n-grams, trained on trusted
texts. Counting and smoothing are joins and sums on n-gram keys: n-grams by
key, histories by key prefix, lower orders by key suffix. The model is of all
trusted texts of one half (by hash of the id). A text is kept if its perplexity
is at most the threshold of its language: a quantile over that language's
texts of the other half, times a margin. Texts under ``MIN_BYTES`` have a
threshold of their own, as their perplexity varies more.

The model grows with the texts, so no task holds it whole. Texts are gathered
to shards; a shard's distinct n-grams are dealt by the two symbols before the
newest, which all orders above ``LOW`` have, together with the model's n-grams
and histories. The log probabilities found go back to the shard, which scores
its texts whole. Orders up to ``LOW`` are at most 257 ** 2 n-grams and
broadcast.

Keys pack symbols of nine bits (byte + 2; 1 a start, 0 the end), the newest
lowest; ``ORDER`` symbols fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.hashing import U64, mix
from tideline.llm.mixing import spread, squeezed
from tideline.llm.scratch import Scratch

ORDER = 5
SYM = 9
SYMBOLS = 257  # every byte, and the end
LOW = 2  # orders that every task has
SHARD_BYTES = 4 << 20
PART_GRAMS = 1 << 18  # of the model, per part
QUANTILE = 0.995
MARGIN = 1.1
MIN_BYTES = 200  # shorter texts are judged by shorter ones


def symbols(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols with ORDER - 1 starts before and an end after each row, whether each is predicted)."""
    n, extra = len(offsets) - 1, ORDER
    rows = np.arange(n)
    sym = np.ones(len(data) + n * extra, np.int64)
    lens = np.diff(offsets)
    at = np.arange(len(data)) + np.repeat((rows + 1) * extra - 1, lens)
    sym[at] = data.astype(np.int64) + 2
    end = offsets[1:] + (rows + 1) * extra - 1
    sym[end] = 0
    told = np.zeros(len(sym), bool)
    told[at] = told[end] = True
    return sym, told


def grams(sym: np.ndarray) -> np.ndarray:
    """Key of the ORDER symbols up to each place (of fewer, at the front)."""
    key = sym.copy()
    for i in range(1, ORDER):
        key[i:] |= sym[:-i] << (SYM * i)
    return key


def counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts of the column ``text``."""
    def run(it):
        for b in it:
            for _, _, offs, data in text_slices(b, "text"):
                sym, told = symbols(offs, data)
                u, n = np.unique(grams(sym)[told], return_counts=True)
                yield out(["gram", "n"], pa.array(u), pa.array(n.astype(np.int64)))

    return texts.transform(arrow_map, run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n: dict[int, int]) -> list[float]:
    """D1, D2, D3+ from how many grams occur once, twice, three and four times."""
    res = []
    y = n.get(1, 0) / (n.get(1, 0) + 2 * n.get(2, 0)) if n.get(1) else 0.0
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n.get(i + 1, 0) / n[i] if n.get(i) and y else i / 2
        res.append(min(max(d, 0.05), i - 0.05))
    return res


def fit(texts: DataFrame, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1 to ORDER: (gram, p) of seen grams and (history, gamma) of seen histories."""
    low = lambda c, k: F.col(c).bitwiseAND(F.lit((1 << (SYM * k)) - 1))
    top = scratch.keep(counts(texts))
    orders = {ORDER: top.select("gram", F.col("n").alias("a"))}
    for k in range(ORDER - 1, 0, -1):
        # how many symbols precede a gram; occurrences for those that begin with a start
        left = orders[k + 1].groupBy(low("gram", k).alias("gram")).agg(F.count(F.lit(1)).alias("kinds"))
        raw = top.groupBy(low("gram", k).alias("gram")).agg(F.sum("n").alias("n"))
        first = F.shiftright("gram", SYM * (k - 1))
        orders[k] = scratch.keep(left.join(raw, "gram").select("gram", F.when(first == 1, F.col("n")).otherwise(F.col("kinds")).alias("a")))
    model, lower = [], None
    for k in range(1, ORDER + 1):
        g = orders[k]
        of = {r["a"]: r["n"] for r in g.where("a <= 4").groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect()}  # four rows
        d1, d2, d3 = discounts(of)
        d = F.when(F.col("a") == 1, d1).when(F.col("a") == 2, d2).otherwise(d3)
        g = g.withColumn("history", F.shiftright("gram", SYM)).withColumn("d", d)
        history = scratch.keep(g.groupBy("history").agg(F.sum("a").alias("total"), (F.sum("d") / F.sum("a")).alias("gamma")))
        g = g.join(history, "history")
        if lower is None:
            g = g.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            g = g.withColumn("suffix", low("gram", k - 1)).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = scratch.keep(g.select("gram", ((F.col("a") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")).alias("p")))
        model.append((lower, history.select("history", "gamma")))
    return model


class Table:
    """Long keys to floats, by open addressing; absent keys give ``default``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float):
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.mask = U64(size - 1)
        self.keys, self.values = np.full(size + 1, -1, np.int64), np.full(size + 1, default, values.dtype)
        left, v, step = keys, values, U64(0)
        while len(left):
            at = ((mix(left.astype(U64)) + step) & self.mask).astype(np.int64)
            _, one = np.unique(at, return_index=True)
            one = one[self.keys[at[one]] == -1]
            self.keys[at[one]], self.values[at[one]] = left[one], v[one]
            rest = np.ones(len(left), bool)
            rest[one] = False
            left, v, step = left[rest], v[rest], step + U64(1)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, found) of each key."""
        at = (mix(keys.astype(U64)) & self.mask).astype(np.int64)
        got = self.keys[at]
        open_ = np.flatnonzero((got != keys) & (got != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & int(self.mask)
            got[open_] = self.keys[at[open_]]
            open_ = open_[(got[open_] != keys[open_]) & (got[open_] != -1)]
        found = got == keys
        at[~found] = len(self.keys) - 1
        return self.values[at], found


def collected(model) -> list[tuple[np.ndarray, ...]]:
    """Orders of the model as sorted arrays of keys and log10 values, for those up to ``LOW`` or a small model."""
    res = []
    for seen, history in model:
        arrays = []
        for df in (seen, history):
            key, value = df.columns
            t = df.select(F.col(key).alias("k"), F.log10(value).cast("float").alias("v")).orderBy("k").toArrow()
            arrays += [t["k"].to_numpy(), t["v"].to_numpy()]
        res.append(tuple(arrays))
    return res


def log_probs(tables: list[tuple[Table, Table]], sym: np.ndarray, told: np.ndarray) -> np.ndarray:
    """log10 probability of every predicted symbol."""
    return gram_logs(tables, grams(sym)[told])


def gram_logs(tables: list[tuple[Table, Table]], key: np.ndarray) -> np.ndarray:
    """log10 probability of the newest symbol of each gram after the others."""
    lp = np.zeros(len(key), np.float64)
    todo = np.arange(len(key))
    for k in range(ORDER, 0, -1):
        own = key[todo] & ((1 << (SYM * k)) - 1)
        seen, history = tables[k - 1]
        p, found = seen.get(own)
        lp[todo[found]] += p[found]
        todo, own = todo[~found], own[~found]
        if not len(todo):
            return lp
        gamma, known = history.get(own >> SYM)
        lp[todo[known]] += gamma[known]
    lp[todo] -= np.log10(SYMBOLS)
    return lp


def dealt(middle: np.ndarray, parts: int) -> np.ndarray:
    """Part of the n-grams or histories whose two symbols before the newest one are the lowest of ``middle``."""
    return (mix((middle & ((1 << (2 * SYM)) - 1)).astype(U64)) % U64(parts)).astype(np.int64)


def by_part(key: np.ndarray, middle: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the keys by part, the parts there are, where each one ends)."""
    part = dealt(middle, parts)
    o = np.lexsort((key, part))
    own, n = np.unique(part, return_counts=True)
    return o, own, np.cumsum(n)


SHARD = "shard long, doc_ids array<long>, langs array<string>, sizes array<long>, texts binary"


def shards(rows: DataFrame) -> DataFrame:
    """The (doc_id, lang, text) rows by shards of about SHARD_BYTES of text, or of one longer text."""
    def run(it):
        from pyspark import TaskContext
        task, seq = TaskContext.get().partitionId(), 0
        ids, langs, sizes, texts, n = [], [], [], [], 0

        def close():
            raw = zstandard.ZstdCompressor(level=3).compress(np.concatenate(texts).tobytes())
            return out(["shard", "doc_ids", "langs", "sizes", "texts"], pa.array([task << 32 | seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                       pa.array([langs], pa.list_(pa.string())), pa.array([sizes], pa.list_(pa.int64())), pa.array([raw], pa.binary()))

        for b in it:
            for lo, hi, offs, data in text_slices(b, "text"):
                if n and n + len(data) > SHARD_BYTES:
                    yield close()
                    ids, langs, sizes, texts, n, seq = [], [], [], [], 0, seq + 1
                ids += column(b, "doc_id").slice(lo, hi - lo).to_pylist()
                langs += column(b, "lang").slice(lo, hi - lo).to_pylist()
                sizes += np.diff(offs).tolist()
                texts.append(data.copy())
                n += len(data)
        if ids:
            yield close()

    return rows.transform(arrow_map, run, SHARD)


def shard_texts(r: dict) -> pa.Array:
    offs = np.append(0, np.cumsum(r["sizes"])).astype(np.int64)
    data = zstandard.ZstdDecompressor().decompress(r["texts"])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(offs), pa.py_buffer(data)])


def shard_slices(r: dict):
    """(first text, end, offsets, bytes) of runs of a shard's texts."""
    return text_slices(out(["text"], shard_texts(r)), "text")


def learned_texts(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The texts of ``shards`` at the (shard, at array) places."""
    def run(it):
        for b in it:
            for r in b.to_pylist():
                yield out(["text"], shard_texts(r).take(pa.array(r["at"], pa.int64())).cast(pa.binary()))

    return texts.select("shard", "sizes", "texts").join(places, "shard").transform(arrow_map, run, "text binary")


def shard_grams(r: dict) -> np.ndarray:
    """Distinct n-grams of a shard's texts."""
    found = [np.unique(grams(sym)[told]) for _, _, offs, data in shard_slices(r) for sym, told in [symbols(offs, data)]]
    return np.unique(np.concatenate(found))


DEALT = "part int, shard long, kind int, keys binary, logs binary"


def wanted(texts: DataFrame, parts: int) -> DataFrame:
    """The distinct n-grams of every shard, a row per part."""
    def run(it):
        for b in it:
            for r in b.to_pylist():
                key = shard_grams(r)
                o, own, ends = by_part(key, key >> SYM, parts)
                n = len(own)
                yield out([c.split()[0] for c in DEALT.split(", ")], pa.array(own, pa.int32()), pa.array([r["shard"]] * n, pa.int64()),
                          pa.array([0] * n, pa.int32()), pa.array([squeezed(np.diff(x, prepend=0)) for x in np.split(key[o], ends[:-1])], pa.binary()),
                          pa.nulls(n, pa.binary()))

    return texts.transform(arrow_map, run, DEALT)


def offered(model: list[tuple[DataFrame, DataFrame]], parts: int) -> DataFrame:
    """The orders of the model above LOW, dealt like the n-grams of texts (shard -1; kind 2 * i, histories 2 * i + 1)."""
    rows = None
    for i, pair in enumerate(model[LOW:]):
        for j, df in enumerate(pair):
            key, value = df.columns
            own = df.select(F.lit(2 * i + j).alias("kind"), F.col(key).alias("key"), F.log10(value).cast("float").alias("log"))
            rows = own if rows is None else rows.unionAll(own)

    def run(it):
        held, n = [], 0
        for b in it:
            held.append(b)
            n += len(b)
            if n >= PART_GRAMS:
                yield from packed(held)
                held, n = [], 0
        if held:
            yield from packed(held)

    def packed(held):
        kind, key, log = (np.concatenate([column(b, c).to_numpy(zero_copy_only=False) for b in held]) for c in ("kind", "key", "log"))
        for k in np.unique(kind).tolist():
            x, v = key[kind == k], log[kind == k]
            o, own, ends = by_part(x, x if k % 2 else x >> SYM, parts)
            n, x, v = len(own), np.split(x[o], ends[:-1]), np.split(v[o], ends[:-1])
            yield out([c.split()[0] for c in DEALT.split(", ")], pa.array(own, pa.int32()), pa.array([-1] * n, pa.int64()), pa.array([k] * n, pa.int32()),
                      pa.array([squeezed(np.diff(y, prepend=0)) for y in x], pa.binary()), pa.array([squeezed(y) for y in v], pa.binary()))

    return rows.transform(arrow_map, run, DEALT)


def looked_up(texts: DataFrame, model: list[tuple[DataFrame, DataFrame]], parts: int) -> DataFrame:
    """(shard, part, logs): log10 probabilities of the n-grams of ``wanted``, in their order."""
    shared = texts.sparkSession.sparkContext.broadcast(collected(model[:LOW]))  # at most 257 ** LOW n-grams
    none = (np.empty(0, np.int64), np.empty(0, np.float32))

    def run(it):
        low = [(Table(a, b, 0.0), Table(c, d, 0.0)) for a, b, c, d in shared.value]
        part, tables, found = None, None, {}
        for b in it:
            for r in b.to_pylist():
                if r["part"] != part:
                    part, tables, found = r["part"], None, {}
                keys = np.cumsum(spread(r["keys"], np.int64))
                if r["shard"] < 0:  # the model's rows come before those of texts
                    found.setdefault(r["kind"], [none]).append((keys, spread(r["logs"], np.float32)))
                    continue
                if tables is None:
                    own = [Table(*map(np.concatenate, zip(*found.pop(k, [none]))), 0.0) for k in range(2 * (ORDER - LOW))]
                    tables = low + [*zip(own[::2], own[1::2])]
                yield out(["shard", "part", "logs"], pa.array([r["shard"]], pa.int64()), pa.array([part], pa.int32()),
                          pa.array([squeezed(gram_logs(tables, keys))], pa.binary()))

    return (wanted(texts, parts).unionAll(offered(model, parts)).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "shard")
            .transform(arrow_map, run, "shard long, part int, logs binary"))


def scored(texts: DataFrame, logs: DataFrame, parts: int) -> DataFrame:
    """(doc_id, lang, n_bytes, log10_prob, perplexity) of the texts of ``shards``, by the ``logs`` of ``parts`` parts."""
    each = logs.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("part", "logs"))).alias("logs"))

    def run(it):
        for b in it:
            for r in b.to_pylist():
                key = shard_grams(r)
                key = key[by_part(key, key >> SYM, parts)[0]]
                table = Table(key, np.concatenate([spread(x["logs"], np.float64) for x in r["logs"]]), 0.0)
                for lo, hi, offs, data in shard_slices(r):
                    sym, told = symbols(offs, data)
                    row = np.repeat(np.arange(hi - lo), np.diff(offs) + 1)
                    n = np.diff(offs)
                    lp = np.bincount(row, table.get(grams(sym)[told])[0], minlength=hi - lo)
                    yield out(["doc_id", "lang", "n_bytes", "log10_prob", "perplexity"], pa.array(r["doc_ids"][lo:hi], pa.int64()),
                              pa.array(r["langs"][lo:hi], pa.string()), pa.array(n), pa.array(lp), pa.array(10 ** (-lp / (n + 1))))

    return texts.join(each, "shard").transform(arrow_map, run, "doc_id long, lang string, n_bytes long, log10_prob double, perplexity double")


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
             train_rows: int | None = None, train_bytes: int | None = None, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, n_bytes, log10_prob, perplexity, threshold, kept) per document.

    ``trusted`` has the ids of trusted documents in its first column. One half
    of them, by hash, is learned from, the other one gives the thresholds. All
    texts of the first count, unless the caller bounds them: ``train_rows``
    texts and ``train_bytes`` bytes, by hash, long texts last.
    Perplexity is per byte, the end counted. Texts under MIN_BYTES bytes and
    others have thresholds of their own. threshold is null for a language
    (or null) without held-back trusted texts of that kind, and then all of
    the kind is kept; so are null and empty texts, which have nothing to judge.
    Without any trusted text every symbol is equally likely. Every row gives
    one row, also repeated ones and those with a null id; other columns are
    ignored.
    """
    scratch = Scratch(docs.sparkSession, "kneser")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    ids = scratch.keep(trusted.select(F.col(trusted.columns[0]).cast("long").alias("doc_id")).where("doc_id is not null").distinct())
    shuffles = max(12, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = scratch.bucketed(shards(rows), "shard", shuffles)
    at = texts.select("shard", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("at", "doc"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    learned = at.select("shard", "at", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.sizes").alias("size")).join(ids.where(half == 0), "doc_id", "left_semi")
    if train_rows is not None or train_bytes is not None:
        long = F.lit(False) if train_bytes is None else F.col("size") > train_bytes // 100
        order = [long, F.xxhash64("doc_id"), F.col("doc_id"), F.col("size")]  # long texts come last
        picked = learned.select("doc_id", "size")
        if train_bytes is not None:
            picked = picked.where(F.col("size") <= train_bytes)
        if train_rows is not None:
            picked = picked.orderBy(*order).limit(train_rows)
        if train_bytes is not None:
            picked = picked.withColumn("upto", F.sum("size").over(Window.orderBy(*order))).where(F.col("upto") <= train_bytes)
        learned = learned.join(picked.select("doc_id", "size").distinct(), ["doc_id", "size"], "left_semi")
    places = scratch.keep(learned.groupBy("shard").agg(F.collect_list("at").alias("at")))
    model = fit(learned_texts(texts, places), scratch)
    parts = max(shuffles, -(-sum(df.count() for pair in model[LOW:] for df in pair) // PART_GRAMS))
    scores = scratch.keep(scored(texts, looked_up(texts, model, parts), parts), large=True)
    scratch.drop(texts)
    scores = scores.withColumn("short", F.col("n_bytes") < MIN_BYTES)
    limits = scratch.keep(scores.where("lang is not null and n_bytes > 0").join(ids.where(half == 1), "doc_id", "left_semi")
                          .groupBy("lang", "short").agg((F.percentile_approx("perplexity", quantile, 10_000) * margin).alias("threshold")))
    judged = scores.join(F.broadcast(limits), ["lang", "short"], "left")  # two rows per language
    keep = F.coalesce((F.col("n_bytes") == 0) | (F.col("perplexity") <= F.col("threshold")), F.lit(True))
    return judged.select("doc_id", "lang", "n_bytes", "log10_prob", "perplexity", "threshold", keep.alias("kept"))
