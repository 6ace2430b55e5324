"""Near-duplicate documents by b-bit MinHash, links confirmed exactly (operator 5).

1. Every text becomes its set of k-word shingles (64-bit hashes), 512 minima,
   their band keys, and a signature of the low ``BITS`` bits of each minimum.
   Texts with equal sets form one class; only classes are compared.
2. Classes that agree on a band are candidates. A pair is estimated from the
   packed signatures: with b bits, unequal minima still agree once in 2**b,
   so similarity is (agreement - 2**-b) / (1 - 2**-b). The cut is five
   standard deviations below the limit.
3. Pairs that pass are confirmed on the full shingle sets, and the links are
   gathered into components.

A band bucket never gives all its pairs. A set of which too few shingles are in
any other set of a bucket can't link, and the number of those that are bounds
the size of a partner (``most``); both are exact and come first. Of the rest,
the member with the fewest own shingles is paired with all others; the estimate
sorts those pairs, and the links join a group of near copies to one component.
Members that stayed outside are then compared with the larger components of
their buckets exactly, by the groups of ``setjoin``: rows are (member, group),
never pairs of members, and a group is opened only where the overlap with its
union allows a link. No bucket is cut or capped.

Nothing is broadcast by the size of its files: joins with a written table sort
and merge, but that with the Bloom filter of wanted texts (a fixed 4.5 MB at
most); Spark may broadcast what it has measured while it runs.

A pair at the limit of 0.8 shares one of the 32 bands of 4 minima with
probability 1 - (1 - 0.8**4)**32 = 1 - 4.7e-8, and its estimate falls below
the cut with 3e-7: the recall of links is 0.9999996 there and higher above.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.components import components
from tideline.llm.hashing import U64, mix, row_counts, shingles, word_hashes
from tideline.llm.scratch import Scratch
from tideline.llm.setjoin import matrix_links, with_families
from tideline.llm.urls import possible

BANDS, ROWS, BITS = 32, 4, 2
N_HASH = 512  # the first BANDS * ROWS make the band keys, all the signature
WORDS = N_HASH * BITS // 64

_rng = np.random.default_rng(97)
_XOR = _rng.integers(0, 1 << 63, N_HASH, dtype=np.uint64) * U64(2) + U64(1)
_MUL = _rng.integers(0, 1 << 63, N_HASH, dtype=np.uint64) * U64(2) + U64(1)
_BAND_MUL = _rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) * U64(2) + U64(1)

SIG = [f"s{i}" for i in range(WORDS)]
FEATURES = [T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.StringType()),
            T.StructField("bands", T.ArrayType(T.LongType())), *[T.StructField(s, T.LongType()) for s in SIG]]


def minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, N_HASH) least value of each hash over the shingles from each start."""
    res = np.empty((len(starts), N_HASH), U64)
    x = np.empty_like(h)
    for i in range(N_HASH):
        np.bitwise_xor(h, _XOR[i], out=x)
        np.multiply(x, _MUL[i], out=x)
        res[:, i] = np.minimum.reduceat(x, starts)
    return res


def band_keys(m: np.ndarray) -> np.ndarray:
    parts = mix(m[:, :BANDS * ROWS]).reshape(len(m), BANDS, ROWS) * _BAND_MUL
    return mix(parts.sum(axis=2) + np.arange(BANDS, dtype=U64)).view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """Low BITS bits of every minimum, 64 / BITS of them to a word."""
    low = mix(m) & U64((1 << BITS) - 1)  # the multiplier is odd: low bits alone follow the shingle's low bits
    per = 64 // BITS
    shift = np.arange(per, dtype=U64) * U64(BITS)
    return np.bitwise_or.reduce(low.reshape(len(m), WORDS, per) << shift, axis=2).view(np.int64)


def class_id(shingle_set: np.ndarray) -> str:
    """128-bit digest of a sorted set."""
    return blake2b(shingle_set.tobytes(), digest_size=16).hexdigest()


def _features(batch: pa.RecordBatch, k: int, names: list[str]):
    for lo, hi, offs, data in text_slices(batch, "_text"):
        n = hi - lo
        words, row, _, _ = word_hashes(data, offs)
        h, r = shingles(words, row, n, k)
        cnt = row_counts(r, n)
        some = np.flatnonzero(cnt)
        ends = np.cumsum(cnt)
        size, digest = [0] * n, [None] * n
        for i in some.tolist():
            u = np.unique(h[ends[i] - cnt[i]:ends[i]])
            size[i], digest[i] = len(u), class_id(u)
        bands, sig = [None] * n, np.zeros((n, WORDS), np.int64)
        if len(some):
            m = minima(h, (ends - cnt)[some])
            for i, keys in zip(some.tolist(), band_keys(m).tolist()):
                bands[i] = keys
            sig[some] = packed(m)
        yield out(names, *[column(batch, c).slice(lo, n) for c in ("_id", "_key")], pa.array(size, pa.int64()),
                  pa.array(digest, pa.string()), pa.array(bands, pa.list_(pa.int64())), *[pa.array(sig[:, i]) for i in range(WORDS)])


def features(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, key, n_shingles, digest, bands, s0..) per row of (_id, _key, _text); digest is null without words."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("key", T.StringType()), *FEATURES])

    def run(it):
        for b in it:
            yield from _features(b, k, schema.names)

    return docs.transform(arrow_map, run, schema)


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """(digest, hashes): the sorted distinct shingle hashes of the rows (want, _text), where ``want`` is given those of that digest."""
    def run(it):
        for b in it:
            want = column(b, "want").to_pylist()
            for lo, hi, offs, data in text_slices(b, "_text"):
                words, row, _, _ = word_hashes(data, offs)
                h, r = shingles(words, row, hi - lo, k)
                sets = [np.unique(x) for x in np.split(h, np.cumsum(row_counts(r, hi - lo))[:-1])]
                own = [(c, x.view(np.int64)) for c, x, w in zip(map(class_id, sets), sets, want[lo:hi]) if len(x) and w in (None, c)]
                yield out(["digest", "hashes"], pa.array([c for c, _ in own], pa.string()),
                          pa.array([x for _, x in own], pa.list_(pa.int64())))

    return texts.transform(arrow_map, run, "digest string, hashes array<long>")


def bounds(sets: DataFrame, percent: int) -> DataFrame:
    """(cls, n, kept, most) of the sets (cls, hashes) that can link: shingles that others have too, greatest size of a partner."""
    each = sets.select("cls", F.explode("hashes").alias("t"))
    shared = each.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("t")
    kept = each.join(shared, "t").groupBy("cls").agg(F.count(F.lit(1)).alias("kept"))
    return (kept.join(sets.select("cls", F.size("hashes").cast("long").alias("n")), "cls")
            .where(f"100 * kept >= {percent} * n")
            .select("cls", "n", "kept", F.expr(f"({100 + percent} * kept) div {percent} - n").alias("most")))


def agreement(left: str, right: str) -> Column:
    """Minima whose retained bits agree, from the packed words of both sides."""
    odd = F.lit(0)
    keep = F.lit(0x5555555555555555)
    for s in SIG:
        x = F.col(left + s).bitwiseXOR(F.col(right + s))
        odd = odd + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(keep))
    return N_HASH - odd


def estimate(left: str, right: str) -> Column:
    """Similarity, corrected for unequal minima that agree by chance."""
    c = 2.0 ** -BITS
    return (agreement(left, right) / N_HASH - c) / (1 - c)


def slack(limit: float) -> float:
    """Five standard deviations of the estimate for a pair at the limit."""
    c = 2.0 ** -BITS
    agree = c + (1 - c) * limit
    return 5 * (agree * (1 - agree) / N_HASH) ** 0.5 / (1 - c)


class _Linker:
    """Candidate search and confirmation over the classes of one run."""

    def __init__(self, scratch: Scratch, classes: DataFrame, sets: DataFrame, percent: int):
        self.scratch, self.classes, self.sets, self.percent = scratch, classes, sets, percent
        self.comps = None

    def label(self, members: DataFrame) -> DataFrame:
        """members with comp, the component known so far (the class itself without a link)."""
        if self.comps is None:
            return members.withColumn("comp", F.col("cls"))
        return (members.join(self.comps, members.cls == self.comps.node, "left")
                .select(*members.columns, F.coalesce("component", "cls").alias("comp")))

    def likely(self, left: str, right: str) -> Column:
        """Whether the estimate from the columns left + s0.. and right + s0.. allows a link."""
        return estimate(left, right) >= self.percent / 100 - slack(self.percent / 100)

    def confirm(self, pairs: DataFrame, estimated: bool = False) -> None:
        """Add those of the candidate pairs (a, b) that are links; ``estimated`` ones passed the estimate."""
        if not estimated:
            sig = self.classes.select("cls", *SIG)
            for side in ("a", "b"):
                pairs = pairs.join(sig.select(F.col("cls").alias(side), *[F.col(s).alias(side + s) for s in SIG]), side)
            pairs = pairs.where(self.likely("a", "b"))
        likely = self.scratch.keep(pairs.select("a", "b").distinct())
        full = (likely.join(self.sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b")
                .join(self.sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a"))
        percent = self.percent

        def exact(it):
            for batch in it:
                keep = []
                for x, y in zip(column(batch, "ha"), column(batch, "hb")):
                    x, y = (v.values.to_numpy().view(U64) for v in (x, y))
                    if len(x) > len(y):
                        x, y = y, x
                    if 100 * len(x) < percent * len(y) or not len(x):
                        keep.append(False)
                        continue
                    i = np.searchsorted(y, x)
                    common = int((y[np.minimum(i, len(y) - 1)] == x).sum())
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        self.join_up(self.scratch.keep(full.select("a", "b", "ha", "hb").transform(arrow_map, exact, "a long, b long")))

    def join_up(self, links: DataFrame) -> None:
        """Join the components that new links connect; only those are labelled anew."""
        nodes = links.select(F.col("a").alias("cls")).unionAll(links.select("b")).distinct()
        if self.comps is None:
            self.comps = components(links, self.scratch)
            return
        known = self.comps.select(F.col("node").alias("cls"), F.col("component").alias("comp"))
        for side in ("a", "b"):
            links = (links.join(known.select(F.col("cls").alias(side), F.col("comp").alias("c" + side)), side, "left")
                     .withColumn("c" + side, F.coalesce("c" + side, side)))
        between = self.scratch.keep(links.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        if between.isEmpty():
            return
        joined = components(between, self.scratch).select(F.col("node").alias("comp"), "component")
        every = self.label(known.select("cls").unionAll(nodes).distinct())
        self.comps = self.scratch.keep(every.join(joined, "comp", "left")
                                       .select(F.col("cls").alias("node"), F.coalesce("component", "comp").alias("component")))

    def star_pairs(self, members: DataFrame) -> DataFrame:
        """Each member with the one of its bucket that has the fewest own shingles."""
        hub = (members.groupBy("bucket").agg(F.max(F.struct(F.expr("kept / n").alias("share"), "n", "cls", "most")).alias("hub"),
                                             F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket", "hub"))
        pairs = members.join(hub, "bucket").where("cls <> hub.cls and n <= hub.most and hub.n <= most")
        return pairs.select(F.col("hub.cls").alias("a"), F.col("cls").alias("b")).distinct()

    def settle(self, members: DataFrame) -> None:
        """All links among the members (cls, bucket, n, kept, most) of the buckets."""
        self.confirm(self.star_pairs(members))
        keep = self.scratch.keep
        own = members.select("cls", "n", "kept", "most").distinct()
        items = keep(with_families(own.join(self.sets.withColumnRenamed("hashes", "tokens"), "cls"), self.comps))
        keys = members.select("cls", F.col("bucket").alias("t")).join(items.select(
            "cls", "family", F.col("n").alias("nq"), F.col("most").alias("mq"), "rank"), "cls")
        more = matrix_links(items, keys.drop("family"), keys.select("family", "t").distinct(), self.percent, keep)
        if not more.isEmpty():
            self.join_up(more)


def shared_buckets(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """The rows (cls, bucket) of buckets with two members or more."""
    keys = scratch.keep(rows.groupBy("bucket").count().where("count > 1").select("bucket"))
    return scratch.keep(rows.join(keys, "bucket").select("cls", "bucket"), large=True)


def search(rows: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """(doc_id, key, n_shingles, component, component_id) per row of (_id, _key, _text).

    component is a number for the rows that reach each other (null without
    words), component_id the least id among them (null if none has one).
    """
    feats = scratch.keep(features(rows, k))
    classes = scratch.keep(
        feats.where("digest is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in SIG])
        .withColumn("cls", F.monotonically_increasing_id()))
    members = shared_buckets(scratch, classes.select("cls", F.explode("bands").alias("bucket")))
    wanted = scratch.keep(members.select("cls").distinct().join(classes.select("cls", "digest", "rep"), "cls"))
    named = wanted.where("rep is not null").select(F.col("rep").alias("_id"), F.col("digest").alias("want"))
    own = possible(rows, "_id", named).where("_maybe")  # so the other texts need not be shuffled
    sets = shingle_sets(own.join(named, "_id").select("want", "_text"), k)
    if not wanted.where("rep is null").isEmpty():  # texts that only rows without an id have
        nameless = shingle_sets(rows.where("_id is null").select(F.lit(None).cast("string").alias("want"), "_text"), k)
        sets = sets.unionAll(nameless.join(wanted.where("rep is null").select("digest"), "digest", "left_semi"))
    sets = scratch.keep(sets.dropDuplicates(["digest"]).join(wanted.select("cls", "digest"), "digest").select("cls", "hashes"), large=True)
    linker = _Linker(scratch, classes, sets, percent)
    linker.settle(scratch.keep(members.join(bounds(sets, percent), "cls"), large=True))
    joined = scratch.keep(classes.select("cls", "digest", "rep").join(linker.comps, F.col("cls") == F.col("node"), "left")
                          .select("digest", "rep", F.coalesce("component", "cls").alias("component")))
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = scratch.keep(joined.join(least, "component").select("digest", "component", "component_id"))
    found = feats.select("doc_id", "key", "n_shingles", "digest").join(of_class, "digest", "left")
    comp = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "key", "n_shingles", "component", comp.alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document.

    Words are runs of other bytes than space and \\t..\\r, A-Z lower-cased; a
    text of fewer than ``k`` words is one shingle. Documents are linked when
    the shared shingles are ``percent`` of all they have, or more;
    component_id is the least id reachable, and kept says whether it is the
    document's own. A null, empty or wordless text has no shingles and no
    link. Repeated rows share their class, hence their result; rows of one id
    with different texts are judged each by its text. Rows with a null id
    link like others but lend no id: they get the least id of their
    component, or null, and are kept only without one
    (``drop_near_duplicates`` leaves one of those, too). Other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.lit("").alias("_key"), F.col(text_col).alias("_text"))
    found = search(rows, k, percent, Scratch(docs.sparkSession, "minhash", merged=True))
    return (found.select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, of each group of near duplicates one row: that of the least id (null ids last, then by text).

    Rows are told apart by id and text, so of rows that repeat both one is
    left; rows without words are all kept. Columns are unchanged.
    """
    scratch = Scratch(docs.sparkSession, "near")
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("_id"),
                        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("_key"))
    rows = keyed.select("_id", "_key", F.col("row").getField(text_col).alias("_text"))
    of = search(rows, k, percent, Scratch(docs.sparkSession, "minhash", merged=True))
    found = scratch.keep(of.where("component is not null").select("component", "doc_id", "key"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("best")
    groups = found.groupBy("component").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1")
    each = scratch.keep(found.join(groups, "component").select(
        "doc_id", "key", (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key"))).alias("stays"))
        .groupBy("doc_id", "key", "stays").agg(F.count(F.lit(1)).alias("n")))
    is_row = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key"))
    left = keyed.join(each.where("not stays").select("doc_id", "key"), is_row, "left_anti")
    again = scratch.keep(each.where("stays and n > 1").select("doc_id", "key"))
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(again, is_row, "left_semi").dropDuplicates(["_id", "_key"])
    return left.join(again, is_row, "left_anti").unionAll(once).select("row.*")
