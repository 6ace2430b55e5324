"""Exact Jaccard join of n-gram sets by a token-group matrix (operator 11).

Every text becomes its set of k-word shingles (64-bit hashes, the tokens);
equal sets form one class, and only classes are compared. A set that shares no
more tokens with all others than a link takes can't link, so two exact sieves
come first:

1. Sorted by hash, two linked sets share ``spare(n)`` tokens at least within
   their first ``prefix(n)`` ones. Only those are sent out, and a class goes on
   if enough of them are in another class too.
2. Of the classes left, the tokens that two of them have are counted. A class
   keeps its shared tokens, rarest first, and from their number the greatest
   size that a partner may have (``most``).

Then the matrix. Near copies are joined to the class with the fewest own tokens
among those that share one of their rarest tokens, which makes most of a group
of copies one component. The classes of a component, or those with the same
least token where there is none, form a family; a family is dealt into groups
of about ``GROUP_TOKENS`` tokens. A query goes to the families that have one of
its rarest tokens, and from there to the groups with a member of fitting size.
A task holds the token union of one group, counts how much of the query lies
in it, and opens the group only where that bound allows a link; its members are
then compared by their exact overlap.

Components already found are not queried again: a class looks for partners in
larger components only (the smaller class decides between equals). So a group
of n copies costs n comparisons where it hangs together, and n/group more for
each class that stays outside.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrow import arrow_map, column, out, text_slices
from tideline.llm.components import components
from tideline.llm.hashing import row_counts, shingles, word_hashes
from tideline.llm.memo import ranges
from tideline.llm.scratch import Scratch

GROUP_TOKENS = 1 << 15
SALT_QUERIES = 4096
BLOCK = 256  # queries compared at once


def need(n, percent: int):
    """Least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def spare(n, percent: int):
    """Tokens that linked sets share within their prefixes: of the two sizes, the smaller one's counts."""
    return 1 + (100 - percent) * n // 100


def prefix(n, percent: int):
    """First tokens, by hash, among which linked sets share ``spare`` ones."""
    return np.minimum(n, n - need(n, percent) + spare(n, percent))


def _sets(batch: pa.RecordBatch, k: int):
    """(first row, [sorted distinct shingle hashes per row]) of bounded slices."""
    for lo, hi, offs, data in text_slices(batch, "_text"):
        words, row, _, _ = word_hashes(data, offs)
        h, r = shingles(words, row, hi - lo, k)
        yield lo, [np.unique(x) for x in np.split(h, np.cumsum(row_counts(r, hi - lo))[:-1])]


def class_id(tokens: np.ndarray) -> str:
    return blake2b(tokens.tobytes(), digest_size=16).hexdigest()


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def features(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, cls, first) per row of (_id, _text); cls is null without words."""
    def run(it):
        for b in it:
            for lo, sets in _sets(b, k):
                n = np.array([len(s) for s in sets], np.int64)
                yield out(["doc_id", "n_shingles", "cls", "first"], column(b, "_id").slice(lo, len(sets)), pa.array(n),
                          pa.array([class_id(s) if len(s) else None for s in sets], pa.string()),
                          lists([s[:p] for s, p in zip(sets, prefix(n, percent).tolist())]))

    return rows.transform(arrow_map, run, "doc_id long, n_shingles long, cls string, first array<long>")


def full_sets(texts: DataFrame, k: int) -> DataFrame:
    """(cls, tokens) of the rows (want, _text): all, or where ``want`` is given those of that class."""
    def run(it):
        for b in it:
            want = column(b, "want").to_pylist()
            for lo, sets in _sets(b, k):
                own = [(c, s) for c, s, w in zip([class_id(s) for s in sets], sets, want[lo:lo + len(sets)])
                       if len(s) and w in (None, c)]
                yield out(["cls", "tokens"], pa.array([c for c, _ in own], pa.string()), lists([s for _, s in own]))

    return texts.transform(arrow_map, run, "cls string, tokens array<long>")


def sieve(classes: DataFrame, percent: int) -> DataFrame:
    """(cls, rep, n) of the classes with enough tokens in their prefix that another class has in its own."""
    # 64 bits of the class tell two classes that share a token apart; all its rows meet pre-summed
    tokens = classes.select(F.xxhash64("cls").alias("c"), F.explode("first").alias("t"))
    shared = tokens.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("t")
    hits = tokens.join(shared, "t", "left_semi").groupBy("c").agg(F.count(F.lit(1)).alias("hits"))
    least = F.expr(f"1 + ({100 - percent} * ceil({percent} * n / 100)) div 100")  # spare() of the smallest partner
    return (classes.select("cls", "rep", "n", F.xxhash64("cls").alias("c")).join(hits, "c")
            .where(F.col("hits") >= least).select("cls", "rep", "n"))


def shared_tokens(sets: DataFrame, percent: int) -> DataFrame:
    """(cls, n, kept, most, tokens, rare) of the sets (cls, tokens) that still may link: shared tokens, rarest first.

    Every partner has one of the ``rare`` tokens among its own rare ones, and ``most`` tokens at most.
    """
    each = sets.select("cls", F.explode("tokens").alias("t"))
    df = each.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    size = sets.select("cls", F.size("tokens").cast("long").alias("n"))
    own = (each.join(df, "t").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("s"))
           .select("cls", F.col("s.t").alias("tokens"), F.size("s").cast("long").alias("kept")).join(size, "cls"))
    return (own.where(f"100 * kept >= {percent} * n")
            .select("cls", "n", "kept", "tokens", F.expr(f"({100 + percent} * kept) div {percent} - n").alias("most"),
                    F.expr(f"slice(tokens, 1, cast(kept - ceil({percent} * n / 100) + 1 as int))").alias("rare")))


# ---- opening groups -----------------------------------------------------

class _Group:
    """The token union of a group and which of its members have each token."""

    def __init__(self):
        self.tokens, self.cls, self.n, self.rank, self.index = [], [], [], [], None

    def add(self, cls, n, rank, tokens) -> None:
        self.cls += cls
        self.n += n
        self.rank += rank
        self.tokens += tokens

    def links(self, cls, n, rank, tokens, percent: int, upward: bool):
        """(query, member) pairs that link; of the members of one component the first.

        ``upward``: only members whose rank is above the query's.
        """
        if self.index is None:
            flat = np.concatenate(self.tokens)
            of = np.repeat(np.arange(len(self.tokens)), [len(t) for t in self.tokens])
            order = np.argsort(flat, kind="stable")
            union, start = np.unique(flat[order], return_index=True)
            self.index = union, start, np.diff(np.append(start, len(flat))), of[order], np.array(self.n, np.int64)
        union, start, size, member, n_of = self.index
        found = []
        for lo in range(0, len(cls), BLOCK):
            part = tokens[lo:lo + BLOCK]
            nq = np.array(n[lo:lo + BLOCK], np.int64)
            flat = np.concatenate(part)
            query = np.repeat(np.arange(len(part)), [len(t) for t in part])
            at = np.minimum(np.searchsorted(union, flat), len(union) - 1)
            hit = union[at] == flat
            bound = np.bincount(query[hit], minlength=len(part))  # overlap of the query with the group
            may = 100 * bound >= percent * (nq + np.maximum(n_of.min() - bound, 0))
            hit &= may[query]
            at, query = at[hit], query[hit]
            pair = np.repeat(query, size[at]) * len(n_of) + member[ranges(start[at], size[at])]
            pair, common = np.unique(pair, return_counts=True)
            q, m = pair // len(n_of), pair % len(n_of)
            ok = 100 * common >= percent * (nq[q] + n_of[m] - common)
            seen = set()
            for i, j in zip((q[ok] + lo).tolist(), m[ok].tolist()):
                above = self.rank[j] > rank[i] if upward else self.cls[j] != cls[i]
                if above and (i, self.rank[j]) not in seen:
                    seen.add((i, self.rank[j]))
                    found.append((cls[i], self.cls[j]))
        return found


def _open(percent: int, upward: bool):
    def run(it):
        key, group = None, _Group()
        for b in it:
            g, salt, query = (column(b, c).to_numpy(zero_copy_only=False) for c in ("g", "salt", "query"))
            if not len(g):
                continue
            tokens = column(b, "tokens")
            new = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (salt[1:] != salt[:-1]) | (query[1:] != query[:-1])))
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(g)]):
                if (g[lo], salt[lo]) != key:
                    key, group = (g[lo], salt[lo]), _Group()
                rows = [column(b, c).slice(lo, hi - lo).to_pylist() for c in ("cls", "n", "rank")]
                rows.append([tokens[i].values.to_numpy() for i in range(lo, hi)])
                if not query[lo]:
                    group.add(*rows)
                elif group.cls:
                    found = group.links(*rows, percent, upward)
                    yield out(["a", "b"], pa.array([a for a, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64()))

    return run


def opened(items: DataFrame, queries: DataFrame, members: DataFrame, percent: int, upward: bool) -> DataFrame:
    """Links (a, b) between the queries (g, cls) and the members (g, cls) of the same group.

    The queries of a group are dealt over as many tasks as they need; each gets the members once.
    """
    salts = queries.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / SALT_QUERIES).cast("int").alias("salts"))
    cols = ["g", "salt", "query", "cls", "n", "rank", "tokens"]
    q = (queries.join(salts, "g").withColumn("salt", F.pmod(F.xxhash64("cls"), "salts").cast("int"))
         .join(items, "cls").withColumn("query", F.lit(True)))
    m = (members.join(salts, "g").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
         .join(items, "cls").withColumn("query", F.lit(False)))
    return (q.select(cols).unionAll(m.select(cols)).repartition("g", "salt").sortWithinPartitions("g", "salt", "query")
            .transform(arrow_map, _open(percent, upward), "a long, b long"))


# ---- the join -----------------------------------------------------------

def fits(n: str, most: str, other: str, other_most: str) -> Column:
    """Whether sets of these sizes may link."""
    return F.expr(f"{other} <= {most} and {n} <= {other_most}")


def star_links(items: DataFrame, percent: int, keep) -> DataFrame:
    """Links of each class to the class with the fewest own tokens among those with the same rare token."""
    post = items.select("cls", "n", "most", "kept", F.explode("rare").alias("t"))
    hub = post.groupBy("t").agg(F.max(F.struct(F.expr("kept / n").alias("share"), "n", "cls", "most")).alias("hub"),
                                F.count(F.lit(1)).alias("c")).where("c > 1").select("t", "hub")
    pairs = keep(post.join(hub, "t").where("cls <> hub.cls").where(fits("n", "most", "hub.n", "hub.most"))
                 .select("cls", F.col("hub.cls").alias("hub")).distinct())
    g = F.xxhash64("hub").alias("g")
    flat = items.withColumn("rank", F.col("cls").cast("string"))
    return keep(opened(flat, pairs.select(g, "cls"), pairs.select(g, F.col("hub").alias("cls")).distinct(), percent, False))


def matrix_links(items: DataFrame, post: DataFrame, tokens: DataFrame, percent: int, keep) -> DataFrame:
    """Links of each class to classes of larger components (items have family and rank).

    A class goes to the families that have one of its keys: ``post`` has the
    keys t of each class, with its nq, mq and rank, ``tokens`` the distinct
    (family, t).
    """
    families = items.groupBy("family").agg(F.sum("kept").alias("kept"))
    dealt = keep(items.join(families.select("family", F.expr(f"cast(ceil(kept / {GROUP_TOKENS}) as int)").alias("groups")), "family")
                 .select("cls", "n", "most", "rank", "family", F.xxhash64("family", F.pmod(F.xxhash64("cls"), "groups")).alias("g")))
    high = dealt.groupBy("family").agg(F.max("rank").alias("high"))
    matrix = tokens.join(high, "family")
    reached = (post.join(matrix, (post["t"] == matrix["t"]) & (post["rank"] < matrix["high"]))
               .select("cls", "nq", "mq", "rank", "family").distinct())
    groups = dealt.groupBy("family", "g").agg(F.min("n").alias("least"), F.max("most").alias("widest"), F.max("rank").alias("top"))
    queries = keep(reached.join(groups, "family").where("rank < top").where(fits("nq", "mq", "least", "widest"))
                   .select("g", "cls"))
    if queries.isEmpty():
        return queries.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    return keep(opened(items, queries, dealt.select("g", "cls"), percent, True))


def with_families(items: DataFrame, found: DataFrame) -> DataFrame:
    """items with component, family (the component, or the least token of a class on its own) and rank (size, component)."""
    size = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    of = found.join(size, "component").select(F.col("node").alias("cls"), "component", "size")
    place = F.concat(*[F.lpad(c.cast("string"), 19, "0") for c in (F.coalesce("size", F.lit(1)), F.coalesce("component", "cls"))])
    family = F.when(F.col("component").isNull(), F.struct(F.lit(False).alias("linked"), F.array_min("tokens").alias("of"))).otherwise(
        F.struct(F.lit(True).alias("linked"), F.col("component").alias("of")))
    return (items.join(of, "cls", "left").withColumn("rank", place).withColumn("family", F.xxhash64(family))
            .withColumn("component", F.coalesce("component", "cls")).drop("size"))


def linked_classes(items: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(cls, component) of the classes, by all links between them."""
    keep = scratch.keep
    first = components(star_links(items, percent, keep), scratch)
    items = keep(with_families(items, first))
    rare = items.select("cls", F.col("n").alias("nq"), F.col("most").alias("mq"), "rank", F.explode("rare").alias("t"))
    tokens = items.select("family", F.explode("tokens").alias("t")).distinct()
    more = matrix_links(items, rare, tokens, percent, keep)
    of = items.select("cls", "component")
    if more.isEmpty():
        return of
    for side in ("a", "b"):
        more = more.join(of.select(F.col("cls").alias(side), F.col("component").alias("c" + side)), side)
    joined = components(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch)
    return (of.join(joined, of["component"] == joined["node"], "left")
            .select("cls", F.coalesce(joined["component"], of["component"]).alias("component")))


def ngram_join(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per document.

    Words are runs of other bytes than space and \\t..\\r, A-Z lower-cased; a
    text of fewer than ``k`` words is one shingle. Documents link when the
    shared shingles are ``percent`` of all they have, or more; component_id is
    the least id reachable, the document's own included. A null, empty or
    wordless text has no shingles and no link. Repeated rows share their class,
    hence their result; rows of one id with different texts are judged each by
    its text, and all of them reach that id. Rows with a null id link like
    others but lend no id: their component_id is null where no other row is
    reachable. An empty table gives no row; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "setjoin")
    keep = scratch.keep
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    wide = keep(features(rows, k, percent))
    firsts = keep(wide.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("first").alias("first")), large=True)
    feats, classes = keep(wide.drop("first")), keep(firsts.drop("first"))
    scratch.drop(wide)
    live = keep(sieve(firsts, percent), large=True)
    scratch.drop(firsts)
    own = live.where("rep is not null").select(F.col("rep").alias("_id"), F.col("cls").alias("want"))
    sets = full_sets(rows.join(own, "_id").select("want", "_text"), k)
    if not live.where("rep is null").isEmpty():  # texts that only rows without an id have
        nameless = full_sets(rows.where("_id is null").select(F.lit(None).cast("string").alias("want"), "_text"), k)
        sets = sets.unionAll(nameless.join(live.where("rep is null").select("cls"), "cls", "left_semi"))
    # from here on a class is a number, given once and written
    sets = keep(sets.dropDuplicates(["cls"]).withColumn("number", F.monotonically_increasing_id()), large=True)
    names = keep(sets.select("cls", "number"))
    items = keep(shared_tokens(sets.select(F.col("number").alias("cls"), "tokens"), percent), large=True)
    scratch.drop(sets)
    found = linked_classes(items, percent, scratch).withColumnRenamed("cls", "number").join(names, "number")
    joined = keep(found.select("cls", "component").join(classes, "cls"))
    least = joined.groupBy("component").agg(F.min("rep").alias("least"))
    linked = joined.join(least, "component").select("cls", "component", "least")
    of_class = keep(classes.join(linked, "cls", "left").select(
        "cls", F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id")))
    comp = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return feats.select("doc_id", "n_shingles", "cls").join(of_class, "cls", "left").select(
        "doc_id", "n_shingles", comp.alias("component_id"))
