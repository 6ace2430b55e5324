"""URL filter: rules by host and path, and a list of canonical URLs (operator 4).

The list is looked up in two steps. A blocked Bloom filter (512-bit blocks of
eight 64-bit words, one bit set in each word) lets nearly all unlisted URLs
through at once; the URLs it cannot rule out are hash-joined with the list
itself, which removes its false positives. The filter has at most
``MAX_BLOCKS`` blocks (a fixed 4.5 MB), so it may be broadcast whatever the
size of the list: a longer list only sends more URLs to the exact join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.scratch import Scratch

MAX_BLOCKS = 1 << 16
BLOCK_BITS = 512
BITS_PER_KEY = 16


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; both empty without one."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host), len(r.path))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def canonical_url(url: Column) -> Column:
    """Host and path with its query, without what does not change the page.

    Dropped: scheme, user, ``www.``, ports 80 and 443, fragment, ``utm_*`` and
    ``ref`` parameters, a final slash; other parameters are sorted. Null
    without ``://``.
    """
    rest = F.when(F.locate("://", url) > 0, F.regexp_replace(url, r"^(?s:.*?)://", ""))
    rest = F.regexp_replace(rest, r"(?s)#.*$", "")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    args = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), "&"),
                                 lambda a: (a != "") & ~a.rlike(r"^(utm_[^=]*|ref)(=|$)")))
    return F.concat(host, path, F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(""))


def _place(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bit in each of the block's eight words."""
    a, b = F.xxhash64(key), F.xxhash64(key, F.lit("bits"))
    block = F.pmod(a, F.lit(n_blocks))
    bits = [F.shiftrightunsigned(b, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(8)]
    return block, [F.call_function("shiftleft", F.lit(1).cast("long"), x) for x in bits]


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter of ``listed.key`` as rows (block, w0..w7); empty blocks have none."""
    block, bits = _place(F.col(key), n_blocks)
    return (listed.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]))


def blocks_for(n: int) -> int:
    """Blocks for ``n`` keys: a power of two, ``MAX_BLOCKS`` at most."""
    need = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    return min(MAX_BLOCKS, 1 << (need - 1).bit_length())


def possible(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """rows with _maybe: whether ``key`` may be in the first column of ``listed`` (no: never); a table kept before."""
    n_blocks = blocks_for(listed.count())
    filt = F.broadcast(bloom_blocks(listed, listed.columns[0], n_blocks))  # at most MAX_BLOCKS rows of 72 bytes
    block, bits = _place(F.col(key), n_blocks)
    probe = rows.withColumn("block", block)
    for i, b in enumerate(bits):
        probe = probe.withColumn(f"_b{i}", b)
    hit = F.lit(True)
    for i in range(8):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"_b{i}")) != 0)
    return probe.join(filt, "block", "left").select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))


def listed_flags(pages: DataFrame, listed: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(id, url, listed boolean) per row of pages, by the Bloom filter and the exact join.

    ``listed`` has one column of canonical URLs (nulls and repeats allowed).
    """
    key = listed.columns[0]
    urls = Scratch(listed.sparkSession, "urls").keep(listed.select(F.col(key).alias("_listed")).where("_listed is not null").distinct())
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    probe = possible(rows.withColumn("_canon", canonical_url(F.col("_url"))), "_canon", urls)
    sure = probe.where("not _maybe").select("_id", "_url", F.lit(False).alias("_hit"))
    exact = (probe.where("_maybe").join(urls.withColumn("_in", F.lit(True)), F.col("_canon") == F.col("_listed"), "left")
             .select("_id", "_url", F.coalesce("_in", F.lit(False)).alias("_hit")))
    return sure.unionAll(exact)


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], id_col: str = "page_id",
                 url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, listed) of every page.

    The longest rule that fits decides; without one, a listed URL is blocked
    and any other allowed. A null URL or one without ``://`` has empty host
    and path, fits no rule and is allowed. Every row gives one row, repeated
    ones and those with a null id too; other columns are ignored.
    """
    flags = listed_flags(pages, listed, id_col, url_col)
    host, path = host_path(F.col("_url"))
    split = flags.select("_id", "_hit", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return split.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
                        F.coalesce(verdict, F.when(F.col("_hit"), "block").otherwise("allow")).alias("verdict"),
                        F.col("_hit").alias("listed"))
