"""Registered queries of the training-data operators, and their oracle SQL.

Each query applies one operator, with production parameters, to its whole
table. Tokenizer files are a parameter of the operators; the queries take
them from the installed ``public_tokenizers``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import align, bpe, centroids, decontaminate, kneser, minhash, mixing, quality, repeats, setjoin, tokens, toolcalls, urls
from tideline.llm.toolcalls import Param, Tool
from tideline.session import workdir
from tideline.sources.tables import load

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
END_ID = 2

# The URL rules, and the sites whose canonical URLs are listed.
URL_RULES = (urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"),
             urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"),
             urls.Rule("block", "net", "/fr/"))
TOOLS = (Tool("search", (Param("query", "string"), Param("limit", "integer", True, 1, 150))),
         Tool("analyse", (Param("query", "string"), Param("limit", "integer", False, 1, 300))))
LISTED_SITES = r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, encoded and decoded again."""
    return bpe.encode_decode(load(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                             public_tokenizers.PATTERN)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a benchmark item every document holds, by greedy string tiling."""
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the packed blocks."""
    path = workdir(spark, "tokens")
    tokens.write_tokens(load(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=END_ID)
    return tokens.read_docs(tokens.read_blocks(spark, path))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL; the list holds the canonical URLs of the listed sites."""
    pages = load(spark, sf_dir, "pages")
    host, _ = urls.host_path(F.col("url"))
    listed = pages.where(host.rlike(LISTED_SITES)).select(urls.canonical_url(F.col("url")).alias("listed_url"))
    return (urls.url_verdicts(pages, listed, URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict", "listed"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by 4-word shingles."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents"), k=4, percent=80)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression ratios and verdict of every document."""
    return quality.quality(load(spark, sf_dir, "documents"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the documents labelled good and not toxic."""
    trusted = load(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return kneser.classify(load(spark, sf_dir, "documents"), trusted)


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and mixed-context score of every document."""
    return mixing.score_texts(load(spark, sf_dir, "documents"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations read as tool calls and results.

    A system or user turn is a call identified by its place, its text the
    query; it uses the result of the call two turns before. An assistant turn
    is the result of the turn before it.
    """
    def ident(back: int):
        return F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn") - back)

    conv = F.col("conv_id").alias("conv")
    tool = F.when(F.col("role") == "system", "configure").when(F.length("text") < 200, "search").otherwise("analyse")
    arguments = F.to_json(F.struct(F.col("text").alias("query"), F.length("text").alias("limit")))
    after = F.when((F.col("role") == "user") & (F.col("turn") >= 2), ident(2))
    calls = turns.where("role in ('user', 'system')").select(
        conv, F.col("turn").alias("seq"), ident(0).alias("call_id"), tool.alias("name"),
        arguments.alias("arguments"), after.alias("after"))
    results = turns.where("role = 'assistant'").select(
        conv, F.col("turn").alias("seq"), ident(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call and result of the conversations, linked, ordered, checked and serialised."""
    return toolcalls.link_calls(*conversation_calls(load(spark, sf_dir, "conversations")), TOOLS)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier ones."""
    return repeats.remove_repeats(load(spark, sf_dir, "documents")).drop("kept")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 90 % of all 3-word shingles."""
    return setjoin.ngram_join(load(spark, sf_dir, "documents"), k=3, percent=90)


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over every document."""
    found, _ = align.align(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                           public_tokenizers.path(PIECES), links="end")
    return found


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from 40 seeds."""
    return centroids.cluster(load(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_blocks": op3_token_blocks,
    "op4_url_filter": op4_url_filter,
    "op5_minhash": op5_minhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_context_mixing": op8_context_mixing,
    "op9_tool_calls": op9_tool_calls,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_ngram_join": op11_ngram_join,
    "op12_align_tokens": op12_align_tokens,
    "op13_centroids": op13_centroids,
}

def _centroid_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Rounds one after the other: nearest centroid by (distance, number), then floor of the mean."""
    gap = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [f"""kept AS MATERIALIZED (
          SELECT row_number() OVER () AS row, vec_id,
                 list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
        c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
          FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
          SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d).c AS c, min(d).gap AS gap
          FROM (SELECT v.row, v.vec_id, v.v, {{'gap': {gap}, 'c': c.c}} AS d FROM kept v, c{r} c) GROUP BY row)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (
          SELECT c, list(CAST(floor(CAST(s - (s % n + n) % n AS DOUBLE) / n) AS BIGINT) ORDER BY i) AS v
          FROM (SELECT c, i, sum(x) AS s, count(*) AS n
                FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c),
        c{r + 1} AS MATERIALIZED (
          SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)""")
    return f"""WITH {', '.join(steps)}
        SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(gap AS BIGINT) AS distance,
               CAST(sum(gap) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(gap) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"""


ORACLE: dict[str, str] = {
    "op13_centroids": _centroid_sql(),
    "op4_url_filter": r"""
        WITH cut AS (
          SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
          FROM pages),
        split AS (
          SELECT page_id, rest,
                 translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                 coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS query
          FROM cut),
        bare AS (
          SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)?$', ''),
                                   '^www\.', '') AS site,
                 array_to_string(list_sort(list_filter(string_split(query, '&'),
                   lambda a: a <> '' AND NOT regexp_matches(a, '^(utm_[^=]*|ref)(=|$)'))), '&') AS args
          FROM split),
        canon AS (
          SELECT *, CASE WHEN rest IS NULL THEN NULL ELSE
                 site || regexp_replace(path, '/+$', '') || CASE WHEN args = '' THEN '' ELSE '?' || args END END AS c
          FROM bare),
        listed AS (
          SELECT DISTINCT c FROM canon
          WHERE regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.')),
        judged AS (
          SELECT page_id, host, path, c IS NOT NULL AND c IN (SELECT c FROM listed WHERE c IS NOT NULL) AS listed,
                 CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
                        THEN 'www.example.com/en/'
                      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
                        THEN 'example.com/en/'
                      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
                      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                 END AS rule
          FROM canon)
        SELECT page_id, host, path, rule, listed,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op9_tool_calls": r"""
        WITH calls AS (
          SELECT conv_id AS conv, turn, role, text,
                 'c' || conv_id || '-' || turn AS call_id,
                 CASE WHEN role = 'system' THEN 'configure' WHEN length(text) < 200 THEN 'search' ELSE 'analyse' END AS name,
                 CASE WHEN role = 'user' AND turn >= 2 THEN 'c' || conv_id || '-' || (turn - 2) END AS after
          FROM conversations WHERE role IN ('user', 'system')),
        chained AS (
          SELECT c.*, p.call_id IS NOT NULL AS there
          FROM calls c LEFT JOIN calls p ON c.conv = p.conv AND c.after = p.call_id),
        island AS (
          SELECT *, sum(CASE WHEN there THEN 0 ELSE 1 END) OVER (PARTITION BY conv, turn % 2 ORDER BY turn) AS run
          FROM chained),
        leveled AS (
          SELECT *, row_number() OVER (PARTITION BY conv, turn % 2, run ORDER BY turn) - 1 AS level FROM island),
        results AS (
          SELECT conv_id AS conv, 'c' || conv_id || '-' || (turn - 1) AS call_id, text AS content
          FROM conversations WHERE role = 'assistant')
        SELECT coalesce(c.conv, r.conv) AS conv, coalesce(c.call_id, r.call_id) AS call_id, turn AS seq, level,
               CASE WHEN c.conv IS NULL THEN NULL WHEN after IS NOT NULL AND NOT there THEN 'dangling' ELSE 'ok' END AS chain,
               name,
               CASE WHEN name = 'configure' THEN 'no_such_tool'
                    WHEN name = 'search' AND NOT length(text) BETWEEN 1 AND 150 THEN 'range:limit'
                    WHEN name = 'analyse' AND NOT length(text) BETWEEN 1 AND 300 THEN 'range:limit' END AS error,
               CASE WHEN c.conv IS NULL THEN 0 ELSE 1 END AS n_calls,
               CASE WHEN r.conv IS NULL THEN 0 ELSE 1 END AS n_results,
               CASE WHEN c.conv IS NULL THEN 'orphan' WHEN r.conv IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
               '{"after":' || coalesce(CAST(to_json(after) AS VARCHAR), 'null')
               || ',"arguments":' || CASE WHEN c.conv IS NULL THEN 'null' ELSE
                  '{"limit":' || length(text) || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}' END
               || ',"id":' || CAST(to_json(coalesce(c.call_id, r.call_id)) AS VARCHAR)
               || ',"name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null')
               || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS record
        FROM leveled c FULL JOIN results r ON c.conv = r.conv AND c.call_id = r.call_id""",
}
