"""URL rules, canonical URLs, and the Bloom filter with its exact join."""

from pyspark.sql import functions as F

from tideline.llm import urls as U
from tideline.llm.registry import URL_RULES


def test_host_path_and_longest_rule(spark):
    cases = {
        "http://A.Example.COM/en/1?x=/es/": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://m.www.example.com/en/a#b": ("m.www.example.com", "/en/a", "www.example.com/en/", "allow"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "x://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"), "x://a.net/es": ("a.net", "/es", None, "allow"),
        "x://example.com": ("example.com", "", None, "allow"), "x://a.com?y": ("a.com", "", None, "allow"),
        "x://a.org/?u=http://b.net/fr/": ("a.org", "/", None, "allow"), "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "x://": ("", "", None, "allow"),
        "http://É.com/É\n/en": ("É.com", "/É\n/en", "com/", "allow"),
        "http://" + "a" * 50_000 + ".net/fr/" + "b" * 50_000: ("a" * 50_000 + ".net", "/fr/" + "b" * 50_000, "net/fr/", "block"),
    }
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "u string")
    got = {r.page_id: tuple(r)[1:5] for r in U.url_verdicts(df, none, URL_RULES).collect()}
    assert got == dict(enumerate(cases.values()))


def test_canonical_url(spark):
    same = ["http://www.A.org/x/?b=2&utm_source=f&a=1#t", "https://a.org:443/x?a=1&b=2", "http://u@a.org/x/?a=1&b=2&ref=q"]
    other = ["http://a.org/X?a=1&b=2", "http://m.a.org/x?a=1&b=2", "http://a.org/x?a=1"]
    df = spark.createDataFrame([(x,) for x in same + other + [None, "rel/path"]], "u string")
    got = [r[0] for r in df.select(U.canonical_url(F.col("u"))).collect()]
    assert set(got[:3]) == {"a.org/x?a=1&b=2"} and len(set(got[3:6]) | set(got[:1])) == 4 and got[6:] == [None, None]


def test_bloom_with_exact_join_equals_plain_membership(spark, monkeypatch):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.org/"), F.col("id") % 1000).alias("url"))
    pages = pages.unionAll(spark.createDataFrame([(None, "http://h.org/7"), (1, None)], "page_id long, url string"))
    listed = spark.range(0, 500, 3).select(F.concat(F.lit("h.org/"), "id").alias("page_id")).unionAll(
        spark.createDataFrame([(None,), ("h.org/0",)], "page_id string"))
    want = sorted((str(r.page_id), r.url is not None and int(r.url[13:]) < 500 and int(r.url[13:]) % 3 == 0) for r in pages.collect())
    for most in (U.MAX_BLOCKS, 1):  # one block: the filter lets all through, the join decides
        monkeypatch.setattr(U, "MAX_BLOCKS", most)
        got = U.listed_flags(pages, listed, "page_id", "url").collect()
        assert sorted((str(r._id), r._hit) for r in got) == want


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    n = U.blocks_for(2000)
    filt = U.bloom_blocks(keys, "k", n)
    probe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    block, bits = U._place(F.col("k"), n)
    p = probe.withColumn("block", block).join(filt, "block", "left")
    for i, b in enumerate(bits):
        p = p.where(F.col(f"w{i}").bitwiseAND(b) != 0)
    found = [r.id for r in p.collect()]
    assert set(range(2000)) <= set(found) and len(found) < 2000 + 18_000 * 0.01


def test_empty_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.url_verdicts(df, spark.createDataFrame([("a",)], "u string"), URL_RULES).collect() == []
