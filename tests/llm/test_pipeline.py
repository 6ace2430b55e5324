"""The pipeline, stage by stage, against brute force over each stage's own input."""

import random
from hashlib import sha256

import corpus_pipeline as P
import public_tokenizers
import pytest
import test_decontaminate
import test_minhash
import test_quality
import test_repeats
import tiktoken

from tideline.llm import bpe, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rnd = random.Random(13)
    syl = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io".split()
    prose = lambda n: [("".join(rnd.choices(syl, k=rnd.randint(1, 4)))) for _ in range(n)]
    items = [prose(30) for _ in range(8)]
    passage = prose(60)
    texts = [prose(rnd.randint(80, 200)) for _ in range(40)]
    texts += [texts[i][:3] + ["changed"] + texts[i][4:] for i in range(6)] + [list(texts[i]) for i in range(4)]
    texts += [prose(60) + passage + prose(60) for _ in range(4)]
    texts += [prose(60) + items[i] + prose(60) for i in range(4)]
    texts += [prose(40) + items[5][15:] + prose(60) + items[5][:15]]
    texts = [" ".join(t) for t in texts] + ["spam " * 400, "too short", "", None]
    rnd.shuffle(texts)
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)] + [(None, " ".join(prose(90)), None, None, None)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def brute_stages(rows, items):
    """The rows after each stage, as (doc_id, text)."""
    rows = [(r[0], r[1]) for r in rows]
    out = [[(i, t) for i, t in rows if not test_quality.brute(t)[-1] and quality.compression((t or "").encode())[3]]]
    named = [(i, t) for i, t in out[-1] if i is not None]
    comp = test_minhash.brute(named, 5)
    out.append([(i, t) for i, t in out[-1] if i is None or comp[i][2]])
    cut = {(r[0], r[4]): r for r in test_repeats.brute(out[-1])}
    by_id = {}
    for r in cut.values():
        by_id[r[0]] = r[5].decode("utf-8", "ignore")
    out.append([(i, by_id[i]) for i, t in out[-1] if by_id[i]])

    def leaks(t):
        words = t.lower().split()
        return any(2 * sum(k for k, _, _ in test_decontaminate.naive_tiles(p, words, 5)) >= len(p) for p in items)

    out.append([(i, t) for i, t in out[-1] if not leaks(t)])
    return out


def test_every_stage_matches_brute_force(spark, data):
    d, rows, items = data
    docs = spark.read.parquet(f"{d}/documents.parquet")
    want = brute_stages(rows, items)
    assert len(want[0]) < len(rows) and all(len(b) < len(a) for a, b in zip((want[0], want[2]), (want[1], want[3])))
    assert sum(len(t) for _, t in want[2]) < sum(len(t) for _, t in want[1])
    for (name, stage), after in zip(P.STAGES[:-1], want):
        stage(spark, docs, d).write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted(after, key=str), name
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path(P.RANKS)))
    got = {r.doc_id: r for r in P.run(spark, d).collect()}
    assert set(got) == {i for i, _ in want[-1]}
    for i, t in want[-1]:
        ids = tik.encode_ordinary(t)
        assert list(memoryview(bytes(got[i].ids)).cast("I")) == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == sha256(t.encode()).hexdigest()


def test_empty_documents(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert P.run(spark, d).collect() == []


def test_stages_keep_odd_rows_and_columns(spark, data):
    d, rows, _ = data
    odd = spark.createDataFrame([(None, None, 1, "k"), (None, "text é " * 30, 2, None), (7, None, 3, "x"), (7, "", 4, "y"),
                                 (8, "text é " * 30, 5, None)], "doc_id long, text string, key int, sha string")
    for name, stage in P.STAGES[1:4]:
        got = stage(spark, odd, d)
        assert got.columns == odd.columns
        ids = sorted(r.key for r in got.collect())
        assert ids == ([1, 2, 3, 4, 5] if name == "decontamination" else [1, 3, 4, 5]), name


def test_leaks_without_an_id_go_and_equal_rows_too(spark, data):
    d, _, items = data
    leak = " ".join(items[0])
    rows = [(None, "x y " + leak, 1), (4, leak, 2), (4, "clean text of a row that shares its id", 3), (None, "clean", 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _leak int")
    assert sorted(r["_leak"] for r in P.decontamination(spark, df, d).collect()) == [3, 4, 5]
    same = spark.createDataFrame([(8, leak, 1), (8, leak, 2), (8, leak, 3)], "doc_id long, text string, row int")
    assert P.near_dedup(spark, same, d).count() == 1


def test_encoding_of_odd_rows_and_clashing_columns(spark, data):
    d, _, _ = data
    odd = spark.createDataFrame([(None, None, 1), (None, "é x", 2), (7, "", 3), (7, "a" * 70000, 4), (7, "é x", 5)],
                                "doc_id long, text string, ids int")
    got = sorted((r.doc_id or 0, r.n_tokens, len(r.ids) // 4) for r in P.encoding(spark, odd, d).collect())
    assert [g[:1] for g in got] == [(0,), (0,), (7,), (7,), (7,)] and all(a == b for _, a, b in got)
