import random

from conftest import rows
from pyspark.sql import functions as F

from tideline.operators.latest import latest_per_key
from tideline.operators.setops import union_tagged
from tideline.operators.upsert import merge_rows
from tideline.session import unique_name, workdir
from tideline.sinks import catalog as cat
from tideline.sinks.keyed import KeyedTable, upsert_sink

KV = "k INT, v STRING"


def test_merge_null_keys_never_match(spark):
    base = spark.createDataFrame([(1, "a"), (None, "b")], KV)
    upd = spark.createDataFrame([(1, "A"), (None, "B"), (2, "C")], KV)
    assert rows(merge_rows(base, upd, ["k"])) == [(None, "B"), (None, "b"), (1, "A"), (2, "C")]


def test_merge_only_newer(spark):
    s = "k INT, ts INT, v STRING"
    base = spark.createDataFrame([(1, 10, "new"), (2, 1, "old")], s)
    upd = spark.createDataFrame([(1, 5, "late"), (2, 3, "fresh"), (3, 1, "ins")], s)
    assert rows(merge_rows(base, upd, ["k"])) == [(1, 5, "late"), (2, 3, "fresh"), (3, 1, "ins")]
    assert rows(merge_rows(base, upd, ["k"], only_newer="ts")) == \
        [(1, 10, "new"), (2, 3, "fresh"), (3, 1, "ins")]


def test_merge_only_newer_honours_the_tie_break(spark):
    s = "k INT, ts INT, id INT"
    base, upd = spark.createDataFrame([(1, 5, 9), (2, 5, 1)], s), spark.createDataFrame([(1, 5, 3), (2, 5, 2)], s)
    assert rows(merge_rows(base, upd, ["k"], only_newer=["ts", "id"])) == [(1, 5, 9), (2, 5, 2)]


def test_keyed_table_upsert_and_rerun_is_idempotent(spark):
    t = KeyedTable(spark, workdir(spark, "kt"), ["k"])
    t.upsert(spark.createDataFrame([(i, f"v{i}") for i in range(20)], KV))
    upd = spark.createDataFrame([(3, "x"), (25, "y")], KV)
    t.upsert(upd)
    once = rows(t.read())
    t.upsert(upd)  # same batch again (a retried batch id)
    assert rows(t.read()) == once
    assert len(once) == 21 and (3, "x") in once and (25, "y") in once and (4, "v4") in once


def test_upsert_fold_equals_global_latest(spark):
    rnd = random.Random(7)
    data = [(rnd.randrange(30), ts, f"r{ts}") for ts in range(300)]
    s = "k INT, ts INT, v STRING"
    t = KeyedTable(spark, workdir(spark, "fold"), ["k"])
    sink = upsert_sink(t, "ts", writer="job")
    for b in range(5):  # in-order batches
        sink(spark.createDataFrame(data[b * 60:(b + 1) * 60], s), b)
    expect = rows(latest_per_key(spark.createDataFrame(data, s), ["k"], "ts"))
    assert rows(t.read().select("k", "ts", "v")) == expect


def test_upsert_sink_skips_empty_batch(spark):
    t = KeyedTable(spark, workdir(spark, "empty"), ["k"])
    upsert_sink(t, "k", writer="job")(spark.createDataFrame([], KV), 0)
    assert not t.exists() or t.read().count() == 0


def test_union_distinct_collapses_only_within_branch(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], KV)
    b = spark.createDataFrame([(1, "x")], KV)
    got = rows(union_tagged({"yellow": a, "green": b}, "t"))
    assert got == [("green", 1, "x"), ("yellow", 1, "x")]
    assert len(rows(union_tagged({"yellow": a, "green": b}, "t", distinct=False))) == 3


def _table(spark):
    db = cat.create_database(spark, unique_name("t"), workdir(spark, "db"))
    t = f"{db}.p"
    df = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021), (3, "c", 2021)], "id INT, v STRING, y INT")
    cat.ctas(spark, t, df, ["y"])
    return t


def test_replace_partition_twice_is_once(spark):
    t = _table(spark)
    new = spark.createDataFrame([(9, "z", 2021)], "id INT, v STRING, y INT")
    cat.replace_partitions(new, t)
    once = rows(spark.table(t))
    cat.replace_partitions(new, t)
    assert rows(spark.table(t)) == once == [(1, "a", 2020), (9, "z", 2021)]


def test_replace_partition_keeps_others_in_a_static_mode_session(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")  # how a bare session starts
    try:
        t = _table(spark)
        cat.replace_partitions(spark.createDataFrame([(9, "z", 2021)], "id INT, v STRING, y INT"), t)
        assert rows(spark.table(t)) == [(1, "a", 2020), (9, "z", 2021)]
        assert spark.conf.get(key) == "static"  # the caller's setting is restored
    finally:
        spark.conf.set(key, before)


def test_rebuild_drops_partitions_the_new_rows_lack(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")  # a session that defaults to partition replacement
    try:
        db = cat.create_database(spark, unique_name("t"), workdir(spark, "db"))
        t, loc = f"{db}.rebuilt", workdir(spark, "rebuilt")
        s = "id INT, day STRING"
        cat.rebuild_table(spark.createDataFrame([(1, "d1"), (2, "d2")], s), t, loc, ["day"])
        cat.rebuild_table(spark.createDataFrame([(3, "d2")], s), t, loc, ["day"])
        cat.repair(spark, t)
        assert rows(spark.table(t)) == [(3, "d2")]
        assert rows(spark.read.parquet(loc)) == [(3, "d2")]  # d1 is gone from storage too
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.set(key, before)


def test_partition_exists_and_drop(spark):
    t = _table(spark)
    assert cat.partition_exists(spark, t, {"y": 2021})
    assert not cat.partition_exists(spark, t, {"y": 1999})
    cat.drop_partition(spark, t, {"y": 2021})
    assert not cat.partition_exists(spark, t, {"y": 2021})
    assert rows(spark.table(t)) == [(1, "a", 2020)]


def test_insert_appends(spark):
    t = _table(spark)
    cat.insert_into(spark.table(t), t)
    assert len(rows(spark.table(t))) == 6


def test_external_table_sees_partitions_after_repair(spark):
    loc = workdir(spark, "ext")
    spark.createDataFrame([(1, "2024"), (2, "2025")], "id INT, year STRING") \
        .write.partitionBy("year").parquet(loc)
    db = cat.create_database(spark, unique_name("t"), workdir(spark, "db"))
    t = f"{db}.ext"
    cat.create_external(spark, t, "id INT, year STRING", ["year"], loc)
    assert spark.table(t).isEmpty()
    cat.repair(spark, t)
    assert rows(spark.table(t)) == [(1, "2024"), (2, "2025")]


def test_manifest_lists_each_file_once(spark):
    loc = workdir(spark, "man")
    df = spark.range(100).withColumn("p", F.col("id") % 2)
    df.repartition(3).write.partitionBy("p").parquet(loc)
    snap = spark.read.parquet(loc)
    m = cat.manifest(snap, "p")
    assert m.select("path").distinct().count() == m.count() == len(snap.inputFiles())
    assert m.where("length <= 0").count() == 0
    cat.write_manifest(snap, loc + "_manifest", "p")
    names = spark.read.text(loc + "_manifest")
    assert {(r.value.split("/p=")[1][0], r.p) for r in names.collect()} == {("0", 0), ("1", 1)}
    assert names.count() == m.count()


def test_retail_rebuild_overwrites_and_is_repeatable(spark):
    from conftest import SF_SMALL
    from tideline.plans import retail as R
    from tideline.sources.tables import load
    t = {n: load(spark, SF_SMALL, n) for n in ("events", "customer", "nation", "orders", "lineitem", "part")}
    db = cat.create_database(spark, unique_name("r"), workdir(spark, "db"))
    loc = workdir(spark, "retail")
    args = (spark, t["events"], t["customer"], t["nation"], t["orders"], t["lineitem"], t["part"], db, loc)
    names = R.retail_rebuild(*args, country="NATION_7")
    first = {k: spark.table(v).count() for k, v in names.items()}
    names = R.retail_rebuild(*args, country="NATION_7")  # full rebuild again: same sizes
    assert {k: spark.table(v).count() for k, v in names.items()} == first
    assert first["top"] == 10 and first["summary"] == t["orders"].select("o_custkey").distinct().count()
    assert first["cleaned"] == R.clean_invoices(t["events"], t["customer"], t["nation"]).count()


def _parquet_files(path):
    import os
    return sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))


def test_partitioned_write_regroups_rows_by_partition(spark):
    from tideline.sinks.files import append_partitioned
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "CAST(id % 4 AS INT) AS p")  # 8 tasks
    plain, grouped = workdir(spark, "plain"), workdir(spark, "grouped")
    append_partitioned(df, plain, ["p"], rebalance=False)
    append_partitioned(df, grouped, ["p"])
    assert _parquet_files(plain) == 32  # every task wrote every partition
    assert _parquet_files(grouped) <= 8 and _parquet_files(grouped) < _parquet_files(plain)
    assert rows(spark.read.parquet(grouped)) == rows(spark.read.parquet(plain))


S3 = "k INT, ts INT, v STRING"


def test_second_writer_and_reset_checkpoint_lose_nothing(spark):
    t = KeyedTable(spark, workdir(spark, "writers"), ["k"])
    t.upsert(spark.createDataFrame([(1, 0, "base"), (2, 0, "base")], S3), writer="a", batch=0)
    t.upsert(spark.createDataFrame([(2, 1, "b"), (3, 1, "b")], S3), writer="b", batch=0)  # its own batch 0
    t.upsert(spark.createDataFrame([(3, 2, "c")], S3), writer="b2", batch=0)  # as after a checkpoint reset
    assert rows(t.read()) == [(1, 0, "base"), (2, 1, "b"), (3, 2, "c")]


def test_replay_keeps_its_place_and_null_keys_are_left_out(spark):
    t = KeyedTable(spark, workdir(spark, "replay"), ["k"])
    first = spark.createDataFrame([(1, 0, "a"), (None, 0, "n")], S3)
    t.upsert(first, writer="a", batch=0)
    t.upsert(spark.createDataFrame([(1, 1, "later")], S3), writer="b", batch=0)
    t.upsert(first, writer="a", batch=0)  # replayed after the other writer's batch
    assert rows(t.read()) == [(1, 1, "later")]


def test_newest_wins_with_tie_break_whatever_the_batch_order(spark):
    t = KeyedTable(spark, workdir(spark, "newest"), ["k"], ["ts", "v"])
    for v in [(1, 10, "m"), (1, 5, "z"), (1, 10, "l"), (2, None, "x")]:
        t.upsert(spark.createDataFrame([v], S3))
    assert rows(t.read()) == [(1, 10, "m"), (2, None, "x")]


def test_a_batch_that_dies_while_writing_changes_nothing(spark):
    import pytest
    t = KeyedTable(spark, workdir(spark, "dies"), ["k"])
    t.upsert(spark.createDataFrame([(1, 0, "a")], S3), writer="a", batch=0)
    bad = spark.createDataFrame([(1, 1, "b"), (2, 1, "x")], S3).withColumn(
        "v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("string"))
    with pytest.raises(Exception):
        t.upsert(bad, writer="a", batch=1)
    assert rows(t.read()) == [(1, 0, "a")]
    t.upsert(spark.createDataFrame([(1, 1, "b"), (2, 1, "x")], S3), writer="a", batch=1)  # the replay
    assert rows(t.read()) == [(1, 1, "b"), (2, 1, "x")]


def test_no_success_markers_are_needed(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        t = KeyedTable(spark, workdir(spark, "nomark"), ["k"])
        for b in range(3):
            t.upsert(spark.createDataFrame([(1, b, f"r{b}"), (10 + b, b, "n")], S3), writer="a", batch=b)
        assert t.read().count() == 4 and (1, 2, "r2") in rows(t.read())
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_compaction_keeps_the_rows_and_later_batches_go_on(spark):
    name = unique_name("kt")
    t = KeyedTable(spark, workdir(spark, "compact"), ["k"], ["ts"], name=name)
    for b in range(4):
        t.upsert(spark.createDataFrame([(i, b * 10 + i, f"r{b}") for i in range(b, 6)], S3), writer="a", batch=b)
    before, old = rows(t.read()), t.path
    t.compact()
    assert t.path != old and rows(t.read()) == before and spark.read.parquet(t.path).count() == len(before)
    t.upsert(spark.createDataFrame([(0, 99, "new"), (5, 1, "late")], S3), writer="a", batch=4)
    t.compact()
    assert dict((r[0], r[2]) for r in rows(t.read())) == {**{r[0]: r[2] for r in before}, 0: "new"}
    spark.sql(f"DROP TABLE {name}")


def test_inserts_write_few_files_per_partition(spark):
    db = unique_name("files")
    cat.create_database(spark, db, workdir(spark, db))
    df = spark.range(0, 4000, 1, 20).selectExpr("id", "CAST(id % 4 AS INT) AS p")
    cat.ctas(spark, f"{db}.t", df.limit(0), ["p"], location=f"{workdir(spark, 'files')}")
    cat.insert_into(df, f"{db}.t")
    loc = spark.sql(f"DESCRIBE EXTENDED {db}.t").where("col_name = 'Location'").first()["data_type"].replace("file:", "")
    assert _parquet_files(loc) <= 8
    cat.replace_partitions(df, f"{db}.t")
    assert _parquet_files(loc) <= 8 and spark.table(f"{db}.t").count() == 4000
