"""Staged appends, sorted messages, figures of runs, grouped writes, salted joins, latest as state."""

import datetime as dt
import os
from collections import Counter

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tideline.functions.decode import json_sorted
from tideline.operators.joins import interval_join
from tideline.operators.latest import latest_per_key, latest_state
from tideline.plans import orders as O
from tideline.plans import retail as R
from tideline.session import unique_name, workdir
from tideline.sinks import catalog as cat
from tideline.sinks.files import append_partitioned, guarded, stream_append
from tideline.sinks.keyed import KeyedTable
from tideline.sinks.staged import AuditFailed, StagedAppend
from tideline.sources.streams import json_stream, stream_source
from tideline.sources.tables import load
from tideline.streaming.metrics import BatchMetrics, state_rows
from tideline.streaming.runner import finish, start

AV = "a INT, v STRING"


def staged(spark, **kw):
    sink = StagedAppend(unique_name("staged"), workdir(spark, "staged"), {"no_v": F.col("v").isNull(), "negative": F.col("a") < 0}, **kw)
    sink.create(spark, AV)
    return sink


def test_only_batches_that_pass_their_checks_are_seen(spark):
    sink = staged(spark)
    sink(spark.createDataFrame([(1, "x"), (2, "y")], AV), 0)
    sink(spark.createDataFrame([(3, "x"), (-4, "y"), (5, None)], AV), 1)
    sink(spark.createDataFrame([(6, "z")], AV), 2)
    sink(spark.createDataFrame([], AV), 3)
    assert rows(spark.table(sink.table)) == [(1, "x", 0), (2, "y", 0), (6, "z", 2)]
    got = {r.batch_id: (r.n_rows, r.n_bad, r.published) for r in sink.audit(spark).collect()}
    assert got == {0: (2, {"no_v": 0, "negative": 0}, True), 1: (3, {"no_v": 1, "negative": 1}, False),
                   2: (1, {"no_v": 0, "negative": 0}, True), 3: (0, {"no_v": 0, "negative": 0}, False)}


def test_a_batch_is_published_once_and_a_failed_one_can_come_again(spark):
    sink = staged(spark)
    for _ in range(2):
        sink(spark.createDataFrame([(1, "x")], AV), 0)
    sink(spark.createDataFrame([(2, None)], AV), 1)
    sink(spark.createDataFrame([(2, "y")], AV), 1)  # mended upstream
    assert rows(spark.table(sink.table)) == [(1, "x", 0), (2, "y", 1)]


def test_a_batch_that_dies_before_publishing_is_not_seen(spark, monkeypatch):
    sink = staged(spark)
    bad = spark.createDataFrame([(1, "x")], AV).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        sink(bad, 0)
    assert spark.table(sink.table).isEmpty()
    sink(spark.createDataFrame([(1, "x")], AV), 0)
    assert rows(spark.table(sink.table)) == [(1, "x", 0)]


def test_strict_ends_the_stream(spark):
    sink = staged(spark, strict=True)
    with pytest.raises(AuditFailed):
        sink(spark.createDataFrame([(1, None)], AV), 0)
    assert spark.table(sink.table).isEmpty()


def test_messages_are_sorted_with_a_reason(spark):
    texts = ['{"a": 1, "v": "x"}', "junk", "", None, '{"a": "one", "v": "x"}', '{"v": "x"}', '{"a": 2, "more": 3}', '{"a": 3', " {} "]
    got = json_sorted(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value STRING, n INT"), AV, ["a"], keep=["n"])
    assert got.columns == ["n", "a", "v", "message", "reason"]
    found = {r.n: (r.a, r.v, r.message, r.reason) for r in got.collect()}
    assert found == {0: (1, "x", None, None), 1: (None, None, "junk", "not_json"), 2: (None, None, "", "not_json"),
                     3: (None, None, None, "not_json"), 4: (None, None, texts[4], "bad_field"), 5: (None, None, texts[5], "missing:a"),
                     6: (2, None, None, None), 7: (None, None, texts[7], "not_json"), 8: (None, None, " {} ", "missing:a")}


def test_late_rows_over_many_batches_and_metrics_table(spark):
    """A run of several micro-batches: what the listener saw, less what was written and what is left in state."""
    t0, land, out, ck = dt.datetime(2024, 1, 1), workdir(spark, "lr"), workdir(spark, "lr-out"), workdir(spark, "lr-ck")
    hours = [[100, 101], [50, 99, 103], [10, 95, 104], [60, 61, 200]]
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)
    for part in hours:  # each file a batch; every batch in one run
        spark.createDataFrame([(t0 + dt.timedelta(hours=h),) for h in part] + [(None,)], "ts TIMESTAMP").coalesce(1).write.mode("append").parquet(land)
    src = spark.readStream.schema("ts TIMESTAMP").option("maxFilesPerTrigger", 1).parquet(land).observe("seen", F.count("ts").alias("dated"))
    agg = src.withWatermark("ts", "5 hours").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    q = start(agg, ck, fn=guarded(lambda df, b: df.write.mode("append").parquet(out)))
    finish(q)
    metrics.wait(q)
    spark.streams.removeListener(metrics)
    written = spark.read.parquet(out).agg(F.sum("n")).first()[0]
    left = state_rows(spark, ck).agg(F.sum("state.count")).first()[0]
    assert metrics.observed("dated") == 11 and written + left < 11
    kept = {(r.w.start - t0).total_seconds() / 3600: r.n for r in spark.read.parquet(out).collect()}
    assert 10 not in kept and 100 in kept and left == 1  # hour 200 is still open
    path = workdir(spark, "metrics")
    metrics.write(spark, path)
    metrics.write(spark, path)
    table = spark.read.parquet(path)
    assert table.count() == len(metrics.rows) == table.select("batch_id").distinct().count() >= 4
    assert table.agg(F.sum("input_rows")).first()[0] == 15 and table.where("late_groups > 0").count() > 0


def test_sales_state_holds_the_open_windows(spark):
    ev, cu, na = (load(spark, SF_SMALL, n) for n in ("events", "customer", "nation"))
    written = R.stream_sales(spark, ev, cu, na)
    left = R.stream_state_left(spark, ev, cu, na)
    dated = R.clean_invoices(ev, cu, na).where("InvoiceDate is not null")
    every = {(r.Country, r.start) for r in R.sales_from_clean(dated).collect()}
    a, b = ({(r.Country, r.start) for r in x.collect()} for x in (written, left))
    assert a | b == every and not a & b and b


def test_grouped_stream_writes_few_files(spark):
    land, n = workdir(spark, "gw"), 4
    spark.range(0, 4000, 1, 20).selectExpr("id", f"CAST(id % {n} AS INT) AS p").write.parquet(land)
    files = {}
    for spread in (None, 1, 3):
        out = workdir(spark, "gw-out")
        src = spark.readStream.schema("id BIGINT, p INT").parquet(land)
        finish(stream_append(src, out, workdir(spark, "gw-ck"), ["p"], spread=spread))
        assert rows(spark.read.parquet(out).groupBy("p").count()) == [(p, 1000) for p in range(n)]
        files[spread] = sum(f.endswith(".parquet") for _, _, fs in os.walk(out) for f in fs)
    assert files[1] == n <= files[3] <= 3 * n < files[None]


def test_salted_join_gives_the_same_rows(spark):
    ev = O.hot_events(load(spark, SF_SMALL, "events"))
    join = lambda **kw: interval_join(O.order_events(ev), O.member_events(ev), on=[("order_owner", "member_owner")],
                                      left_ts="order_ts", right_ts="member_ts", within="2 hours", **kw)
    want = rows(join())
    assert len(want) > 20 and rows(join(salts=5)) == want == rows(join(salts=3, spread="right"))


def test_no_state_store_holds_a_hot_owner(spark):
    """Four thousand orders of one owner within an hour, some of others."""
    orders, members = workdir(spark, "hot-o"), workdir(spark, "hot-m")
    at = "TIMESTAMP_NTZ '2024-01-20 10:00:00' + make_dt_interval(0, 0, 0, id % 3600)"
    spark.range(6000).selectExpr("id AS order_id", "IF(id % 3 = 0, id, 1) AS order_owner", "1D AS order_value",
                                 f"{at} AS order_ts").write.parquet(orders)
    spark.range(5).selectExpr("id AS member_id", "1L AS member_owner", "'gold' AS membership", f"{at} AS member_ts").write.parquet(members)
    share, found = {}, {}
    for salts in (1, 8):
        ck, out = workdir(spark, "hot-ck"), workdir(spark, "hot-out")
        j = O._joined_stream(O._order_stream(spark, orders), O._member_stream(spark, members), "15 minutes", salts)
        finish(stream_append(j, out, ck))
        found[salts] = spark.read.parquet(out).count()
        parts = Counter({r.partition_id: r["count"] for r in
                         state_rows(spark, ck, joinSide="left").groupBy("partition_id").count().collect()})
        share[salts] = max(parts.values()) / sum(parts.values())
    assert found[1] == found[8] > 1000 and share[8] < 0.3 < share[1]


def test_latest_state_emits_changed_keys_only(spark):
    land, ck, seen = workdir(spark, "ls"), workdir(spark, "ls-ck"), []
    s = "k INT, ts INT, v STRING"
    data = [[(1, 5, "a"), (2, 1, "b"), (None, 9, "n")], [(1, 4, "late"), (3, None, "c")], [(2, 1, "z"), (3, 0, "d")]]
    t = KeyedTable(spark, workdir(spark, "ls-table"), ["k"])

    def sink(df, b):
        seen.append(rows(df))
        t.upsert(df, writer="w", batch=b)

    for part in data:
        spark.createDataFrame(part, s).coalesce(1).write.mode("append").parquet(land)
        src = stream_source(spark, "parquet", land, schema=s)
        finish(start(latest_state(src, ["k"], ["ts", "v"]), ck, fn=sink, mode="update"))
    assert seen == [[(1, 5, "a"), (2, 1, "b")], [(1, 5, "a"), (3, None, "c")], [(2, 1, "z"), (3, 0, "d")]]
    every = spark.createDataFrame([r for p in data for r in p if r[0]], s)
    assert rows(t.read()) == rows(latest_per_key(every, ["k"], "ts", ["v"]))


def test_payload_column_and_start_instant(spark):
    land = workdir(spark, "ps")
    old, new = ('{"a": 1, "v": "old"}',), ('{"a": 2, "v": "new"}',)
    write = lambda r: spark.createDataFrame([r], "data STRING").selectExpr("CAST(data AS BINARY) AS data").write.mode("append").parquet(land)
    write(old)
    for path in [os.path.join(land, f) for f in os.listdir(land)]:
        os.utime(path, (1_000_000_000, 1_000_000_000))
    write(new)
    got = {}
    for name, begin in (("all", None), ("new", dt.datetime(2010, 1, 1, tzinfo=dt.timezone.utc))):
        src = json_stream(spark, "parquet", AV, land, source_schema="data BINARY", payload="data", start=begin)
        out = workdir(spark, "ps-out")
        finish(stream_append(src, out, workdir(spark, "ps-ck")))
        got[name] = rows(spark.read.parquet(out))
    assert got == {"all": [(1, "old"), (2, "new")], "new": [(2, "new")]}


def test_manifest_names_odd_partitions_and_hides_other_files(spark):
    path = workdir(spark, "mf")
    names = ["a:b", "c%d", "e f", "g+h", "i=j", "k/l", None, "é"]
    s = "id INT, p STRING"
    append_partitioned(spark.createDataFrame(list(enumerate(names)), s), path, ["p"])
    table = lambda: spark.read.schema(s).parquet(path)
    cat.write_manifest(table(), f"{path}_m", "p")
    assert {r.p for r in spark.read.text(f"{path}_m").select("p").distinct().collect()} == set(names)
    for r in cat.manifest(table(), "p").collect():
        assert os.path.exists(r.path.replace("file:", "", 1).replace("//", "/"))
    append_partitioned(spark.createDataFrame([(50, "a:b"), (51, "c%d")], s), path, ["p"])
    assert {r.id for r in cat.read_manifested(table(), f"{path}_m").collect()} == set(range(len(names)))
    cat.write_manifest(table(), f"{path}_m", "p", changed=F.col("p") == "c%d")
    assert {r.id for r in cat.read_manifested(table(), f"{path}_m").collect()} == {*range(len(names)), 51}


def test_sync_forgets_partitions_whose_files_are_gone(spark):
    loc, db = workdir(spark, "sy"), unique_name("sy")
    cat.create_database(spark, db, workdir(spark, db))
    spark.createDataFrame([(1, "x"), (2, "y")], AV).write.partitionBy("v").parquet(loc)
    cat.create_external(spark, f"{db}.t", AV, ["v"], loc)
    cat.sync(spark, f"{db}.t")
    assert cat.partition_exists(spark, f"{db}.t", {"v": "x"})
    assert cat.delete_prefix(spark, f"{loc}/v=x") and not cat.delete_prefix(spark, f"{loc}/v=x")
    cat.repair(spark, f"{db}.t")
    assert cat.partition_exists(spark, f"{db}.t", {"v": "x"})  # a plain repair only adds
    cat.sync(spark, f"{db}.t")
    assert not cat.partition_exists(spark, f"{db}.t", {"v": "x"}) and rows(spark.table(f"{db}.t")) == [(2, "y")]


def test_a_query_keeps_the_settings_it_started_with(spark):
    """Two inputs, one far behind: the watermark follows the slower one, or with ``max`` the faster."""
    t0, left = dt.datetime(2024, 1, 1), {}
    for policy in ("min", "max"):
        a, b, ck = workdir(spark, "wa"), workdir(spark, "wb"), workdir(spark, "w-ck")
        for path, hours in ((a, (1, 40)), (b, (1, 2))):
            spark.createDataFrame([(1, t0 + dt.timedelta(hours=h)) for h in hours], "k INT, ts TIMESTAMP").write.parquet(path)
        x, y = (spark.readStream.schema("k INT, ts TIMESTAMP").parquet(p).withWatermark("ts", "1 hour").alias(n)
                for p, n in ((a, "x"), (b, "y")))
        j = x.join(y, F.expr("x.k = y.k AND x.ts >= y.ts AND x.ts <= y.ts + INTERVAL 2 HOURS"))
        q = start(j.select("x.k"), ck, fn=lambda df, _: df.collect(),
                  conf={"spark.sql.streaming.multipleWatermarkPolicy": policy, "spark.sql.shuffle.partitions": "3"})
        finish(q)
        left[policy] = sum(state_rows(spark, ck, joinSide=s).count() for s in ("left", "right"))
        assert len([d for d in os.listdir(f"{ck}/state/0") if d.isdigit()]) == 3
    assert left["max"] < left["min"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_a_writer_without_a_path_of_its_own_appends(spark):
    from tideline.sinks.files import batch_writer
    path = workdir(spark, "pathless")
    write = batch_writer("parquet", options={"path": path}, partition_by=["v"])  # as a warehouse named by options
    for b in range(2):
        write(spark.createDataFrame([(b, "x")], AV), b)
    write(spark.createDataFrame([], AV), 2)
    assert rows(spark.read.parquet(path)) == [(0, "x"), (1, "x")]
