import datetime as dt
import os
import shutil
import time

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tideline.functions.decode import event_time
from tideline.operators.windows import windowed_sum
from tideline.plans import retail as R
from tideline.operators.latest import latest_per_key
from tideline.session import workdir
from tideline.sinks.keyed import KeyedTable, upsert_sink
from tideline.functions.timeparts import with_time_parts
from tideline.sinks.files import append_partitioned, batch_writer, guarded, stream_append
from tideline.plans.feeds import Feed
from tideline.sources.streams import stream_source
from tideline.sources.tables import load
from tideline.streaming.runner import StreamSpec, finish, run_all, start

T0 = dt.datetime(2024, 1, 1)


def test_guard_skips_empty_batch(spark):
    calls = []
    guarded(lambda df, b: calls.append(b))(spark.createDataFrame([], "a INT"), 0)
    guarded(lambda df, b: calls.append(b))(spark.createDataFrame([(1,)], "a INT"), 1)
    assert calls == [1]


def _small_events(spark):
    return load(spark, SF_SMALL, "events")


def test_append_windows_match_batch_with_emission_rule(spark):
    ev = _small_events(spark)
    feed = Feed(spark, ev.select("user_id", "value", "ts"), "ts", 10)
    out, ck = workdir(spark, "w"), workdir(spark, "w-ck")
    for i in feed.slices:
        feed.deliver(i)
        src = spark.readStream.schema("user_id BIGINT, value DOUBLE, ts TIMESTAMP_NTZ").parquet(feed.landing)
        agg = windowed_sum(src.withColumn("ts", event_time("ts")), ["user_id"], "ts", "1 day",
                           "value", delay="10 hours")
        finish(start(agg, ck, fn=lambda df, _: append_partitioned(df, out)))
    got = rows(spark.read.parquet(out))
    mx = ev.agg(F.max("ts")).first()[0]
    batch = windowed_sum(ev, ["user_id"], "ts", "1 day", "value")
    expect = rows(batch.filter(F.col("end") <= F.lit(mx - dt.timedelta(hours=10))))
    assert got == expect and len(got) > 0


def test_late_rows_are_dropped_and_counted(spark):
    ev, cu, na = (load(spark, SF_SMALL, n) for n in ("events", "customer", "nation"))
    report = {}
    late = R.stream_sales(spark, ev, cu, na, newest_first=True, report=report)
    ordered = R.stream_sales(spark, ev, cu, na)
    # brute force: rows of older slices whose hour ends at or before the newest time less the delay
    inv = R.invoice_rows(ev, cu, na)
    typed = inv.withColumn("_day", F.floor(F.datediff(F.to_date("ts"), F.lit(ev.agg(F.min("ts")).first()[0]).cast("date")) / 6))
    newest = typed.agg(F.max("_day")).first()[0]
    good = lambda df: R.retail_clean(df).where("InvoiceDate is not null").select("InvoiceDate")
    limit = good(typed.where(F.col("_day") == newest)).agg(F.max("InvoiceDate")).first()[0] - dt.timedelta(hours=10)
    older = good(typed.where(F.col("_day") < newest)).where(F.date_trunc("hour", "InvoiceDate") + F.expr("INTERVAL 1 HOUR") <= F.lit(limit))
    assert report["dropped"] == older.count() > 50
    assert late.count() < ordered.count()


def test_rate_limit_splits_batches(spark):
    land = workdir(spark, "rl")
    for i in range(3):
        spark.createDataFrame([(i,)], "a INT").coalesce(1).write.mode("append").parquet(land)
    src = stream_source(spark, "parquet", land, schema="a INT", maxFilesPerTrigger=1)
    seen = []
    q = start(src, workdir(spark, "rl-ck"), fn=lambda df, b: seen.append(df.count()))
    finish(q)
    assert seen == [1, 1, 1]


def test_restart_from_checkpoint_is_exactly_once(spark):
    land, out, ck = workdir(spark, "eo"), workdir(spark, "eo-out"), workdir(spark, "eo-ck")
    spark.createDataFrame([(1,), (2,)], "a INT").write.parquet(land)
    src = lambda: stream_source(spark, "parquet", land, schema="a INT")
    finish(start(src(), ck, fmt="parquet", path=out))
    finish(start(src(), ck, fmt="parquet", path=out))  # nothing new: no duplicates
    spark.createDataFrame([(3,)], "a INT").write.mode("append").parquet(land)
    finish(start(src(), ck, fmt="parquet", path=out))
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (3,)]


def test_two_queries_run_together(spark):
    a, b = workdir(spark, "ta"), workdir(spark, "tb")
    spark.createDataFrame([("x",)], "value STRING").write.text(a)
    spark.createDataFrame([("y",), ("z",)], "value STRING").write.text(b)
    got = {}
    qs = run_all([StreamSpec(stream_source(spark, "text", a), lambda df, _: got.update(a=df.count()),
                             workdir(spark, "ta-ck")),
                  StreamSpec(stream_source(spark, "text", b), lambda df, _: got.update(b=df.count()),
                             workdir(spark, "tb-ck"))])
    assert got == {"a": 1, "b": 2} and all(sum(p["numInputRows"] for p in q.recentProgress) > 0 for q in qs)


def _lose_last_commit(spark, ckpt):
    """A copy of ``ckpt`` whose last batch never committed: what a restart
    sees when the driver died after the sink wrote and before the commit."""
    copy = workdir(spark, "replay-ck")
    last = max(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())
    skip = {str(last), f".{last}.crc"}
    shutil.copytree(ckpt, copy, ignore=lambda d, names: [n for n in names
                                                         if d.endswith("commits") and n in skip])
    return copy, last


def _stamped_source(spark, land):
    src = stream_source(spark, "parquet", land, schema="a INT")
    return with_time_parts(src, None, ("year", "month", "day", "hour")).withColumn(
        "stamp", F.current_timestamp().cast("string"))


def test_file_sink_replay_adds_nothing(spark):
    land, out, ck = workdir(spark, "fr"), workdir(spark, "fr-out"), workdir(spark, "fr-ck")
    spark.createDataFrame([(1,), (2,), (3,)], "a INT").write.parquet(land)
    finish(stream_append(_stamped_source(spark, land), out, ck, ["year", "month", "day", "hour"]))
    before = rows(spark.read.parquet(out))
    replay, last = _lose_last_commit(spark, ck)
    q = stream_append(_stamped_source(spark, land), out, replay, ["year", "month", "day", "hour"])
    finish(q)
    assert last == 0 and q.lastProgress["batchId"] == 0  # the batch really ran again
    assert rows(spark.read.parquet(out)) == before and len(before) == 3


def test_batch_writer_replay_replaces_its_own_files(spark):
    land, out, ck = workdir(spark, "br"), workdir(spark, "br-out"), workdir(spark, "br-ck")
    spark.createDataFrame([(1,), (2,)], "a INT").write.parquet(land)
    write = batch_writer("parquet", path=out, partition_by=["year", "month", "day", "hour"])
    calls = []

    def sink(df, batch_id):
        calls.append(batch_id)
        write(df, batch_id)
    finish(start(_stamped_source(spark, land), ck, fn=sink))
    before = rows(spark.read.parquet(out))
    time.sleep(1.1)  # a wall clock read at replay time would differ
    replay, _ = _lose_last_commit(spark, ck)
    finish(start(_stamped_source(spark, land), replay, fn=sink))
    after = rows(spark.read.parquet(out))
    assert calls == [0, 0]  # the sink really wrote batch 0 twice
    # same rows, same ingest partition and stamp: the batch timestamp comes from the offset log
    assert after == before and len(after) == 2
    assert len({r["stamp"] for r in spark.read.parquet(out).collect()}) == 1


def test_upsert_stream_replay_keeps_the_table(spark):
    s = "k INT, ts INT, v STRING"
    land, ck = workdir(spark, "ur"), workdir(spark, "ur-ck")
    data = [(i % 7, i, f"r{i}") for i in range(40)]
    for lo in (0, 20):  # two files -> two batches
        spark.createDataFrame(data[lo:lo + 20], s).coalesce(1).write.mode("append").parquet(land)
    t = KeyedTable(spark, workdir(spark, "ur-table"), ["k"], ["ts"])
    src = lambda: stream_source(spark, "parquet", land, schema=s, maxFilesPerTrigger=1)
    finish(start(src(), ck, fn=upsert_sink(t, "ts")))
    before = rows(t.read().select("k", "ts", "v"))
    replay, last = _lose_last_commit(spark, ck)
    finish(start(src(), replay, fn=upsert_sink(t, "ts")))
    assert last == 1
    assert rows(t.read().select("k", "ts", "v")) == before == \
        rows(latest_per_key(spark.createDataFrame(data, s), ["k"], "ts"))


def test_stream_interval_join_equals_batch_on_a_dense_range(spark):
    """Across micro-batches (one per slice) the watermarked join state keeps
    every partner the time range allows: the stream gives the batch result."""
    from tideline.plans import orders as O
    ev = _small_events(spark)
    got = rows(O.stream_interval_join(spark, ev, within="1 day"))
    expect = rows(O.orders_with_members(ev, within="1 day"))
    assert got == expect and len(got) > 20


def test_rows_without_a_time_are_delivered(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 9))],
                               "a INT, ts TIMESTAMP_NTZ")
    for rows_in in (df, df.where("ts is null")):
        feed = Feed(spark, rows_in, "ts", 3)
        for i in feed.slices:
            feed.deliver(i)
        assert rows(spark.read.parquet(feed.landing)) == rows(rows_in)


def test_queries_started_together_keep_their_own_state_partitions(spark):
    land = workdir(spark, "sp")
    spark.createDataFrame([(i,) for i in range(10)], "a INT").write.parquet(land)
    cks, qs = [], []
    for n in (3, 5):
        own = spark.newSession()
        own.conf.set("spark.sql.shuffle.partitions", str(n))
        cks.append((workdir(spark, "sp-ck"), n))
        agg = own.readStream.schema("a INT").parquet(land).groupBy("a").count()
        qs.append(start(agg, cks[-1][0], fn=lambda df, _: df.collect(), mode="complete"))
    finish(*qs)
    for ck, n in cks:
        assert len([d for d in os.listdir(f"{ck}/state/0") if d.isdigit()]) == n


def test_first_failure_stops_the_other_queries(spark):
    import pytest
    land = workdir(spark, "ff")
    spark.createDataFrame([(1,)], "a INT").write.parquet(land)

    def fail(df, _):
        raise ValueError("no")
    src = lambda: stream_source(spark, "parquet", land, schema="a INT")
    other = start(src(), workdir(spark, "ff-a"), fn=lambda df, _: None, trigger={"processingTime": "1 second"})
    bad = start(src(), workdir(spark, "ff-b"), fn=fail)
    with pytest.raises(RuntimeError):
        finish(other, bad)
    assert not other.isActive


def test_fixed_interval_trigger_picks_up_new_files(spark):
    land, out = workdir(spark, "pt"), workdir(spark, "pt-out")
    spark.createDataFrame([(1,)], "a INT").write.parquet(land)
    q = start(stream_source(spark, "parquet", land, schema="a INT"), workdir(spark, "pt-ck"), fmt="parquet", path=out,
              trigger={"processingTime": "500 milliseconds"})
    q.processAllAvailable()
    spark.createDataFrame([(2,)], "a INT").write.mode("append").parquet(land)
    q.processAllAvailable()
    q.stop()
    assert rows(spark.read.parquet(out)) == [(1,), (2,)]
