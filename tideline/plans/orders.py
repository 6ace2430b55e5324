"""Order lakehouse: topics -> raw tables -> interval join -> latest per key -> upsert.

Batch forms of each step, the streaming forms (replayed from the tables as
arriving files, drained with ``availableNow`` after each delivery), and the
three-stage medallion that chains them by table hand-off.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.decode import epoch_ms, event_time, json_decode, json_sorted, to_ntz
from tideline.functions.fixed import (
    MEMBER_WATERMARK, MEMBER_WITHIN, ORDER_WATERMARK, PRODUCT_DIM_COLUMNS, PRODUCT_DIM_ROWS,
)
from tideline.functions.timeparts import with_time_parts
from tideline.operators.joins import enrich, interval_join
from tideline.operators.latest import latest_per_key, latest_semi, latest_state
from tideline.operators.upsert import merge_rows
from tideline.plans.feeds import Feed
from tideline.plans.inputs import (
    EVENT_DDL, EVENT_SCHEMA, MEMBER_SCHEMA, ORDER_SCHEMA, K, event_message, event_messages, member_events,
    member_messages, odd_events, order_events, order_messages, with_k,
)
from tideline.session import unique_name, workdir
from tideline.sinks.files import batch_writer, guarded, stream_append
from tideline.sinks.keyed import KeyedTable, absent, upsert_sink
from tideline.sinks.staged import StagedAppend
from tideline.sources.streams import json_stream, stream_source
from tideline.sources.tables import inline_table
from tideline.streaming.runner import StreamSpec, finish, run_all, start

INGEST_PARTS = ["year", "month", "day", "hour"]

ORDER_ROW = "order_id BIGINT, order_owner BIGINT, order_value DOUBLE, order_ts TIMESTAMP_NTZ"
MEMBER_ROW = "member_id BIGINT, member_owner BIGINT, membership STRING, member_ts TIMESTAMP_NTZ"
JOINED_COLS = ["order_id", "order_owner", "order_value", "order_ts",
               "member_id", "member_owner", "membership", "member_ts"]


# ---- batch --------------------------------------------------------------

def orders_with_members(events: DataFrame, within: str = MEMBER_WITHIN) -> DataFrame:
    """Each click with every purchase of the same user at most ``within`` before it."""
    return interval_join(order_events(events), member_events(events),
                         on=[("order_owner", "member_owner")],
                         left_ts="order_ts", right_ts="member_ts", within=within)


def latest_event_per_user(events: DataFrame) -> DataFrame:
    return latest_per_key(events, ["user_id"], "ts", tie_break=["event_id"])


def latest_event_semi(events: DataFrame) -> DataFrame:
    return latest_semi(events, ["user_id"], "ts")


def product_dim(spark: SparkSession) -> DataFrame:
    return inline_table(spark, PRODUCT_DIM_ROWS, PRODUCT_DIM_COLUMNS,
                        "order_id INT, product_name STRING")


def product_orders(events: DataFrame) -> DataFrame:
    """Events as orders whose product code is the payload's ``k``."""
    return with_k(events).select("event_id", "user_id", "ts", F.col("k").alias("order_id"))


def enrich_products(spark: SparkSession, events: DataFrame, wide: bool = False) -> DataFrame:
    """Inner join with the 4-row inline product table (broadcast: its size is
    fixed by the literal). Narrow: ``order_id, product_name``; wide: every
    order column plus ``product_name``."""
    cols = None if wide else ["order_id", "product_name"]
    return enrich(product_orders(events), product_dim(spark), "order_id", cols=cols, small=True)


def decode_event_messages(events: DataFrame) -> DataFrame:
    """JSON messages (some of them junk) -> typed rows; junk gives all-NULL rows."""
    dec = json_decode(event_messages(events, junk_errors=True), EVENT_SCHEMA)
    return dec.withColumn("ts", epoch_ms("ts"))


UPSERT_KEYS = ["user_id", "k"]


def halves(events: DataFrame, split: str) -> tuple[DataFrame, DataFrame]:
    """The rows before ``split`` and the others; those without a time are among the others."""
    later = F.coalesce(F.col("ts") >= F.lit(split).cast("timestamp_ntz"), F.lit(True))
    return events.where(~later), events.where(later)


def upsert_latest(spark: SparkSession, events: DataFrame, split: str = "2024-01-15") -> DataFrame:
    """Keyed table built from the latest row per (user, k) before ``split``,
    then MERGEd with the latest of the other rows: keys only in the base
    are kept, keys in both are replaced, new keys are inserted."""
    first, second = (latest_per_key(half, UPSERT_KEYS, "ts", ["event_id"])
                     for half in halves(with_k(odd_events(events)), split))
    table = KeyedTable(spark, workdir(spark, "keyed-events"), UPSERT_KEYS)
    table.upsert(first)
    table.upsert(second)
    return table.read()


def upsert_two_writers(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Two writers, each with batches 0 and 1 and the second batch 1 sent twice,
    into one table that keeps the latest event per user; then compacted."""
    name = unique_name("tl_events")
    table = KeyedTable(spark, workdir(spark, "two-writers"), ["user_id"], ["ts", "event_id"], name=name)
    for kind, who in ((F.col("event_type") == "click", "clicks"), (F.col("event_type") != "click", "others")):
        for batch in (0, 1, 1):
            part = odd_events(events).where(kind & (F.pmod("event_id", F.lit(2)) == batch))
            table.upsert(latest_per_key(part, ["user_id"], "ts", ["event_id"]), writer=who, batch=batch)
    table.compact()
    current = table.read()
    spark.sql(f"DROP TABLE {name}")
    return current


def upsert_late_batch(spark: SparkSession, events: DataFrame, split: str = "2024-01-15") -> DataFrame:
    """The later half of the events first, the earlier half after it: a late
    batch adds keys but does not replace newer rows."""
    table = KeyedTable(spark, workdir(spark, "late-batch"), ["user_id"], ["ts", "event_id"])
    early, late = halves(odd_events(events), split)
    for half in (late, early):
        table.upsert(latest_per_key(half, ["user_id"], "ts", ["event_id"]))
    return table.read()


def merge_newer(events: DataFrame, split: str = "2024-01-15") -> DataFrame:
    """The later half's latest rows per user, MERGEd with the earlier half's where those are newer:
    matched keys keep the newer row, keys of the earlier half alone are inserted."""
    base, updates = (latest_per_key(half, ["user_id"], "ts", ["event_id"])
                     for half in reversed(halves(odd_events(events).where("user_id is not null"), split)))
    return merge_rows(base, updates, ["user_id"], only_newer=["ts", "event_id"])


def upsert_compacted(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Batches 0 to 3 (by event_id) from two writers into a table where the last
    batch wins. It is compacted after two of them, again while the last is
    being written, and the folded batches are sent a second time after each:
    the result is the fold of the four batches, in their order."""
    name = unique_name("tl_folded")
    table = KeyedTable(spark, workdir(spark, "folded"), ["user_id"], name=name)
    parts = [latest_per_key(odd_events(events).where(F.pmod("event_id", F.lit(4)) == b), ["user_id"], "ts", ["event_id"])
             for b in range(4)]

    def send(b: int) -> None:
        table.upsert(parts[b], writer=("even", "odd")[b % 2], batch=b // 2)

    send(0)
    send(1)
    table.compact()
    send(0)  # replays of what is folded
    send(1)
    send(2)
    with ThreadPoolExecutor(1) as other:
        folding = other.submit(table.compact)
        send(3)
        folding.result()
    for b in range(4):
        send(b)
    current = table.read()
    spark.sql(f"DROP TABLE {name}")
    return current


def upsert_wider_batch(spark: SparkSession, events: DataFrame, split: str = "2024-01-15") -> DataFrame:
    """A second batch with one more column (k) in another order, then a compaction: users that only the first batch has lack it."""
    name = unique_name("tl_wider")
    table = KeyedTable(spark, workdir(spark, "wider"), ["user_id"], ["ts", "event_id"], name=name)
    early, late = halves(odd_events(events).drop("props"), split)
    table.upsert(latest_per_key(early, ["user_id"], "ts", ["event_id"]))
    more = with_k(halves(odd_events(events), split)[1]).drop("props")
    table.upsert(latest_per_key(more.select(*sorted(more.columns)), ["user_id"], "ts", ["event_id"]))
    table.compact()
    current = table.read()
    spark.sql(f"DROP TABLE {name}")
    return current


# ---- streaming ----------------------------------------------------------

def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if not absent(e):
            raise
        return spark.createDataFrame([], ddl)


EVENT_ROW = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, ts TIMESTAMP_NTZ, k INT"


def stream_json_ingest(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Message stream -> text payload -> ``from_json`` -> raw table partitioned
    by event day (bad messages are kept as all-NULL rows), appended exactly
    once through the file sink."""
    feed = Feed(spark, event_messages(odd_events(events), junk_errors=True), "ts", days, fmt="text",
                name="events-json")
    raw, ckpt = workdir(spark, "raw-events"), workdir(spark, "raw-events-ckpt")
    parts = ["year", "month", "day"]
    for i in feed.slices:
        feed.deliver(i)
        dec = json_stream(spark, "text", EVENT_SCHEMA, feed.landing)
        dec = with_time_parts(dec.withColumn("ts", to_ntz(epoch_ms("ts"))), "ts", parts)
        finish(stream_append(dec, raw, ckpt, parts))
    return _read(spark, raw, EVENT_ROW + ", year STRING, month STRING, day STRING")


def _order_stream(spark: SparkSession, path: str) -> DataFrame:
    return (spark.readStream.schema(ORDER_ROW).parquet(path)
            .withColumn("order_ts", event_time("order_ts")))


def _member_stream(spark: SparkSession, path: str) -> DataFrame:
    return (spark.readStream.schema(MEMBER_ROW).parquet(path)
            .withColumn("member_ts", event_time("member_ts")))


def _joined_stream(orders: DataFrame, members: DataFrame, within: str, salts: int = 1) -> DataFrame:
    j = interval_join(orders, members, on=[("order_owner", "member_owner")],
                      left_ts="order_ts", right_ts="member_ts", within=within,
                      left_delay=ORDER_WATERMARK, right_delay=MEMBER_WATERMARK, salts=salts)
    return j.withColumns({"order_ts": to_ntz("order_ts"), "member_ts": to_ntz("member_ts")})


def stream_interval_join(spark: SparkSession, events: DataFrame, days: int = 6,
                         within: str = MEMBER_WITHIN, salts: int = 1, checkpoint: str | None = None) -> DataFrame:
    """Stream-stream inner join with watermarks 2 h (orders) / 3 h (members);
    append mode, so each match is written once; state is bounded by the
    watermarks and the time condition."""
    of = Feed(spark, order_events(events), "order_ts", days, name="orders")
    mf = Feed(spark, member_events(events), "member_ts", days, name="members")
    out, ckpt = workdir(spark, "joined"), checkpoint or workdir(spark, "joined-ckpt")
    for i in of.slices:
        of.deliver(i)
        mf.deliver(i)
        j = _joined_stream(_order_stream(spark, of.landing), _member_stream(spark, mf.landing), within, salts)
        finish(stream_append(j, out, ckpt))
    return _read(spark, out, ", ".join([ORDER_ROW, MEMBER_ROW]))


def stream_upsert_latest(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Each micro-batch: latest row per user, then an upsert into a keyed table
    that keeps the latest event (rows without a user are left out)."""
    feed = Feed(spark, odd_events(events), "ts", days, name="events")
    table = KeyedTable(spark, workdir(spark, "processed-events"), ["user_id"], ["ts", "event_id"])
    ckpt = workdir(spark, "upsert-ckpt")
    for i in feed.slices:
        feed.deliver(i)
        src = spark.readStream.schema(events.schema).parquet(feed.landing)
        finish(start(src, ckpt, fn=upsert_sink(table, "ts", ["event_id"])))
    return table.read()


def stream_update_latest(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Latest event per user as a stateful aggregate in ``update`` mode: a
    micro-batch upserts only the users it saw, with their latest row so far."""
    feed = Feed(spark, odd_events(events), "ts", days, name="updates")
    table = KeyedTable(spark, workdir(spark, "updated-events"), ["user_id"])
    ckpt = workdir(spark, "update-ckpt")
    for i in feed.slices:
        feed.deliver(i)
        src = spark.readStream.schema(events.schema).parquet(feed.landing)
        sink = guarded(lambda df, b: table.upsert(df, writer="updates", batch=b))
        finish(start(latest_state(src, ["user_id"], ["ts", "event_id"]), ckpt, fn=sink, mode="update"))
    return table.read()


def stream_staged_append(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Batches staged, audited and published by one catalog step each. The
    batch of rows without a time fails its check and never shows; the first
    batch is sent twice and published once."""
    feed = Feed(spark, odd_events(events), "ts", days, name="staged")
    table, ckpt = unique_name("tl_staged"), workdir(spark, "staged-ckpt")
    sink = StagedAppend(table, workdir(spark, "staged"), {"no_time": F.col("ts").isNull()})
    sink.create(spark, EVENT_DDL)
    again: list[tuple[DataFrame, int]] = []
    for i in feed.slices:
        feed.deliver(i)
        src = spark.readStream.schema(events.schema).parquet(feed.landing)
        finish(start(src, ckpt, fn=guarded(sink)))
        if not again:
            again.append((feed.slice(i), 0))
    for rows, batch in again:
        sink(rows, batch)
    published = spark.table(table).drop("batch_id")
    return published


SORTED_ROW = EVENT_ROW + ", message STRING, reason STRING"


def damaged_messages(events: DataFrame) -> DataFrame:
    """Event messages; by the payload's k, those of error events are junk (k < 10), have text for a number (< 15) or lack the id (< 20)."""
    err, k = F.col("event_type") == "error", K()
    text = (F.when(err & (k < 10), F.lit("junk"))
            .when(err & (k < 15), F.concat(F.lit('{"event_id":"x'), F.col("event_id"), F.lit('"}')))
            .when(err & (k < 20), F.concat(F.lit('{"user_id":'), F.col("user_id"), F.lit("}"))))
    return events.select(F.coalesce(text, event_message()).alias("value"), "ts")


def stream_quarantine(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Messages sorted into decoded rows and rejected messages with a reason,
    each in its own table, by one ``foreachBatch`` (a batch replaces its own
    folder in both, so a replay changes nothing). Returns both together."""
    feed = Feed(spark, damaged_messages(events), "ts", days, fmt="text", name="sorted")
    good, bad, ckpt = workdir(spark, "good"), workdir(spark, "quarantine"), workdir(spark, "sorted-ckpt")
    to_good, to_bad = batch_writer("parquet", path=good), batch_writer("parquet", path=bad)

    def both(df: DataFrame, batch_id: int) -> None:
        df.persist()  # sorted once for the two tables
        to_good(df.where("reason is null"), batch_id)
        to_bad(df.where("reason is not null").select("message", "reason"), batch_id)
        df.unpersist()

    for i in feed.slices:
        feed.deliver(i)
        rows = json_sorted(stream_source(spark, "text", feed.landing), EVENT_SCHEMA, required=["event_id"])
        finish(start(rows.withColumn("ts", to_ntz(epoch_ms("ts"))), ckpt, fn=both))
    kept = _read(spark, good, SORTED_ROW).select(*[f.split()[0] for f in SORTED_ROW.split(", ")])
    rejected = _read(spark, bad, "message STRING, reason STRING").select("message", "reason")
    return kept.unionByName(rejected, allowMissingColumns=True)


def stream_from_start(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Messages in a ``data`` column of binary rows, read from a given instant
    on: those of the first two slices were there before it."""
    messages = event_messages(events).select(F.col("value").cast("binary").alias("data"), "ts")
    feed = Feed(spark, messages, "ts", days, name="payloads")
    begin = None
    for n, i in enumerate(feed.slices):
        if n == 2:
            time.sleep(2.1)  # some file systems keep whole seconds
            begin = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1)
        feed.deliver(i)
    begin = begin or dt.datetime.now(dt.timezone.utc)
    out = workdir(spark, "from-start")
    rows = json_stream(spark, "parquet", EVENT_SCHEMA, feed.landing, source_schema="data BINARY", payload="data", start=begin)
    finish(stream_append(rows.withColumn("ts", to_ntz(epoch_ms("ts"))), out, workdir(spark, "from-start-ckpt")))
    return _read(spark, out, EVENT_ROW)


HOT_OWNER = 1  # given to every third order and every hundredth membership, all within one hour
HOT_HOUR = "2024-01-20 10:00:00"


def hot_events(events: DataFrame) -> DataFrame:
    """The events, a third of the clicks and some purchases moved to one owner and one hour."""
    id_ = F.col("event_id")
    hot = (((F.col("event_type") == "click") & (F.pmod(id_, F.lit(3)) == 0))
           | ((F.col("event_type") == "purchase") & (F.pmod(id_, F.lit(100)) == 0)))
    at = F.lit(HOT_HOUR).cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod(id_, F.lit(3600)))
    return events.withColumns({"user_id": F.when(hot, F.lit(HOT_OWNER).cast("bigint")).otherwise(F.col("user_id")),
                               "ts": F.when(hot, at).otherwise(F.col("ts"))})


def stream_interval_join_hot(spark: SparkSession, events: DataFrame, days: int = 6, within: str = "15 minutes",
                             salts: int = 8, checkpoint: str | None = None) -> DataFrame:
    """The interval join with a third of the orders on one owner and hour,
    which are dealt over ``salts`` join keys, so no state store holds them all."""
    return stream_interval_join(spark, hot_events(events), days, within, salts, checkpoint)


def stream_two_topics(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Two topics in one application: each query has its own schema, sink
    and checkpoint, and both run at the same time. Orders land partitioned
    by ingest time (year/month/day/hour), memberships by membership level."""
    of = Feed(spark, order_messages(events), "ts", days, fmt="text", name="orders-topic")
    mf = Feed(spark, member_messages(events), "ts", days, fmt="text", name="members-topic")
    raw_o, raw_m = workdir(spark, "raw-order"), workdir(spark, "raw-member")
    ck_o, ck_m = workdir(spark, "raw-order-ckpt"), workdir(spark, "raw-member-ckpt")

    for i in of.slices:
        of.deliver(i)
        mf.deliver(i)
        o = json_stream(spark, "text", ORDER_SCHEMA, of.landing) \
            .withColumn("timestamp", to_ntz(epoch_ms("timestamp")))
        m = json_stream(spark, "text", MEMBER_SCHEMA, mf.landing) \
            .withColumn("timestamp", to_ntz(epoch_ms("timestamp")))
        # ingest time = the micro-batch's timestamp (kept in the offset log)
        run_all([StreamSpec(with_time_parts(o, None), None, ck_o, path=raw_o,
                            partition_by=INGEST_PARTS),
                 StreamSpec(m, None, ck_m, path=raw_m, partition_by=["membership"])])
    ro = _read(spark, raw_o, "order_id BIGINT, order_owner BIGINT, order_value DOUBLE, "
                             "timestamp TIMESTAMP_NTZ, year STRING, month STRING, day STRING, hour STRING")
    rm = _read(spark, raw_m, "member_id BIGINT, order_owner BIGINT, timestamp TIMESTAMP_NTZ, "
                             "membership STRING")
    orders = ro.select(F.lit("orders").alias("topic"), F.col("order_id").alias("id"), "order_owner", "order_value",
                       "timestamp", F.lit(None).cast("string").alias("membership"))
    return orders.unionByName(rm.select(F.lit("membership").alias("topic"), F.col("member_id").alias("id"), "order_owner",
                                        F.lit(None).cast("double").alias("order_value"), "timestamp", "membership"))


def stream_enrich_products(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Per micro-batch: stamp ingest time, join the inline product table,
    append (exactly once) partitioned by ingest year/month/day/hour. Returns
    the data columns (the ingest-time partition values depend on the wall
    clock)."""
    feed = Feed(spark, event_messages(events), "ts", days, fmt="text", name="orders-json")
    out, ckpt = workdir(spark, "raw-products"), workdir(spark, "raw-products-ckpt")
    dim = product_dim(spark)
    for i in feed.slices:
        feed.deliver(i)
        dec = json_stream(spark, "text", EVENT_SCHEMA, feed.landing)
        dec = dec.select("event_id", "user_id", to_ntz(epoch_ms("ts")).alias("ts"),
                         F.col("k").alias("order_id"))
        # stream-static join with the broadcast literal; ingest time = batch timestamp
        joined = enrich(with_time_parts(dec, None), dim, "order_id", small=True)
        finish(stream_append(joined, out, ckpt, INGEST_PARTS))
    return _read(spark, out, "order_id INT, event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, "
                             "product_name STRING").select(
        "order_id", "event_id", "user_id", "ts", "product_name")


PROCESSED_ROW = ", ".join([ORDER_ROW, MEMBER_ROW,
                           "year STRING, month STRING, day STRING, hour STRING"])


def order_medallion(spark: SparkSession, events: DataFrame, days: int = 10,
                    within: str = MEMBER_WITHIN) -> DataFrame:
    """Topics -> raw (stage 1) -> interval join -> curated (stage 2) ->
    latest per owner + MERGE -> processed (stage 3), one ``availableNow``
    run per stage after each delivery, as an hourly schedule would run them.

    Raw orders are partitioned by ingest year/month/day/hour (wall clock:
    one partition per micro-batch); curated is a file-sink table whose commit
    log gives stage 3 exactly-once input; processed is a keyed table on
    ``order_owner`` with the latest order (ties: later membership) per owner.
    Returns the processed rows without the ingest-time columns.
    """
    of = Feed(spark, order_messages(events), "ts", days, fmt="text", name="m-orders-topic")
    mf = Feed(spark, member_messages(events), "ts", days, fmt="text", name="m-members-topic")
    raw_o, raw_m, curated = (workdir(spark, n) for n in ("m-raw-order", "m-raw-member", "m-curated"))
    ck = {n: workdir(spark, f"m-ckpt-{n}") for n in ("o", "m", "join", "upsert")}
    processed = KeyedTable(spark, workdir(spark, "m-processed"), ["order_owner"],
                           ["order_ts", "member_ts", "member_id"])

    raw_order_row = ORDER_ROW + ", year STRING, month STRING, day STRING, hour STRING"
    for i in of.slices:
        of.deliver(i)
        mf.deliver(i)
        o = json_stream(spark, "text", ORDER_SCHEMA, of.landing).select(
            "order_id", "order_owner", "order_value", to_ntz(epoch_ms("timestamp")).alias("order_ts"))
        m = json_stream(spark, "text", MEMBER_SCHEMA, mf.landing).select(
            "member_id", F.col("order_owner").alias("member_owner"), "membership",
            to_ntz(epoch_ms("timestamp")).alias("member_ts"))
        run_all([StreamSpec(with_time_parts(o, None), None, ck["o"], path=raw_o,
                            partition_by=INGEST_PARTS),
                 StreamSpec(m, None, ck["m"], path=raw_m, partition_by=["membership"])])
        ro = (spark.readStream.schema(raw_order_row).parquet(raw_o)
              .withColumn("order_ts", event_time("order_ts")))
        rm = (spark.readStream.schema(MEMBER_ROW).parquet(raw_m)
              .withColumn("member_ts", event_time("member_ts")))
        j = _joined_stream(ro, rm, within)
        finish(start(j.select(*JOINED_COLS, "year", "month", "day", "hour"), ck["join"],
                     fmt="parquet", path=curated))
        cur = spark.readStream.schema(PROCESSED_ROW).parquet(curated)
        finish(start(cur, ck["upsert"],
                     fn=upsert_sink(processed, "order_ts", ["member_ts", "member_id"])))
    return processed.read().select(*JOINED_COLS)
