"""How the pipelines' inputs are read off the test tables.

* order event  = ``events`` row with ``event_type = 'click'``:
  order_id = event_id, order_owner = user_id, order_value = value, order_ts = ts
* member event = ``events`` row with ``event_type = 'purchase'``:
  member_id = event_id, member_owner = user_id, membership = level by ``k % 4``,
  member_ts = ts
* invoice      = any ``events`` row: UnitPrice = value, Quantity = props.k,
  InvoiceDate = ts, Country = nation name of customer ``user_id``

Messages (JSON text, as a topic would carry them) are made from the same
rows. The invoice feed marks some rows as damaged by a fixed rule on their
content, so cleaning and reject reasons see bad text on every run:

* error events with k < 10: UnitPrice ``n/a``;  10 <= k < 15: Quantity ``abc``
* error events with k >= 90: InvoiceDate ``unknown``
* error events with 15 <= k < 20: UnitPrice ``1e20``; < 25: ``NaN``; < 30: ``Infinity``;
  < 35: six decimals
* signup events with k < 5: Country is the nation key (digits only)
* view events write zero-padded dates, the others unpadded ones

The event messages and the replayed events lack some values, by content too:
signup events with k >= 95 have no time, view events with k = 99 no user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.decode import to_epoch_ms
from tideline.functions.fixed import MEMBERSHIP_LEVELS

def K() -> Column:
    """props ({"k": n}) -> k."""
    return F.from_json(F.col("props"), "k INT")["k"]


def with_k(events: DataFrame) -> DataFrame:
    """``props`` ({"k": n}) decoded to an int column ``k``."""
    parsed = events.select("*", F.json_tuple("props", "k").alias("k"))  # a generator: parsed once per row
    return parsed.withColumn("k", F.col("k").try_cast("int"))


def membership_level(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MEMBERSHIP_LEVELS]),
                        (F.pmod(k, F.lit(len(MEMBERSHIP_LEVELS))) + 1).cast("int"))


def odd_events(events: DataFrame) -> DataFrame:
    """The events, some without a time and some without a user (see above)."""
    k = K()
    return events.withColumns({
        "ts": F.when(~((F.col("event_type") == "signup") & (k >= 95)), F.col("ts")),
        "user_id": F.when(~((F.col("event_type") == "view") & (k == 99)), F.col("user_id"))})


def order_events(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type") == "click")
            .select(F.col("event_id").alias("order_id"), F.col("user_id").alias("order_owner"),
                    F.col("value").alias("order_value"), F.col("ts").alias("order_ts")))


def member_events(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("member_id"), F.col("user_id").alias("member_owner"),
                    membership_level(K()).alias("membership"), F.col("ts").alias("member_ts")))


# ---- JSON messages ------------------------------------------------------

EVENT_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
             "value DOUBLE, props STRING")
EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, ts BIGINT, k INT"
ORDER_SCHEMA = "order_id BIGINT, order_owner BIGINT, order_value DOUBLE, timestamp BIGINT"
MEMBER_SCHEMA = "member_id BIGINT, order_owner BIGINT, membership STRING, timestamp BIGINT"
INVOICE_SCHEMA = "Country STRING, InvoiceDate STRING, Quantity STRING, UnitPrice STRING"  # what is used of a message


def event_message() -> Column:
    """An event as JSON (epoch-millisecond time, k flattened)."""
    return F.to_json(F.struct(
        "event_id", "user_id", "event_type", "value",
        to_epoch_ms("ts").alias("ts"), K().alias("k")))


def event_messages(events: DataFrame, junk_errors: bool = False) -> DataFrame:
    """One JSON message per event. With ``junk_errors`` error events with k < 10 carry the text ``junk``."""
    msg = event_message()
    if junk_errors:
        msg = F.when((F.col("event_type") == "error") & (K() < 10), F.lit("junk")).otherwise(msg)
    return events.select(msg.alias("value"), "ts")


def order_messages(events: DataFrame) -> DataFrame:
    o = order_events(events)
    return o.select(F.to_json(F.struct(
        "order_id", "order_owner", "order_value",
        to_epoch_ms("order_ts").alias("timestamp"))).alias("value"), F.col("order_ts").alias("ts"))


def member_messages(events: DataFrame) -> DataFrame:
    m = member_events(events)
    return m.select(F.to_json(F.struct(
        "member_id", F.col("member_owner").alias("order_owner"), "membership",
        to_epoch_ms("member_ts").alias("timestamp"))).alias("value"), F.col("member_ts").alias("ts"))


def invoice_rows(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Invoice fields as text (the message body), plus ``ts`` for replay."""
    # the dimensions first: the facts then move once, by customer
    who = (customer.select("c_custkey", "c_name", "c_nationkey")
           .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")))
    e = with_k(events)
    j = e.join(who, e.user_id == who.c_custkey)
    et, k = F.col("event_type"), F.col("k")
    err = et == "error"
    date_fmt = F.when(et == "view", F.date_format("ts", "MM/dd/yyyy HH:mm")) \
                .otherwise(F.date_format("ts", "M/d/yyyy H:mm"))
    return j.select(
        F.when((et == "signup") & (k < 5), F.col("c_nationkey").cast("string"))
         .otherwise(F.col("n_name")).alias("Country"),
        F.col("c_name").alias("Customer"),
        et.alias("Description"),
        F.when(err & (k >= 90), F.lit("unknown")).otherwise(date_fmt).alias("InvoiceDate"),
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.when(err & (k >= 10) & (k < 15), F.lit("abc")).otherwise(k.cast("string")).alias("Quantity"),
        F.col("user_id").cast("string").alias("StockCode"),
        F.when(err & (k < 10), F.lit("n/a")).when(err & k.between(15, 19), F.lit("1e20"))
         .when(err & k.between(20, 24), F.lit("NaN")).when(err & k.between(25, 29), F.lit("Infinity"))
         .when(err & k.between(30, 34), F.lit("12.345678")).otherwise(F.col("value").cast("string")).alias("UnitPrice"),
        F.month("ts").alias("ingest_month"), F.dayofmonth("ts").alias("ingest_day"),
        F.hour("ts").alias("ingest_hour"),
        "ts",
    )


def invoice_messages(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    rows = invoice_rows(events, customer, nation)
    fields = [c for c in rows.columns if c != "ts"]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"), "ts")
