"""Retail sales: hourly sales per country (batch and stream), cleaning, and
the batch rebuild (customer summary, top customers, popular items)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.decode import event_time, exact_money
from tideline.functions.fixed import COUNTRY_PATTERN, SALES_WATERMARK, SALES_WINDOW
from tideline.operators.clean import PRICE_LIMIT, retail_clean, retail_rejects
from tideline.operators.windows import windowed_sum
from tideline.plans.feeds import Feed
from tideline.plans.inputs import INVOICE_SCHEMA, invoice_messages, invoice_rows, with_k
from tideline.session import workdir
from tideline.sinks.catalog import rebuild_table, repair
from tideline.sinks.files import batch_writer
from tideline.sinks.keyed import absent
from tideline.sources.streams import json_stream
from tideline.streaming.metrics import BatchMetrics, state_rows
from tideline.streaming.runner import finish, start


def sales_by_country_hour(events: DataFrame, customer: DataFrame, nation: DataFrame,
                          size: str = SALES_WINDOW, country_pattern: str = COUNTRY_PATTERN) -> DataFrame:
    """``sum(UnitPrice * Quantity)`` per country and hour over typed events.

    Plan: filter and sum per (user, hour) first — a partial+final hash
    aggregate, so a user holding a third of the events ships one row per hour
    per map task — then attach the country (customer is unique per key, so
    the join cannot skew; nation has 25 rows and is broadcast by size), then
    sum per (country, hour). Both sums are decimal, so the two-step total
    equals the one-step one exactly.
    """
    e = (with_k(events.select("user_id", "ts", F.col("value").alias("UnitPrice"), "props"))
         .withColumnRenamed("k", "Quantity")
         .filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & (F.col("UnitPrice") < PRICE_LIMIT)))
    per_user = (e.groupBy("user_id", F.window("ts", size).alias("w"))
                 .agg(F.sum(exact_money("UnitPrice") * F.col("Quantity")).alias("amt")))
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", F.col("n_name").alias("Country"))
    who = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .filter(F.col("Country").rlike(country_pattern)))
    j = per_user.join(who, per_user.user_id == who.c_custkey)
    return (j.groupBy("Country", "w").agg(F.sum("amt").cast("double").alias("Total_sales"))
             .select("Country", F.col("w.start").cast("timestamp_ntz").alias("start"),
                     F.col("w.end").cast("timestamp_ntz").alias("end"), "Total_sales"))


def clean_invoices(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Invoice text rows -> typed, filtered rows (Country, UnitPrice, Quantity, InvoiceDate)."""
    return retail_clean(invoice_rows(events, customer, nation))


def invoice_rejects(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    return retail_rejects(invoice_rows(events, customer, nation))


def sales_from_clean(clean: DataFrame, delay: str | None = None,
                     size: str = SALES_WINDOW) -> DataFrame:
    """Windowed sales over cleaned invoice rows (the streaming job's aggregation)."""
    c = clean.withColumn("InvoiceDate", event_time("InvoiceDate"))
    return windowed_sum(c, ["Country"], "InvoiceDate", size,
                        exact_money("UnitPrice") * F.col("Quantity"),
                        out="Total_sales", delay=delay, count="n_rows")


SALES_ROW = "Country STRING, start TIMESTAMP_NTZ, `end` TIMESTAMP_NTZ, Total_sales DOUBLE, n_rows BIGINT"


def stream_sales(spark: SparkSession, events: DataFrame, customer: DataFrame,
                 nation: DataFrame, days: int = 6, newest_first: bool = False,
                 delay: str = SALES_WATERMARK, report: dict | None = None) -> DataFrame:
    """Invoice messages replayed as text files -> decode -> clean -> watermark
    -> hourly window sum -> append each micro-batch to a warehouse table.

    Append mode: a window is written once, after the watermark (max event
    time seen minus ``delay``) passes its end. ``newest_first`` replays the
    slices in reverse, so older rows arrive late and are dropped. With a
    ``report`` a listener keeps the figures of every micro-batch
    (``report["metrics"]``), and the late rows are the dated rows observed
    less those in windows written and those in windows still in the state:
    ``report["dropped"]``, exact however the rows fell into batches.
    """
    feed = Feed(spark, invoice_messages(events, customer, nation), "ts", days, fmt="text",
                name="invoices")
    out, ckpt = workdir(spark, "totalsales"), workdir(spark, "totalsales-ckpt")
    order = sorted(feed.slices, key=lambda i: -1 if i is None else i, reverse=True) if newest_first else feed.slices
    metrics = BatchMetrics()
    if report is not None:
        spark.streams.addListener(metrics)
    for i in order:
        feed.deliver(i)
        clean = retail_clean(json_stream(spark, "text", INVOICE_SCHEMA, feed.landing))
        if report is not None:
            clean = clean.observe("rows", F.count("InvoiceDate").alias("dated"))
        agg = sales_from_clean(clean, delay=delay)
        q = start(agg, ckpt, fn=batch_writer("parquet", path=out))
        finish(q)
        if report is not None:
            metrics.wait(q)
    written = _read_or_empty(spark, out, SALES_ROW)
    if report is not None:
        spark.streams.removeListener(metrics)
        counted = lambda df, n: df.agg(F.sum(n)).first()[0] or 0
        left = state_rows(spark, ckpt)
        report.update(metrics=metrics, checkpoint=ckpt, dropped=metrics.observed("dated") - counted(written, "n_rows")
                      - counted(left, "state.count"))
    return written.select("Country", "start", "end", "Total_sales")


def stream_late_drop(spark: SparkSession, events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Windowed sales with the newest slice first, and next to them the rows that came too late for their window."""
    report: dict = {}
    sales = stream_sales(spark, events, customer, nation, newest_first=True, report=report)
    return sales.withColumn("late_rows", F.lit(report["dropped"]).cast("bigint"))


def stream_state_left(spark: SparkSession, events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """The windows that a sales stream still holds in its state at the end: those the watermark has not passed."""
    report: dict = {}
    stream_sales(spark, events, customer, nation, report=report)
    return state_rows(spark, report["checkpoint"]).select(
        "Country", F.col("window.start").cast("timestamp_ntz").alias("start"),
        F.col("window.end").cast("timestamp_ntz").alias("end"), F.col("state.count").alias("n_rows"))


def _read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if not absent(e):
            raise
        return spark.createDataFrame([], ddl)  # nothing was ever written: every batch was empty


# ---- batch rebuild: summary, top customers, popular items ---------------

def customer_summary(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders per customer: count, spend, first/last order date.

    Aggregates orders by customer key first (map-side combine, so a customer
    with a third of all orders is pre-summed per task), then joins the
    customer rows — one row per key on each side of the join.
    """
    per = (orders.groupBy("o_custkey")
                 .agg(F.count(F.lit(1)).alias("n_orders"),
                      F.sum(exact_money("o_totalprice", 2)).cast("double").alias("total_spend"),
                      F.min("o_orderdate").alias("first_order"),
                      F.max("o_orderdate").alias("last_order")))
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    return (per.join(c, per.o_custkey == c.c_custkey)
               .select("c_custkey", "c_name", "c_mktsegment", "n_orders", "total_spend",
                       "first_order", "last_order"))


def top_customers(summary: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` biggest spenders, ties by key (per-partition top-k, then merge)."""
    return summary.orderBy(F.col("total_spend").desc(), F.col("c_custkey").asc()).limit(k)


def popular_items(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  nation: DataFrame, part: DataFrame, country: str, k: int = 10) -> DataFrame:
    """Top ``k`` parts by quantity ordered by customers of one country.

    Semi joins narrow customers -> orders -> line items before the only
    aggregation (Spark adds a runtime bloom filter on the large side when the
    other is filtered); the part name is attached to the ``k`` winners only.
    """
    cust = (customer.join(nation.filter(F.col("n_name") == country),
                          F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
                    .select("c_custkey"))
    ords = orders.join(cust, orders.o_custkey == cust.c_custkey, "left_semi").select("o_orderkey")
    li = lineitem.join(ords, lineitem.l_orderkey == ords.o_orderkey, "left_semi")
    per_part = (li.groupBy("l_partkey")
                  .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_qty"),
                       F.count(F.lit(1)).alias("n_lines")))
    top = per_part.orderBy(F.col("total_qty").desc(), F.col("l_partkey").asc()).limit(k)
    p = part.select("p_partkey", "p_name")
    # the winners are at most k rows: broadcast them and stream `part` past them
    return (p.join(F.broadcast(top), top.l_partkey == p.p_partkey)
               .select(F.col("l_partkey").alias("p_partkey"), "p_name", "total_qty", "n_lines"))


def retail_rebuild(spark: SparkSession, events: DataFrame, customer: DataFrame,
                   nation: DataFrame, orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                   database: str, location: str, country: str, k: int = 10) -> dict[str, str]:
    """Full rebuild of the four retail output tables (each overwritten whole),
    then partition sync. Returns table names by role."""
    names = {
        "cleaned": f"{database}.invoices_clean",
        "summary": f"{database}.customer_totals",
        "top": f"{database}.customers_top",
        "popular": f"{database}.items_popular",
    }
    cleaned = clean_invoices(events, customer, nation).withColumn(
        "invoice_day", F.to_date("InvoiceDate"))
    rebuild_table(cleaned, names["cleaned"], f"{location}/cleaned", ["invoice_day"])
    rebuild_table(customer_summary(orders, customer), names["summary"], f"{location}/summary")
    rebuild_table(top_customers(spark.table(names["summary"]), k), names["top"], f"{location}/top")
    rebuild_table(popular_items(lineitem, orders, customer, nation, part, country, k),
                  names["popular"], f"{location}/popular")
    repair(spark, names["cleaned"])
    return names
