"""Every registered query: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can say the same, an independent DuckDB query over the raw
tables (views ``events customer nation orders lineitem part supplier …``).

Each query reads whole tables; the oracle SQL spells out the semantics
directly (no JSON round trip, no files), so it checks the Spark plan rather
than repeating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.fixed import MEMBERSHIP_LEVELS, PRODUCT_DIM_ROWS
from tideline.plans import orders as O
from tideline.plans import retail as R
from tideline.plans import tables as T
from tideline.sources.tables import load

POPULAR_COUNTRY = "NATION_7"
TOP_K = 10


def _t(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [load(spark, sf, n) for n in names]


def _q(fn: Callable, *names: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*_t(spark, sf_dir, *names), **kw)
    return run


def _qs(fn: Callable, *names: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    """Like ``_q`` for plans that also take the session (they write tables)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, *_t(spark, sf_dir, *names), **kw)
    return run


def _popular(lineitem, orders, customer, nation, part):
    return R.popular_items(lineitem, orders, customer, nation, part, POPULAR_COUNTRY, TOP_K)


def _top(orders, customer):
    return R.top_customers(R.customer_summary(orders, customer), TOP_K)


def _rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four rebuilt retail tables after two runs, as (table, key, amount) rows."""
    from tideline.session import workdir
    db = T._database(spark, "retail")
    for _ in range(2):
        names = R.retail_rebuild(spark, *_t(spark, sf_dir, "events", "customer", "nation", "orders", "lineitem", "part"),
                                 db, workdir(spark, "retail"), POPULAR_COUNTRY, TOP_K)
    out = None
    for role, key, amount in (("cleaned", "Country", "UnitPrice"), ("summary", "c_name", "total_spend"),
                              ("top", "c_name", "total_spend"), ("popular", "p_name", "total_qty")):
        rows = spark.table(names[role]).select(F.lit(role).alias("table_role"), F.col(key).alias("key"),
                                               F.col(amount).cast("double").alias("amount"))
        out = rows if out is None else out.unionAll(rows)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # retail sales
    "sales_by_country_hour": _q(R.sales_by_country_hour, "events", "customer", "nation"),
    "retail_clean": _q(R.clean_invoices, "events", "customer", "nation"),
    "retail_rejects": _q(R.invoice_rejects, "events", "customer", "nation"),
    "stream_sales_by_country_hour": _qs(R.stream_sales, "events", "customer", "nation"),
    "stream_late_drop": _qs(R.stream_late_drop, "events", "customer", "nation"),
    "stream_state_left": _qs(R.stream_state_left, "events", "customer", "nation"),
    "retail_customer_summary": _q(R.customer_summary, "orders", "customer"),
    "retail_top_customer": _q(_top, "orders", "customer"),
    "retail_rebuild": _rebuild,
    "retail_popular_item": _q(_popular, "lineitem", "orders", "customer", "nation", "part"),
    # orders: decode, join, latest, upsert
    "json_decode": _q(O.decode_event_messages, "events"),
    "latest_per_key": _q(O.latest_event_per_user, "events"),
    "latest_semi": _q(O.latest_event_semi, "events"),
    "enrich_inline_dim": lambda spark, sf: O.enrich_products(spark, load(spark, sf, "events")),
    "enrich_inline_dim_wide": lambda spark, sf: O.enrich_products(spark, load(spark, sf, "events"),
                                                                   wide=True),
    "interval_join": _q(O.orders_with_members, "events"),
    "interval_join_day": _q(O.orders_with_members, "events", within="1 day"),
    "upsert_latest": _qs(O.upsert_latest, "events"),
    "upsert_two_writers": _qs(O.upsert_two_writers, "events"),
    "upsert_late_batch": _qs(O.upsert_late_batch, "events"),
    "upsert_compacted": _qs(O.upsert_compacted, "events"),
    "upsert_wider_batch": _qs(O.upsert_wider_batch, "events"),
    "merge_newer": _q(O.merge_newer, "events"),
    # streaming
    "stream_json_ingest": _qs(O.stream_json_ingest, "events"),
    "stream_interval_join": _qs(O.stream_interval_join, "events"),
    "stream_interval_join_day": _qs(O.stream_interval_join, "events", within="1 day"),
    "stream_interval_join_hot": _qs(O.stream_interval_join_hot, "events"),
    "stream_upsert_latest": _qs(O.stream_upsert_latest, "events"),
    "stream_update_latest": _qs(O.stream_update_latest, "events"),
    "stream_staged_append": _qs(O.stream_staged_append, "events"),
    "stream_quarantine": _qs(O.stream_quarantine, "events"),
    "stream_from_start": _qs(O.stream_from_start, "events"),
    "stream_two_topics": _qs(O.stream_two_topics, "events"),
    "stream_enrich_inline_dim": _qs(O.stream_enrich_products, "events"),
    "stream_archive_by_hour": _qs(T.stream_archive_by_hour, "events"),
    "medallion_processed": _qs(O.order_medallion, "events"),
    # tables
    "union_tagged_distinct": _q(T.union_tagged_distinct, "customer", "supplier"),
    "ctas_partitioned": _qs(T.ctas_partitioned, "orders"),
    "insert_into_select": _qs(T.insert_into_select, "orders"),
    "partition_drop_insert": _qs(T.partition_drop_insert, "orders"),
    "replace_partition": _qs(T.replace_partition, "orders"),
    "external_table_repair": _qs(T.external_table_repair, "events"),
    "external_table_sync": _qs(T.external_table_sync, "events"),
    "append_ingest_partitioned": _qs(T.append_ingest_partitioned, "events"),
    "archive_by_hour": _qs(T.archive_by_hour, "events"),
    "append_key_partitioned": _qs(T.append_key_partitioned, "events"),
    "snapshot_manifest": _qs(T.snapshot_manifest, "events"),
    "taxi_style_refresh": _qs(T.taxi_style_refresh, "customer", "supplier"),
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

K = "CAST(json_extract(props, '$.k') AS INTEGER)"
LEVEL = ("CASE {k} % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(MEMBERSHIP_LEVELS[:-1]))
         + f" ELSE '{MEMBERSHIP_LEVELS[-1]}' END")
PRODUCTS = ", ".join(f"({i}, '{n}')" for i, n in PRODUCT_DIM_ROWS)
MS = "date_trunc('millisecond', {c})"


def _orders_members(ms: bool = False) -> str:
    t = (lambda c: MS.format(c=c)) if ms else (lambda c: c)
    return f"""o AS (SELECT event_id AS order_id, user_id AS order_owner, value AS order_value,
                      {t('ts')} AS order_ts FROM events WHERE event_type = 'click'),
      m AS (SELECT event_id AS member_id, user_id AS member_owner,
                   {LEVEL.format(k=K)} AS membership, {t('ts')} AS member_ts
            FROM events WHERE event_type = 'purchase')"""


def _interval(within: str, ms: bool = False) -> str:
    return f"""WITH {_orders_members(ms)}
      SELECT o.*, m.* FROM o JOIN m ON o.order_owner = m.member_owner
        AND o.order_ts >= m.member_ts AND o.order_ts <= m.member_ts + INTERVAL {within}"""


INVOICE_CTES = f"""inv AS (
        SELECT e.event_type AS et, e.value, e.ts, CAST(json_extract(e.props, '$.k') AS INTEGER) AS k,
               c.c_nationkey, n.n_name
        FROM events e JOIN customer c ON e.user_id = c.c_custkey
                      JOIN nation n ON c.c_nationkey = n.n_nationkey),
      typed AS (
        SELECT CASE WHEN et = 'signup' AND k < 5 THEN CAST(c_nationkey AS VARCHAR) ELSE n_name END AS Country,
               CASE WHEN et <> 'error' THEN value WHEN k < 10 THEN NULL WHEN k BETWEEN 15 AND 19 THEN 1e20
                    WHEN k BETWEEN 20 AND 24 THEN 'NaN'::DOUBLE WHEN k BETWEEN 25 AND 29 THEN 'Infinity'::DOUBLE
                    WHEN k BETWEEN 30 AND 34 THEN 12.345678 ELSE value END AS UnitPrice,
               CASE WHEN et = 'error' AND k >= 10 AND k < 15 THEN NULL ELSE k END AS Quantity,
               CASE WHEN et = 'error' AND k >= 90 THEN NULL ELSE date_trunc('minute', ts) END AS InvoiceDate,
               ts
        FROM inv),
      clean AS (
        SELECT Country, UnitPrice, Quantity, InvoiceDate, ts FROM typed
        WHERE Quantity > 0 AND UnitPrice > 0 AND UnitPrice < 1e12 AND regexp_matches(Country, '[A-Za-z]'))"""

SALES_AGG = """SELECT Country, date_trunc('hour', InvoiceDate) AS start,
               date_trunc('hour', InvoiceDate) + INTERVAL 1 HOUR AS "end",
               CAST(sum(CAST(UnitPrice AS DECIMAL(28,10)) * Quantity) AS DOUBLE) AS Total_sales
        FROM {src} WHERE InvoiceDate IS NOT NULL GROUP BY ALL"""

SLICE = "floor(datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) / 6)"

LATEST = """SELECT * FROM {src} QUALIFY row_number() OVER (
          PARTITION BY {keys} ORDER BY {order}) = 1"""

ODD_TS = f"CASE WHEN event_type = 'signup' AND {K} >= 95 THEN NULL ELSE ts END"
ODD_USER = f"CASE WHEN event_type = 'view' AND {K} = 99 THEN NULL ELSE user_id END"
ODD = f"(SELECT event_id, {ODD_TS} AS ts, {ODD_USER} AS user_id, event_type, value, props FROM events)"
JUNK = f"(event_type = 'error' AND {K} < 10)"
DECODED = ", ".join(
    f"CASE WHEN {JUNK} THEN NULL ELSE {expr} END AS {name}"
    for name, expr in [("event_id", "event_id"), ("user_id", "user_id"), ("event_type", "event_type"),
                       ("value", "value"), ("ts", MS.format(c="ts")), ("k", K)])

YEAR_PARTS = "strftime({c}, '%Y') AS year, strftime({c}, '%m') AS month, strftime({c}, '%d') AS day"
HOUR_PART = "strftime({c}, '%H') AS hour"
O_YEAR = "CAST(year(o_orderdate) AS INTEGER) AS o_year"
PER_PART = "count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value"

ORACLE: dict[str, str] = {
    "sales_by_country_hour": f"""
      SELECT n.n_name AS Country, date_trunc('hour', e.ts) AS start,
             date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS "end",
             CAST(sum(CAST(e.value AS DECIMAL(28,10)) * CAST(json_extract(e.props, '$.k') AS INTEGER))
                  AS DOUBLE) AS Total_sales
      FROM events e JOIN customer c ON e.user_id = c.c_custkey
                    JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE CAST(json_extract(e.props, '$.k') AS INTEGER) > 0 AND e.value > 0
        AND regexp_matches(n.n_name, '[A-Za-z]')
      GROUP BY ALL""",
    "retail_clean": f"""WITH {INVOICE_CTES}
      SELECT Country, UnitPrice, Quantity, InvoiceDate FROM clean""",
    "retail_rejects": f"""WITH {INVOICE_CTES}
      SELECT CASE WHEN Quantity IS NULL THEN 'bad_quantity'
                  WHEN Quantity <= 0 THEN 'quantity_not_positive'
                  WHEN UnitPrice IS NULL THEN 'bad_price'
                  WHEN UnitPrice <= 0 THEN 'price_not_positive'
                  WHEN UnitPrice >= 1e12 THEN 'price_out_of_range'
                  WHEN Country IS NULL OR NOT regexp_matches(Country, '[A-Za-z]') THEN 'bad_country'
                  WHEN InvoiceDate IS NULL THEN 'no_date'
                  ELSE 'ok' END AS reason, count(*) AS n
      FROM typed GROUP BY 1""",
    # append mode emits a window once the watermark (max event time - 10 h) passes its end
    "stream_sales_by_country_hour": f"""WITH {INVOICE_CTES}, agg AS ({SALES_AGG.format(src='clean')})
      SELECT * FROM agg
      WHERE "end" <= (SELECT max(InvoiceDate) FROM clean) - INTERVAL 10 HOUR""",
    # newest slice first: every older slice is behind the watermark and dropped
    "stream_late_drop": f"""WITH {INVOICE_CTES},
      newest AS (SELECT * FROM clean WHERE {SLICE} = (SELECT max({SLICE}) FROM events)),
      agg AS ({SALES_AGG.format(src='newest')})
      SELECT agg.*, (SELECT count(*) FROM clean WHERE InvoiceDate IS NOT NULL
                     AND {SLICE} < (SELECT max({SLICE}) FROM events)) AS late_rows
      FROM agg
      WHERE "end" <= (SELECT max(InvoiceDate) FROM newest) - INTERVAL 10 HOUR""",
    "stream_state_left": f"""WITH {INVOICE_CTES}
      SELECT Country, date_trunc('hour', InvoiceDate) AS start, date_trunc('hour', InvoiceDate) + INTERVAL 1 HOUR AS "end",
             count(*) AS n_rows
      FROM clean WHERE date_trunc('hour', InvoiceDate) + INTERVAL 1 HOUR
                       > (SELECT max(InvoiceDate) FROM clean) - INTERVAL 10 HOUR
      GROUP BY ALL""",
    "retail_customer_summary": """
      SELECT c.c_custkey, c.c_name, c.c_mktsegment, count(*) AS n_orders,
             CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
             min(o.o_orderdate) AS first_order, max(o.o_orderdate) AS last_order
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      GROUP BY c.c_custkey, c.c_name, c.c_mktsegment""",
    "retail_top_customer": f"""
      SELECT c.c_custkey, c.c_name, c.c_mktsegment, count(*) AS n_orders,
             CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
             min(o.o_orderdate) AS first_order, max(o.o_orderdate) AS last_order
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      GROUP BY c.c_custkey, c.c_name, c.c_mktsegment
      ORDER BY total_spend DESC, c.c_custkey LIMIT {TOP_K}""",
    "retail_popular_item": f"""
      WITH li AS (
        SELECT * FROM lineitem WHERE l_orderkey IN (
          SELECT o_orderkey FROM orders WHERE o_custkey IN (
            SELECT c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
            WHERE n.n_name = '{POPULAR_COUNTRY}'))),
      pp AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_qty, count(*) AS n_lines
             FROM li GROUP BY l_partkey ORDER BY total_qty DESC, l_partkey LIMIT {TOP_K})
      SELECT pp.l_partkey AS p_partkey, p.p_name, pp.total_qty, pp.n_lines
      FROM pp JOIN part p ON pp.l_partkey = p.p_partkey""",
    "json_decode": f"SELECT {DECODED} FROM events",
    "latest_per_key": LATEST.format(src="events", keys="user_id",
                                    order="ts DESC NULLS LAST, event_id DESC NULLS LAST"),
    "latest_semi": """
      SELECT e.* FROM events e JOIN (SELECT user_id, max(ts) AS mts FROM events GROUP BY user_id) g
        ON e.user_id = g.user_id AND e.ts = g.mts""",
    "enrich_inline_dim": f"""
      SELECT p.order_id, p.product_name
      FROM events e JOIN (VALUES {PRODUCTS}) p(order_id, product_name) ON {K} = p.order_id""",
    "enrich_inline_dim_wide": f"""
      SELECT p.order_id, e.event_id, e.user_id, e.ts, p.product_name
      FROM events e JOIN (VALUES {PRODUCTS}) p(order_id, product_name) ON {K} = p.order_id""",
    "interval_join": _interval("1 HOUR"),
    "interval_join_day": _interval("1 DAY"),
    "upsert_latest": f"""
      WITH e AS (SELECT *, {K} AS k FROM {ODD} WHERE user_id IS NOT NULL),
      b AS ({LATEST.format(src="e WHERE ts < TIMESTAMP '2024-01-15'", keys="user_id, k",
                           order="ts DESC, event_id DESC")}),
      u AS ({LATEST.format(src="e WHERE coalesce(ts >= TIMESTAMP '2024-01-15', true)", keys="user_id, k",
                           order="ts DESC NULLS LAST, event_id DESC")})
      SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.user_id = b.user_id AND u.k = b.k)
      UNION ALL SELECT * FROM u""",
    "stream_json_ingest": f"""
      SELECT {DECODED}, {YEAR_PARTS.format(c=MS.format(c="CASE WHEN " + JUNK + " THEN NULL ELSE ts END"))}
      FROM {ODD}""",
    "stream_interval_join": _interval("1 HOUR"),
    "stream_interval_join_day": _interval("1 DAY"),
    "stream_upsert_latest": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                          order="ts DESC NULLS LAST, event_id DESC"),
    "upsert_two_writers": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                        order="ts DESC NULLS LAST, event_id DESC"),
    "upsert_late_batch": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                       order="ts DESC NULLS LAST, event_id DESC"),
    "merge_newer": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                 order="ts DESC NULLS LAST, event_id DESC"),
    # the last batch that has the user wins, by the latest row it has
    "upsert_compacted": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                      order="event_id % 4 DESC, ts DESC NULLS LAST, event_id DESC"),
    "upsert_wider_batch": LATEST.format(
        src=f"""(SELECT * EXCLUDE props, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN NULL ELSE {K} END AS k
              FROM {ODD} WHERE user_id IS NOT NULL)""", keys="user_id", order="ts DESC NULLS LAST, event_id DESC"),
    "stream_interval_join_hot": f"""WITH hot AS (
        SELECT *, event_type = 'click' AND event_id % 3 = 0 OR event_type = 'purchase' AND event_id % 100 = 0 AS h
        FROM events),
      events AS (SELECT * EXCLUDE (h, user_id, ts), CASE WHEN h THEN 1 ELSE user_id END AS user_id,
                        CASE WHEN h THEN TIMESTAMP '2024-01-20 10:00:00' + to_seconds(event_id % 3600) ELSE ts END AS ts
                 FROM hot),
      {_orders_members()}
      SELECT o.*, m.* FROM o JOIN m ON o.order_owner = m.member_owner
        AND o.order_ts >= m.member_ts AND o.order_ts <= m.member_ts + INTERVAL 15 MINUTE""",
    "stream_update_latest": LATEST.format(src=f"{ODD} WHERE user_id IS NOT NULL", keys="user_id",
                                          order="ts DESC NULLS LAST, event_id DESC"),
    "stream_staged_append": f"SELECT * FROM {ODD} WHERE ts IS NOT NULL",
    "stream_quarantine": f"""
      SELECT event_id, user_id, event_type, value, {MS.format(c="ts")} AS ts, {K} AS k, NULL AS message, NULL AS reason
      FROM events WHERE event_type <> 'error' OR {K} >= 20
      UNION ALL
      SELECT NULL, NULL, NULL, NULL, NULL, NULL,
             CASE WHEN {K} < 10 THEN 'junk' WHEN {K} < 15 THEN '{{"event_id":"x' || event_id || '"}}'
                  ELSE '{{"user_id":' || user_id || '}}' END,
             CASE WHEN {K} < 10 THEN 'not_json' WHEN {K} < 15 THEN 'bad_field' ELSE 'missing:event_id' END
      FROM events WHERE event_type = 'error' AND {K} < 20""",
    "stream_from_start": f"""
      SELECT event_id, user_id, event_type, value, {MS.format(c="ts")} AS ts, {K} AS k FROM events WHERE {SLICE} >= 2""",
    "stream_two_topics": f"""
      SELECT 'orders' AS topic, event_id AS id, user_id AS order_owner, value AS order_value,
             date_trunc('millisecond', ts) AS timestamp, NULL AS membership
      FROM events WHERE event_type = 'click'
      UNION ALL
      SELECT 'membership', event_id, user_id, NULL, date_trunc('millisecond', ts), {LEVEL.format(k=K)}
      FROM events WHERE event_type = 'purchase'""",
    "stream_enrich_inline_dim": f"""
      SELECT p.order_id, e.event_id, e.user_id, date_trunc('millisecond', e.ts) AS ts, p.product_name
      FROM events e JOIN (VALUES {PRODUCTS}) p(order_id, product_name) ON {K} = p.order_id""",
    "archive_by_hour": """
      SELECT *, strftime(ts, '%Y') AS ingest_year, strftime(ts, '%m') AS ingest_month,
             strftime(ts, '%d') AS ingest_day, strftime(ts, '%H') AS ingest_hour FROM events""",
    "stream_archive_by_hour": f"""
      SELECT *, strftime(ts, '%Y') AS ingest_year, strftime(ts, '%m') AS ingest_month,
             strftime(ts, '%d') AS ingest_day, strftime(ts, '%H') AS ingest_hour FROM {ODD}""",
    "medallion_processed": f"""
      WITH {_orders_members(ms=True)},
      j AS (SELECT o.*, m.* FROM o JOIN m ON o.order_owner = m.member_owner
              AND o.order_ts >= m.member_ts AND o.order_ts <= m.member_ts + INTERVAL 1 HOUR)
      SELECT * FROM j
      QUALIFY row_number() OVER (PARTITION BY order_owner
                                 ORDER BY order_ts DESC, member_ts DESC, member_id DESC) = 1""",
    "union_tagged_distinct": """
      SELECT 'customer' AS party_type, c_nationkey AS nationkey,
             CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance_band FROM customer
      UNION
      SELECT 'supplier', s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier""",
    "ctas_partitioned": f"SELECT *, {O_YEAR} FROM orders",
    "insert_into_select": f"""
      SELECT *, {O_YEAR} FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT *, {O_YEAR} FROM orders""",
    "replace_partition": f"""
      SELECT *, {O_YEAR} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
      UNION ALL
      SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             {O_YEAR}
      FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
    "external_table_repair": f"SELECT *, {YEAR_PARTS.format(c='ts')}, {HOUR_PART.format(c='ts')} FROM events",
    "append_ingest_partitioned": f"""
      SELECT '2024' AS year, '01' AS month,
             CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '15' ELSE '31' END AS day,
             '00' AS hour, *
      FROM {ODD}""",
    "append_key_partitioned": f"SELECT * FROM {ODD}",
    "snapshot_manifest": f"""
      SELECT label, {PER_PART}
      FROM (SELECT CASE event_type WHEN 'click' THEN 'c:lick' WHEN 'error' THEN '100 %' WHEN 'view' THEN 'v/i ew+1'
                        WHEN 'signup' THEN NULL ELSE event_type END AS label,
                   CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM events)
      GROUP BY label""",
    "external_table_sync": f"""
      SELECT event_type AS listed, event_type, {PER_PART} FROM events WHERE event_type <> 'error' GROUP BY event_type""",
    "partition_drop_insert": f"""
      SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1998 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority, {O_YEAR} FROM orders""",
    "retail_rebuild": f"""WITH {INVOICE_CTES},
      spend AS (SELECT c.c_custkey, c.c_name, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend
                FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL),
      sold AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem
               WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
                 SELECT c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                 WHERE n.n_name = '{POPULAR_COUNTRY}')) GROUP BY l_partkey)
      SELECT 'cleaned' AS table_role, Country AS key, UnitPrice AS amount FROM clean
      UNION ALL SELECT 'summary', c_name, total_spend FROM spend
      UNION ALL (SELECT 'top', c_name, total_spend FROM spend ORDER BY total_spend DESC, c_custkey LIMIT {TOP_K})
      UNION ALL (SELECT 'popular', p_name, qty FROM sold JOIN part ON l_partkey = p_partkey
                 ORDER BY qty DESC, l_partkey LIMIT {TOP_K})""",
    "taxi_style_refresh": """
      SELECT 'yellow' AS taxi_type, c_custkey AS party_key, c_name AS name, c_acctbal AS acctbal,
             c_nationkey AS partition_column FROM customer
      UNION
      SELECT 'green', s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier""",
}

