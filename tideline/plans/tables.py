"""Table maintenance flows: tagged union, CTAS, INSERT, partition replace,
external table + repair, partitioned appends, snapshot manifest, and the
tagged-union partition refresh (staging CTAS -> replace -> drop staging)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.timeparts import with_time_parts
from tideline.operators.setops import union_tagged
from tideline.plans.feeds import Feed
from tideline.plans.inputs import EVENT_DDL, odd_events
from tideline.session import unique_name, workdir
from tideline.sinks import catalog as cat
from tideline.sinks.files import append_ingest_partitioned as _append_ingest
from tideline.sinks.files import append_partitioned, archive_by_time, stream_append
from tideline.sources.streams import table_stream
from tideline.streaming.runner import finish


def _database(spark: SparkSession, prefix: str = "tl") -> str:
    name = unique_name(prefix)
    return cat.create_database(spark, name, workdir(spark, f"db-{name}"))


def balance_bands(customer: DataFrame, supplier: DataFrame) -> dict[str, DataFrame]:
    """Two tables with one layout: (nationkey, balance band of 1000)."""
    return {
        "customer": customer.select(F.col("c_nationkey").alias("nationkey"),
                                    F.floor(F.col("c_acctbal") / 1000).cast("bigint").alias("balance_band")),
        "supplier": supplier.select(F.col("s_nationkey").alias("nationkey"),
                                    F.floor(F.col("s_acctbal") / 1000).cast("bigint").alias("balance_band")),
    }


def union_tagged_distinct(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    return union_tagged(balance_bands(customer, supplier), "party_type", distinct=True)


def orders_by_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_year", F.year("o_orderdate"))


def ctas_partitioned(spark: SparkSession, orders: DataFrame) -> DataFrame:
    db = _database(spark)
    cat.ctas(spark, f"{db}.orders_by_year", orders_by_year(orders), ["o_year"])
    return spark.table(f"{db}.orders_by_year")


def insert_into_select(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """CTAS of the finished orders, then ``INSERT INTO … SELECT`` of all
    orders: INSERT appends, so finished orders are in the table twice."""
    db = _database(spark)
    t = f"{db}.orders_log"
    ob = orders_by_year(orders)
    cat.ctas(spark, t, ob.filter(F.col("o_orderstatus") == "F"), ["o_year"])
    cat.insert_into(ob.select(*spark.table(t).columns), t)
    return spark.table(t)


def refreshed_orders(orders: DataFrame, since: str) -> DataFrame:
    """A re-delivery of the partitions from ``since`` on: every order closed."""
    return (orders_by_year(orders)
            .filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
            .withColumn("o_orderstatus", F.lit("F")))


def replace_partition(spark: SparkSession, orders: DataFrame, since: str = "2000-01-01",
                      runs: int = 2) -> DataFrame:
    """Replace the partitions a re-delivery covers (dynamic overwrite), twice:
    the second run changes nothing, other partitions are untouched."""
    db = _database(spark)
    t = f"{db}.orders_by_year"
    cat.ctas(spark, t, orders_by_year(orders), ["o_year"])
    cols = spark.table(t).columns
    for _ in range(runs):
        cat.replace_partitions(refreshed_orders(orders, since).select(*cols), t)
    return spark.table(t)


def event_parts(events: DataFrame) -> DataFrame:
    """Events with event-time year/month/day/hour strings (the processed layout)."""
    return with_time_parts(events, "ts")


def external_table_repair(spark: SparkSession, events: DataFrame,
                          report: dict | None = None) -> DataFrame:
    """Files written first, then an external table over them (it sees no
    partition), then ``MSCK REPAIR TABLE`` registers every partition."""
    loc = workdir(spark, "processed-files")
    parts = ["year", "month", "day", "hour"]
    append_partitioned(event_parts(events), loc, parts)
    db = _database(spark)
    t = f"{db}.processed"
    cat.create_external(spark, t, EVENT_DDL + ", year STRING, month STRING, day STRING, hour STRING",
                        parts, loc)
    before = spark.table(t).isEmpty()
    cat.repair(spark, t)
    if report is not None:
        report["empty_before_repair"] = before
    return spark.table(t)


def _two_batches(events: DataFrame, split: str) -> tuple[DataFrame, DataFrame]:
    """The rows before ``split`` and the others, some of which have no time."""
    later = F.coalesce(F.col("ts") >= F.lit(split).cast("timestamp_ntz"), F.lit(True))
    odd = odd_events(events)
    return odd.where(~later), odd.where(later)


def _per_partition(df: DataFrame, parts: list[str]) -> DataFrame:
    return df.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"))


def append_ingest_partitioned(spark: SparkSession, events: DataFrame,
                              split: str = "2024-01-15",
                              ingest_at: tuple[str, str] = ("2024-01-15 00:05:00",
                                                            "2024-01-31 00:05:00")) -> DataFrame:
    """Two appends stamped with their ingest instants (given, so re-runs agree)."""
    path = workdir(spark, "raw-ingest")
    for batch, at in zip(_two_batches(events, split), ingest_at):
        _append_ingest(batch, path, at=at)
    back = spark.read.schema(EVENT_DDL + ", year STRING, month STRING, day STRING, hour STRING").parquet(path)
    return back


def append_key_partitioned(spark: SparkSession, events: DataFrame,
                           split: str = "2024-01-15") -> DataFrame:
    """Two appends partitioned by a business key (event type)."""
    path = workdir(spark, "raw-by-type")
    for batch in _two_batches(events, split):
        append_partitioned(batch, path, ["event_type"])
    return spark.read.schema(EVENT_DDL).parquet(path)


def odd_labels(events: DataFrame) -> DataFrame:
    """A partition column whose values storage has to escape, and null."""
    kind = F.col("event_type")
    return events.withColumn("label", F.when(kind == "click", "c:lick").when(kind == "error", "100 %").when(
        kind == "view", "v/i ew+1").when(kind != "signup", kind))


def snapshot_manifest(spark: SparkSession, events: DataFrame, split: str = "2024-01-15") -> DataFrame:
    """Text manifests of a partitioned table's files, one folder per partition
    value. One partition is then replaced (by its doubled values) and its
    manifest alone rewritten, and another gets files that no manifest names;
    the rows and values per partition, read through the manifests."""
    path = workdir(spark, "manifested")
    for batch in _two_batches(events, split):
        append_partitioned(odd_labels(batch), path, ["label"])
    table = lambda: spark.read.schema(EVENT_DDL + ", label STRING").option("basePath", path).parquet(path)
    cat.write_manifest(table(), f"{path}_manifest", "label")
    clicks = odd_labels(odd_events(events)).where("event_type = 'click'")
    append_partitioned(clicks.withColumn("value", F.col("value") * 2), path, ["label"], mode="overwrite",
                       options={"partitionOverwriteMode": "dynamic"})
    cat.write_manifest(table(), f"{path}_manifest", "label", changed=F.col("label") == "c:lick")
    append_partitioned(odd_labels(odd_events(events)).where("event_type = 'error'"), path, ["label"])  # not in the snapshot
    return _per_partition(cat.read_manifested(table(), f"{path}_manifest"), ["label"])


def external_table_sync(spark: SparkSession, events: DataFrame) -> DataFrame:
    """An external table whose catalog follows its folders: one partition's
    files are deleted, another's arrive, one sync registers the new one and
    forgets the old one. Returns the partitions the catalog has, with their rows."""
    loc, db = workdir(spark, "synced-files"), _database(spark)
    t = f"{db}.synced"
    append_partitioned(events.where("event_type <> 'view'"), loc, ["event_type"])
    cat.create_external(spark, t, EVENT_DDL, ["event_type"], loc)
    cat.sync(spark, t)
    cat.delete_prefix(spark, f"{loc}/event_type=error")
    append_partitioned(events.where("event_type = 'view'"), loc, ["event_type"])
    cat.sync(spark, t)
    listed = spark.sql(f"SHOW PARTITIONS {t}").select(F.regexp_replace("partition", "^event_type=", "").alias("listed"))
    counts = _per_partition(spark.table(t), ["event_type"])
    return listed.join(counts, listed["listed"] == counts["event_type"], "full").select(
        "listed", "event_type", "n_rows", "total_value")


def partition_drop_insert(spark: SparkSession, orders: DataFrame, year: int = 1998) -> DataFrame:
    """If the partition of ``year`` exists, drop it and its files, then insert its orders again, closed."""
    db = _database(spark)
    t = f"{db}.orders_by_year"
    cat.ctas(spark, t, orders_by_year(orders), ["o_year"])
    if cat.partition_exists(spark, t, {"o_year": year}):
        cat.drop_partition(spark, t, {"o_year": year})
    closed = orders_by_year(orders).where(F.col("o_year") == year).withColumn("o_orderstatus", F.lit("F"))
    cat.insert_into(closed.select(*spark.table(t).columns), t)
    return spark.table(t)


# ---- tagged-union partition refresh ---------------------------------------

PARTY_DDL = "party_key BIGINT, name STRING, acctbal DOUBLE, partition_column INT"


def parties(customer: DataFrame, supplier: DataFrame) -> dict[str, DataFrame]:
    return {
        "yellow": customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                  F.col("c_acctbal").alias("acctbal"),
                                  F.col("c_nationkey").alias("partition_column")),
        "green": supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                 F.col("s_acctbal").alias("acctbal"),
                                 F.col("s_nationkey").alias("partition_column")),
    }


def refresh_summary(spark: SparkSession, sources: dict[str, str], summary: str, db: str,
                    only: list | None = None) -> None:
    """One refresh: repair the source tables, CTAS a staging table from the
    tagged UNION, replace the summary partitions staging holds (all of them,
    or ``only`` those values), drop staging. Re-running gives the same table."""
    for t in sources.values():
        cat.repair(spark, t)
    staging = f"{db}.party_staging"
    cat.drop_table(spark, staging)
    tagged = union_tagged({tag: spark.table(t) for tag, t in sources.items()}, "taxi_type")
    cat.ctas(spark, staging, tagged, ["partition_column"],
             location=workdir(spark, "party-staging"))
    rows = spark.table(staging)
    if only is not None:
        rows = rows.filter(F.col("partition_column").isin(only))
    cat.replace_partitions(rows.select(*spark.table(summary).columns), summary)
    cat.drop_table(spark, staging)


def taxi_style_refresh(spark: SparkSession, customer: DataFrame, supplier: DataFrame,
                       runs: int = 2) -> DataFrame:
    db = _database(spark)
    sources = {}
    for tag, df in parties(customer, supplier).items():
        loc = workdir(spark, f"{tag}-files")
        append_partitioned(df, loc, ["partition_column"])
        t = f"{db}.{tag}_taxi"
        cat.create_external(spark, t, PARTY_DDL, ["partition_column"], loc)
        sources[tag] = t
    summary = f"{db}.party_summary"
    spark.sql(f"CREATE TABLE {summary} (taxi_type STRING, {PARTY_DDL}) USING parquet "
              f"PARTITIONED BY (partition_column) LOCATION '{workdir(spark, 'party-summary')}'")
    for _ in range(runs):
        refresh_summary(spark, sources, summary, db)
    return spark.table(summary)


def archive_by_hour(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Events archived by event time under zero-padded ``ingest_*=`` folders, read back with them."""
    path = workdir(spark, "archive")
    archive_by_time(events, path, at="ts")
    return spark.read.schema(EVENT_DDL + ", " + ", ".join(f"{c} STRING" for c in ARCHIVE_PARTS)).parquet(path)


# ---- stream archive from a catalog table ------------------------------------

ARCHIVE_PARTS = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]


def stream_archive_by_hour(spark: SparkSession, events: DataFrame, days: int = 6) -> DataFrame:
    """Tail a catalog table as a stream; each micro-batch is archived
    (exactly once, file sink) under
    ``ingest_year=YYYY/ingest_month=MM/ingest_day=DD/ingest_hour=HH`` of its
    event time. Returns the archived rows with their path columns."""
    db = _database(spark)
    t = f"{db}.orderlog_landing"
    spark.sql(f"CREATE TABLE {t} ({EVENT_DDL}) USING parquet "
              f"LOCATION '{workdir(spark, 'orderlog-landing')}'")
    feed = Feed(spark, odd_events(events), "ts", days, name="orderlog")
    archive, ckpt = workdir(spark, "orderlog"), workdir(spark, "orderlog-ckpt")
    cols = spark.table(t).columns
    for i in feed.slices:
        cat.insert_into(feed.slice(i).select(*cols), t)
        src = table_stream(spark, t)
        stamped = with_time_parts(src, "ts", prefix="ingest_")
        finish(stream_append(stamped, archive, ckpt, ARCHIVE_PARTS, spread=1))
    back = spark.read.schema(EVENT_DDL + ", " + ", ".join(f"{c} STRING" for c in ARCHIVE_PARTS)).parquet(archive)
    return back.select(*cols, *ARCHIVE_PARTS)
