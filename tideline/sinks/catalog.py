"""Catalog tables: CTAS, INSERT, partition replace/test/drop, repair, manifest.

Plain Spark SQL on ``USING parquet`` tables (no Hive needed); every table
gets an explicit location so nothing lands in a machine-local warehouse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _spec(spec: Mapping[str, object]) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "\\'") + "'"
    return ", ".join(f"`{k}` = {lit(v)}" for k, v in spec.items())


def create_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def ctas(spark: SparkSession, table: str, df: DataFrame, partition_by: Sequence[str] = (),
         location: str | None = None, fmt: str = "parquet") -> None:
    """``CREATE TABLE t USING parquet PARTITIONED BY (…) [LOCATION] AS SELECT …``
    (rows regrouped by the partition columns first, see ``files.rebalanced``)."""
    from tideline.sinks.files import rebalanced
    view = f"_ctas_src_{abs(hash(table))}"
    rebalanced(df, partition_by).createOrReplaceTempView(view)
    part = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    loc = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {_q(table)} USING {fmt} {part} {loc} AS SELECT * FROM `{view}`")
    spark.catalog.dropTempView(view)


def rebuild_table(df: DataFrame, table: str, location: str,
                  partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full rebuild of a catalog table at ``location``: every old row goes,
    including partitions the new rows lack (the output is cleared first, then
    rebuilt). Static overwrite is set for the write, so a session whose
    default is dynamic does not keep stale partitions.
    """
    from tideline.sinks.files import rebalanced
    w = (rebalanced(df, partition_by).write.format(fmt).mode("overwrite")
         .option("partitionOverwriteMode", "static").option("path", location))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``INSERT INTO t SELECT …``: columns by position, as SQL does (rows
    regrouped by the table's partition columns first)."""
    _regrouped(df, table).write.insertInto(table, overwrite=overwrite)


def _regrouped(df: DataFrame, table: str) -> DataFrame:
    from tideline.sinks.files import rebalanced
    spark = df.sparkSession
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    place = {name: i for i, name in enumerate(spark.table(table).columns)}
    return rebalanced(df, [df.columns[place[p]] for p in parts])


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions present in ``df``; others stay as they are.

    Dynamic partition overwrite: delete-then-insert of today's partition in
    one step, idempotent when re-run with the same rows. ``insertInto`` does
    not take the mode as a write option, so the session setting is set for
    the write (a session left in static mode would wipe the whole table).
    """
    from tideline.session import DYNAMIC_OVERWRITE, session_conf
    df = _regrouped(df, table)
    with session_conf(df.sparkSession, DYNAMIC_OVERWRITE):
        df.write.insertInto(table, overwrite=True)


def partition_exists(spark: SparkSession, table: str, spec: Mapping[str, object]) -> bool:
    return len(spark.sql(f"SHOW PARTITIONS {_q(table)} PARTITION ({_spec(spec)})").take(1)) > 0


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    """Remove one partition from the catalog (and its files for managed tables)."""
    spark.sql(f"ALTER TABLE {_q(table)} DROP IF EXISTS PARTITION ({_spec(spec)})")


def create_external(spark: SparkSession, table: str, schema_ddl: str,
                    partition_by: Sequence[str], location: str, fmt: str = "parquet") -> None:
    """Register existing files as a partitioned table (no partition is known yet)."""
    part = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {_q(table)} ({schema_ddl}) USING {fmt} {part} LOCATION '{location}'")


def repair(spark: SparkSession, table: str) -> None:
    """Register partitions found on storage (``MSCK REPAIR TABLE``)."""
    spark.sql(f"MSCK REPAIR TABLE {_q(table)}")


def sync(spark: SparkSession, table: str) -> None:
    """Make the partitions those found on storage: new ones are registered, those whose folder is gone are forgotten."""
    spark.sql(f"MSCK REPAIR TABLE {_q(table)} SYNC PARTITIONS")


def delete_prefix(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all below it; whether there was one."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(table)}")


def file_path() -> Column:
    """The file a row was read from, as storage names it (``_metadata.file_path`` is a URI, with escapes)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def manifest(table: DataFrame, partition: str) -> DataFrame:
    """(partition value, path, length) of the data files of a table read from files.

    The value is the column's, not cut out of the path, so names that storage
    escapes (``:``, ``%``, null) come out right. Only footers are read.
    """
    return table.select(F.col(partition), file_path().alias("path"), F.col("_metadata.file_size").alias("length")).distinct()


def write_manifest(table: DataFrame, path: str, partition: str, changed: Column | None = None) -> None:
    """Write the manifest as text files, one folder per value of ``partition``.

    With ``changed`` (a condition on the partition column) only those
    partitions are listed and rewritten, the manifests of the others stay; a
    partition that lost all its files needs a full one.
    """
    rows = manifest(table if changed is None else table.where(changed), partition)
    mode = "static" if changed is None else "dynamic"
    (rows.drop("length").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(partition).text(path))


def read_manifested(table: DataFrame, path: str) -> DataFrame:
    """The rows of the table's files that a manifest names (a semi join in Spark; no listing on the driver)."""
    listed = table.sparkSession.read.text(path).select(F.col("value").alias("_listed")).distinct()
    return (table.select("*", file_path().alias("_file")).join(listed, F.col("_file") == F.col("_listed"), "left_semi")
            .drop("_file"))
