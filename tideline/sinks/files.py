"""File writers: partitioned batch writes, ``foreachBatch`` callbacks, and the
exactly-once stream append (file sink)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.timeparts import with_time_parts
from tideline.streaming.runner import start

BatchFn = Callable[[DataFrame, int], None]


def guarded(fn: BatchFn) -> BatchFn:
    """Skip a micro-batch with no rows.

    The batch is persisted for the call: ``isEmpty`` computes (and caches)
    only the partitions it needs to find one row, and the sink reuses them,
    so a batch is evaluated once — ``count() > 0`` then write would run a
    stateful batch plan twice.
    """
    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if not df.isEmpty():
                fn(df, batch_id)
        finally:
            df.unpersist()
    return run


def rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows regrouped by the output partition columns before a partitioned
    write (the ``REBALANCE`` hint), when AQE is on.

    Without it every writing task opens a file in every partition value it
    holds: tasks x partitions files, a small-file flood at scale. With it,
    AQE hashes rows by ``cols``, coalesces small groups, and splits a value
    that holds a third of the rows into advisory-size chunks written in
    parallel, so a partition gets about ``size / advisory size`` files.
    Streams (see ``grouped``) and sessions without AQE are returned unchanged (there the hint
    would be a plain hash repartition that puts a hot value in one task).
    """
    cols = list(cols)
    if not cols or df.isStreaming:
        return df
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        return df
    return df.hint("rebalance", *cols)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                       fmt: str = "parquet", mode: str = "append",
                       options: Mapping[str, str] | None = None,
                       rebalance: bool = True) -> None:
    """Append (or write) ``df`` under ``path`` as a hive-partitioned table.

    By default the rows are first regrouped by the partition columns
    (:func:`rebalanced`): one partition value is written by as few tasks as
    its size needs, and a value holding a third of the rows is still written
    in parallel. Set ``spark.sql.files.maxRecordsPerFile`` to bound file size.
    """
    if rebalance:
        df = rebalanced(df, partition_by)
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_ingest_partitioned(df: DataFrame, path: str, at=None,
                              parts=("year", "month", "day", "hour"), fmt: str = "parquet",
                              two_digit_year: bool = False) -> None:
    """Add ingest-time parts (``at``: instant or ``None`` = now) and append."""
    append_partitioned(with_time_parts(df, at, parts, two_digit_year=two_digit_year),
                       path, list(parts), fmt)


def archive_by_time(df: DataFrame, path: str, at=None, prefix: str = "ingest_",
                    parts=("year", "month", "day", "hour"), fmt: str = "parquet") -> None:
    """Archive rows under ``<prefix>year=YYYY/<prefix>month=MM/…`` (zero padded).

    ``at`` is an event-time column name (repeatable) or an instant / ``None``
    for the wall clock at write time.
    """
    cols = [f"{prefix}{p}" for p in parts]
    append_partitioned(with_time_parts(df, at, parts, prefix=prefix), path, cols, fmt)


def grouped(df: DataFrame, cols: Sequence[str], spread: int = 1) -> DataFrame:
    """Rows regrouped by the output partition columns by an explicit shuffle, for streams.

    A value's rows meet in ``spread`` tasks at most (dealt by a hash of the
    row, so a task that is run again writes the same rows): a batch has
    ``values * spread`` files at most. Raise ``spread`` where one value holds
    much of a batch.
    """
    cols = list(cols)
    if not cols:
        return df
    if spread <= 1:
        return df.repartition(*cols)
    rest = [c for c in df.columns if c not in cols]
    return df.repartition(*cols, F.pmod(F.xxhash64(*rest), F.lit(spread)))


def stream_append(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                  fmt: str = "parquet", trigger: dict | None = None, spread: int | None = None) -> StreamingQuery:
    """Append a stream to a table folder through Spark's file sink: exactly once.

    At commit each micro-batch's files are listed in the folder's
    ``_spark_metadata`` log; a batch replayed after a restart is skipped
    (its id is already there), and readers of the folder (``spark.read``,
    ``readStream``) see only committed files, so a task or job that died
    half-way leaves nothing visible. Empty batches write no files. Ingest-time
    columns made on the stream with ``with_time_parts(df, None)`` take the
    batch timestamp recorded in the offset log, so a replayed batch lands in
    the same partitions. Starts the query (``availableNow`` by default).
    With ``spread`` rows are regrouped by the path columns first
    (:func:`grouped`), which pays where a batch has many values of them.
    """
    if spread:
        df = grouped(df, partition_by, spread)
    return start(df, checkpoint, fmt=fmt, path=path, partition_by=partition_by, trigger=trigger)


def batch_writer(fmt: str, mode: str = "append", path: str | None = None,
                 options: Mapping[str, str] | None = None,
                 partition_by: Sequence[str] = (), batch_col: str | None = "batch_id") -> BatchFn:
    """A ``foreachBatch`` callback that appends each non-empty batch through
    any batch data source (``jdbc`` for a warehouse table, ``parquet``…).

    With a ``path`` (file formats) the batch goes to its own ``batch_col=<id>``
    partition by dynamic partition overwrite: a batch replayed after a restart
    replaces the files it wrote before instead of adding a second copy, so the
    table ends up exactly once. Without a path (``jdbc``) the append is at
    least once; de-duplicate on the warehouse side (e.g. stage + MERGE).
    """
    def run(df: DataFrame, batch_id: int) -> None:
        parts = list(partition_by)
        w_mode = mode
        extra = dict(options or {})
        if path and batch_col:
            df = df.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
            parts.append(batch_col)
            w_mode = "overwrite"
            extra["partitionOverwriteMode"] = "dynamic"
        w = df.write.format(fmt).mode(w_mode).options(**extra)
        if parts:
            w = w.partitionBy(*parts)
        w.save(path) if path else w.save()
    return guarded(run)
