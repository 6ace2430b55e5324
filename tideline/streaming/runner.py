"""Starting, draining and inspecting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.session import session_conf


def start(df: DataFrame, checkpoint: str, fn: Callable | None = None,
          fmt: str | None = None, path: str | None = None, mode: str = "append",
          trigger: dict | None = None, partition_by: Sequence[str] = (),
          name: str | None = None, conf: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start a query with a checkpoint (restart resumes from it, exactly once
    for idempotent sinks). ``fn`` makes it a ``foreachBatch`` query; the
    default trigger drains what is available and stops (``availableNow``),
    pass e.g. ``{"processingTime": "60 seconds"}`` for a fixed cadence.

    A query keeps the session's settings of the moment it starts, some of them
    for good (Spark records them in the checkpoint). ``conf`` sets its own:
    ``spark.sql.shuffle.partitions`` to what its state needs, or
    ``spark.sql.streaming.multipleWatermarkPolicy`` to ``max`` where a
    slow input must not hold back the state of the others (its late rows are
    then lost; the default, ``min``, waits for the slowest).
    """
    if conf:
        with session_conf(df.sparkSession, dict(conf)):
            return start(df, checkpoint, fn, fmt, path, mode, trigger, partition_by, name)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if fn is not None:
        return w.foreachBatch(fn).start()
    w = w.format(fmt or "parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path) if path else w.start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries to end; at the first failure stop the others and raise it."""
    left = list(queries)
    while left:
        for q in list(left):
            if q.exception() is not None:
                for other in queries:
                    other.stop()
                raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")
            if not q.isActive:
                left.remove(q)
        if left:
            try:
                left[0].awaitTermination(0.2)
            except StreamingQueryException:
                pass  # reported above


@dataclass
class StreamSpec:
    """One query of a multi-topic application: own source, sink and checkpoint.

    The sink is ``fn`` (``foreachBatch``) or, without it, a file sink at
    ``path`` (exactly once, partitioned by ``partition_by``)."""
    source: DataFrame
    fn: Callable[[DataFrame, int], None] | None
    checkpoint: str
    trigger: dict | None = None
    mode: str = "append"
    name: str | None = None
    path: str | None = None
    partition_by: Sequence[str] = ()
    fmt: str = "parquet"


def run_all(specs: Sequence[StreamSpec], wait: bool = True) -> list[StreamingQuery]:
    """Start several independent queries on one session (they run concurrently)."""
    qs = [start(s.source, s.checkpoint, fn=s.fn, mode=s.mode, trigger=s.trigger, name=s.name,
                fmt=None if s.fn else s.fmt, path=s.path, partition_by=s.partition_by)
          for s in specs]
    if wait:
        finish(*qs)
    return qs
