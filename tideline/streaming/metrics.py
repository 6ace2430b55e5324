"""Figures of streaming runs: a listener that keeps one row per micro-batch,
and the rows left in a query's state."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS = ("query_id STRING, batch_id BIGINT, watermark STRING, input_rows BIGINT, observed MAP<STRING, BIGINT>, "
           "state_rows BIGINT, late_groups BIGINT")


class BatchMetrics(StreamingQueryListener):
    """One row per micro-batch of the queries it watches (columns of ``METRICS``).

    ``observed`` holds what the query's ``observe`` counted in the batch,
    ``watermark`` the one the batch ran with. ``late_groups`` is Spark's own
    counter, which sums late rows per task and key before it counts; see
    ``late_rows`` for rows. Works for queries that never end: ``write`` appends
    what has come since the last call.

    Register with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self.rows: list[tuple] = []
        self.written = 0
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        observed = {k: int(v) for m in (p.get("observedMetrics") or {}).values() for k, v in m.items() if v is not None}
        ops = p.get("stateOperators") or []
        self.rows.append((p["id"], p["batchId"], (p.get("eventTime") or {}).get("watermark"), p.get("numInputRows") or 0,
                          observed, sum(o["numRowsTotal"] for o in ops), sum(o["numRowsDroppedByWatermark"] for o in ops)))

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, *queries: StreamingQuery, timeout: float = 60) -> None:
        """Until the last event of these ended queries has come (events arrive a little after the fact)."""
        for q in queries:
            if not self._end(q.runId).wait(timeout):
                raise TimeoutError(f"no end event of query {q.id}")

    def observed(self, name: str) -> int:
        """The sum of one observed count over all batches."""
        return sum(r[4].get(name, 0) for r in self.rows)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRICS)

    def write(self, spark: SparkSession, path: str) -> None:
        """Append the batches since the last call to a metrics table."""
        new = self.rows[self.written:]
        if new:
            spark.createDataFrame(new, METRICS).coalesce(1).write.mode("append").parquet(path)
            self.written += len(new)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """What a stopped query's stateful operator holds: the fields of its keys, then ``state`` (the buffered value).

    Read by the state data source from the checkpoint's last committed batch.
    ``options`` go to it, e.g. ``joinSide="left"`` for a stream-stream join.
    """
    r = spark.read.format("statestore").option("operatorId", operator)
    for k, v in options.items():
        r = r.option(k, v)
    s = r.load(checkpoint)
    return s.select("key.*", s["value"].alias("state"), "partition_id")
