"""A keyed table that takes upserts as appends and resolves them on read.

Each batch is appended under its own ``log/writer=<id>/batch=<id>`` folder by a
dynamic partition overwrite, with a sequence number. Reading keeps one row per
key: the last write, or with ``newest`` the greatest of those columns (ties:
the last write). So an upsert costs what its batch holds, whatever the size of
the table; several writers never touch each other's folders; a batch replayed
after a crash replaces its own folder and nothing else, under the number it
had; and a new or reset checkpoint is a new writer, whose batch 0 is its own.

``compact`` may run while writers write. It folds the batches it finds into a
fresh ``base/v<n>``, lists them in ``ledger/v<n>`` (with those folded before),
and points the catalog table at the new base (``ALTER TABLE … SET LOCATION``),
which makes both visible at once. A reader takes the base and the batches that
the ledger of that base lacks, so a batch that arrives meanwhile is read from
the log, and a folded batch that is replayed later changes nothing: it is in
the ledger. Base rows keep their batch and number, so a batch with a smaller
number that was not folded loses to them as it would have before. ``vacuum``
deletes the folders of folded batches; readers of an older base need them.

The columns of the table are those of all its batches, by name: a column that
a batch lacks is null in its rows (a row is replaced whole), one that it adds
is null in older rows, and one whose type changed is refused. They are kept as
the schemas of empty files under ``columns``, which writers only add to.

The order of two writers' batches is that of the clocks of their drivers; give
``newest`` where rows can say themselves which is later. A row with a NULL key
can't be matched later, so it is not stored (pipelines count or divert such
rows before).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.latest import latest_per_key

SEQ = "_seq"
LOG_COLS = ("writer", "batch", SEQ)
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def absent(e: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path (yet)."""
    return (e.getCondition() or "").split(".")[0] in ABSENT


class KeyedTable:
    """A keyed table at ``path``; with ``name`` the catalog says which base is in use."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], newest: Sequence[str] = (),
                 name: str | None = None):
        self.spark, self.root, self.keys, self.newest, self.name = spark, path.rstrip("/"), list(keys), list(newest), name

    @property
    def version(self) -> str | None:
        """The base in use, if there is one."""
        if not self.name or not self.spark.catalog.tableExists(self.name):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"].rstrip("/").rsplit("/", 1)[1]

    @property
    def path(self) -> str:
        """The folder of the base in use, before the first compaction that of the log."""
        return f"{self.root}/base/{self.version}" if self.version else f"{self.root}/log"

    def _read(self, folder: str, schema: T.StructType | str | None = None) -> DataFrame | None:
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.option("mergeSchema", schema is None).parquet(f"{self.root}/{folder}")
        except AnalysisException as e:
            if absent(e):
                return None
            raise

    # ---- columns --------------------------------------------------------

    def columns(self) -> T.StructType:
        """The columns of all batches so far, in the order they came (none before the first)."""
        seen = self._read("columns")
        fields = [] if seen is None else sorted(seen.schema, key=lambda f: f.metadata["since"])
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def _by_name(self, updates: DataFrame) -> DataFrame:
        """``updates`` under the table's column names; new columns are added to the table."""
        known = {f.name.lower(): f for f in self.columns()}
        new = []
        for f in updates.schema:
            if f.name.lower() in LOG_COLS:
                raise ValueError(f"column {f.name} has the name of one of the table's own")
            old = known.get(f.name.lower())
            if old is None:
                new.append(T.StructField(f.name, f.dataType, metadata={"since": time.time_ns() + len(new)}))
            elif old.dataType.simpleString() != f.dataType.simpleString():
                raise ValueError(f"column {f.name} is {f.dataType.simpleString()}, in the table {old.dataType.simpleString()}")
        if new:
            self.spark.createDataFrame([], T.StructType(new)).write.mode("append").parquet(f"{self.root}/columns")
        names = [known[c.lower()].name if c.lower() in known else c for c in updates.columns]
        return updates.toDF(*names)

    def _schema(self) -> T.StructType:
        return T.StructType([*self.columns(), T.StructField(SEQ, T.LongType()), T.StructField("writer", T.StringType()),
                             T.StructField("batch", T.StringType())])

    # ---- reading --------------------------------------------------------

    def _ledger(self, version: str | None) -> DataFrame | None:
        return self._read(f"ledger/{version}", "writer STRING, batch STRING") if version else None

    def _unfolded(self, version: str | None) -> DataFrame | None:
        """The rows of the batches that the base lacks."""
        schema = self._schema()
        log = self._read("log", schema) if len(schema) > len(LOG_COLS) else None
        ledger = self._ledger(version)
        return log if log is None or ledger is None else log.join(ledger, ["writer", "batch"], "left_anti").select(schema.names)

    def _rows(self, version: str | None, unfolded: DataFrame | None) -> DataFrame | None:
        base = self._read(f"base/{version}", self._schema()) if version else None
        parts = [p for p in (base, unfolded) if p is not None]
        return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def exists(self) -> bool:
        version = self.version
        return self._rows(version, self._unfolded(version)) is not None

    def read(self) -> DataFrame:
        """The current row of every key."""
        version = self.version
        rows = self._rows(version, self._unfolded(version))
        if rows is None:
            raise FileNotFoundError(self.path)
        return self._current(rows).drop(*LOG_COLS)

    def _current(self, rows: DataFrame) -> DataFrame:
        order = [*self.newest, SEQ, "writer", "batch"]
        return latest_per_key(rows, self.keys, order[0], order[1:])

    # ---- writing --------------------------------------------------------

    def folded(self, writer: str, batch: str) -> bool:
        """Whether the base in use holds the batch."""
        ledger = self._ledger(self.version)
        return ledger is not None and not ledger.where((F.col("writer") == writer) & (F.col("batch") == batch)).isEmpty()

    def _sequence(self, writer: str, batch: str) -> int:
        """The number a replayed batch had, else the time in microseconds."""
        log = self._read(f"log/writer={writer}/batch={batch}", f"{SEQ} LONG")
        old = None if log is None else log.agg(F.min(SEQ)).first()[0]
        return time.time_ns() // 1000 if old is None else old

    def upsert(self, updates: DataFrame, writer: str | None = None, batch: int | str = 0) -> None:
        """Store ``updates`` (at most one row per key, rows with NULL keys are left out).

        (``writer``, ``batch``) names the batch: the same names replace it (or
        do nothing, once it is folded), new ones add to it. Without a writer
        the call is one of its own.
        """
        writer, batch = f"w{writer or uuid.uuid4().hex}", f"b{batch}"
        if self.folded(writer, batch):
            return
        has_key = F.lit(True)
        for k in self.keys:
            has_key = has_key & F.col(k).isNotNull()
        rows = self._by_name(updates).where(has_key).withColumns(
            {SEQ: F.lit(self._sequence(writer, batch)).cast("long"), "writer": F.lit(writer), "batch": F.lit(batch)})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("writer", "batch").parquet(f"{self.root}/log"))

    # ---- maintenance ----------------------------------------------------

    def compact(self) -> None:
        """Fold the batches written so far into a fresh base; needs ``name``.

        One compaction at a time; writers and readers may go on. If it dies
        before the switch, nothing has changed.
        """
        if not self.name:
            raise ValueError("compact needs a catalog name to switch")
        version = self.version
        fresh = self._unfolded(version)  # one listing of the log, for the rows and for the ledger
        if fresh is None:
            return
        number = f"v{time.time_ns() // 1000}"
        self._current(self._rows(version, fresh)).write.parquet(f"{self.root}/base/{number}")
        batches, before = fresh.select("writer", "batch").distinct(), self._ledger(version)
        (batches if before is None else before.unionAll(batches)).write.parquet(f"{self.root}/ledger/{number}")
        self._switch(f"{self.root}/base/{number}")

    def _switch(self, folder: str) -> None:
        schema = self._schema()
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet LOCATION '{folder}'")
            return
        have = {c.name.lower() for c in self.spark.catalog.listColumns(self.name)}
        more = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name.lower() not in have)
        if more:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({more})")
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")

    def vacuum(self) -> int:
        """Delete the log folders of folded batches; their number. Readers of an older base must be done.

        The names come from the driver's listing of the log (one per batch
        since the last call), the ledger keeps all of them.
        """
        ledger = self._ledger(self.version)
        if ledger is None:
            return 0
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        gone = 0
        for r in ledger.toLocalIterator():
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/log/writer={r.writer}/batch={r.batch}")
            gone += bool(folder.getFileSystem(conf).delete(folder, True))
        return gone


def upsert_sink(table: KeyedTable, order_by: str, tie_break: Sequence[str] = (),
                writer: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback: latest row per key of the batch, then upsert.

    The writer is the streaming query's id, which its checkpoint keeps: a
    restart replays its own batches, a new checkpoint is another writer. Give
    ``writer`` to call the sink outside a streaming query.
    """
    def run(df: DataFrame, batch_id: int) -> None:
        who = writer or df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not who:
            raise ValueError("no streaming query id here: give upsert_sink a writer")
        table.upsert(latest_per_key(df, table.keys, order_by, tie_break), writer=who.replace("-", ""), batch=batch_id)
    return run
