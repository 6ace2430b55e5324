"""Write, audit, publish: a batch is visible only once its checks have passed.

``StagedAppend`` is a ``foreachBatch`` callback over a catalog table that is
partitioned by batch. A batch goes to a staging folder of its own, is read
back there and checked in one aggregation, and one catalog step (``ALTER TABLE
… ADD PARTITION``) publishes it. A batch that fails stays in its folder, with
its figures in the audit table, and no reader of the table ever sees it. A
batch replayed after a crash is staged again if it was not published, and left
alone if it was.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sinks.catalog import partition_exists

AUDIT = "n_rows BIGINT, n_bad MAP<STRING, BIGINT>, published BOOLEAN, batch_id BIGINT"


class AuditFailed(RuntimeError):
    """A batch did not pass its checks."""


class StagedAppend:
    """Appends batches to ``table`` (its partition column is ``batch_id``) under ``location``.

    ``checks`` name conditions that no row may meet; ``min_rows`` is the
    fewest rows a batch must have. With ``strict`` a failed batch raises
    (which ends a stream), else it is skipped and only recorded.
    """

    def __init__(self, table: str, location: str, checks: Mapping[str, Column] | None = None,
                 min_rows: int = 1, strict: bool = False):
        self.table, self.location, self.checks = table, location.rstrip("/"), dict(checks or {})
        self.min_rows, self.strict = min_rows, strict

    def create(self, spark: SparkSession, schema_ddl: str) -> None:
        """The target table, without a partition yet."""
        spark.sql(f"CREATE TABLE {self.table} ({schema_ddl}, batch_id BIGINT) USING parquet "
                  f"PARTITIONED BY (batch_id) LOCATION '{self.location}/published'")

    def folder(self, batch_id: int) -> str:
        return f"{self.location}/staging/batch-{batch_id}"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if partition_exists(spark, self.table, {"batch_id": batch_id}):
            return  # a replay of a batch that readers already see
        df.write.mode("overwrite").parquet(self.folder(batch_id))
        staged = spark.read.schema(df.schema).parquet(self.folder(batch_id))
        # a condition that is null for a row is not met
        found = staged.agg(F.count(F.lit(1)).alias("n_rows"),
                           *[F.count_if(c).alias(f"bad_{i}") for i, c in enumerate(self.checks.values())]).first()
        bad = {name: found[f"bad_{i}"] for i, name in enumerate(self.checks)}
        passed = found["n_rows"] >= self.min_rows and not any(bad.values())
        if passed:
            spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION (batch_id = {batch_id}) "
                      f"LOCATION '{self.folder(batch_id)}'")
        (spark.createDataFrame([(found["n_rows"], bad, passed, batch_id)], AUDIT).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
         .parquet(f"{self.location}/audit"))
        if not passed and self.strict:
            raise AuditFailed(f"batch {batch_id} of {self.table}: {found['n_rows']} rows, {bad}")

    def audit(self, spark: SparkSession) -> DataFrame:
        """Figures of every batch: rows, rows that met each check, whether it was published."""
        return spark.read.schema(AUDIT).parquet(f"{self.location}/audit")
