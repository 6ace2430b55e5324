"""Replaying a table as a stream of arriving files.

The rows are cut into time slices (``days`` calendar days each, counted from
the first day of the data) and written once, partitioned by slice, to a
staging folder. ``deliver(i)`` then appends slice ``i`` to the landing folder
a stream source watches. Running the stream to the end of what is available
after each delivery gives a deterministic arrival order (no reliance on file
modification times), on any shared file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import workdir


class Feed:
    def __init__(self, spark: SparkSession, df: DataFrame, ts_col: str, days: int,
                 fmt: str = "parquet", name: str = "feed"):
        self.spark, self.fmt = spark, fmt
        self.schema = df.withColumn("_slice", F.lit(None).cast("bigint")).schema
        self.staging = workdir(spark, f"{name}-staging")
        self.landing = workdir(spark, f"{name}-landing")
        bounds = df.agg(F.min(F.to_date(ts_col)).alias("lo"),
                        F.max(F.to_date(ts_col)).alias("hi"),
                        F.count_if(F.col(ts_col).isNull()).alias("undated")).first()
        self.slices: list[int | None] = [None]
        if bounds["lo"] is None:  # no row has a time
            df.withColumn("_slice", F.lit(None).cast("bigint")).write.partitionBy("_slice").parquet(self.staging)
            return
        lo = F.lit(bounds["lo"]).cast("date")
        sliced = df.withColumn("_slice", F.floor(F.datediff(F.to_date(ts_col), lo) / days))
        sliced.write.partitionBy("_slice").parquet(self.staging)
        n = (bounds["hi"] - bounds["lo"]).days // days + 1
        self.slices = [*range(n), *([None] if bounds["undated"] else [])]

    def slice(self, i: int | None) -> DataFrame:
        """Rows of slice ``i`` (a partition-pruned read of the staging copy);
        ``None``, the last slice, has the rows without a time."""
        staged = self.spark.read.schema(self.schema).parquet(self.staging)
        return staged.filter(F.col("_slice").eqNullSafe(F.lit(i).cast("bigint"))).drop("_slice")

    def deliver(self, i: int | None) -> None:
        part = self.slice(i)
        if self.fmt == "text":
            part.select("value").write.mode("append").text(self.landing)
        else:
            part.write.mode("append").format(self.fmt).save(self.landing)

