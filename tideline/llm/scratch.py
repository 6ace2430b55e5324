"""Tables written in the shared folder, to cut lineage and keep results.

A later stage, or a task run again after a lost executor, reads the files
instead of computing them anew. (``DataFrame.checkpoint`` would do as well,
but keeps the optimiser's constraints, whose number multiplies in a loop that
renames columns.)
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tideline.session import shared_root, unique_name, workdir


class Scratch:
    """A new folder under ``spark.checkpoint.dir`` and the tables of one run.

    Joins with a ``merged`` run's tables sort and merge. Spark knows a table by
    the size of its files, and one it would broadcast for that may take ten
    times as much as a hash table in the driver, more with every row.
    """

    def __init__(self, spark: SparkSession, name: str, merged: bool = False):
        shared_root(spark)
        self.spark, self.path, self.n, self.merged = spark, workdir(spark, name), 0, merged
        self.paths: dict[int, str] = {}
        self.tables: dict[int, str] = {}
        self.frames: list[DataFrame] = []  # so that an id stands for one table

    def keep(self, df: DataFrame, large: bool = False) -> DataFrame:
        """``df``, written and read back.

        Spark deletes the shuffle files of a plan once the driver's garbage
        collector finds it unused, which may be long after; with ``large``
        that is asked for at once, as the next steps need the disk.
        """
        self.n += 1
        path = f"{self.path}/{self.n:04d}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        if self.merged:
            kept = kept.hint("merge")
        self.paths[id(kept)] = path
        self.frames.append(kept)
        if large:
            del df
            self._collect()
        return kept

    def _collect(self) -> None:
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def bucketed(self, df: DataFrame, col: str, n: int, large: bool = False) -> DataFrame:
        """``df``, written in ``n`` buckets by ``col``, so joins on it leave these rows where they are.

        The catalog knows it by a name of its own until it is dropped; ``large`` as in ``keep``.
        """
        self.n += 1
        path, name = f"{self.path}/{self.n:04d}", unique_name("scratch")
        df.write.format("parquet").bucketBy(n, col).option("path", path).saveAsTable(name)
        kept = self.spark.table(name)
        self.paths[id(kept)], self.tables[id(kept)] = path, name
        self.frames.append(kept)
        if large:
            del df
            self._collect()
        return kept

    def drop(self, *kept: DataFrame) -> None:
        """Delete tables that nothing will read any more (what came of them is written)."""
        jvm = self.spark.sparkContext._jvm
        for df in kept:
            if id(df) in self.tables:
                self.spark.sql(f"DROP TABLE {self.tables.pop(id(df))}")
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
