"""Batch inputs: parquet tables by name and small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tideline.session import prepare


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; Catalyst prunes columns and pushes filters."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def inline_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str],
                 schema: str | None = None) -> DataFrame:
    """A literal table (its size is fixed by the code that lists it)."""
    return spark.createDataFrame(list(rows), schema=schema or list(columns))
