"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c: str | Column) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | Column,
                   tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the greatest ``order_by`` (then ``tie_break``, all descending).

    ``row_number() = 1`` lets Catalyst plan a ``WindowGroupLimit``: each map
    task keeps only its best row per key before the shuffle, so a key that
    holds a third of the rows still ships at most one row per task.
    Give ``tie_break`` columns to make the winner deterministic when the
    ordering value repeats. Batch only (Spark rejects non-time windows on
    streams); on a stream, call it inside ``foreachBatch``.
    """
    w = Window.partitionBy(*keys).orderBy(_desc(order_by), *[_desc(c) for c in tie_break])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_semi(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows whose ``ts`` equals the maximum ``ts`` of their key (ties all kept).

    ``rank() = 1`` over one shuffle; each map task keeps only the rows that
    tie for its own maximum (``WindowGroupLimit``). Rows with a NULL key or
    time never match, as in a join on them.
    """
    rows = df.dropna(subset=[*keys, ts])
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return rows.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def latest_state(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` (compared in turn, nulls least) of every key, as an aggregate.

    On a stream it is stateful: in ``update`` mode a micro-batch emits the keys
    whose rows it saw, each with its latest row over all batches so far. State
    is one row per key and never shrinks (there is no time after which a key
    could not come again); rows with a null key are left out. Ties go to the
    greatest row, by all its columns in order.
    """
    cols = df.columns
    order = F.struct(*order_by, *[c for c in cols if c not in order_by])
    return (df.dropna(subset=list(keys)).groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
            .agg(F.max_by(F.struct(*cols), order).alias("_row")).select("_row.*"))
