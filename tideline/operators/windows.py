"""Sums over tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_sum(df: DataFrame, keys: Sequence[str], ts: str, size: str,
                 value: str | Column, out: str = "total", delay: str | None = None,
                 exact_scale: int | None = 4, count: str | None = None) -> DataFrame:
    """``sum(value)`` per keys and tumbling ``window(ts, size)``.

    Returns ``keys…, start, end, out``; windows are epoch-aligned and
    half-open ``[start, end)``; rows with a NULL time fall in no window.
    With ``delay`` the input gets a watermark: on a stream in append mode a
    window is written once, when the watermark passes its end, and older
    rows are dropped. With ``exact_scale`` the sum runs in decimal and is
    returned as double, so the total does not depend on partitioning or
    addition order: a column name is cast to ``decimal(18, exact_scale)``,
    a Column expression is summed as given (make it decimal yourself).
    Partial aggregation runs before the shuffle, so hot keys cost nothing
    extra. ``start``/``end`` are TIMESTAMP_NTZ (UTC). ``count`` names a
    column with the rows of each window.
    """
    v = F.col(value) if isinstance(value, str) else value
    if exact_scale is not None:
        v = v.cast(f"decimal(18,{exact_scale})") if isinstance(value, str) else v
    if delay:
        df = df.withWatermark(ts, delay)
    agg = F.sum(v)
    if exact_scale is not None:
        agg = agg.cast("double")
    g = df.groupBy(*keys, F.window(ts, size).alias("_w")).agg(
        agg.alias(out), *([F.count(F.lit(1)).alias(count)] if count else []))
    return g.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("start"),
                    F.col("_w.end").cast("timestamp_ntz").alias("end"), out, *([count] if count else []))
