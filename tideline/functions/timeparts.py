"""Partition columns made from a point in time (ingest time or event time)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}


def _instant(at) -> Column:
    if at is None:
        return F.current_timestamp()
    if isinstance(at, Column):
        return at
    if isinstance(at, str):
        return F.to_timestamp(F.lit(at))
    if isinstance(at, _dt.datetime):
        return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    raise TypeError(f"unsupported instant {at!r}")


def with_time_parts(df: DataFrame, at=None, parts=("year", "month", "day", "hour"),
                    prefix: str = "", two_digit_year: bool = False) -> DataFrame:
    """Add zero-padded string columns ``<prefix><part>`` for a point in time.

    ``at`` is a column name/Column (event time), a literal instant
    (``datetime`` or text, ingest time fixed by the caller), or ``None`` for
    the wall clock at query time (the same value for every row of the query).
    """
    if isinstance(at, str) and at in df.columns:
        t = F.col(at).cast("timestamp")
    else:
        t = _instant(at)
    cols = {}
    for p in parts:
        pat = "yy" if (p == "year" and two_digit_year) else _PATTERNS[p]
        cols[f"{prefix}{p}"] = F.date_format(t, pat)
    return df.withColumns(cols)
