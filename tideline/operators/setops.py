"""Tagged union of tables with the same column layout."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(branches: Mapping[str, DataFrame], tag_col: str,
                 distinct: bool = True) -> DataFrame:
    """``SELECT '<tag>' AS tag_col, * FROM t1 UNION [ALL] SELECT '<tag2>', * FROM t2 …``.

    Columns line up by position, as in SQL. With ``distinct`` (SQL
    ``UNION``) duplicates collapse; since tags differ, only duplicates inside
    one branch do. The distinct is a hash aggregate with map-side combine.
    """
    parts = [df.select(F.lit(tag).alias(tag_col), "*") for tag, df in branches.items()]
    out = reduce(DataFrame.union, parts)
    return out.distinct() if distinct else out
