"""MERGE semantics (update-all on key match, insert-all otherwise) on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(base: DataFrame, updates: DataFrame, keys: Sequence[str],
               only_newer: str | Sequence[str] = ()) -> DataFrame:
    """Base rows whose key is not in ``updates``, plus all of ``updates``.

    ``updates`` must hold at most one row per key (run ``latest_per_key``
    first). Keys compare with plain equality, so a NULL key never matches:
    base keeps its NULL-key rows and every NULL-key update is inserted, as
    MERGE does. By default the update always wins (last batch wins); with
    ``only_newer=<columns>`` (compared in order) an update older than the stored row is
    ignored. Columns are matched by name.

    Both joins are keyed anti/semi joins on unique keys, so no key can be
    skewed on either side.
    """
    keys = list(keys)
    order = [only_newer] if isinstance(only_newer, str) else list(only_newer)
    if order:
        stale = (updates.select(*keys, F.struct(*order).alias("_new"))
                 .join(base.select(*keys, F.struct(*order).alias("_old")), keys, "inner")
                 .filter(F.col("_new") < F.col("_old"))
                 .select(*keys))
        updates = updates.join(stale, keys, "left_anti")
    kept = base.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates)
