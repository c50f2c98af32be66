"""Keep-first de-duplication as an aggregation.

``min(struct(order, rest))`` collapses copies on the map side, so a group that holds a
third of all rows reaches the reducer as one row per map task. A window with
``row_number`` would send every copy to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``; null keys form one group."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and set(order) <= set(keys):
        return keep_any(df, keys)
    first = F.min(F.struct(*[c for c in order if c not in keys], *rest)).alias("_first")
    # The 64-bit hash leads the sort, so long text keys are rarely compared in full.
    hashed = F.xxhash64(*keys).alias("_key_hash")
    kept = df.groupBy(hashed, *keys).agg(first)
    return kept.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For frames where the kept row does not matter."""
    return df.dropDuplicates(list(keys))
