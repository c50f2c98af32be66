"""Small plan-shaping helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that later filters and projections reuse their values.

    A filter on a projected column is pushed below the projection and evaluates the
    expression again. A one-element ``inline`` is a barrier for that rewrite: the value is
    made once per row.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(packed)))


def fan_out(df: DataFrame, array: str, *names: str, keep: list[str] | None = None,
            position: bool = False) -> DataFrame:
    """One row per array item; rows with an empty or null array disappear.

    A plain ``explode`` of a computed array makes the optimizer filter on its size below
    the projection, which evaluates the array twice. The outer form is not rewritten; the
    filter on the item then works on the finished value.
    """
    kept = [c for c in df.columns if c != array] if keep is None else keep
    explode = F.posexplode_outer if position else F.explode_outer
    out = df.select(*kept, explode(array).alias(*names))
    return out.filter(F.col(names[-1]).isNotNull())


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union all; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
