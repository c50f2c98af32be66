"""Closed-form statistics as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import _c

Z_95 = 1.96


def wilson_ci(correct: Column | str, n: Column | str, z: float = Z_95) -> tuple[Column, Column]:
    """Wilson score interval (low, high), clamped to [0, 1]; null for n = 0."""
    n_ = F.nullif(_c(n).cast("double"), F.lit(0.0))
    share = _c(correct).cast("double") / n_
    scale = F.lit(1.0) + F.lit(z * z) / n_
    centre = (share + F.lit(z * z) / (n_ * 2)) / scale
    half = F.sqrt((share * (F.lit(1.0) - share) + F.lit(z * z) / (n_ * 4)) / n_) * z / scale
    low = F.when(n_.isNotNull(), F.greatest(F.lit(0.0), centre - half))
    high = F.when(n_.isNotNull(), F.least(F.lit(1.0), centre + half))
    return low, high


def f1(tp: Column, n_true: Column, n_pred: Column) -> Column:
    """F1 of one class; 0 when the class has no true positive."""
    both = n_true + n_pred
    return F.when(both > 0, tp * 2.0 / both).otherwise(F.lit(0.0))
