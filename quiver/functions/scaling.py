"""Min-max scaling of a value against its window minimum and maximum."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def minmax_scale(x: Column, mn: Column, mx: Column, lo: float = 0.0, hi: float = 1.0,
                 degenerate: str = "nan") -> Column:
    """lo + (x - mn) * (hi - lo) / (mx - mn).

    A constant feature (mx = mn) never divides (ANSI mode would raise):
    'nan' gives NaN, 'zero' gives ``lo``; 'drop' also yields NaN here and the
    caller removes the symbol.
    """
    span = F.lit(float(hi) - float(lo))
    scaled = F.lit(float(lo)) + (x - mn) * span / (mx - mn)
    fallback = F.lit(float(lo)) if degenerate == "zero" else F.lit(float("nan"))
    return F.when(mx == mn, fallback).otherwise(scaled)
