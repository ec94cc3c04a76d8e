"""Numeric helpers shared by metrics, features and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; a missing value stays missing."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Missing instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return safe_div(part.cast("double") * 100.0, whole)


def count_if(condition: Column) -> Column:
    """Rows meeting the condition; unknown counts as no."""
    return F.count(F.when(condition, F.lit(1)))


def band(c: Column, edges, labels) -> Column:
    """First label whose upper edge lies above the value; the last label takes the rest."""
    if len(labels) != len(edges) + 1:
        raise ValueError("a band needs one label more than it has edges")
    out = None
    for edge, label in zip(edges, labels):
        out = F.when(c < edge, label) if out is None else out.when(c < edge, label)
    return out.otherwise(labels[-1])

