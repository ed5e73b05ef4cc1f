"""Numeric column expressions used by the classifier and its measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brindle.functions.text import as_column

# Upper bounds of the error-rate buckets.
RATE_BOUNDS = [0.0001, 0.0002, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0]


def sigmoid(x: str | Column) -> Column:
    return 1.0 / (1.0 + F.exp(-as_column(x)))


def logit(p: str | Column) -> Column:
    """ln(p / (1-p)); NULL at 0 and 1, where it has no finite value."""
    p = as_column(p)
    return F.when((p > 0) & (p < 1), F.ln(p / (1 - p)))


def unlogit(x: str | Column) -> Column:
    return sigmoid(x)


def rate_bucket(rate: str | Column) -> Column:
    """Index of the first bound that is not below the rate; the last bucket takes the rest."""
    rate = as_column(rate)
    bucket = F.when(rate <= RATE_BOUNDS[0], 0)
    for index, bound in enumerate(RATE_BOUNDS[1:-1], start=1):
        bucket = bucket.when(rate <= bound, index)
    return bucket.otherwise(len(RATE_BOUNDS) - 1)


def fixed_point(x: str | Column, digits: int = 5) -> Column:
    return F.format_string(f"%.{digits}f", as_column(x))
