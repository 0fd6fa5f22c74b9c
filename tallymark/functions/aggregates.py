"""Aggregate builders. Each one has a map-side partial form, so a hot group is reduced before the shuffle."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.conditional import as_column


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate holds; NULL counts as not holding."""
    return F.sum(F.when(predicate, 1).otherwise(0))


def sum_if(predicate: Column, value: Column | str) -> Column:
    return F.sum(F.when(predicate, as_column(value)).otherwise(0))


def signed_sum(kind: Column | str, value: Column | str, plus: Any, minus: Any) -> Column:
    """Adds values of one kind, subtracts those of another, ignores the rest."""
    kind, value = as_column(kind), as_column(value)
    return F.sum(F.when(kind == plus, value).when(kind == minus, -value).otherwise(0))


def count_distinct_if(predicate: Column, value: Column | str) -> Column:
    return F.countDistinct(F.when(predicate, as_column(value)))


def avg_round(value: Column | str, scale: int) -> Column:
    return F.round(F.avg(as_column(value)), scale)


def rate(predicate: Column, scale: int, factor: float = 1.0) -> Column:
    """Share of rows for which the predicate holds."""
    share = F.try_divide(factor * F.sum(F.when(predicate, 1).otherwise(0)), F.count(F.lit(1)))
    return F.round(share, scale)
