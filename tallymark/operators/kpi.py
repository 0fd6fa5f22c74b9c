"""Grouped and global indicators, flag counters, alert rollups, sorting and top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kpis(
    df: DataFrame, aggs: Mapping[str, Column], by: Sequence[str | Column] = (), having: Column | None = None
) -> DataFrame:
    """Named aggregates, per group or over all rows."""
    named = [c.alias(name) for name, c in aggs.items()]
    out = df.groupBy(*by).agg(*named) if by else df.agg(*named)
    return out if having is None else out.filter(having)


def kpis_with_distinct(
    df: DataFrame, distinct: Mapping[str, str], sums: Mapping[str, Column], maxima: Mapping[str, Column], by: Sequence[str]
) -> DataFrame:
    """Aggregates per group next to several distinct counts, without a copy of the rows for each of them.

    ``distinct`` names the key column of each count, ``sums`` are aggregates that add up, ``maxima`` such as keep the largest. The
    rows are first summed up to the group and the keys, map-side; there, the first row of each key of a group stands for
    the key, and the marks are counted. Windows run on group and key, so a hot group is spread over its keys.
    """
    keys = list(dict.fromkeys(distinct.values()))
    parts = kpis(df, {**sums, **maxima}, by=[*by, *keys])
    order = {key: [k for k in keys if k != key] or [key] for key in keys}
    marks = {
        f"_first_{key}": F.col(key).isNotNull() & (F.row_number().over(Window.partitionBy(*by, key).orderBy(*order[key])) == 1)
        for key in keys
    }
    counted = {name: F.count_if(F.col(f"_first_{key}")) for name, key in distinct.items()}
    return kpis(
        parts.withColumns(marks), {**counted, **{n: F.sum(n) for n in sums}, **{n: F.max(n) for n in maxima}}, by=by
    )


def kpi_row(indicators: Mapping[str, DataFrame]) -> DataFrame:
    """One row of scalar subqueries, each from a one-row, one-column DataFrame."""
    first = next(iter(indicators.values()))
    return first.sparkSession.range(1).select(*[df.scalar().alias(name) for name, df in indicators.items()])


def flag_counts(
    df: DataFrame, predicates: Mapping[str, Column], totals: Mapping[str, Column] | None = None
) -> DataFrame:
    """Several counters and totals in one pass over the data."""
    counters = {name: F.count_if(p) for name, p in predicates.items()}
    return kpis(df, {**counters, **(totals or {})})


def share(df: DataFrame, predicate: Column, name: str = "share", eps: float = 0.001) -> DataFrame:
    return df.agg((F.count_if(predicate) / (F.count(F.lit(1)) + F.lit(eps))).alias(name))


def segment_alert(
    df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column], having: Column, only: Mapping[str, Sequence] = {}
) -> DataFrame:
    """Group, aggregate and keep the groups that pass ``having``. Groups with a NULL key raise no alert.

    ``only`` restricts key columns to listed values before the aggregation.
    """
    kept = df.filter(_keys_set(by))
    for column, values in only.items():
        kept = kept.filter(F.col(column).isin(*values))
    return kpis(kept, aggs, by=by, having=having)


def nested_alert(
    df: DataFrame,
    outer: str,
    inner: str,
    inner_values: Sequence[str],
    parts: Mapping[str, Column],
    having: Mapping[str, Column],
    keep: Column,
) -> DataFrame:
    """Alerts on (outer, inner) groups whose condition looks at the whole outer group.

    ``parts`` are aggregates at the (outer, inner) grain, ``having`` combines them over the outer group, and
    ``keep`` decides. The window only sees the aggregated rows: one per pair of keys.
    """
    grain = kpis(df.filter(F.col(outer).isNotNull()), parts, by=[outer, inner])
    whole = Window.partitionBy(outer)
    totals = grain.withColumns({name: c.over(whole) for name, c in having.items()})
    return totals.filter(keep & F.col(inner).isin(*inner_values))


def _keys_set(by: Sequence[str]) -> Column:
    kept = F.lit(True)
    for key in by:
        kept = kept & F.col(key).isNotNull()
    return kept


def min_sample(df: DataFrame, by: Sequence[str], n: int, aggs: Mapping[str, Column]) -> DataFrame:
    """Groups with fewer than ``n`` rows."""
    return kpis(df, {"cnt": F.count(F.lit(1)), **aggs}, by=by, having=F.col("cnt") < n)


def sorted_by(df: DataFrame, order: Sequence[Column], tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Total order. The tie breakers also let the range shuffle split a hot value of the leading key."""
    return df.orderBy(*order, *tie_breakers)


def top_n(df: DataFrame, order: Sequence[Column], n: int, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; each task keeps only ``n`` candidates, so nothing is sorted as a whole."""
    return df.orderBy(*order, *tie_breakers).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
