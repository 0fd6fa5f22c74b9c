"""Deduplication, ranks and rolling sums, laid out so that no task receives an unbounded group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.joins import is_small, pieces_of, shuffle_width, spread, with_pieces
from tallymark.session import cut_lineage


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_col: str = "data_load_ts", tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key.

    The filter on the row number makes Spark keep one candidate per key and input task before the shuffle
    (window group limit), so the copies of a hot key never meet in one task.
    """
    if not keys:
        raise ValueError("dedupe_latest: at least one key column is needed")
    newest_first = [F.col(c).desc_nulls_last() for c in (order_col, *tie_breakers)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def range_cuts(distinct: DataFrame, column: str, buckets: int) -> list:
    """At most ``buckets - 1`` points that cut the distinct values into ranges of about the same number."""
    shares = [i / buckets for i in range(1, buckets)]
    cuts = distinct.agg(F.percentile_approx(column, shares, 20 * buckets)).first()[0] if shares else None
    return sorted(set(cuts or []))


def dense_rank_by(
    df: DataFrame, order_col: str, rank_col: str = "rank", buckets: int | None = None, limit: int | None = None
) -> DataFrame:
    """Global dense rank in descending order, NULL last, without a single-task window.

    1. The rows are counted by value once; everything but the last step works on one row per distinct value.
    2. Cut points of the *distinct* values come from one sketch. The values are numbered inside each range, and each
       range gets the number of distinct values above it, so a hot value weighs no more than any other.
    3. Every row takes the number of its value by an equi join, for which the rows of the values with more rows than
       ``limit`` (rows per bucket by default) are spread.
    """
    buckets = buckets or max(2, shuffle_width(df.sparkSession))
    counts = cut_lineage(df.groupBy(order_col).agg(F.count(F.lit(1)).alias("_rows")))
    cuts = range_cuts(counts, order_col, buckets)
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    limit = limit or max(1, math.ceil(total / buckets))
    # At most two values per bucket can hold half the limit.
    held = counts.filter(F.col("_rows") > limit / 2).collect()
    hot = {value: pieces_of(n, limit) for value, n in held}

    # Range 0 holds the largest values; NULL gets a range of its own at the end.
    value = F.col(order_col)
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda cut: cut > value)) if cuts else F.lit(0)
    position = F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(above)

    distinct = counts.select(order_col).withColumn("_range", position)
    inside = Window.partitionBy("_range").orderBy(value.desc_nulls_last())
    numbered = distinct.withColumn("_inside", F.row_number().over(inside))
    sizes = distinct.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range: never more than ``buckets + 1`` rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    ranks = numbered.join(F.broadcast(offsets), "_range").select(
        F.col(order_col).alias("_value"), (F.col("_inside") + F.col("_offset")).alias(rank_col)
    )

    same = F.col(order_col).eqNullSafe(F.col("_value"))
    if not hot or is_small(ranks):
        return df.join(ranks, same, "left").drop("_value")
    rows = spread(df, order_col, hot, "_piece")
    # NULL has a rank as well, so its row is copied like the others.
    copies = with_pieces(ranks, "_value", hot)
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_hot_pieces") - 1))).drop("_hot_pieces")
    return rows.join(copies, same & (F.col("_piece") == F.col("_copy")), "left").drop("_value", "_piece", "_copy")


def rolling_rows(
    df: DataFrame, by: Sequence[str], order: str, value: Column, n: int, name: str
) -> DataFrame:
    """Aggregate to the (group, order) grain, then sum over the last ``n`` rows of each group.

    The window only sees one row per group and order value, whatever the number of input rows.
    """
    grain = df.groupBy(*by, order).agg(value.alias("_grain_value"))
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(-(n - 1), 0)
    return grain.select(*by, order, F.sum("_grain_value").over(frame).alias(name))


def rolling_days(
    df: DataFrame, by: Sequence[str], date_col: str, value: Column, n: int, name: str
) -> DataFrame:
    """As ``rolling_rows``, over the last ``n`` calendar days; missing days count as nothing."""
    grain = df.groupBy(*by, date_col).agg(value.alias("_grain_value"))
    frame = Window.partitionBy(*by).orderBy(F.unix_date(date_col)).rangeBetween(-(n - 1), 0)
    return grain.select(*by, date_col, F.sum("_grain_value").over(frame).alias(name))
