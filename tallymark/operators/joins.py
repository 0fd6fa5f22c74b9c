"""Join shapes of the jobs.

Whether a side table is broadcast is Catalyst's decision, by its bytes. Before a join by shuffle, the key values that
hold more rows than a task should get, NULL included, are found in one pass for all keys, by mergeable sketches of frequent
values, and spread over several tasks. The limit is relative to the data (rows per shuffle partition), so the number of
such values is bounded by the number of partitions, and every one of them is spread into as many pieces as it needs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values that a sketch tracks for each limit's worth of rows. A count may be wrong by 3.5 rows in as many as are tracked, so
# a value with half the limit is still found and a quarter of the limit is told apart from it.
TRACKED = 16
# More than this a sketch does not track; values with more than 3.5 rows in a million are found at any limit.
TRACKED_AT_MOST = 1_000_000
# Kinds of values a sketch can track; others are counted on a sample with so many rows for each limit's worth.
SKETCHED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
SAMPLED_ROWS = 200
SAMPLE_SEED = 42

Hot = Mapping[Any, int]


class Dim(NamedTuple):
    """A side table: its rows, the shared key and the columns taken from it (all but the key by default)."""

    df: DataFrame
    key: str
    columns: Sequence[str] | None = None


class Step(NamedTuple):
    """A left join of a chain: the table, the key on the left (any earlier table) and the key of the table."""

    df: DataFrame
    left_key: str
    right_key: str


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of a result; it reads statistics only."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(side: DataFrame) -> bool:
    """Whether Catalyst broadcasts this side of a left join on its own."""
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return not side.isStreaming and plan_bytes(side) <= limit


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces_of(rows: float, limit: float) -> int:
    """Pieces of at most half the limit, so that a value counted too low still gets small ones."""
    return math.ceil(2 * rows / limit)


def frequent_values(df: DataFrame, keys: Sequence[str], tracked: int) -> tuple[int, dict[str, dict[Any, int]]]:
    """The number of rows, and by key column its most frequent values with their counts, in one pass.

    Each task fills a sketch per key column, which tracks at most ``tracked`` values. The sketches are merged in two steps, so
    that no task merges those of all others.
    """
    width = shuffle_width(df.sparkSession)
    names = [F.col(f"`{k.replace('`', '``')}`").alias(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(*names, F.pmod(F.spark_partition_id(), F.lit(width)).alias("part"))
    fill = [F.expr(f"approx_top_k_accumulate(k{i}, {tracked})").alias(f"s{i}") for i in range(len(keys))]
    merge = [F.expr(f"approx_top_k_combine(s{i}, {tracked})").alias(f"s{i}") for i in range(len(keys))]
    read = [F.expr(f"approx_top_k_estimate(s{i}, {min(tracked, 100_000)})").alias(f"top{i}") for i in range(len(keys))]
    # One group, since a merge of no sketches at all fails.
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *fill)
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.sum("n").alias("n"), *merge)
    # A value with less than one row in ``tracked`` says nothing.
    least = F.col("n") / tracked
    found = merged.select("n", *read).select("n", *[F.filter(f"top{i}", lambda v: v["count"] > least).alias(f"top{i}") for i in range(len(keys))]).first()
    if found is None:
        return 0, {k: {} for k in keys}
    return found["n"], {k: {v["item"]: v["count"] for v in found[f"top{i}"]} for i, k in enumerate(keys)}


def hot_values(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> dict[str, Hot]:
    """The values of each key column with more rows than ``limit``, and their pieces.

    By default the limit is the rows per shuffle partition. At most two values per partition can hold half of that,
    which bounds the result. All key columns are read in one pass over the rows, whose result only steers the layout. A
    limit given by the caller can take a second pass, if it is so low that more values must be tracked.
    """
    if df.isStreaming or not keys:
        return {key: {} for key in keys}
    width = shuffle_width(df.sparkSession)
    known = [k for k in keys if isinstance(df.select(k).schema[0].dataType, SKETCHED)]
    tracked = min(TRACKED * max(4, width), TRACKED_AT_MOST)
    total, counts = frequent_values(df, known, tracked)
    limit = limit or max(1, math.ceil(total / width))
    needed = min(TRACKED * math.ceil(total / limit), TRACKED_AT_MOST)
    if known and needed > tracked:
        total, counts = frequent_values(df, known, needed)
    hot = {key: {value: pieces_of(n, limit) for value, n in counts[key].items() if n > limit / 2} for key in known}
    if len(known) == len(keys):
        return hot
    share = min(1.0, SAMPLED_ROWS / limit)
    others = [k for k in keys if k not in hot]
    sample = df.select(*others) if share == 1.0 else df.select(*others).sample(share, SAMPLE_SEED)
    for key in others:
        rows = sample.groupBy(key).count().filter(F.col("count") > limit * share / 2)
        hot[key] = {value: pieces_of(n, limit * share) for value, n in rows.collect()}
    return hot


def _pieces_table(spark: SparkSession, hot: Hot, kind: T.DataType) -> DataFrame:
    """One row per hot value: at most two per shuffle partition, so it may be broadcast."""
    schema = T.StructType([T.StructField("_hot_value", kind), T.StructField("_hot_pieces", T.IntegerType())])
    return F.broadcast(spark.createDataFrame(list(hot.items()), schema))


def with_pieces(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """The rows with the pieces of their key value in ``_hot_pieces``, 1 for values that are not hot."""
    kind = df.select(key).schema[0].dataType
    table = _pieces_table(df.sparkSession, hot, kind)
    joined = df.join(table, F.col(key).eqNullSafe(F.col("_hot_value")), "left").drop("_hot_value")
    return joined.withColumn("_hot_pieces", F.coalesce("_hot_pieces", F.lit(1)))


def spread(df: DataFrame, key: str, hot: Hot, salt: str) -> DataFrame:
    """Number the rows of a hot value by piece; all other rows get piece 0.

    The piece follows from the row and its input split, so a repeated task puts each row where it was.
    """
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    number = F.xxhash64(*hashable) if len(set(df.columns)) == len(df.columns) else F.lit(0)
    numbered = df.withColumn(salt, number + F.spark_partition_id())
    piece = F.pmod(F.col(salt), F.col("_hot_pieces")).cast("int")
    return with_pieces(numbered, key, hot).withColumn(salt, piece).drop("_hot_pieces")


def copy_to_pieces(df: DataFrame, key: str, hot: Hot, salt: str) -> DataFrame:
    """Repeat the rows of a hot value once per piece; NULL keys match nothing and go. ``key`` may be qualified."""
    known = with_pieces(df.filter(F.col(key).isNotNull()), key, {k: n for k, n in hot.items() if k is not None})
    return known.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col("_hot_pieces") - 1))).drop("_hot_pieces")


def enrich(
    df: DataFrame, dims: Sequence[Dim], hot: Mapping[str, Hot] | None = None, limit: int | None = None,
    small: Callable[[DataFrame], bool] = is_small,
) -> DataFrame:
    """Left equi joins in order. Only the needed columns travel; several matches give several rows.

    A side table whose key comes from another side table is joined to that one first, so every join is on a key of
    its own left table, whose hot values can be spread. ``hot`` can name the hot values of each key; by default they
    are measured, if a table that is not ``small`` is joined.
    """
    sides: list[tuple[str, DataFrame]] = []
    for dim in dims:
        columns = [c for c in dim.df.columns if c != dim.key] if dim.columns is None else list(dim.columns)
        side = dim.df.select(dim.key, *columns)
        owner = next((i for i, (_, s) in reversed(list(enumerate(sides))) if dim.key in s.columns), None)
        if dim.key in df.columns or owner is None:
            sides.append((dim.key, side))
        else:
            sides[owner] = (sides[owner][0], enrich(sides[owner][1], [Dim(side, dim.key)], hot, limit, small))
    large = [(key, side) for key, side in sides if not small(side)]
    keys = list(dict.fromkeys(key for key, _ in large))
    hot = hot_values(df, keys, limit) if hot is None else hot
    salts = {key: f"_piece_{key}" for key in keys if hot.get(key)}
    for key, salt in salts.items():
        df = spread(df, key, hot[key], salt)
    for key, side in sides:
        if key in salts and any(side is s for _, s in large):
            df = df.join(copy_to_pieces(side, key, hot[key], salts[key]), [key, salts[key]], "left")
        else:
            df = df.join(side, key, "left")
    return df.drop(*salts.values())


def join_order(sides: Sequence[tuple[str, DataFrame]], large: Sequence[bool]) -> list[int]:
    """Positions of the sides, so that little is carried through the shuffles: first those joined by shuffle, a key at a time
    and the key that adds the narrowest rows first, then the small ones, which shuffle nothing."""
    widths: dict[str, int] = {}
    for (key, side), is_large in zip(sides, large):
        widths[key] = widths.get(key, 0) + is_large * side._jdf.schema().defaultSize()
    return sorted(range(len(sides)), key=lambda i: (not large[i], large[i] * widths[sides[i][0]], sides[i][0]))


def left_chain(
    df: DataFrame, name: str, steps: Sequence[Step], hot: Mapping[str, Hot] | None = None, limit: int | None = None,
    small: Callable[[DataFrame], bool] = is_small,
) -> DataFrame:
    """Left joins whose keys may come from any earlier table; NULL keys match nothing.

    Columns are addressed as ``alias.column``; ``name`` is the alias of the first table. The chain is joined as a
    tree: a table first takes in the tables that hang on its own keys and is then joined to the table that it hangs
    on. That gives the same rows, and each join is on a key of one stored table, so the hot values of all keys are
    measured and spread (``hot`` names them by ``alias.column``), NULL included.
    """
    mine = [s for s in steps if s.left_key.split(".", 1)[0] == name]
    sides = [(s, left_chain(s.df, s.right_key.split(".", 1)[0], steps, hot, limit, small)) for s in mine]
    large = [not small(side) for _, side in sides]
    keys = list(dict.fromkeys(s.left_key.split(".", 1)[1] for (s, _), is_large in zip(sides, large) if is_large))
    known = hot_values(df, keys, limit) if hot is None else {k: hot.get(f"{name}.{k}", {}) for k in keys}
    salts = {key: f"_piece_{name}_{key}" for key in keys if known[key]}
    for key, salt in salts.items():
        df = spread(df, key, known[key], salt)
    joined = df.alias(name)
    for i in join_order([(s.left_key, side) for s, side in sides], large):
        (step, side), is_large = sides[i], large[i]
        key, condition = step.left_key.split(".", 1)[1], F.col(step.left_key) == F.col(step.right_key)
        if is_large and key in salts:
            copy = f"_copy_{name}_{i}"
            side = copy_to_pieces(side, step.right_key, known[key], copy)
            condition = condition & (F.col(salts[key]) == F.col(copy))
        joined = joined.join(side, condition, "left")
    return joined


def join_aggregates(
    df: DataFrame, key: str, aggregates: Sequence[DataFrame], defaults: Mapping[str, Any]
) -> DataFrame:
    """Left joins to tables already aggregated to the key, so there is no fan-out, then fill the defaults.

    Every aggregate leaves its shuffle partitioned by the key, and the joins reuse that partitioning.
    """
    joined = reduce(lambda left, agg: left.join(agg, key, "left"), aggregates, df)
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(v)) for name, v in defaults.items()})


def broadcast_left(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join to a dimension, which Catalyst ships to every task if its bytes allow it."""
    return enrich(df, [Dim(dim, key)])


def _nullsafe(keys: Sequence[str], others: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, others)])


def full_outer_nullsafe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_keys: Sequence[str] | None = None,
    limit: int | None = None, aggregated: bool = False,
) -> DataFrame:
    """Full outer join in which NULL keys match each other; the keys of both sides are merged.

    ``aggregated`` says that both sides have at most one row per key, so no key can be hot. Otherwise the combined keys with
    more rows than a task should get (``limit``, by default the rows per shuffle partition) are measured on both sides. A
    full outer join cannot spread them, so where there are any, the result is made of a left join, for which the hot keys
    of the left side are spread and the rows of the right side repeated, and of the right side's rows without a match, for
    which those of the right side are spread against the distinct keys of the left.
    """
    right_keys = list(right_keys or keys)
    renamed = right.select(
        *[F.col(k).alias(f"_right_{i}") for i, k in enumerate(right_keys)],
        *[c for c in right.columns if c not in right_keys],
    )
    others = [f"_right_{i}" for i in range(len(keys))]
    same = _nullsafe(keys, others)
    merged = {k: F.coalesce(F.col(k), F.col(o)) for k, o in zip(keys, others)}
    if aggregated:
        return left.join(renamed, same, "full_outer").withColumns(merged).drop(*others)

    # All keys as one number, which only steers where rows go.
    left = left.withColumn("_left_key", F.xxhash64(*keys))
    renamed = renamed.withColumn("_right_key", F.xxhash64(*others))
    hot_left = hot_values(left, ["_left_key"], limit)["_left_key"]
    hot_right = hot_values(renamed, ["_right_key"], limit)["_right_key"]
    if not hot_left and not hot_right:
        return left.join(renamed, same, "full_outer").withColumns(merged).drop("_left_key", "_right_key", *others)

    piece = F.col("_piece") == F.col("_copy")
    rows, copies = spread(left, "_left_key", hot_left, "_piece"), copy_to_pieces(renamed, "_right_key", hot_left, "_copy")
    matched = rows.join(copies, same & (F.col("_left_key") == F.col("_right_key")) & piece, "left")
    matched = matched.withColumns(merged).drop("_left_key", "_right_key", "_piece", "_copy", *others)
    known = copy_to_pieces(left.select(*keys, "_left_key").distinct(), "_left_key", hot_right, "_copy")
    alone = spread(renamed, "_right_key", hot_right, "_piece").join(
        known, same & (F.col("_left_key") == F.col("_right_key")) & piece, "left_anti"
    )
    alone = alone.withColumnsRenamed(dict(zip(others, keys))).drop("_right_key", "_piece")
    return matched.unionByName(alone, allowMissingColumns=True)
