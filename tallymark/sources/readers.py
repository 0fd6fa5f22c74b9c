"""Readers. None of them triggers a job; filters and column choices reach the scan through Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


class JdbcPartition(NamedTuple):
    """How a JDBC read is split: one query per stride of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int


def read_table(spark: SparkSession, name: str) -> DataFrame:
    if not name or not name.strip():
        raise ValueError("read_table: the table name must not be blank")
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    predicate: Column | None = None,
    partition: JdbcPartition | None = None,
    **options: str,
) -> DataFrame:
    """Selected columns and rows of a database table.

    The projection and the predicate are ordinary DataFrame operations, which the JDBC source turns into the
    remote query; no SQL text is assembled from values. Without ``partition`` the read is one task, so large
    tables should name one.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition is not None:
        reader = reader.options(
            partitionColumn=partition.column,
            lowerBound=partition.lower,
            upperBound=partition.upper,
            numPartitions=str(partition.count),
        )
    df = reader.load()
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a stated schema, so no pass over the files is spent on inference."""
    return spark.read.schema(schema).json(path)


def sql_over(spark: SparkSession, views: Mapping[str, DataFrame], query: str) -> DataFrame:
    """SQL over named DataFrames; each ``{name}`` in the query stands for one of them.

    The views exist only for this call, so nothing is left behind in the session.
    """
    return spark.sql(query, **views)
