"""Binding of library jobs to the supplied tables.

A domain table is a projection of the supplied tables, written once in SQL that both engines read. A query is
a library call on such tables, the columns it returns, and (where SQL can say it) the SQL for the same result.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

# Domain tables: name -> SQL over {table} placeholders.
DOMAIN: dict[str, str] = {}
REGISTRY: dict[str, Query] = {}
# Queries whose numbers come from a trainer, so that SQL cannot state them; what SQL can say of them is in the registry.
TRAINED: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    text = DOMAIN[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


# One-letter column kinds of a result: how both sides are brought to the same type.
_SPARK = {
    "l": lambda c: F.col(c).cast("bigint"),
    "d": lambda c: F.col(c).cast("double"),
    "s": lambda c: F.col(c).cast("string"),
    "b": lambda c: F.col(c).cast("boolean"),
    "D": lambda c: F.col(c).cast("date").cast("string"),
    "t": lambda c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss"),
}
_DUCK = {
    "l": "CAST({c} AS BIGINT)",
    "d": "CAST({c} AS DOUBLE)",
    "s": "CAST({c} AS VARCHAR)",
    "b": "CAST({c} AS BOOLEAN)",
    "D": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "t": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[..., DataFrame]
    uses: Sequence[str]
    out: Sequence[tuple[str, str]]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        result = self.build(*[table(spark, sf_dir, name) for name in self.uses])
        return result.select(*[_SPARK[kind](c).alias(c) for c, kind in self.out])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        names = {t: t for t in TABLES}
        parts = [f"{n} AS ({DOMAIN[n].format(**names)})" for n in self.uses if n in DOMAIN]
        parts.append(f"result AS ({self.sql})")
        columns = ", ".join(f"{_DUCK[kind].format(c=c)} AS {c}" for c, kind in self.out)
        return f"WITH {', '.join(parts)} SELECT {columns} FROM result"


def add(name: str, build: Callable[..., DataFrame], uses: str, out: str, sql: str | None = None, to: dict[str, Query] = REGISTRY) -> None:
    """Register a query. ``out`` lists ``column:kind`` pairs."""
    if name in REGISTRY or name in TRAINED:
        raise ValueError(f"query {name} is registered twice")
    columns = [tuple(item.split(":")) for item in out.split()]
    to[name] = Query(name, build, uses.split(), columns, sql)


def mean(expr: str, scale: int, out: int) -> str:
    """SQL for the mean of a decimal expression, rounded half up from exact integers."""
    total = f"SUM(CAST(ROUND(CAST({expr} AS DOUBLE) * {10**scale}) AS BIGINT))"
    n = f"COUNT({expr})"
    return quotient(total, n, out - scale, out)


def quotient(numerator: str, denominator: str, shift: int, out: int) -> str:
    """SQL for numerator * 10**shift / denominator of two integers, half up, as units of 10**-out."""
    num = f"(CAST({numerator} AS HUGEINT) * {10 ** max(shift, 0)})"
    den = f"(CAST({denominator} AS HUGEINT) * {10 ** max(-shift, 0)})"
    rounded = f"SIGN({num}) * ((2 * ABS({num}) + {den}) // (2 * {den}))"
    return f"CASE WHEN {denominator} > 0 THEN CAST({rounded} AS DOUBLE) / {10**out} END"


def exact(df: DataFrame, scale: int, *columns: str) -> DataFrame:
    """Decimals instead of doubles, so that sums do not depend on the order of rows."""
    return df.withColumns({c: F.col(c).cast(f"decimal(18,{scale})") for c in columns})
