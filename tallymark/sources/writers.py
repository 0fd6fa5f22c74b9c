"""Writers. Every one runs the plan once: how many rows were written is observed in the write itself.

A table that is replaced is written as a new version first (see ``versions``), so a write that fails or is killed leaves the
old table whole. ``run_id`` names the run in the version; a rerun under the same name replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.quality import assert_rows, counted
from tallymark.sources import versions
from tallymark.sources.versions import literal, quoted

RUN_COLUMN = "run_id"
# The codec of a format's files where it is not the default, and up to how many folders a task writes side by side.
CODECS = {"parquet": "zstd"}
FEW_FOLDERS = 8
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def cluster_by_partition(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Bring the rows of one output partition together, so that a write makes few files per directory.

    The rebalance hint lets AQE split an oversized partition value over several tasks and merge small ones.
    """
    if partition_by:
        return df.hint("rebalance", *partition_by)
    return df.hint("rebalance")


def few_folders(df: DataFrame, partition_by: Sequence[str] | None) -> bool:
    """Whether the rows go to so few folders that tasks can write them as they are; reads the partition columns only."""
    if not partition_by:
        return True
    values = df.agg(F.approx_count_distinct(F.struct(*partition_by))).first()[0]
    return values <= FEW_FOLDERS


@contextmanager
def side_by_side(spark: SparkSession, on: bool) -> Iterator[None]:
    """Tasks keep the files of a few folders open instead of sorting their rows by folder; beyond that they sort the rest."""
    before = spark.conf.get(_OPEN_FILES)
    if on:
        spark.conf.set(_OPEN_FILES, str(FEW_FOLDERS))
    try:
        yield
    finally:
        if on:
            spark.conf.set(_OPEN_FILES, before)


def _partitioned(writer: DataFrameWriter, partition_by: Sequence[str] | None, fmt: str) -> DataFrameWriter:
    writer = writer.format(fmt)
    if fmt in CODECS:
        writer = writer.option("compression", CODECS[fmt])
    return writer.partitionBy(*partition_by) if partition_by else writer


def _replace(
    df: DataFrame, name: str, partition_by: Sequence[str] | None, fmt: str, comment: str | None, run_id: str | None,
    must_have_rows: bool, clustered: bool,
) -> int:
    """Write a version and point to it; without rows, if there must be some, the version goes and the old table stays."""
    spark, run_id = df.sparkSession, versions.new_run_id() if run_id is None else run_id
    version = versions.version_name(name, run_id)
    shaped, rows = counted(cluster_by_partition(df, partition_by) if clustered else df)
    try:
        with side_by_side(spark, bool(partition_by) and not clustered):
            _partitioned(shaped.write.mode("errorifexists"), partition_by, fmt).saveAsTable(version)
        if must_have_rows:
            assert_rows(rows(), name)
        if comment:
            set_comment(spark, version, comment)
        versions.point_to(spark, name, version, run_id, comment)
    except Exception:
        if versions.current_version(spark, name) != version:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
        raise
    return rows()


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    comment: str | None = None,
    run_id: str | None = None,
    clustered: bool = True,
) -> int:
    """Replace (or append to) a managed table; returns the rows written.

    An overwrite also takes over a changed schema. Readers see the old rows until all new ones are written. An append to a
    table that is replaced in versions goes to its current version. Rows for folders are brought together by a shuffle, unless
    an overwrite says that they need not be ``clustered``.
    """
    if not name or not name.strip():
        raise ValueError("write_table: the table name must not be blank")
    if mode == "overwrite":
        return _replace(df, name, partition_by, fmt, comment, run_id, False, clustered and bool(partition_by))
    spark = df.sparkSession
    shaped, rows = counted(cluster_by_partition(df, partition_by) if partition_by else df)
    target = versions.current_version(spark, name) or name
    _partitioned(shaped.write.mode(mode), partition_by, fmt).saveAsTable(target)
    if comment:
        set_comment(spark, target, comment)
    return rows()


def write_validated(
    df: DataFrame, name: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite", run_id: str | None = None,
    clustered: bool = True,
) -> int:
    """Write a result in well-sized files and refuse an empty one, for which the old table stays; returns the rows written.

    An overwrite with rows that come from a shuffle need not have them ``clustered`` by another one.
    """
    if mode == "overwrite":
        return _replace(df, name, partition_by, "parquet", None, run_id, True, clustered)
    existed = df.sparkSession.catalog.tableExists(name)
    n = write_table(cluster_by_partition(df, partition_by), name, partition_by, mode)
    if not n and not existed:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    assert_rows(n, name)
    return n


def write_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def append_rejected(bad: DataFrame, name: str, run_id: str | None = None) -> bool:
    """Append quarantined rows; returns whether there were any. No table is made for none.

    With ``run_id`` the table is partitioned by the run, and the rows replace those that an earlier attempt of the same run
    has written, also if there are none any more; the rows of other runs are not touched.
    """
    spark = bad.sparkSession
    existed = spark.catalog.tableExists(name)
    if run_id is None:
        n = write_table(bad, name, mode="append")
    else:
        tagged = bad.withColumn(RUN_COLUMN, F.lit(run_id))
        n = _replace_run(tagged, name, run_id) if existed else write_table(tagged, name, [RUN_COLUMN], mode="append")
    if not n and not existed:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    return n > 0


def _replace_run(tagged: DataFrame, name: str, run_id: str) -> int:
    """Dynamic overwrite of one run's partition: its files are exchanged when all rows are written."""
    spark = tagged.sparkSession
    table = spark.table(name)
    if [c.name for c in spark.catalog.listColumns(name) if c.isPartition] != [RUN_COLUMN]:
        raise ValueError(f"{name} is not partitioned by {RUN_COLUMN}")
    if {(f.name, f.dataType) for f in tagged.schema} != {(f.name, f.dataType) for f in table.schema}:
        raise ValueError(f"{name} has other columns than the rows for it")
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}
    rows, n = counted(cluster_by_partition(tagged, [RUN_COLUMN]))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _partitioned(writer, [RUN_COLUMN], details["Provider"]).save(details["Location"])
    part = f"PARTITION ({RUN_COLUMN} = {literal(run_id)})"
    spark.sql(f"ALTER TABLE {quoted(name)} " + (f"ADD IF NOT EXISTS {part}" if n() else f"DROP IF EXISTS {part}"))
    spark.catalog.refreshTable(name)
    return n()


def append_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType, name: str) -> None:
    """Append literal rows, array columns included."""
    write_table(spark.createDataFrame(list(rows), schema), name, mode="append")


def set_comment(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql("COMMENT ON TABLE IDENTIFIER(:name) IS :text", args={"name": name, "text": comment})
