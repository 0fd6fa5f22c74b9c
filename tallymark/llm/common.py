"""Helpers the operators share: input columns, local names in expressions, shared scratch tables, text blocks."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.session import checkpoint_dir

# The white space that separates words.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
# Spark bounds batches by rows alone unless this is set.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns that operators read; a null text becomes the empty text."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words between runs of white space; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text: Column) -> Column:
    """Tells texts of one doc_id apart where ids repeat."""
    return F.xxhash64(text)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the one that all executors share."""
    shared = checkpoint_dir(spark)
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared folder and go on from there: no lineage, no second computation."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Spark removes the shuffle files of finished jobs when the driver collects its garbage; this asks for it.

    For use after a large step, so that the disks hold the files of one step instead of all. What the session still
    notes about the last job goes with the next one, so a tiny job runs in between.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        spark.range(1).count()


def quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def in_batches(df: DataFrame) -> DataFrame:
    """The same rows; what goes to Python workers goes in batches of bounded size, however long the texts are."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df
