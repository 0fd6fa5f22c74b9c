"""Score newly arrived files once, with the same job a batch run uses.

The scoring jobs are row-local after their left joins with static tables, so they need no state store and no
watermark; the file source and the checkpoint give exactly-once output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def score_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    job: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    fmt: str = "json",
) -> StreamingQuery:
    arriving = spark.readStream.format(fmt).schema(schema).load(source)
    writer = job(arriving).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(target)
