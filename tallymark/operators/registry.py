"""Job registry rows with array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a registry row.
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("project_name", T.StringType()),
        T.StructField("project_desc", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("token", T.StringType()),
        T.StructField("repository_name", T.StringType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("folders", T.ArrayType(T.StringType())),
        T.StructField("file_names", T.ArrayType(T.StringType())),
        T.StructField("schedule_time", T.StringType()),
        T.StructField("schedule_frequency", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("repeat_frequency", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("selected_rules", T.ArrayType(T.IntegerType())),
        T.StructField("selected_templates", T.ArrayType(T.IntegerType())),
        T.StructField("selected_gates", T.ArrayType(T.IntegerType())),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_by", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def coverage(df: DataFrame, by: str, array_col: str, element: str) -> DataFrame:
    """How many rows of each group list each element of an array column."""
    listed = df.select(by, F.explode(array_col).alias(element))
    return listed.groupBy(by, element).agg(F.count(F.lit(1)).alias("jobs"))
