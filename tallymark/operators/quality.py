"""Data-quality gates, quarantine, conforming of values, key checks, row filters and lineage columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallymark.functions.conditional import as_column

# Status words and the reason text.
DELETED = "DELETED"
FAIL = "FAIL"
UNKNOWN = "UNKNOWN"
QUARANTINE_REASON = "failed_not_null_dq_check"
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def as_of_date(as_of=None) -> Column:
    """The business date of a run: the given one, or today."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def as_of_timestamp(as_of=None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def drop_deleted(df: DataFrame) -> DataFrame:
    """Rows not marked as deleted; a NULL status is dropped as well."""
    return df.filter(F.col("record_status") != DELETED)


def passes_gate() -> Column:
    """Not deleted, and no hard quality failure; an unset quality flag passes. NULL for an unset status, which does not pass."""
    quality = F.col("data_quality_flag")
    return (F.col("record_status") != DELETED) & (quality.isNull() | (quality != FAIL))


def dq_gate(df: DataFrame) -> DataFrame:
    """``drop_deleted``, and no hard quality failures; an unset quality flag passes."""
    return df.filter(passes_gate())


def blank_failing(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows that cannot pass the gate without what they hold, except the gate's own columns and those to ``keep``.

    They still take part in choosing the newest version, but weigh little in its shuffle.
    """
    held = {*keep, "record_status", "data_quality_flag"}
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in df.columns}
    return df.select(*[q if c in held else F.when(passes_gate(), F.col(q)).alias(c) for c, q in quoted.items()])


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns], F.lit(False))


def split_quarantine(df: DataFrame, not_null: Sequence[str], as_of=None) -> tuple[DataFrame, DataFrame]:
    """Rows with all mandatory columns set, and the others with reason and time."""
    broken = any_null(not_null)
    bad = df.filter(broken).withColumns(
        {"quarantine_reason": F.lit(QUARANTINE_REASON), "quarantine_ts": as_of_timestamp(as_of)}
    )
    return df.filter(~broken), bad


def cleaned(c: Column | str) -> Column:
    return F.upper(F.trim(as_column(c)))


def conform_enum(c: Column | str, valid: Sequence[str], unknown: str | None = None) -> Column:
    """Upper-case trimmed value if it is one of the valid ones, else ``unknown``."""
    value = cleaned(c)
    return F.when(value.isin(*valid), value).otherwise(F.lit(unknown))


def null_out_of_range(c: Column | str, low: float = 0, high: float = 100) -> Column:
    c = as_column(c)
    return F.when(c.between(low, high), c)


def blank_to_null(c: Column | str) -> Column:
    """NULL for the empty string, else upper-case trimmed. Blanks only are trimmed to the empty string."""
    return F.when(as_column(c) != "", cleaned(c))


def valid_email(c: Column | str) -> Column:
    """NULL for a NULL address."""
    return as_column(c).rlike(EMAIL_SHAPE)


def positive(c: Column | str) -> Column:
    return as_column(c).isNotNull() & (as_column(c) > 0)


def set_and_not_zero(c: Column | str) -> Column:
    return as_column(c).isNotNull() & (as_column(c) != 0)


def set_and_before(c: Column | str, day: Column) -> Column:
    return as_column(c).isNotNull() & (as_column(c) < day)


def set_and_within_days(c: Column | str, day: Column, days: int) -> Column:
    """Also true for dates already past."""
    return as_column(c).isNotNull() & (F.datediff(as_column(c), day) <= days)


def assert_rows(n: int, context: str) -> None:
    if not n:
        raise ValueError(f"{context}: no rows are left, nothing is written")


def assert_non_empty(df: DataFrame, context: str) -> None:
    """Runs the plan up to its first row; a result that is written anyway is counted by the write (``counted``)."""
    assert_rows(0 if df.isEmpty() else 1, context)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The same rows, and their number once they have been written or collected; counting costs no job of its own.

    To be put right before the write: the tasks that write count once, even if they have to be repeated.
    """
    seen = Observation()

    def rows() -> int:
        # A plan found empty while it runs leaves no metric at all, which ``seen.get`` cannot read.
        metrics = seen._jo.getRow()
        return int(metrics.getLong(0)) if metrics.size() else 0

    return df.observe(seen, F.count(F.lit(1)).alias("rows")), rows


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | any_null(keys))


def row_filter(df: DataFrame, region_col: str, regions: Sequence[str], is_global: bool = False) -> DataFrame:
    """Only the rows of the caller's regions, unless the caller may see all."""
    return df if is_global else df.filter(F.col(region_col).isin(*regions))


def add_audit(df: DataFrame, as_of=None) -> DataFrame:
    return df.withColumns(
        {"silver_load_ts": as_of_timestamp(as_of), "source_batch_id": F.col("ingestion_batch_id")}
    )


def base_clean(df: DataFrame, source: str, as_of=None) -> DataFrame:
    return (
        dq_gate(df)
        .drop("raw_payload")
        .withColumns({"_silver_load_ts": as_of_timestamp(as_of), "_source_bronze_table": F.lit(source)})
    )


def stamp(df: DataFrame, name: str, as_of=None) -> DataFrame:
    """Add the load time of a mart or summary."""
    return df.withColumn(name, as_of_timestamp(as_of))
