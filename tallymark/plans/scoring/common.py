"""What the scoring jobs share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.privacy import hash_pii, mask_email_normalised, mask_id, mask_phone
from tallymark.sources.writers import write_path

# How each kind of contact column is shown in an alert.
MASKS = {"name": hash_pii, "email": mask_email_normalised, "phone": mask_phone, "ssn": mask_id, "card": mask_id}


def row_alerts(
    scored: DataFrame, predicate: Column, columns: Sequence[str], contacts: Mapping[str, str] = {}
) -> DataFrame:
    """Rows that need attention. ``contacts`` maps a contact column to its kind; only masked values leave."""
    masked = [MASKS[kind](c).alias(f"{c}_masked") for c, kind in contacts.items() if c in scored.columns]
    return scored.filter(predicate).select(*columns, *masked)


def publish(scored: DataFrame, path: str) -> DataFrame:
    """Store the scored rows once and go on from the stored ones.

    Summary, alerts and rollup then read a few columns of the result instead of each scoring all rows again.
    """
    write_path(scored, path)
    return scored.sparkSession.read.parquet(path)


def staged(df: DataFrame, *stages: Mapping[str, Column]) -> DataFrame:
    """Add columns in stages; a stage may use the columns of earlier ones."""
    for stage in stages:
        df = df.withColumns(dict(stage))
    return df


def is_true(name: str) -> Column:
    return F.col(name) == F.lit(True)
