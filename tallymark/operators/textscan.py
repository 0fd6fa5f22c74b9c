"""Search a text column for personal data and secrets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pattern names and their regular expressions. They use only syntax that Java and RE2 read the
# same way, no alternation inside a repetition, and a bounded local part, so long texts cost linear time.
PATTERNS = {
    "aws_key": r"AKIA[0-9A-Z]{16}",
    "api_key": r"([Aa][Pp][Ii][_-]?[Kk][Ee][Yy]|[Tt][Oo][Kk][Ee][Nn]) *[=:] *[\"']?[A-Za-z0-9_-]{16,}",
    "db_url": r"(postgres|postgresql|mysql|mongodb|sqlserver|oracle)://[^ \t\r\n\"']+",
    "jwt": r"eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+",
    "password": r"[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd] *[=:] *[\"']?[^ \t\r\n\"']+",
    "bearer_token": r"[Bb][Ee][Aa][Rr][Ee][Rr] +[A-Za-z0-9._~+/=-]{20,}",
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+",
    "phone": r"[+][0-9]{1,3}[ -]?[(]?[0-9]{3}[)]?[ -]?[0-9]{3}[ -]?[0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "credit_card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "connection_string": r"(Server|Host|Data Source) *= *[^;\r\n]+;",
}


# Text that every match of a pattern contains. A plain search for it is much cheaper than the expression, and
# most texts do not have it.
NEEDED = {
    "aws_key": "AKIA",
    "db_url": "://",
    "jwt": "eyJ",
    "email": "@",
    "phone": "+",
    "ssn": "-",
    "connection_string": "=",
}


def pattern_count(text: Column, pattern: str, needed: str | None = None) -> Column:
    """Occurrences of a pattern; ``needed`` is text without which there are none."""
    count = F.regexp_count(text, F.lit(pattern))
    return count if needed is None else F.when(F.contains(text, F.lit(needed)), count).otherwise(0)


def scan_patterns(
    df: DataFrame, text_col: str, keep: Sequence[str] = (), patterns: Mapping[str, str] = PATTERNS
) -> DataFrame:
    """One row per input row and pattern that occurs in it, with the number of occurrences."""
    hits = F.array(
        *[
            F.struct(
                F.lit(name).alias("pattern"),
                pattern_count(F.col(text_col), regex, NEEDED.get(name) if patterns is PATTERNS else None).alias("hits"),
            )
            for name, regex in patterns.items()
        ]
    )
    found = F.explode(F.filter(hits, lambda hit: hit["hits"] > 0)).alias("_hit")
    return df.select(*keep, found).select(*keep, "_hit.pattern", "_hit.hits")


def pattern_matrix(
    scanned: DataFrame, by: str, groups: Sequence[str], patterns: Mapping[str, str] = PATTERNS, other: str = "other"
) -> DataFrame:
    """One row per pattern and its hits by group: the listed groups, and all others, NULL included, in ``other``.

    The hits are summed per (pattern, group) first, so the pivot only handles one row per pair. A pattern without
    hits has a row of zeros.
    """
    group = F.when(F.col(by).isin(list(groups)), F.col(by)).otherwise(F.lit(other))
    totals = scanned.groupBy("pattern", group.alias("_group")).agg(F.sum("hits").alias("hits"))
    wide = totals.groupBy("pattern").pivot("_group", [*groups, other]).agg(F.sum("hits"))
    names = scanned.sparkSession.createDataFrame([(name,) for name in patterns], "pattern string")
    return names.join(wide, "pattern", "left").na.fill(0)
