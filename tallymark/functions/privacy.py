"""Masking and hashing of personal data. All are built-in expressions and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.conditional import as_column

# The mask texts.
EMAIL_MASK = "***@"
PHONE_MASK = "******"
ID_MASK = "XXXXXXXX"


def mask_email(c: Column | str) -> Column:
    """First character and domain. NULL for NULL and for text without an ``@``."""
    c = as_column(c)
    domain = F.get(F.split(c, "@"), F.lit(1))
    return F.concat(F.substring(c, 1, 1), F.lit(EMAIL_MASK), domain)


def mask_email_normalised(c: Column | str) -> Column:
    """As ``mask_email``, on the trimmed lower-case address and with nothing shown of an empty local part."""
    parts = F.split(F.lower(F.trim(as_column(c))), "@")
    local, domain = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.concat(F.substring(local, 1, 1), F.lit(EMAIL_MASK), domain)


def _last_four(c: Column | str, mask: str) -> Column:
    return F.concat(F.lit(mask), F.substring(as_column(c), -4, 4))


def mask_phone(c: Column | str) -> Column:
    return _last_four(c, PHONE_MASK)


def mask_id(c: Column | str) -> Column:
    return _last_four(c, ID_MASK)


def hash_pii(c: Column | str) -> Column:
    return F.sha2(F.trim(as_column(c)), 256)
