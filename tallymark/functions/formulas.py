"""Closed-form business formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.conditional import as_column

# Fixed values of the formulas.
MORTGAGE_MONTHS = 360
DAYS_PER_YEAR = 365.25
DOSAGE_FACTOR = 0.85
DOSAGE_BASE = 12.5


def annuity_payment(principal: Column | str, annual_rate_pct: Column | str, n: int = MORTGAGE_MONTHS) -> Column:
    """Level monthly payment of a loan; NULL for a zero rate."""
    p, monthly = as_column(principal), as_column(annual_rate_pct) / 12 / 100
    growth = F.pow(1 + monthly, F.lit(n))
    return F.try_divide(p * monthly * growth, growth - 1)


def age_years(birth: Column | str, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, as_column(birth)) / F.lit(DAYS_PER_YEAR))


def bmi(weight_kg: Column | str, height_cm: Column | str) -> Column:
    metres = as_column(height_cm) / 100
    return F.try_divide(as_column(weight_kg), F.pow(metres, F.lit(2)))


def adjusted_dosage(dosage: Column | str) -> Column:
    return as_column(dosage) * DOSAGE_FACTOR + DOSAGE_BASE


def deviation(c: Column | str, nominal: float) -> Column:
    """Relative distance from a nominal value."""
    return F.abs(as_column(c) - nominal) / nominal
