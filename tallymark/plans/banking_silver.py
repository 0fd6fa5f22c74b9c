"""Banking bronze to silver.

Every builder takes the bronze rows and returns the silver rows and the quarantined ones. Deleted versions are
dropped first and the newest remaining version is kept, so an older live version comes back when the newest
one is deleted. ``as_of`` replaces today's date; ``tie_breakers`` order versions with equal times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallymark.functions.conditional import band, ratio
from tallymark.functions.formulas import age_years
from tallymark.functions.privacy import mask_email, mask_id, mask_phone
from tallymark.operators.quality import add_audit, as_of_date, drop_deleted, split_quarantine
from tallymark.operators.windows import dedupe_latest

MONEY = DecimalType(18, 2)
SCORE = DecimalType(5, 2)

# Thresholds, code lists, mandatory columns and output columns of the silver tables.
HIGH_VALUE_FROM = 200000
DORMANT_AFTER_DAYS = 365
EXPIRING_MONTHS = 3
CREDIT_BANDS = [(750, "EXCELLENT"), (650, "GOOD"), (550, "FAIR")]
CREDIT_BAND_DEFAULT = "POOR"
OPEN_STATUSES = ["OPEN", "UNDER_REVIEW", "ESCALATED"]
SEVERE = ["HIGH", "CRITICAL"]
MANDATORY = {
    "customers": ["customer_id", "first_name", "last_name"],
    "accounts": ["account_id", "customer_id"],
    "transactions": ["transaction_id", "account_id", "transaction_amount"],
    "loans": ["loan_id", "customer_id"],
    "cards": ["card_id", "customer_id"],
    "compliance_alerts": ["alert_id", "alert_type"],
}
PARTITIONS = {
    "customers": ["customer_type"],
    "accounts": ["account_type"],
    "transactions": ["transaction_date", "transaction_type"],
    "loans": ["loan_type"],
    "cards": ["card_type"],
    "compliance_alerts": ["alert_type"],
}
AUDIT = ["source_system", "data_quality_flag", "source_batch_id", "data_load_ts", "silver_load_ts"]
COLUMNS = {
    "customers": [
        "customer_id", "customer_type", "full_name", "first_name", "last_name", "date_of_birth", "age_years",
        "email_masked", "secondary_email_masked", "mobile_number_masked", "alternate_phone_masked",
        "pan_number_masked", "aadhaar_number_masked", "kyc_status", "kyc_verified_flag", "risk_category",
        "high_risk_customer_flag", *AUDIT,
    ],
    "accounts": [
        "account_id", "customer_id", "account_type", "account_status", "branch_code", "currency_code",
        "account_open_date", "account_close_date", "account_age_days", "current_balance", "available_balance",
        "held_funds_amount", "ifsc_code", "is_joint_account", "joint_holder_customer_id_masked", "product_code",
        "account_last_txn_date", "dormant_flag", *AUDIT,
    ],
    "transactions": [
        "transaction_id", "account_id", "customer_id", "transaction_type", "transaction_channel",
        "transaction_amount", "signed_amount", "debit_credit_indicator", "transaction_currency",
        "transaction_timestamp", "transaction_date", "transaction_reference", "counterparty_account_masked",
        "counterparty_ifsc", "merchant_id", "transaction_status", "is_successful", "high_value_txn_flag", *AUDIT,
    ],
    "loans": [
        "loan_id", "customer_id", "loan_type", "loan_status", "application_date", "disbursement_date",
        "sanctioned_amount", "outstanding_amount", "outstanding_to_sanctioned_ratio", "interest_rate",
        "emi_amount", "emi_due_date", "is_overdue_flag", "is_defaulted_flag", "credit_score",
        "credit_score_band", "tenure_months", "loan_purpose", *AUDIT,
    ],
    "cards": [
        "card_id", "customer_id", "account_id", "card_type", "card_network", "card_number_masked", "card_status",
        "is_active_flag", "issue_date", "expiry_date", "expiring_soon_flag", "credit_limit",
        "available_credit_limit", "credit_utilization_ratio", "billing_cycle_day", "card_tier",
        "last_transaction_date", *AUDIT,
    ],
    "compliance_alerts": [
        "alert_id", "customer_id", "account_id", "transaction_id", "alert_type", "alert_severity",
        "is_high_severity_flag", "alert_status", "is_open_flag", "alert_generated_ts", "rule_triggered",
        "risk_score", "sar_filed_flag", "investigation_status", "reported_to_regulator_flag", "resolution_date",
        "alert_age_days", *AUDIT,
    ],
}

Built = tuple[DataFrame, DataFrame]


def _typed(kind, *names: str) -> dict[str, Column]:
    return {name: F.col(name).try_cast(kind) for name in names}


def current_versions(bronze: DataFrame, key: str, order_col: str, tie_breakers: Sequence[str]) -> DataFrame:
    return dedupe_latest(drop_deleted(bronze), [key], order_col, tie_breakers)


def split_good(versions: DataFrame, table: str, as_of=None) -> Built:
    return split_quarantine(versions, MANDATORY[table], as_of)


def _finish(df: DataFrame, table: str, as_of) -> DataFrame:
    return add_audit(df, as_of).select(*COLUMNS[table])


def conform_customers(good: DataFrame, as_of=None) -> DataFrame:
    middle = F.coalesce(F.col("middle_name"), F.lit(""))
    shaped = good.withColumns(
        {
            **_typed("date", "date_of_birth"),
            "full_name": F.trim(F.concat_ws(" ", F.col("first_name"), middle, F.col("last_name"))),
            "kyc_verified_flag": F.col("kyc_status") == "VERIFIED",
            "high_risk_customer_flag": F.col("risk_category") == "HIGH",
            **{f"{c}_masked": mask_email(c) for c in ("email", "secondary_email")},
            **{f"{c}_masked": mask_phone(c) for c in ("mobile_number", "alternate_phone")},
            **{f"{c}_masked": mask_id(c) for c in ("pan_number", "aadhaar_number")},
        }
    ).withColumn("age_years", age_years("date_of_birth", as_of_date(as_of)))
    return _finish(shaped, "customers", as_of)


def conform_accounts(good: DataFrame, as_of=None) -> DataFrame:
    today = as_of_date(as_of)
    idle = F.datediff(today, F.col("account_last_txn_date"))
    shaped = good.withColumns(
        {
            **_typed(MONEY, "current_balance", "available_balance"),
            **_typed("date", "account_open_date", "account_close_date", "account_last_txn_date"),
            "is_joint_account": F.col("joint_holder_customer_id").isNotNull(),
            "joint_holder_customer_id_masked": mask_id("joint_holder_customer_id"),
        }
    ).withColumns(
        {
            "account_age_days": F.datediff(F.coalesce("account_close_date", today), F.col("account_open_date")),
            "held_funds_amount": F.col("current_balance") - F.col("available_balance"),
            "dormant_flag": (F.col("account_status") == "DORMANT") | (idle > DORMANT_AFTER_DAYS),
        }
    )
    return _finish(shaped, "accounts", as_of)


def conform_transactions(good: DataFrame, as_of=None) -> DataFrame:
    amount = F.col("transaction_amount")
    shaped = good.withColumns(
        {
            **_typed(MONEY, "transaction_amount"),
            **_typed("timestamp", "transaction_timestamp"),
            "is_successful": F.col("transaction_status") == "SUCCESS",
            "counterparty_account_masked": mask_id("counterparty_account"),
        }
    ).withColumns(
        {
            "transaction_date": F.to_date("transaction_timestamp"),
            "signed_amount": F.when(F.col("debit_credit_indicator") == "DEBIT", -amount).otherwise(amount),
            "high_value_txn_flag": amount >= HIGH_VALUE_FROM,
        }
    )
    return _finish(shaped, "transactions", as_of)


def conform_loans(good: DataFrame, as_of=None) -> DataFrame:
    shaped = good.withColumns(
        {
            **_typed(MONEY, "sanctioned_amount", "outstanding_amount"),
            **_typed("date", "application_date", "disbursement_date", "emi_due_date"),
            "is_defaulted_flag": F.col("loan_status") == "DEFAULTED",
            "credit_score_band": band("credit_score", CREDIT_BANDS, CREDIT_BAND_DEFAULT),
        }
    ).withColumns(
        {
            "outstanding_to_sanctioned_ratio": F.round(ratio("outstanding_amount", "sanctioned_amount"), 4),
            "is_overdue_flag": F.col("emi_due_date") < as_of_date(as_of),
        }
    )
    return _finish(shaped, "loans", as_of)


def conform_cards(good: DataFrame, as_of=None) -> DataFrame:
    limit, left = F.col("credit_limit"), F.col("available_credit_limit")
    shaped = good.withColumns(
        {
            **_typed(MONEY, "credit_limit", "available_credit_limit"),
            **_typed("date", "issue_date", "expiry_date", "last_transaction_date"),
            "is_active_flag": F.col("card_status") == "ACTIVE",
        }
    ).withColumns(
        {
            "credit_utilization_ratio": F.round(ratio(limit - left, limit), 4),
            "expiring_soon_flag": F.col("expiry_date") <= F.add_months(as_of_date(as_of), EXPIRING_MONTHS),
        }
    )
    return _finish(shaped, "cards", as_of)


def conform_compliance_alerts(good: DataFrame, as_of=None) -> DataFrame:
    false = F.lit(False)
    until = F.coalesce("resolution_date", as_of_date(as_of))
    shaped = good.withColumns(
        {
            **_typed(SCORE, "risk_score"),
            **_typed("timestamp", "alert_generated_ts"),
            **_typed("date", "resolution_date"),
            "is_open_flag": F.col("alert_status").isin(OPEN_STATUSES),
            "is_high_severity_flag": F.col("alert_severity").isin(SEVERE),
            "sar_filed_flag": F.coalesce("sar_filed_flag", false),
            "reported_to_regulator_flag": F.coalesce("reported_to_regulator_flag", false),
        }
    ).withColumn("alert_age_days", F.datediff(until, F.to_date("alert_generated_ts")))
    return _finish(shaped, "compliance_alerts", as_of)


# Table, key, column that orders the versions, and conforming step.
TABLES = {
    "customers": ("customer_id", "data_load_ts", conform_customers),
    "accounts": ("account_id", "data_load_ts", conform_accounts),
    "transactions": ("transaction_id", "transaction_timestamp", conform_transactions),
    "loans": ("loan_id", "data_load_ts", conform_loans),
    "cards": ("card_id", "data_load_ts", conform_cards),
    "compliance_alerts": ("alert_id", "alert_generated_ts", conform_compliance_alerts),
}


def build(table: str, bronze: DataFrame, as_of=None, tie_breakers: Sequence[str] = ()) -> Built:
    """Silver rows and quarantined rows of one table."""
    key, order_col, conform = TABLES[table]
    good, bad = split_good(current_versions(bronze, key, order_col, tie_breakers), table, as_of)
    return conform(good, as_of), bad
