"""Banking silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.aggregates import avg_round, count_where, rate, sum_if
from tallymark.functions.conditional import band
from tallymark.operators.joins import join_aggregates
from tallymark.operators.kpi import kpis, kpis_with_distinct
from tallymark.operators.quality import stamp

# Tiers of the whole relationship.
VALUE_TIERS = [(5000000, "PLATINUM"), (1000000, "GOLD"), (100000, "SILVER")]
VALUE_TIER_DEFAULT = "STANDARD"
PARTITIONS = {
    "customer_360": ["risk_category"],
    "daily_transaction_summary": ["transaction_date"],
    "loan_portfolio_risk_summary": ["loan_type"],
}


def customer_360(
    customers: DataFrame, accounts: DataFrame, cards: DataFrame, loans: DataFrame, alerts: DataFrame, as_of=None
) -> DataFrame:
    """One row per customer. Each detail table is aggregated to the customer before it is joined."""
    rows, key = F.count(F.lit(1)), ["customer_id"]
    account_totals = kpis(
        accounts,
        {
            "total_accounts": rows,
            "active_accounts": count_where(F.col("account_status") == "ACTIVE"),
            "dormant_accounts": count_where(F.col("dormant_flag")),
            "total_current_balance": F.sum("current_balance"),
            "total_available_balance": F.sum("available_balance"),
        },
        by=key,
    )
    card_totals = kpis(
        cards,
        {
            "total_cards": rows,
            "active_cards": count_where(F.col("is_active_flag")),
            "total_credit_limit": F.sum("credit_limit"),
            "total_available_credit": F.sum("available_credit_limit"),
            "avg_credit_utilization_ratio": avg_round("credit_utilization_ratio", 4),
        },
        by=key,
    )
    loan_totals = kpis(
        loans,
        {
            "total_loans": rows,
            "active_loans": count_where(F.col("loan_status") == "DISBURSED"),
            "defaulted_loans": count_where(F.col("is_defaulted_flag")),
            "total_sanctioned_amount": F.sum("sanctioned_amount"),
            "total_outstanding_amount": F.sum("outstanding_amount"),
            "latest_credit_score": F.max("credit_score"),
        },
        by=key,
    )
    alert_totals = kpis(
        alerts.filter(F.col("customer_id").isNotNull()),
        {
            "total_compliance_alerts": rows,
            "open_compliance_alerts": count_where(F.col("is_open_flag")),
            "high_severity_alerts": count_where(F.col("is_high_severity_flag")),
            "sar_filed_count": count_where(F.col("sar_filed_flag")),
            "max_risk_score": F.max("risk_score"),
        },
        by=key,
    )
    profile = customers.select(
        "customer_id", "full_name", "customer_type", "age_years", "kyc_status", "kyc_verified_flag",
        "risk_category", "high_risk_customer_flag",
    )
    details = [account_totals, card_totals, loan_totals, alert_totals]
    # These stay NULL for customers without cards, loans or alerts.
    unset = {"customer_id", "avg_credit_utilization_ratio", "latest_credit_score", "max_risk_score"}
    defaults = {c: 0 for d in details for c in d.columns if c not in unset}
    joined = join_aggregates(profile, "customer_id", details, defaults)
    worth = F.col("total_current_balance") + F.col("total_outstanding_amount")
    tiered = joined.withColumn("customer_value_tier", band(worth, VALUE_TIERS, VALUE_TIER_DEFAULT))
    return stamp(tiered, "gold_load_ts", as_of)


def daily_transaction_summary(transactions: DataFrame, as_of=None) -> DataFrame:
    """Daily indicators; active accounts and customers are counted by marks, since two distinct counts would copy every row."""
    amount, status, side = F.col("transaction_amount"), F.col("transaction_status"), F.col("debit_credit_indicator")
    summary = kpis_with_distinct(
        transactions,
        {"distinct_accounts_active": "account_id", "distinct_customers_active": "customer_id"},
        {
            "total_transaction_count": F.count(F.lit(1)),
            "successful_transaction_count": count_where(F.col("is_successful")),
            "failed_transaction_count": count_where(status == "FAILED"),
            "reversed_transaction_count": count_where(status == "REVERSED"),
            "total_debit_amount": sum_if(side == "DEBIT", amount),
            "total_credit_amount": sum_if(side == "CREDIT", amount),
            "total_transaction_value": F.sum(amount),
            "high_value_transaction_count": count_where(F.col("high_value_txn_flag")),
            "_amounts": F.count(amount),
        },
        {"max_transaction_value": F.max(amount)},
        by=["transaction_date", "transaction_type", "transaction_channel", "transaction_currency"],
    )
    mean = F.round(F.try_divide("total_transaction_value", "_amounts"), 2)
    return stamp(summary.withColumn("avg_transaction_value", mean).drop("_amounts"), "gold_load_ts", as_of)


def loan_portfolio_risk_summary(loans: DataFrame, as_of=None) -> DataFrame:
    summary = kpis(
        loans,
        {
            "total_loans": F.count(F.lit(1)),
            "distinct_borrowers": F.countDistinct("customer_id"),
            "total_sanctioned_amount": F.sum("sanctioned_amount"),
            "total_outstanding_amount": F.sum("outstanding_amount"),
            "avg_outstanding_ratio": avg_round("outstanding_to_sanctioned_ratio", 4),
            "avg_interest_rate": avg_round("interest_rate", 2),
            "avg_emi_amount": avg_round("emi_amount", 2),
            "avg_credit_score": avg_round("credit_score", 0),
            "overdue_loan_count": count_where(F.col("is_overdue_flag")),
            "defaulted_loan_count": count_where(F.col("is_defaulted_flag")),
            "default_rate": rate(F.col("is_defaulted_flag"), 4),
        },
        by=["loan_type", "loan_status", "credit_score_band"],
    )
    return stamp(summary, "gold_load_ts", as_of)
