"""Finance: loan risk features and insurance claim features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.conditional import band, flag, indicator_sum, ratio, weighted_score
from tallymark.functions.formulas import annuity_payment
from tallymark.operators.joins import Dim, enrich
from tallymark.plans.scoring.common import row_alerts, staged

# Thresholds, weights and labels of the rules. Bands list (threshold, result) in order.
LOAN = {
    "score_bands": [(750, 0), (700, 1), (650, 2), (600, 3)],
    "score_default": 4,
    "income": [(200000, "high"), (80000, "medium")],
    "income_default": "low",
    "valuation": 0.95,
    "zip_digits": 3,
    "zip_classes": 5,
    "features": ["credit_score", "annual_income", "dti_ratio", "risk_bucket", "loan_amount", "loan_term"],
    "label": "default_flag",
}
CLAIM = {
    "many_claims": 3,
    "amount": [(50000, 3), (25000, 2), (10000, 1)],
    "timing": [(90, 2), (180, 1)],
    "weights": {"velocity_flag": 2.5, "amount_flag": 1.8, "timing_flag": 2.0},
    "no_report": 1.5,
    "no_witness": 1.2,
    "features": [
        "claim_to_premium_ratio", "velocity_flag", "amount_flag", "timing_flag", "suspicious_score",
        "prior_claims_count",
    ],
    "label": "is_fraud",
}


def loan_features(applications: DataFrame, cfg=LOAN) -> DataFrame:
    amount = F.col("loan_amount")
    prefix = F.substring("zip_code", 1, cfg["zip_digits"]).try_cast("int")
    return staged(
        applications,
        {
            "dti_ratio": ratio(amount, "annual_income", "nonzero"),
            "risk_bucket": band("credit_score", cfg["score_bands"], cfg["score_default"]),
            "income_bracket": band("annual_income", cfg["income"], cfg["income_default"], ">"),
            "ltv_ratio": ratio(amount, F.col("property_value") * cfg["valuation"], "nonzero"),
            "monthly_payment": annuity_payment(amount, "interest_rate"),
            "zip_risk": prefix % cfg["zip_classes"],
        },
    )


def claim_features(
    claims: DataFrame, history: DataFrame, policies: DataFrame, agents: DataFrame, cfg=CLAIM
) -> DataFrame:
    joined = enrich(claims, [Dim(history, "policy_number"), Dim(policies, "policy_number"), Dim(agents, "agent_id")])
    after_start = F.datediff("claim_date", "policy_start_date")
    return staged(
        joined,
        {
            "claim_to_premium_ratio": ratio("claim_amount", "annual_premium", "eps"),
            "velocity_flag": flag(F.col("prior_claims_count") >= cfg["many_claims"]),
            "amount_flag": band("claim_amount", cfg["amount"], 0, ">"),
            "timing_flag": band(after_start, cfg["timing"], 0, "<"),
        },
        {
            "suspicious_score": weighted_score(cfg["weights"])
            + indicator_sum([(F.col("police_report_filed") == F.lit(False), cfg["no_report"])])
            + indicator_sum([(F.col("witness_count") == 0, cfg["no_witness"])])
        },
    )


def claim_alerts(predicted: DataFrame) -> DataFrame:
    return row_alerts(
        predicted,
        F.col("prediction") == 1.0,
        ["claim_id", "claim_amount"],
        {"claimant_name": "name", "claimant_ssn": "ssn"},
    )
