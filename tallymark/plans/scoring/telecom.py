"""Telecom: churn, revenue assurance, personalised offers, subscriber fraud, network quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.conditional import band, band_where, ratio, rule_table, rules, weighted_score
from tallymark.operators.joins import Dim, enrich
from tallymark.operators.kpi import flag_counts, nested_alert, segment_alert
from tallymark.operators.quality import as_of_date
from tallymark.plans.scoring.common import is_true, row_alerts, staged

# Thresholds, weights and labels of the rules. Bands list (threshold, result) in order.
CHURN = {
    "months": 12,
    "days": 30.0,
    "calls": [(500, 1), (200, 2)],
    "contract": [(-30, 0), (0, 1), (30, 2), (90, 3)],
    "no_complaint": 999,
    # The last two rows together are one rule with two alternatives.
    "risk": [
        ({"contract_band": (">=", 3), "call_band": ("==", 3), "complaint_age_days": ("<", 30)}, "HIGH"),
        ({"contract_band": (">=", 2), "call_band": (">=", 2), "complaint_age_days": ("<", 60)}, "MEDIUM"),
        ({"contract_band": (">=", 3), "gb_per_charge": ("<", 0.5)}, "HIGH"),
        ({"contract_band": (">=", 2)}, "MEDIUM"),
        ({"complaint_age_days": ("<", 90)}, "MEDIUM"),
    ],
    "risk_default": "LOW",
}
ASSURANCE = {
    "voice_roaming": 0.35,
    "voice_home": 0.05,
    "mebibyte": 1048576.0,
    "data_roaming": 0.02,
    "gibibyte": 1073741824.0,
    "data_home": 8.50,
    "sms_roaming": 0.25,
    "sms_home": 0.05,
    "leakage": [(25, "CRITICAL"), (10, "HIGH"), (5, "MEDIUM")],
    "fraud": [
        ({"duration_seconds": (">", 7200), "rated_amount": ("<", 1.0)}, 4),
        ({"data_bytes": (">", 5368709120), "rated_amount": ("<", 5.0)}, 4),
        ({"rated_amount": ("==", 0)}, 3),
    ],
    "fraud_from": 3,
    "region_leak_above": 10000,
    "plans": ["unlimited", "tiered", "prepaid"],
}
OFFERS = {
    "value": [(150, "platinum"), (100, "gold"), (60, "silver"), (30, "bronze")],
    "engagement": [(50, 5), (25, 4), (10, 3), (5, 2), (1, 1)],
    "data": [(50, 5), (20, 4), (10, 3), (5, 2)],
    "voice": [(1000, 5), (500, 4), (200, 3)],
    "streaming": [(40, 5), (20, 4), (10, 3)],
    "weights": {
        "propensity_to_upgrade": 4.0, "engagement_score": 1.5, "data_affinity": 2.0, "propensity_to_churn": -3.0,
    },
    "upgrade_above": 15,
    "offers": [
        ({"value_tier": ("==", "platinum"), "upgrade_score": (">", 15)}, "premium_bundle"),
        ({"data_affinity": (">=", 4), "streaming_affinity": (">=", 4)}, "unlimited_data_streaming"),
        ({"voice_affinity": (">=", 4), "data_affinity": ("<=", 2)}, "voice_focused_plan"),
        ({"propensity_to_churn": (">", 0.6)}, "retention_discount_20pct"),
        ({"tenure_months": (">", 24)}, "loyalty_reward"),
    ],
    "offer_default": "standard_offer",
    "retention_share": 0.20,
    "loyalty_amount": 15.00,
    "bundle_amount": 25.00,
    "alert_above": 0.7,
    "rollup_offers": ["premium_bundle", "retention_discount_20pct", "unlimited_data_streaming"],
    "group_count_above": 100,
    "avg_arpu_above": 80,
}
FRAUD = {
    "sim": [(3, 5), (2, 4), (1, 2)],
    "device": [(4, 5), (3, 4), (2, 3), (1, 1)],
    "international": [(50, 5), (20, 4), (10, 3), (5, 2)],
    "wangiri": [
        ({"short_call_count_1h": (">", 20), "unique_numbers_1h": (">", 15)}, 5),
        ({"short_call_count_1h": (">", 10), "unique_numbers_1h": (">", 8)}, 4),
        ({"short_call_count_1h": (">", 5)}, 2),
    ],
    "subscription": [
        ({"account_age_days": ("<", 30), "intl_usage_pct": (">", 80)}, 5),
        ({"account_age_days": ("<", 60), "intl_usage_pct": (">", 60)}, 4),
        ({"account_age_days": ("<", 90), "credit_score": ("<", 500)}, 3),
    ],
    "weights": {
        "sim_swap_risk": 4.5, "device_risk": 2.0, "irsf_risk": 5.0, "wangiri_risk": 3.5, "sub_fraud_risk": 3.0,
    },
    "probability": [(35, 0.95), (25, 0.80), (15, 0.55), (8, 0.30)],
    "probability_default": 0.05,
    "alert_above": 0.8,
    "high_risk_from": 4,
    "types": [
        ("sim_swap", "sim_swap_risk", 4), ("irsf", "irsf_risk", 4), ("wangiri", "wangiri_risk", 4),
        ("subscription", "sub_fraud_risk", 3),
    ],
    "channels": ["online", "retail_store", "call_center", "ivr"],
    "avg_score_above": 20,
}
NETWORK = {
    "throughput": [(100, 5), (50, 4), (25, 3), (10, 2), (5, 1)],
    "drops": [(0.5, 5), (1.0, 4), (2.0, 3), (3.0, 2), (5.0, 1)],
    "utilization": [(40, 5), (60, 4), (75, 3), (85, 2), (95, 1)],
    "interference": [(-80, 4), (-90, 3), (-100, 2), (-110, 1)],
    # Utilisation above, users above this share of the capacity.
    "congestion": [(85, 0.9, "CRITICAL"), (70, 0.7, "HIGH")],
    "congestion_medium": (60, "MEDIUM"),
    "congestion_default": "LOW",
    "weights": {"throughput_score": 3.0, "drop_rate_score": 4.5, "utilization_score": 2.5},
    "base": 5,
    "interference_weight": 1.5,
    "poor_below": 10,
    "technologies": ["5G_NR", "LTE", "3G"],
}


def churn_features(usage: DataFrame, as_of=None, cfg=CHURN) -> DataFrame:
    today, complaint = as_of_date(as_of), F.col("last_complaint_date")
    return staged(
        usage,
        {
            "contract_days": F.datediff(today, F.col("contract_end_date")),
            "yearly_charge": F.col("monthly_charge") * cfg["months"],
            "daily_gb": F.col("data_usage_gb") / cfg["days"],
            "call_band": band("call_minutes", cfg["calls"], 3, ">"),
            "gb_per_charge": ratio("data_usage_gb", "monthly_charge", "eps"),
            "complaint_age_days": F.coalesce(F.datediff(today, complaint), F.lit(cfg["no_complaint"])),
        },
        {"contract_band": band("contract_days", cfg["contract"], 4, "<")},
        {"churn_risk": rule_table(cfg["risk"], cfg["risk_default"])},
    )


def churn_summary(scored: DataFrame) -> DataFrame:
    risk = F.col("churn_risk")
    return flag_counts(scored, {"high": risk == "HIGH", "medium": risk == "MEDIUM"})


def churn_high_risk(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("churn_risk") == "HIGH")


def revenue_assurance(
    calls: DataFrame, invoices: DataFrame, payments: DataFrame, plan_rates: DataFrame, cfg=ASSURANCE
) -> DataFrame:
    joined = enrich(calls, [Dim(invoices, "subscriber_id"), Dim(payments, "subscriber_id"), Dim(plan_rates, "plan_type")])
    minutes, data = F.col("duration_seconds") / 60.0, F.col("data_bytes")
    roaming, expected, billed = is_true("roaming_flag"), F.col("expected_total"), F.col("billed_amount")

    def by_roaming(abroad, home):
        return F.when(roaming, abroad).otherwise(home)

    return staged(
        joined,
        {
            "expected_voice_charge": by_roaming(minutes * cfg["voice_roaming"], minutes * cfg["voice_home"]),
            "expected_data_charge": by_roaming(
                data / cfg["mebibyte"] * cfg["data_roaming"], data / cfg["gibibyte"] * cfg["data_home"]
            ),
            "expected_sms_charge": F.when(
                is_true("sms_flag"), by_roaming(cfg["sms_roaming"], cfg["sms_home"])
            ).otherwise(0.0),
            "fraud_indicator": rule_table(cfg["fraud"], 0),
        },
        {
            "expected_total": F.col("expected_voice_charge")
            + F.col("expected_data_charge")
            + F.col("expected_sms_charge")
        },
        {
            "leakage_pct": ratio(expected - billed, expected, "eps", 0.001) * 100,
            "revenue_impact": expected - billed,
        },
        {"leakage_flag": band(F.abs("leakage_pct"), cfg["leakage"], "OK", ">")},
    )


def assurance_summary(scored: DataFrame, cfg=ASSURANCE) -> DataFrame:
    return flag_counts(
        scored,
        {"critical": F.col("leakage_flag") == "CRITICAL", "fraudulent": F.col("fraud_indicator") >= cfg["fraud_from"]},
        {"total_impact": F.sum("revenue_impact")},
    )


def assurance_alerts(scored: DataFrame) -> DataFrame:
    return row_alerts(
        scored,
        F.col("leakage_flag") == "CRITICAL",
        ["cdr_id", "subscriber_id", "leakage_flag", "revenue_impact"],
        {"customer_name": "name", "customer_email": "email", "customer_phone": "phone", "customer_ssn": "ssn"},
    )


def assurance_rollup(scored: DataFrame, cfg=ASSURANCE) -> DataFrame:
    """Regions with a large net leak, one row per listed plan that has critical records."""
    return nested_alert(
        scored.filter(F.col("leakage_flag") == "CRITICAL"),
        "region",
        "plan_type",
        cfg["plans"],
        {"plan_leak": F.sum("revenue_impact")},
        {"total_leak": F.sum("plan_leak")},
        F.abs("total_leak") > cfg["region_leak_above"],
    ).select("region", "plan_type", "total_leak")


def personalised_offers(
    customers: DataFrame, usage: DataFrame, campaigns: DataFrame, browsing: DataFrame, cfg=OFFERS
) -> DataFrame:
    joined = enrich(customers, [Dim(usage, "customer_id"), Dim(campaigns, "customer_id"), Dim(browsing, "customer_id")])
    offer = F.col("recommended_offer")
    return staged(
        joined,
        {
            "value_tier": band("monthly_arpu", cfg["value"], "basic"),
            "engagement_score": band("total_interactions", cfg["engagement"], 0),
            "data_affinity": band("data_usage_gb", cfg["data"], 1, ">"),
            "voice_affinity": band("call_minutes", cfg["voice"], 1, ">"),
            "streaming_affinity": band("streaming_hours", cfg["streaming"], 1, ">"),
        },
        {"upgrade_score": weighted_score(cfg["weights"])},
        {"recommended_offer": rule_table(cfg["offers"], cfg["offer_default"])},
        {
            "discount_amount": rules(
                [
                    (offer == "retention_discount_20pct", F.col("monthly_arpu") * cfg["retention_share"]),
                    (offer == "loyalty_reward", cfg["loyalty_amount"]),
                    (offer == "premium_bundle", cfg["bundle_amount"]),
                ],
                0.0,
            )
        },
    )


def offers_summary(scored: DataFrame, cfg=OFFERS) -> DataFrame:
    return flag_counts(
        scored,
        {
            "likely_churners": F.col("propensity_to_churn") > cfg["alert_above"],
            "upgrade_candidates": F.col("upgrade_score") > cfg["upgrade_above"],
            "platinum": F.col("value_tier") == "platinum",
        },
    )


def offers_alerts(scored: DataFrame, cfg=OFFERS) -> DataFrame:
    return row_alerts(
        scored,
        F.col("propensity_to_churn") > cfg["alert_above"],
        ["customer_id", "recommended_offer", "discount_amount", "propensity_to_churn"],
        {"email": "email", "phone_number": "phone", "ssn": "ssn", "credit_card_number": "card"},
    )


def offers_rollup(scored: DataFrame, cfg=OFFERS) -> DataFrame:
    return segment_alert(
        scored,
        ["value_tier", "recommended_offer"],
        {"customers": F.count(F.lit(1)), "avg_arpu": F.avg("monthly_arpu")},
        (F.col("customers") > cfg["group_count_above"]) & (F.col("avg_arpu") > cfg["avg_arpu_above"]),
        only={"recommended_offer": cfg["rollup_offers"]},
    )


def subscriber_fraud(
    subscribers: DataFrame, sim_changes: DataFrame, device_changes: DataFrame, international: DataFrame, cfg=FRAUD
) -> DataFrame:
    joined = enrich(
        subscribers,
        [Dim(sim_changes, "subscriber_id"), Dim(device_changes, "subscriber_id"), Dim(international, "subscriber_id")],
    )
    return staged(
        joined,
        {"sim_swap_count_30d": F.coalesce("sim_changes_30d", F.lit(0))},
        {
            "sim_swap_risk": band("sim_swap_count_30d", cfg["sim"], 0),
            "device_risk": band("device_changes_30d", cfg["device"], 0),
            "irsf_risk": band("intl_call_count_24h", cfg["international"], 0, ">"),
            "wangiri_risk": rule_table(cfg["wangiri"], 0),
            "sub_fraud_risk": rule_table(cfg["subscription"], 0),
        },
        {"fraud_score": weighted_score(cfg["weights"])},
        {"fraud_probability": band("fraud_score", cfg["probability"], cfg["probability_default"], ">")},
    )


def _likely_fraud(cfg) -> Column:
    return band_where("fraud_score", cfg["probability"], lambda p: p > cfg["alert_above"], ">")


def fraud_summary(scored: DataFrame, cfg=FRAUD) -> DataFrame:
    return flag_counts(
        scored,
        {
            "likely_fraud": _likely_fraud(cfg),
            "sim_swaps": F.col("sim_swap_risk") >= cfg["high_risk_from"],
            "revenue_share": F.col("irsf_risk") >= cfg["high_risk_from"],
        },
        {"total": F.count(F.lit(1))},
    )


def fraud_alerts(scored: DataFrame, cfg=FRAUD) -> DataFrame:
    return row_alerts(
        scored,
        _likely_fraud(cfg),
        ["subscriber_id", "fraud_probability", "fraud_score"],
        {
            "msisdn": "phone", "customer_name": "name", "customer_email": "email", "customer_phone": "phone",
            "customer_ssn": "ssn", "credit_card_number": "card",
        },
    )


def fraud_rollup(scored: DataFrame, cfg=FRAUD) -> DataFrame:
    """Fraud types overlap, so a subscriber counts once for every type that applies."""
    matching = F.array_compact(F.array(*[F.when(F.col(c) >= limit, name) for name, c, limit in cfg["types"]]))
    typed = scored.select("channel", "fraud_score", F.explode(matching).alias("fraud_type"))
    return segment_alert(
        typed,
        ["fraud_type", "channel"],
        {"avg_score": F.avg("fraud_score"), "subscribers": F.count(F.lit(1))},
        F.col("avg_score") > cfg["avg_score_above"],
        only={"channel": cfg["channels"]},
    )


def network_quality(
    cells: DataFrame, traffic: DataFrame, complaints: DataFrame, speed_tests: DataFrame, cfg=NETWORK
) -> DataFrame:
    joined = enrich(cells, [Dim(traffic, "cell_id"), Dim(complaints, "cell_id"), Dim(speed_tests, "cell_id")])
    used, users, room = F.col("prb_utilization_pct"), F.col("connected_users"), F.col("max_capacity")
    medium_above, medium = cfg["congestion_medium"]
    return staged(
        joined,
        {
            "throughput_score": band("avg_throughput_mbps", cfg["throughput"], 0),
            "drop_rate_score": band("drop_call_rate", cfg["drops"], 0, "<"),
            "utilization_score": band(used, cfg["utilization"], 0, "<"),
            "congestion_risk": rules(
                [((used > above) & (users > room * share), risk) for above, share, risk in cfg["congestion"]]
                + [(used > medium_above, medium)],
                cfg["congestion_default"],
            ),
            "interference_flag": band("interference_level_dbm", cfg["interference"], 0, ">"),
        },
        {
            "nqi_score": weighted_score(cfg["weights"], cfg["base"])
            - F.col("interference_flag") * cfg["interference_weight"]
        },
    )


def network_summary(scored: DataFrame, cfg=NETWORK) -> DataFrame:
    return flag_counts(
        scored,
        {"critical": F.col("congestion_risk") == "CRITICAL", "poor_quality": F.col("nqi_score") < cfg["poor_below"]},
        {"total": F.count(F.lit(1))},
    )


def network_alerts(scored: DataFrame) -> DataFrame:
    return row_alerts(
        scored,
        F.col("congestion_risk") == "CRITICAL",
        ["cell_id", "nqi_score", "congestion_risk"],
        {"engineer_name": "name", "engineer_email": "email", "engineer_phone": "phone", "engineer_ssn": "ssn"},
    )


def network_rollup(scored: DataFrame, cfg=NETWORK) -> DataFrame:
    return segment_alert(
        scored.filter(F.col("congestion_risk") == "CRITICAL"),
        ["market_id", "technology"],
        {"avg_nqi": F.avg("nqi_score"), "cells": F.count(F.lit(1))},
        F.col("cells") > 0,
        only={"technology": cfg["technologies"]},
    )
