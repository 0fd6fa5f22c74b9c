"""Retail: demand features, customer value, pricing, point-of-sale checks, delivery cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.conditional import band, flag, lookup, ratio, rule_table, rules
from tallymark.operators.joins import Dim, enrich
from tallymark.operators.kpi import flag_counts, nested_alert, segment_alert, share
from tallymark.operators.quality import as_of_date
from tallymark.plans.scoring.common import row_alerts, staged

# Thresholds, weights and labels of the rules. Bands list (threshold, result) in order.
DEMAND = {
    "promo_above": 15.0,
    "high_value_above": 500,
    "seasons": [([11, 12], 1.45), ([6, 7, 8], 1.15), ([1, 2], 0.75)],
    "loyalty": [(20, "platinum"), (10, "gold"), (5, "silver")],
    "loyalty_default": "bronze",
    "features": ["dow", "m", "wk", "promo_flag", "seasonal_factor"],
    "alert_above": 100,
}
CUSTOMER_VALUE = {
    "recency": [(7, 5), (14, 4), (30, 3), (60, 2), (90, 1)],
    "frequency": [(50, 5), (25, 4), (12, 3), (6, 2), (2, 1)],
    "monetary": [(10000, 5), (5000, 4), (2000, 3), (500, 2), (100, 1)],
    "multiplier": [(4, 2.5), (2, 1.5)],
    "multiplier_default": 0.5,
    "margin": 0.35,
    "churn": [(1, 0.85), (2, 0.60), (3, 0.35), (4, 0.15)],
    "churn_default": 0.05,
    "segments": [
        ({"r_score": (">=", 4), "f_score": (">=", 4), "m_score": (">=", 4)}, "VIP"),
        ({"r_score": (">=", 3), "f_score": (">=", 3)}, "Loyal"),
        ({"r_score": (">=", 4), "f_score": ("<=", 2)}, "New_Active"),
        ({"r_score": ("<=", 2), "f_score": (">=", 3)}, "At_Risk"),
        ({"r_score": ("<=", 1), "f_score": ("<=", 1)}, "Lost"),
    ],
    "segment_default": "Regular",
    "notable_segments": ["VIP", "At_Risk", "Lost"],
    "alert_above": 0.6,
    "rollup_segments": ["VIP", "Loyal", "At_Risk", "Lost"],
    "channels": ["online", "in_store", "mobile_app"],
    "avg_value_above": 5000,
    "channel_count_above": 10,
}
PRICING = {
    "floor": 1.15,
    "ceiling": 3.50,
    "actions_by_index": [
        ({"competitor_index": (">", 1.20)}, "price_cut"),
        ({"competitor_index": (">", 1.05)}, "monitor"),
        ({"competitor_index": ("<", 0.80)}, "margin_opportunity"),
    ],
    "action_default": "competitive",
    "demand": [
        ({"forecasted_demand": (">", 500)}, 1.15),
        ({"forecasted_demand": (">", 200)}, 1.05),
        ({"forecasted_demand": ("<", 20)}, 0.80),
    ],
    "markdown": [(120, 0.50), (90, 0.35), (60, 0.20), (30, 0.10)],
    "alert_difference": 10,
    "categories": ["electronics", "apparel", "home", "grocery", "beauty"],
    "actions": ["price_cut", "margin_opportunity"],
    "group_count_above": 10,
    "margin_below": 15,
}
POS = {
    "taxes": {"CA": 0.0725, "NY": 0.08, "TX": 0.0625, "FL": 0.06, "WA": 0.065},
    "tax_default": 0.05,
    "discount": [(50, 5), (35, 4), (20, 3), (10, 2), (0, 1)],
    "returns": {"electronics": 0.18, "apparel": 0.25, "grocery": 0.02, "home": 0.12},
    "returns_default": 0.08,
    "fraud": [
        ({"total": (">", 5000), "payment_method": ("==", "gift_card")}, 3),
        ({"total": (">", 2000), "quantity": (">", 10)}, 2),
        ({"discount": (">", 60)}, 2),
        ({"total": (">", 1000)}, 1),
    ],
    "fraud_from": 2,
    "categories": ["electronics", "apparel", "grocery", "home"],
    "group_count_above": 50,
    "avg_total_above": 200,
    "frauds_above": 5,
}
DELIVERY = {
    "priority": {"same_day": 5.0, "next_day": 4.0, "two_day": 3.0, "standard": 2.0, "economy": 1.0},
    "priority_default": 0.5,
    "fuel": {"electric": 0.04, "hybrid": 0.12, "diesel_truck": 0.35, "van": 0.22},
    "fuel_default": 0.18,
    "late": [(24, 50.0), (12, 25.0), (4, 10.0), (1, 5.0)],
    "lead_time": [(30, 4), (14, 3), (7, 2), (3, 1)],
    "handling": 3.50,
    "priority_cost": 2.25,
    "urgent_from": 4,
    "risky_from": 3,
    "alert_above": 20,
    "types": ["same_day", "next_day", "standard"],
    "avg_cost_above": 50,
}


def demand_features(sales: DataFrame, cfg=DEMAND) -> DataFrame:
    day = F.col("transaction_date")
    return staged(
        sales,
        {"dow": F.dayofweek(day), "m": F.month(day), "wk": F.weekofyear(day)},
        {
            "promo_flag": flag(F.col("discount_pct") > cfg["promo_above"]),
            "high_value": flag(F.col("unit_price") * F.col("quantity") > cfg["high_value_above"]),
            "seasonal_factor": rules([(F.col("m").isin(months), f) for months, f in cfg["seasons"]], 1.0),
            "loyalty_tier": band("purchase_frequency", cfg["loyalty"], cfg["loyalty_default"]),
        },
    )


def demand_alerts(predicted: DataFrame, cfg=DEMAND) -> DataFrame:
    return row_alerts(predicted, F.col("prediction") > cfg["alert_above"], ["product_sku", "prediction"])


def customer_value(
    customers: DataFrame, purchases: DataFrame, returns: DataFrame, as_of=None, cfg=CUSTOMER_VALUE
) -> DataFrame:
    joined = enrich(customers, [Dim(purchases, "customer_id"), Dim(returns, "customer_id")])
    return staged(
        joined,
        {"recency_days": F.datediff(as_of_date(as_of), F.col("last_purchase_date"))},
        {
            "r_score": band("recency_days", cfg["recency"], 0, "<="),
            "f_score": band("order_count", cfg["frequency"], 0),
            "m_score": band("lifetime_spend", cfg["monetary"], 0),
        },
        {
            "clv_estimate": F.col("avg_order_value")
            * F.col("order_count")
            * band("r_score", cfg["multiplier"], cfg["multiplier_default"])
            * cfg["margin"],
            "churn_prob": band("r_score", cfg["churn"], cfg["churn_default"], "<="),
            "segment": rule_table(cfg["segments"], cfg["segment_default"]),
        },
    )


def customer_value_share(scored: DataFrame, cfg=CUSTOMER_VALUE) -> DataFrame:
    return share(scored, F.col("segment").isin(cfg["notable_segments"]), "notable_share")


def customer_value_alerts(scored: DataFrame, cfg=CUSTOMER_VALUE) -> DataFrame:
    return row_alerts(
        scored,
        F.col("churn_prob") > cfg["alert_above"],
        ["customer_id", "segment", "clv_estimate", "churn_prob"],
        {"email": "email", "phone_number": "phone", "ssn": "ssn"},
    )


def customer_value_rollup(scored: DataFrame, cfg=CUSTOMER_VALUE) -> DataFrame:
    """Valuable segments, one row per listed channel with enough customers.

    The segments are chosen after the aggregation, on a handful of rows; a filter on the segment itself would
    be pushed below the scoring and repeat its rules.
    """
    value, average = F.col("clv_estimate"), F.try_divide("_total", "_values")
    listed = F.max(flag(F.col("segment").isin(cfg["rollup_segments"])))
    return nested_alert(
        scored,
        "segment",
        "preferred_channel",
        cfg["channels"],
        {"customers": F.count(F.lit(1)), "_sum": F.sum(value), "_set": F.count(value), "_listed": listed},
        {"_total": F.sum("_sum"), "_values": F.sum("_set")},
        (F.col("_listed") == 1) & (average > cfg["avg_value_above"]) & (F.col("customers") > cfg["channel_count_above"]),
    ).select("segment", "preferred_channel", average.alias("avg_clv"), "customers")


def pricing(
    products: DataFrame, competitors: DataFrame, demand_forecast: DataFrame, inventory: DataFrame, cfg=PRICING
) -> DataFrame:
    joined = enrich(products, [Dim(competitors, "sku"), Dim(demand_forecast, "sku"), Dim(inventory, "sku")])
    cost = F.col("cost_price")
    return staged(
        joined,
        {
            "price_floor": cost * cfg["floor"],
            "price_ceiling": cost * cfg["ceiling"],
            "competitor_index": ratio("retail_price", "competitor_price", "eps"),
            "markdown_pct": band("days_of_inventory", cfg["markdown"], 0.0, ">"),
            "demand_multiplier": rule_table(cfg["demand"], 1.0),
        },
        {
            "comp_action": rule_table(cfg["actions_by_index"], cfg["action_default"]),
            "optimal_price": F.round(
                cost
                * (F.lit(1.0) + F.col("margin_pct") / 100)
                * F.col("demand_multiplier")
                * (F.lit(1.0) - F.col("markdown_pct")),
                2,
            ),
        },
    )


def pricing_summary(scored: DataFrame) -> DataFrame:
    return flag_counts(
        scored,
        {"price_cuts": F.col("comp_action") == "price_cut", "markdowns": F.col("markdown_pct") > 0},
        {"total": F.count(F.lit(1))},
    )


def pricing_alerts(scored: DataFrame, cfg=PRICING) -> DataFrame:
    return row_alerts(
        scored,
        F.abs(F.col("optimal_price") - F.col("retail_price")) > cfg["alert_difference"],
        ["sku", "retail_price", "optimal_price", "comp_action"],
        {"customer_email": "email", "customer_ssn": "ssn"},
    )


def pricing_rollup(scored: DataFrame, cfg=PRICING) -> DataFrame:
    return segment_alert(
        scored,
        ["category", "comp_action"],
        {"products": F.count(F.lit(1)), "avg_margin": F.avg("margin_pct")},
        (F.col("products") > cfg["group_count_above"]) & (F.col("avg_margin") < cfg["margin_below"]),
        only={"category": cfg["categories"], "comp_action": cfg["actions"]},
    )


def pos_checks(transactions: DataFrame, products: DataFrame, stores: DataFrame, cfg=POS) -> DataFrame:
    joined = enrich(transactions, [Dim(products, "product_sku"), Dim(stores, "store_id")])
    return staged(
        joined,
        {
            "tax_amount": F.col("total") * lookup("state", cfg["taxes"], cfg["tax_default"]),
            "discount_tier": band("discount", cfg["discount"], 0, ">"),
            "return_risk": lookup("category", cfg["returns"], cfg["returns_default"]),
            "fraud_flag": rule_table(cfg["fraud"], 0),
        },
    )


def pos_summary(scored: DataFrame, cfg=POS) -> DataFrame:
    fraud = F.col("fraud_flag")
    return flag_counts(scored, {"flagged": fraud >= cfg["fraud_from"], "clean": fraud < cfg["fraud_from"]})


def pos_alerts(scored: DataFrame, cfg=POS) -> DataFrame:
    return row_alerts(scored, F.col("fraud_flag") >= cfg["fraud_from"], ["txn_id", "total", "fraud_flag"])


def pos_rollup(scored: DataFrame, cfg=POS) -> DataFrame:
    return segment_alert(
        scored,
        ["region", "category"],
        {
            "transactions": F.count(F.lit(1)),
            "avg_total": F.avg("total"),
            "frauds": F.count_if(F.col("fraud_flag") >= cfg["fraud_from"]),
        },
        (F.col("transactions") > cfg["group_count_above"])
        & (F.col("avg_total") > cfg["avg_total_above"])
        & (F.col("frauds") > cfg["frauds_above"]),
        only={"category": cfg["categories"]},
    )


def delivery_cost(warehouses: DataFrame, deliveries: DataFrame, fleet: DataFrame, cfg=DELIVERY) -> DataFrame:
    joined = enrich(warehouses, [Dim(deliveries, "warehouse_id"), Dim(fleet, "warehouse_id")])
    return staged(
        joined,
        {
            "priority_score": lookup("delivery_type", cfg["priority"], cfg["priority_default"]),
            "fuel_cost_per_mile": lookup("vehicle_type", cfg["fuel"], cfg["fuel_default"]),
            "late_penalty": band("estimated_delay_hours", cfg["late"], 0.0, ">"),
            "supplier_risk": band("lead_time_days", cfg["lead_time"], 0, ">"),
        },
        {
            "delivery_cost": F.col("distance_miles") * F.col("fuel_cost_per_mile")
            + F.col("late_penalty")
            + F.lit(cfg["handling"])
            + F.col("priority_score") * cfg["priority_cost"]
        },
    )


def delivery_summary(scored: DataFrame, cfg=DELIVERY) -> DataFrame:
    return flag_counts(
        scored,
        {
            "urgent": F.col("priority_score") >= cfg["urgent_from"],
            "risky_suppliers": F.col("supplier_risk") >= cfg["risky_from"],
            "late": F.col("late_penalty") > 0,
        },
    )


def delivery_alerts(scored: DataFrame, cfg=DELIVERY) -> DataFrame:
    return row_alerts(
        scored,
        F.col("late_penalty") > cfg["alert_above"],
        ["warehouse_id", "delivery_cost", "late_penalty"],
        {"manager_ssn": "ssn", "supplier_contact_email": "email"},
    )


def delivery_rollup(scored: DataFrame, cfg=DELIVERY) -> DataFrame:
    return segment_alert(
        scored,
        ["warehouse_id", "delivery_type"],
        {"avg_cost": F.avg("delivery_cost")},
        F.col("avg_cost") > cfg["avg_cost_above"],
        only={"delivery_type": cfg["types"]},
    )
