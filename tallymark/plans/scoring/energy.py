"""Energy: grid sensors, meter theft, outage risk, renewable output, transformer health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.conditional import band, band_where, flag, indicator_sum, lookup, ratio, rules, weighted_score
from tallymark.functions.formulas import deviation
from tallymark.operators.joins import Dim, enrich
from tallymark.operators.kpi import flag_counts, nested_alert, segment_alert
from tallymark.plans.scoring.common import is_true, row_alerts, staged

# The schema of a sensor reading.
SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("current", T.DoubleType()),
        T.StructField("frequency", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("power_factor", T.DoubleType()),
        T.StructField("operator_name", T.StringType()),
        T.StructField("operator_badge_id", T.StringType()),
    ]
)

# Thresholds, weights and labels of the rules. Bands list (threshold, result) in order.
GRID = {
    "nominal_voltage": 240.0,
    "nominal_frequency": 50.0,
    "hot": 85.0,
    "low_power_factor": 0.85,
    "overload": 400,
    "weights": {
        "voltage_deviation": 3.0, "freq_deviation": 4.0, "temp_flag": 2.0, "pf_flag": 1.5, "overload_flag": 5.0,
    },
    "anomaly": 8.0,
    "features": ["voltage_deviation", "freq_deviation", "temp_flag", "pf_flag", "overload_flag", "risk_index"],
}
THEFT = {
    "usage": [(0.20, 5), (0.40, 4), (0.60, 3), (0.80, 2)],
    "billing": [(0.5, 4), (0.7, 3), (0.85, 2)],
    "signal": [(15, 3), (30, 2)],
    "neighbor": [(0.4, 4), (0.6, 3), (0.8, 2)],
    "weights": {"usage_anomaly": 3.0, "billing_gap": 2.5, "tamper_score": 4.0, "neighbor_deviation": 2.0},
    "probability": [(30, 0.95), (20, 0.75), (12, 0.50), (5, 0.25)],
    "rates": {"commercial": 0.14},
    "rate_default": 0.12,
    "alert_above": 0.7,
    "suspect_above": 0.5,
    "district_loss_above": 5000,
    "classes": ["residential", "commercial", "industrial"],
}
OUTAGE = {
    "wind": [(70, 5), (50, 4), (35, 3), (25, 2), (15, 1)],
    "ice": [(1.0, 5), (0.5, 4), (0.25, 3), (0.1, 2)],
    "flood": [(6, 5), (4, 4), (2, 3), (1, 2)],
    "vegetation": [(5, 4), (10, 3), (20, 2), (30, 1)],
    "infrastructure": [(50, 4), (35, 3), (20, 2), (10, 1)],
    "weights": {
        "wind_risk": 3.2, "ice_risk": 4.5, "flood_risk": 3.8, "vegetation_risk": 2.1, "infrastructure_risk": 2.5,
    },
    "priority": [(30, "EMERGENCY"), (20, "HIGH"), (12, "MEDIUM"), (5, "LOW")],
    "priority_default": "MONITOR",
    "etor": {"EMERGENCY": 2.5, "HIGH": 6.0, "MEDIUM": 12.0},
    "etor_default": 24.0,
    "many_customers": 5000,
    "district_affected_above": 10000,
    "faults": ["tree_contact", "equipment_failure", "lightning", "animal"],
}
RENEWABLE = {
    "cloud": [(80, 0.15), (60, 0.35), (40, 0.55), (20, 0.75), (5, 0.90)],
    "heat": [(45, 0.82), (40, 0.88), (35, 0.93), (25, 0.97)],
    "wind": [(25, 0.0), (15, 1.0), (12, 0.85), (8, 0.55), (4, 0.20), (3, 0.05)],
    "age": [(25, 0.72), (20, 0.80), (15, 0.86), (10, 0.92)],
    "age_default": 0.98,
    "wind_availability": 0.95,
    "other_availability": 0.50,
    "peak_price": 85.50,
    "off_peak_price": 42.25,
    "hours": 24,
    "low_share": 0.2,
    "high_share": 0.8,
    "alert_below": 10,
    "types": ["solar", "wind"],
    "region_below": 100,
}
TRANSFORMER = {
    "h2": [(1800, 4), (700, 3), (100, 2), (25, 1)],
    "ch4": [(1000, 4), (400, 3), (75, 2), (10, 1)],
    "c2h2": [(150, 4), (35, 3), (9, 2), (1, 1)],
    "thermal": [(140, 4), (120, 3), (100, 2), (80, 1)],
    "load": [(120, 4), (100, 3), (80, 2), (60, 1)],
    "age": [(40, 3.5), (30, 2.5), (20, 1.5), (10, 0.8)],
    "age_default": 0.3,
    "weights": {
        "h2_flag": 8.5, "ch4_flag": 7.0, "c2h2_flag": 12.0, "thermal_risk": 9.5, "load_stress": 6.0,
        "age_factor": 4.5,
    },
    "full_health": 100,
    "failure": [(20, 0.92), (40, 0.65), (60, 0.35), (80, 0.15)],
    "failure_default": 0.03,
    "poor_below": 40,
    "critical_below": 30,
    "alert_above": 0.5,
    "manufacturers": ["ABB", "Siemens", "GE", "Hitachi"],
}


def grid_features(readings: DataFrame, cfg=GRID) -> DataFrame:
    return staged(
        readings,
        {
            "voltage_deviation": deviation("voltage", cfg["nominal_voltage"]),
            "freq_deviation": deviation("frequency", cfg["nominal_frequency"]),
            "temp_flag": flag(F.col("temperature") > cfg["hot"]),
            "pf_flag": flag(F.col("power_factor") < cfg["low_power_factor"]),
            "overload_flag": flag(F.col("current") > cfg["overload"]),
        },
        {"risk_index": weighted_score(cfg["weights"])},
    )


def grid_alerts(scored: DataFrame, cfg=GRID) -> DataFrame:
    return row_alerts(
        scored, F.col("risk_index") > cfg["anomaly"], ["sensor_id", "risk_index"], {"operator_name": "name"}
    )


def meter_theft(
    meters: DataFrame, billing: DataFrame, history: DataFrame, transformer_load: DataFrame, cfg=THEFT
) -> DataFrame:
    joined = enrich(
        meters, [Dim(billing, "account_id"), Dim(history, "account_id"), Dim(transformer_load, "meter_id")]
    )
    reading, usage = F.col("reading_kwh"), F.col("usage_ratio")

    def below_share(value, reference, steps):
        return rules([(value < reference * share, points) for share, points in steps], 0)

    return staged(
        joined,
        {"usage_ratio": ratio(reading, "avg_historical_kwh", "eps")},
        {
            "usage_anomaly": band(usage, cfg["usage"], 0, "<"),
            "billing_gap": below_share(F.col("billed_kwh"), reading, cfg["billing"]),
            "tamper_score": indicator_sum([(is_true("tamper_flag"), 5), (is_true("reverse_flow_flag"), 4)])
            + band("signal_strength", cfg["signal"], 0, "<"),
            "neighbor_deviation": below_share(usage, F.col("neighbor_avg_ratio"), cfg["neighbor"]),
        },
        {"theft_score": weighted_score(cfg["weights"])},
        {
            "theft_probability": band("theft_score", cfg["probability"], 0.05, ">"),
            "est_monthly_loss": (F.col("avg_historical_kwh") - reading)
            * lookup("rate_class", cfg["rates"], cfg["rate_default"]),
        },
    )


def _likely_theft(above: float, cfg) -> Column:
    return band_where("theft_score", cfg["probability"], lambda p: p > above, ">")


def meter_theft_summary(scored: DataFrame, cfg=THEFT) -> DataFrame:
    return flag_counts(
        scored,
        {"suspects": _likely_theft(cfg["alert_above"], cfg), "tampered": is_true("tamper_flag")},
        {"total_loss": F.sum("est_monthly_loss")},
    )


def meter_theft_alerts(scored: DataFrame, cfg=THEFT) -> DataFrame:
    return row_alerts(
        scored,
        _likely_theft(cfg["alert_above"], cfg),
        ["meter_id", "account_id", "theft_probability", "est_monthly_loss"],
        {"customer_name": "name", "customer_email": "email", "customer_phone": "phone", "customer_ssn": "ssn"},
    )


def meter_theft_rollup(scored: DataFrame, cfg=THEFT) -> DataFrame:
    """Districts whose suspects lose much, one row per listed rate class that has suspects."""
    return nested_alert(
        scored.filter(_likely_theft(cfg["suspect_above"], cfg)),
        "district_id",
        "rate_class",
        cfg["classes"],
        {"class_loss": F.sum("est_monthly_loss")},
        {"total_loss": F.sum("class_loss")},
        F.col("total_loss") > cfg["district_loss_above"],
    ).select("district_id", "rate_class", "total_loss")


def outage_risk(
    feeders: DataFrame, severe_weather: DataFrame, tree_proximity: DataFrame, past_outages: DataFrame, cfg=OUTAGE
) -> DataFrame:
    joined = enrich(
        feeders, [Dim(severe_weather, "district_id"), Dim(tree_proximity, "feeder_id"), Dim(past_outages, "feeder_id")]
    )
    return staged(
        joined,
        {
            "wind_risk": band("wind_gust_mph", cfg["wind"], 0, ">"),
            "ice_risk": band("ice_accum_inches", cfg["ice"], 0, ">"),
            "flood_risk": band("rainfall_24h_inches", cfg["flood"], 0, ">"),
            "vegetation_risk": band("tree_proximity_ft", cfg["vegetation"], 0, "<"),
            "infrastructure_risk": band("asset_age_years", cfg["infrastructure"], 0, ">"),
        },
        {"outage_risk_score": weighted_score(cfg["weights"])},
        {"dispatch_priority": band("outage_risk_score", cfg["priority"], cfg["priority_default"], ">")},
        {"etor_hours": lookup("dispatch_priority", cfg["etor"], cfg["etor_default"])},
    )


def _emergency(cfg) -> Column:
    return band_where("outage_risk_score", cfg["priority"], lambda p: p == "EMERGENCY", ">")


def outage_summary(scored: DataFrame, cfg=OUTAGE) -> DataFrame:
    return flag_counts(
        scored,
        {
            "emergencies": _emergency(cfg),
            "large_outages": F.col("customers_affected") > cfg["many_customers"],
        },
        {"total": F.count(F.lit(1))},
    )


def outage_alerts(scored: DataFrame, cfg=OUTAGE) -> DataFrame:
    return row_alerts(
        scored,
        _emergency(cfg),
        ["feeder_id", "dispatch_priority", "customers_affected"],
        {"crew_lead_name": "name", "crew_lead_email": "email", "crew_lead_phone": "phone", "crew_lead_ssn": "ssn"},
    )


def outage_rollup(scored: DataFrame, cfg=OUTAGE) -> DataFrame:
    """Districts with many customers in emergencies, one row per listed fault type that occurs."""
    return nested_alert(
        scored.filter(_emergency(cfg)),
        "district_id",
        "fault_type",
        cfg["faults"],
        {"fault_affected": F.sum("customers_affected")},
        {"total_affected": F.sum("fault_affected")},
        F.col("total_affected") > cfg["district_affected_above"],
    ).select("district_id", "fault_type", "total_affected")


def renewable_forecast(plants: DataFrame, weather: DataFrame, past_output: DataFrame, cfg=RENEWABLE) -> DataFrame:
    joined = enrich(plants, [Dim(weather, "plant_id"), Dim(past_output, "plant_id")])
    kind, capacity = F.col("plant_type"), F.col("capacity_mw")
    solar = (
        capacity * F.col("solar_factor") * F.col("temp_derating") * F.col("degradation_factor") * F.col("irradiance_ratio")
    )
    return staged(
        joined,
        {
            "solar_factor": band("cloud_cover_pct", cfg["cloud"], 1.0, ">"),
            "temp_derating": band("ambient_temp_c", cfg["heat"], 1.0, ">"),
            "wind_factor": band("wind_speed_ms", cfg["wind"], 0.0, ">"),
            "degradation_factor": band("panel_age_years", cfg["age"], cfg["age_default"], ">"),
        },
        {
            "forecast_mw": rules(
                [
                    (kind == "solar", solar),
                    (kind == "wind", capacity * F.col("wind_factor") * cfg["wind_availability"]),
                ],
                capacity * cfg["other_availability"],
            )
        },
        {
            "revenue_estimate": F.col("forecast_mw")
            * F.when(is_true("peak_hours_flag"), cfg["peak_price"]).otherwise(cfg["off_peak_price"])
            * cfg["hours"]
        },
    )


def renewable_summary(scored: DataFrame, cfg=RENEWABLE) -> DataFrame:
    forecast, capacity = F.col("forecast_mw"), F.col("capacity_mw")
    return flag_counts(
        scored,
        {"low_output": forecast < capacity * cfg["low_share"], "high_output": forecast > capacity * cfg["high_share"]},
    )


def renewable_alerts(scored: DataFrame, cfg=RENEWABLE) -> DataFrame:
    return row_alerts(
        scored,
        F.col("forecast_mw") < cfg["alert_below"],
        ["plant_id", "forecast_mw"],
        {"operator_name": "name", "operator_email": "email", "operator_ssn": "ssn"},
    )


def renewable_rollup(scored: DataFrame, cfg=RENEWABLE) -> DataFrame:
    return segment_alert(
        scored,
        ["plant_type", "region"],
        {"total_forecast": F.sum("forecast_mw")},
        F.col("total_forecast") < cfg["region_below"],
        only={"plant_type": cfg["types"]},
    )


def transformer_health(
    assets: DataFrame, gas_history: DataFrame, thermal: DataFrame, load_history: DataFrame, cfg=TRANSFORMER
) -> DataFrame:
    joined = enrich(assets, [Dim(gas_history, "asset_id"), Dim(thermal, "asset_id"), Dim(load_history, "asset_id")])
    return staged(
        joined,
        {
            "h2_flag": band("dissolved_gas_h2", cfg["h2"], 0, ">"),
            "ch4_flag": band("dissolved_gas_ch4", cfg["ch4"], 0, ">"),
            "c2h2_flag": band("dissolved_gas_c2h2", cfg["c2h2"], 0, ">"),
            "thermal_risk": band("hotspot_temp_c", cfg["thermal"], 0, ">"),
            "load_stress": band("peak_load_pct", cfg["load"], 0, ">"),
            "age_factor": band("asset_age_years", cfg["age"], cfg["age_default"], ">"),
        },
        {"health_index": F.lit(cfg["full_health"]) - weighted_score(cfg["weights"])},
        {"failure_prob": band("health_index", cfg["failure"], cfg["failure_default"], "<")},
    )


def _likely_failure(cfg) -> Column:
    return band_where("health_index", cfg["failure"], lambda p: p > cfg["alert_above"], "<")


def transformer_summary(scored: DataFrame, cfg=TRANSFORMER) -> DataFrame:
    return flag_counts(
        scored,
        {
            "poor_health": F.col("health_index") < cfg["poor_below"],
            "likely_failures": _likely_failure(cfg),
        },
    )


def transformer_alerts(scored: DataFrame, cfg=TRANSFORMER) -> DataFrame:
    return row_alerts(
        scored,
        _likely_failure(cfg),
        ["asset_id", "health_index", "failure_prob"],
        {"operator_name": "name", "operator_email": "email", "operator_phone": "phone", "operator_ssn": "ssn"},
    )


def transformer_rollup(scored: DataFrame, cfg=TRANSFORMER) -> DataFrame:
    return segment_alert(
        scored.filter(F.col("health_index") < cfg["critical_below"]),
        ["zone_id", "manufacturer"],
        {"avg_health_index": F.avg("health_index"), "assets": F.count(F.lit(1))},
        F.col("assets") > 0,
        only={"manufacturer": cfg["manufacturers"]},
    )
