"""Scoring jobs on projections of lineitem, orders, part, supplier, customer and events.

The projections spread the measurements over all bands, thresholds included, and leave some NULL. Side tables
have one row per key. ``SCORED`` holds each job with the SQL of its scored rows, for the alerts and rollups.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries.common import DOMAIN, add
from tallymark.plans.scoring import energy, finance, health, retail, telecom

AS_OF = "2001-11-04"


class Scored(NamedTuple):
    build: object
    uses: str
    sql: str


SCORED: dict[str, Scored] = {}


def score(name: str, build, uses: str, out: str, sql: str) -> None:
    SCORED[name] = Scored(build, uses, sql)
    add(name, build, uses, out, sql)


# Energy

DOMAIN["grid_readings"] = """
    SELECT CAST(l_partkey AS STRING) AS sensor_id, CAST(l_quantity + 215 AS DOUBLE) AS voltage,
           CAST(l_extendedprice / 200 AS DOUBLE) AS current, CAST(l_discount * 20 + 49 AS DOUBLE) AS frequency,
           CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(l_quantity + 60 AS DOUBLE) END AS temperature,
           CAST(l_tax + 0.8 AS DOUBLE) AS power_factor, 'Operator ' || CAST(l_suppkey AS STRING) AS operator_name
    FROM {lineitem}"""
score(
    "grid_features", energy.grid_features, "grid_readings",
    "sensor_id:s voltage:d voltage_deviation:d freq_deviation:d temp_flag:l pf_flag:l overload_flag:l risk_index:d",
    """SELECT *, voltage_deviation * 3e0 + freq_deviation * 4e0 + temp_flag * 2e0 + pf_flag * 1.5e0
              + overload_flag * 5e0 AS risk_index
       FROM (SELECT *, ABS(voltage - 240e0) / 240e0 AS voltage_deviation, ABS(frequency - 50e0) / 50e0 AS freq_deviation,
             CASE WHEN temperature > 85 THEN 1 ELSE 0 END AS temp_flag,
             CASE WHEN power_factor < 0.85e0 THEN 1 ELSE 0 END AS pf_flag,
             CASE WHEN current > 400 THEN 1 ELSE 0 END AS overload_flag FROM grid_readings)""",
)

DOMAIN["meters"] = """
    SELECT l_partkey AS meter_id, l_orderkey AS account_id, CAST(l_quantity AS DOUBLE) AS reading_kwh,
           CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS tamper_flag,
           l_linestatus = 'F' AND l_linenumber = 7 AS reverse_flow_flag, l_linenumber * 5 AS signal_strength,
           l_suppkey AS district_id, 'Name ' || CAST(l_orderkey AS STRING) AS customer_name,
           'm' || CAST(l_orderkey AS STRING) || '@Mail.example.com' AS customer_email,
           '555' || CAST(l_orderkey AS STRING) AS customer_phone, CAST(l_partkey AS STRING) AS customer_ssn
    FROM {lineitem}"""
DOMAIN["meter_billing"] = """
    SELECT o_orderkey AS account_id, CAST(o_orderkey % 41 AS DOUBLE) AS billed_kwh,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'commercial' WHEN '2-HIGH' THEN 'industrial'
               WHEN '3-MEDIUM' THEN NULL ELSE 'residential' END AS rate_class
    FROM {orders}"""
DOMAIN["meter_history"] = """
    SELECT CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderkey END AS account_id,
           CAST((o_custkey % 121) * 4 AS DOUBLE) AS avg_historical_kwh
    FROM {orders}"""
DOMAIN["meter_load"] = "SELECT p_partkey AS meter_id, CAST(p_size AS DOUBLE) / 25 AS neighbor_avg_ratio FROM {part}"
score(
    "meter_theft", energy.meter_theft, "meters meter_billing meter_history meter_load",
    "meter_id:l account_id:l rate_class:s usage_ratio:d usage_anomaly:l billing_gap:l tamper_score:l "
    "neighbor_deviation:l theft_score:d theft_probability:d est_monthly_loss:d",
    """SELECT *, CASE WHEN theft_score > 30 THEN 0.95e0 WHEN theft_score > 20 THEN 0.75e0
           WHEN theft_score > 12 THEN 0.5e0 WHEN theft_score > 5 THEN 0.25e0 ELSE 0.05e0 END AS theft_probability,
           (avg_historical_kwh - reading_kwh) * CASE WHEN rate_class = 'commercial' THEN 0.14e0 ELSE 0.12e0 END
               AS est_monthly_loss
       FROM (SELECT *, usage_anomaly * 3e0 + billing_gap * 2.5e0 + tamper_score * 4e0 + neighbor_deviation * 2e0
                 AS theft_score
       FROM (SELECT *, CASE WHEN usage_ratio < 0.2e0 THEN 5 WHEN usage_ratio < 0.4e0 THEN 4
                 WHEN usage_ratio < 0.6e0 THEN 3 WHEN usage_ratio < 0.8e0 THEN 2 ELSE 0 END AS usage_anomaly,
             CASE WHEN billed_kwh < reading_kwh * 0.5e0 THEN 4 WHEN billed_kwh < reading_kwh * 0.7e0 THEN 3
                 WHEN billed_kwh < reading_kwh * 0.85e0 THEN 2 ELSE 0 END AS billing_gap,
             CASE WHEN tamper_flag THEN 5 ELSE 0 END + CASE WHEN reverse_flow_flag THEN 4 ELSE 0 END
                 + CASE WHEN signal_strength < 15 THEN 3 WHEN signal_strength < 30 THEN 2 ELSE 0 END AS tamper_score,
             CASE WHEN usage_ratio < neighbor_avg_ratio * 0.4e0 THEN 4
                 WHEN usage_ratio < neighbor_avg_ratio * 0.6e0 THEN 3
                 WHEN usage_ratio < neighbor_avg_ratio * 0.8e0 THEN 2 ELSE 0 END AS neighbor_deviation
       FROM (SELECT m.*, billed_kwh, rate_class, avg_historical_kwh, neighbor_avg_ratio,
                 reading_kwh / (avg_historical_kwh + 0.01e0) AS usage_ratio
             FROM meters m LEFT JOIN meter_billing b ON m.account_id = b.account_id
             LEFT JOIN meter_history h ON m.account_id = h.account_id
             LEFT JOIN meter_load l ON m.meter_id = l.meter_id)))""",
)

DOMAIN["feeders"] = """
    SELECT l_partkey AS feeder_id, l_suppkey AS district_id, CAST(FLOOR(l_extendedprice / 10) AS BIGINT) AS customers_affected,
           CASE l_linenumber WHEN 1 THEN 'tree_contact' WHEN 2 THEN 'equipment_failure' WHEN 3 THEN 'lightning'
               WHEN 4 THEN 'animal' ELSE 'other' END AS fault_type,
           CAST(l_quantity * 1.2 AS DOUBLE) AS asset_age_years, 'Crew ' || CAST(l_suppkey AS STRING) AS crew_lead_name,
           'crew' || CAST(l_suppkey AS STRING) || '@mail.example.com' AS crew_lead_email,
           '555000' || CAST(l_suppkey AS STRING) AS crew_lead_phone, CAST(l_suppkey AS STRING) AS crew_lead_ssn
    FROM {lineitem}"""
DOMAIN["severe_weather"] = """
    SELECT s_suppkey AS district_id, CAST(s_suppkey % 80 AS DOUBLE) AS wind_gust_mph,
           CAST(s_nationkey AS DOUBLE) / 20 AS ice_accum_inches,
           CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal / 1200 END AS rainfall_24h_inches
    FROM {supplier}"""
DOMAIN["tree_proximity"] = "SELECT p_partkey AS feeder_id, CAST(p_size AS DOUBLE) AS tree_proximity_ft FROM {part}"
DOMAIN["past_outages"] = "SELECT p_partkey AS feeder_id, p_type AS last_cause FROM {part}"
score(
    "outage_risk", energy.outage_risk, "feeders severe_weather tree_proximity past_outages",
    "feeder_id:l district_id:l fault_type:s customers_affected:l last_cause:s wind_risk:l ice_risk:l flood_risk:l "
    "vegetation_risk:l infrastructure_risk:l outage_risk_score:d dispatch_priority:s etor_hours:d",
    """SELECT *, CASE dispatch_priority WHEN 'EMERGENCY' THEN 2.5 WHEN 'HIGH' THEN 6 WHEN 'MEDIUM' THEN 12 ELSE 24 END
           AS etor_hours
       FROM (SELECT *, CASE WHEN outage_risk_score > 30 THEN 'EMERGENCY' WHEN outage_risk_score > 20 THEN 'HIGH'
                 WHEN outage_risk_score > 12 THEN 'MEDIUM' WHEN outage_risk_score > 5 THEN 'LOW' ELSE 'MONITOR' END
                 AS dispatch_priority
       FROM (SELECT *, wind_risk * 3.2e0 + ice_risk * 4.5e0 + flood_risk * 3.8e0 + vegetation_risk * 2.1e0
                 + infrastructure_risk * 2.5e0 AS outage_risk_score
       FROM (SELECT f.*, last_cause,
             CASE WHEN wind_gust_mph > 70 THEN 5 WHEN wind_gust_mph > 50 THEN 4 WHEN wind_gust_mph > 35 THEN 3
                 WHEN wind_gust_mph > 25 THEN 2 WHEN wind_gust_mph > 15 THEN 1 ELSE 0 END AS wind_risk,
             CASE WHEN ice_accum_inches > 1e0 THEN 5 WHEN ice_accum_inches > 0.5e0 THEN 4
                 WHEN ice_accum_inches > 0.25e0 THEN 3 WHEN ice_accum_inches > 0.1e0 THEN 2 ELSE 0 END AS ice_risk,
             CASE WHEN rainfall_24h_inches > 6 THEN 5 WHEN rainfall_24h_inches > 4 THEN 4
                 WHEN rainfall_24h_inches > 2 THEN 3 WHEN rainfall_24h_inches > 1 THEN 2 ELSE 0 END AS flood_risk,
             CASE WHEN tree_proximity_ft < 5 THEN 4 WHEN tree_proximity_ft < 10 THEN 3
                 WHEN tree_proximity_ft < 20 THEN 2 WHEN tree_proximity_ft < 30 THEN 1 ELSE 0 END AS vegetation_risk,
             CASE WHEN asset_age_years > 50 THEN 4 WHEN asset_age_years > 35 THEN 3 WHEN asset_age_years > 20 THEN 2
                 WHEN asset_age_years > 10 THEN 1 ELSE 0 END AS infrastructure_risk
             FROM feeders f LEFT JOIN severe_weather w ON f.district_id = w.district_id
             LEFT JOIN tree_proximity t ON f.feeder_id = t.feeder_id
             LEFT JOIN past_outages o ON f.feeder_id = o.feeder_id)))""",
)

DOMAIN["plants"] = """
    SELECT l_partkey AS plant_id, CASE l_returnflag WHEN 'R' THEN 'solar' WHEN 'A' THEN 'wind' ELSE 'hydro' END
           AS plant_type, CAST(l_quantity AS DOUBLE) AS capacity_mw,
           CASE l_linenumber WHEN 7 THEN NULL ELSE 'region ' || CAST(l_partkey AS STRING) END AS region,
           'Operator ' || CAST(l_suppkey AS STRING) AS operator_name,
           'op' || CAST(l_suppkey AS STRING) || '@mail.example.com' AS operator_email,
           CAST(l_orderkey AS STRING) AS operator_ssn
    FROM {lineitem}"""
DOMAIN["plant_weather"] = """
    SELECT p_partkey AS plant_id, CAST(p_size * 2 AS DOUBLE) AS cloud_cover_pct, CAST(p_size AS DOUBLE) AS ambient_temp_c,
           CASE p_type WHEN 'PROMO' THEN NULL ELSE CAST(p_size AS DOUBLE) / 1.6 END AS wind_speed_ms,
           CASE p_type WHEN 'SMALL' THEN TRUE WHEN 'LARGE' THEN FALSE END AS peak_hours_flag
    FROM {part}"""
DOMAIN["plant_output"] = """
    SELECT p_partkey AS plant_id, CAST(p_partkey % 30 AS DOUBLE) AS panel_age_years,
           CASE p_type WHEN 'MEDIUM' THEN NULL ELSE p_retailprice / 1000 END AS irradiance_ratio
    FROM {part}"""
score(
    "renewable_forecast", energy.renewable_forecast, "plants plant_weather plant_output",
    "plant_id:l plant_type:s region:s solar_factor:d temp_derating:d wind_factor:d degradation_factor:d forecast_mw:d "
    "revenue_estimate:d",
    """SELECT *, forecast_mw * CASE WHEN peak_hours_flag THEN 85.5e0 ELSE 42.25e0 END * 24 AS revenue_estimate
       FROM (SELECT *, CASE WHEN plant_type = 'solar'
                 THEN capacity_mw * solar_factor * temp_derating * degradation_factor * irradiance_ratio
                 WHEN plant_type = 'wind' THEN capacity_mw * wind_factor * 0.95e0 ELSE capacity_mw * 0.5e0 END
                 AS forecast_mw
       FROM (SELECT p.*, irradiance_ratio, peak_hours_flag,
             CASE WHEN cloud_cover_pct > 80 THEN 0.15e0 WHEN cloud_cover_pct > 60 THEN 0.35e0
                 WHEN cloud_cover_pct > 40 THEN 0.55e0 WHEN cloud_cover_pct > 20 THEN 0.75e0
                 WHEN cloud_cover_pct > 5 THEN 0.9e0 ELSE 1e0 END AS solar_factor,
             CASE WHEN ambient_temp_c > 45 THEN 0.82e0 WHEN ambient_temp_c > 40 THEN 0.88e0
                 WHEN ambient_temp_c > 35 THEN 0.93e0 WHEN ambient_temp_c > 25 THEN 0.97e0 ELSE 1e0 END AS temp_derating,
             CASE WHEN wind_speed_ms > 25 THEN 0e0 WHEN wind_speed_ms > 15 THEN 1e0 WHEN wind_speed_ms > 12 THEN 0.85e0
                 WHEN wind_speed_ms > 8 THEN 0.55e0 WHEN wind_speed_ms > 4 THEN 0.2e0
                 WHEN wind_speed_ms > 3 THEN 0.05e0 ELSE 0e0 END AS wind_factor,
             CASE WHEN panel_age_years > 25 THEN 0.72e0 WHEN panel_age_years > 20 THEN 0.8e0
                 WHEN panel_age_years > 15 THEN 0.86e0 WHEN panel_age_years > 10 THEN 0.92e0 ELSE 0.98e0 END
                 AS degradation_factor
             FROM plants p LEFT JOIN plant_weather w ON p.plant_id = w.plant_id
             LEFT JOIN plant_output o ON p.plant_id = o.plant_id))""",
)

DOMAIN["transformers"] = """
    SELECT l_partkey AS asset_id, l_suppkey AS zone_id,
           CASE l_linenumber WHEN 1 THEN 'ABB' WHEN 2 THEN 'Siemens' WHEN 3 THEN 'GE' WHEN 4 THEN 'Hitachi'
               WHEN 5 THEN 'Other' END AS manufacturer,
           CAST(l_extendedprice / 50 AS DOUBLE) AS dissolved_gas_h2, CAST(l_quantity * 25 AS DOUBLE) AS dissolved_gas_ch4,
           CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(l_quantity * 4 AS DOUBLE) END AS dissolved_gas_c2h2,
           'Operator ' || CAST(l_suppkey AS STRING) AS operator_name,
           'op' || CAST(l_suppkey AS STRING) || '@mail.example.com' AS operator_email,
           '5550' || CAST(l_suppkey AS STRING) AS operator_phone, CAST(l_orderkey AS STRING) AS operator_ssn
    FROM {lineitem}"""
DOMAIN["gas_history"] = "SELECT p_partkey AS asset_id, p_brand AS lab FROM {part}"
DOMAIN["thermal"] = "SELECT p_partkey AS asset_id, CAST(p_size * 3 AS DOUBLE) AS hotspot_temp_c FROM {part}"
DOMAIN["load_history"] = """
    SELECT CASE p_type WHEN 'PROMO' THEN NULL ELSE p_partkey END AS asset_id,
           CAST(p_partkey % 130 AS DOUBLE) AS peak_load_pct, CAST(p_size AS DOUBLE) AS asset_age_years
    FROM {part}"""
score(
    "transformer_health", energy.transformer_health, "transformers gas_history thermal load_history",
    "asset_id:l zone_id:l manufacturer:s lab:s h2_flag:l ch4_flag:l c2h2_flag:l thermal_risk:l load_stress:l "
    "age_factor:d health_index:d failure_prob:d",
    """SELECT *, CASE WHEN health_index < 20 THEN 0.92e0 WHEN health_index < 40 THEN 0.65e0
           WHEN health_index < 60 THEN 0.35e0 WHEN health_index < 80 THEN 0.15e0 ELSE 0.03e0 END AS failure_prob
       FROM (SELECT *, 100 - (h2_flag * 8.5e0 + ch4_flag * 7e0 + c2h2_flag * 12e0 + thermal_risk * 9.5e0
                 + load_stress * 6e0 + age_factor * 4.5e0) AS health_index
       FROM (SELECT t.*, lab,
             CASE WHEN dissolved_gas_h2 > 1800 THEN 4 WHEN dissolved_gas_h2 > 700 THEN 3
                 WHEN dissolved_gas_h2 > 100 THEN 2 WHEN dissolved_gas_h2 > 25 THEN 1 ELSE 0 END AS h2_flag,
             CASE WHEN dissolved_gas_ch4 > 1000 THEN 4 WHEN dissolved_gas_ch4 > 400 THEN 3
                 WHEN dissolved_gas_ch4 > 75 THEN 2 WHEN dissolved_gas_ch4 > 10 THEN 1 ELSE 0 END AS ch4_flag,
             CASE WHEN dissolved_gas_c2h2 > 150 THEN 4 WHEN dissolved_gas_c2h2 > 35 THEN 3
                 WHEN dissolved_gas_c2h2 > 9 THEN 2 WHEN dissolved_gas_c2h2 > 1 THEN 1 ELSE 0 END AS c2h2_flag,
             CASE WHEN hotspot_temp_c > 140 THEN 4 WHEN hotspot_temp_c > 120 THEN 3 WHEN hotspot_temp_c > 100 THEN 2
                 WHEN hotspot_temp_c > 80 THEN 1 ELSE 0 END AS thermal_risk,
             CASE WHEN peak_load_pct > 120 THEN 4 WHEN peak_load_pct > 100 THEN 3 WHEN peak_load_pct > 80 THEN 2
                 WHEN peak_load_pct > 60 THEN 1 ELSE 0 END AS load_stress,
             CASE WHEN asset_age_years > 40 THEN 3.5e0 WHEN asset_age_years > 30 THEN 2.5e0
                 WHEN asset_age_years > 20 THEN 1.5e0 WHEN asset_age_years > 10 THEN 0.8e0 ELSE 0.3e0 END AS age_factor
             FROM transformers t LEFT JOIN gas_history g ON t.asset_id = g.asset_id
             LEFT JOIN thermal h ON t.asset_id = h.asset_id LEFT JOIN load_history l ON t.asset_id = l.asset_id))""",
)

# Retail

DOMAIN["demand_sales"] = """
    SELECT l_partkey AS product_sku, l_orderkey AS sale_id, CAST(l_quantity * 4 AS DOUBLE) AS quantity,
           CAST(l_extendedprice / l_quantity AS DOUBLE) / 40 AS unit_price, CAST(l_discount * 200 AS DOUBLE) AS discount_pct,
           CAST(l_shipdate AS DATE) AS transaction_date,
           CASE l_linenumber WHEN 7 THEN NULL ELSE l_linenumber * 5 - 5 END AS purchase_frequency, l_linenumber
    FROM {lineitem}"""
score(
    "demand_features", retail.demand_features, "demand_sales",
    "product_sku:l sale_id:l quantity:d unit_price:d transaction_date:D dow:l m:l wk:l promo_flag:l high_value:l "
    "seasonal_factor:d loyalty_tier:s",
    """SELECT *, CASE WHEN m IN (11, 12) THEN 1.45e0 WHEN m IN (6, 7, 8) THEN 1.15e0 WHEN m IN (1, 2) THEN 0.75e0
           ELSE 1e0 END AS seasonal_factor
       FROM (SELECT *, DAYOFWEEK(transaction_date) + 1 AS dow, MONTH(transaction_date) AS m,
             WEEKOFYEAR(transaction_date) AS wk, CASE WHEN discount_pct > 15 THEN 1 ELSE 0 END AS promo_flag,
             CASE WHEN unit_price * quantity > 500 THEN 1 ELSE 0 END AS high_value,
             CASE WHEN purchase_frequency >= 20 THEN 'platinum' WHEN purchase_frequency >= 10 THEN 'gold'
                 WHEN purchase_frequency >= 5 THEN 'silver' ELSE 'bronze' END AS loyalty_tier FROM demand_sales)""",
)

DOMAIN["rfm_customers"] = """
    SELECT o_orderkey AS customer_id, CAST(o_totalprice / 40 AS DOUBLE) AS lifetime_spend,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey % 60 END AS order_count,
           CAST(o_totalprice / 400 AS DOUBLE) AS avg_order_value,
           DATE '2001-11-04' - CAST(o_custkey % 100 AS INT) AS last_purchase_date,
           'c' || CAST(o_orderkey AS STRING) || '@mail.example.com' AS email,
           '555' || CAST(o_orderkey AS STRING) AS phone_number, CAST(o_custkey AS STRING) AS ssn
    FROM {orders}"""
DOMAIN["rfm_purchases"] = """
    SELECT o_orderkey AS customer_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'online' WHEN '2-HIGH' THEN 'in_store'
           WHEN '3-MEDIUM' THEN 'mobile_app' WHEN '4-NOT SPECIFIED' THEN 'phone' END AS preferred_channel
    FROM {orders}"""
DOMAIN["rfm_returns"] = "SELECT o_orderkey AS customer_id, o_orderstatus AS return_state FROM {orders}"
score(
    "customer_value", lambda *frames: retail.customer_value(*frames, as_of=AS_OF),
    "rfm_customers rfm_purchases rfm_returns",
    "customer_id:l preferred_channel:s return_state:s recency_days:l r_score:l f_score:l m_score:l clv_estimate:d "
    "churn_prob:d segment:s",
    """SELECT *, avg_order_value * order_count * CASE WHEN r_score >= 4 THEN 2.5e0 WHEN r_score >= 2 THEN 1.5e0
               ELSE 0.5e0 END * 0.35e0 AS clv_estimate,
           CASE WHEN r_score <= 1 THEN 0.85e0 WHEN r_score <= 2 THEN 0.6e0 WHEN r_score <= 3 THEN 0.35e0
               WHEN r_score <= 4 THEN 0.15e0 ELSE 0.05e0 END AS churn_prob,
           CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
               WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal' WHEN r_score >= 4 AND f_score <= 2 THEN 'New_Active'
               WHEN r_score <= 2 AND f_score >= 3 THEN 'At_Risk' WHEN r_score <= 1 AND f_score <= 1 THEN 'Lost'
               ELSE 'Regular' END AS segment
       FROM (SELECT *, CASE WHEN recency_days <= 7 THEN 5 WHEN recency_days <= 14 THEN 4 WHEN recency_days <= 30 THEN 3
                 WHEN recency_days <= 60 THEN 2 WHEN recency_days <= 90 THEN 1 ELSE 0 END AS r_score,
             CASE WHEN order_count >= 50 THEN 5 WHEN order_count >= 25 THEN 4 WHEN order_count >= 12 THEN 3
                 WHEN order_count >= 6 THEN 2 WHEN order_count >= 2 THEN 1 ELSE 0 END AS f_score,
             CASE WHEN lifetime_spend >= 10000 THEN 5 WHEN lifetime_spend >= 5000 THEN 4
                 WHEN lifetime_spend >= 2000 THEN 3 WHEN lifetime_spend >= 500 THEN 2
                 WHEN lifetime_spend >= 100 THEN 1 ELSE 0 END AS m_score
       FROM (SELECT c.*, preferred_channel, return_state,
                 DATE_DIFF('day', last_purchase_date, DATE '2001-11-04') AS recency_days
             FROM rfm_customers c LEFT JOIN rfm_purchases p ON c.customer_id = p.customer_id
             LEFT JOIN rfm_returns r ON c.customer_id = r.customer_id))""",
)

DOMAIN["priced_products"] = """
    SELECT l_partkey AS sku, CAST(l_quantity AS DOUBLE) * 2 AS cost_price, CAST(l_quantity AS DOUBLE) * 3 AS retail_price,
           CAST(l_linenumber * 4 - l_suppkey % 6 AS DOUBLE) AS margin_pct,
           CASE l_suppkey % 6 WHEN 0 THEN 'electronics' WHEN 1 THEN 'apparel' WHEN 2 THEN 'home' WHEN 3 THEN 'grocery'
               WHEN 4 THEN 'beauty' ELSE 'toys' END AS category,
           'p' || CAST(l_orderkey AS STRING) || '@mail.example.com' AS customer_email,
           CAST(l_orderkey AS STRING) AS customer_ssn
    FROM {lineitem}"""
DOMAIN["competitor_prices"] = """
    SELECT p_partkey AS sku, CASE p_type WHEN 'PROMO' THEN NULL ELSE CAST(p_size AS DOUBLE) * 3 END AS competitor_price
    FROM {part}"""
DOMAIN["demand_forecast"] = "SELECT p_partkey AS sku, CAST(p_partkey % 701 AS DOUBLE) AS forecasted_demand FROM {part}"
DOMAIN["product_stock"] = "SELECT p_partkey AS sku, p_size * 3 AS days_of_inventory FROM {part}"
score(
    "pricing", retail.pricing, "priced_products competitor_prices demand_forecast product_stock",
    "sku:l category:s retail_price:d price_floor:d price_ceiling:d competitor_index:d comp_action:s markdown_pct:d "
    "demand_multiplier:d optimal_price:d",
    """SELECT *, CASE WHEN competitor_index > 1.2e0 THEN 'price_cut' WHEN competitor_index > 1.05e0 THEN 'monitor'
           WHEN competitor_index < 0.8e0 THEN 'margin_opportunity' ELSE 'competitive' END AS comp_action,
           CAST(ROUND(CAST(CAST(cost_price * (1e0 + margin_pct / 100) * demand_multiplier * (1e0 - markdown_pct)
               AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS optimal_price
       FROM (SELECT p.*, cost_price * 1.15e0 AS price_floor, cost_price * 3.5e0 AS price_ceiling,
             retail_price / (competitor_price + 0.01e0) AS competitor_index,
             CASE WHEN days_of_inventory > 120 THEN 0.5e0 WHEN days_of_inventory > 90 THEN 0.35e0
                 WHEN days_of_inventory > 60 THEN 0.2e0 WHEN days_of_inventory > 30 THEN 0.1e0 ELSE 0e0 END AS markdown_pct,
             CASE WHEN forecasted_demand > 500 THEN 1.15e0 WHEN forecasted_demand > 200 THEN 1.05e0
                 WHEN forecasted_demand < 20 THEN 0.8e0 ELSE 1e0 END AS demand_multiplier
             FROM priced_products p LEFT JOIN competitor_prices c ON p.sku = c.sku
             LEFT JOIN demand_forecast d ON p.sku = d.sku LEFT JOIN product_stock s ON p.sku = s.sku)""",
)

DOMAIN["pos_transactions"] = """
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS txn_id, l_partkey AS product_sku,
           l_suppkey AS store_id, CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_discount * 700 AS DOUBLE) AS discount,
           CAST(l_extendedprice AS DOUBLE) / 10 AS total,
           CASE l_returnflag WHEN 'R' THEN 'gift_card' ELSE 'card' END AS payment_method
    FROM {lineitem}"""
DOMAIN["pos_products"] = """
    SELECT p_partkey AS product_sku, CASE p_type WHEN 'PROMO' THEN 'electronics' WHEN 'SMALL' THEN 'apparel'
           WHEN 'LARGE' THEN 'grocery' WHEN 'MEDIUM' THEN 'home' WHEN 'ECONOMY' THEN 'garden' END AS category
    FROM {part}"""
DOMAIN["pos_stores"] = """
    SELECT s_suppkey AS store_id, CASE s_nationkey % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'FL'
           WHEN 4 THEN 'WA' WHEN 5 THEN 'OR' END AS state,
           CASE WHEN s_acctbal < 0 THEN NULL ELSE 'Region ' || CAST(s_nationkey AS STRING) END AS region
    FROM {supplier}"""
score(
    "pos_checks", retail.pos_checks, "pos_transactions pos_products pos_stores",
    "txn_id:s category:s region:s total:d tax_amount:d discount_tier:l return_risk:d fraud_flag:l",
    """SELECT t.*, category, region,
       CASE state WHEN 'CA' THEN total * 0.0725e0 WHEN 'NY' THEN total * 0.08e0 WHEN 'TX' THEN total * 0.0625e0
           WHEN 'FL' THEN total * 0.06e0 WHEN 'WA' THEN total * 0.065e0 ELSE total * 0.05e0 END AS tax_amount,
       CASE WHEN discount > 50 THEN 5 WHEN discount > 35 THEN 4 WHEN discount > 20 THEN 3 WHEN discount > 10 THEN 2
           WHEN discount > 0 THEN 1 ELSE 0 END AS discount_tier,
       CASE category WHEN 'electronics' THEN 0.18 WHEN 'apparel' THEN 0.25 WHEN 'grocery' THEN 0.02
           WHEN 'home' THEN 0.12 ELSE 0.08 END AS return_risk,
       CASE WHEN total > 5000 AND payment_method = 'gift_card' THEN 3 WHEN total > 2000 AND quantity > 10 THEN 2
           WHEN discount > 60 THEN 2 WHEN total > 1000 THEN 1 ELSE 0 END AS fraud_flag
       FROM pos_transactions t LEFT JOIN pos_products p ON t.product_sku = p.product_sku
       LEFT JOIN pos_stores s ON t.store_id = s.store_id""",
)

DOMAIN["warehouse_loads"] = """
    SELECT o_orderkey AS warehouse_id, o_custkey % 40 AS lead_time_days,
           'sup' || CAST(o_custkey AS STRING) || '@mail.example.com' AS supplier_contact_email,
           CAST(o_orderkey AS STRING) AS manager_ssn
    FROM {orders}"""
DOMAIN["deliveries"] = """
    SELECT o_orderkey AS warehouse_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'same_day' WHEN '2-HIGH' THEN 'next_day'
           WHEN '3-MEDIUM' THEN 'standard' WHEN '5-LOW' THEN 'economy' END AS delivery_type,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_custkey % 30 AS DOUBLE) END AS estimated_delay_hours,
           CAST(o_totalprice / 1000 AS DOUBLE) AS distance_miles
    FROM {orders}"""
DOMAIN["fleet"] = """
    SELECT o_orderkey AS warehouse_id, CASE o_custkey % 6 WHEN 0 THEN 'electric' WHEN 1 THEN 'hybrid'
           WHEN 2 THEN 'diesel_truck' WHEN 3 THEN 'van' WHEN 4 THEN 'bike' END AS vehicle_type
    FROM {orders}"""
score(
    "delivery_cost", retail.delivery_cost, "warehouse_loads deliveries fleet",
    "warehouse_id:l delivery_type:s vehicle_type:s priority_score:d fuel_cost_per_mile:d late_penalty:d supplier_risk:l "
    "delivery_cost:d",
    """SELECT *, distance_miles * fuel_cost_per_mile + late_penalty + 3.5e0 + priority_score * 2.25e0 AS delivery_cost
       FROM (SELECT w.*, delivery_type, vehicle_type, distance_miles,
             CASE delivery_type WHEN 'same_day' THEN 5e0 WHEN 'next_day' THEN 4e0 WHEN 'two_day' THEN 3e0
                 WHEN 'standard' THEN 2e0 WHEN 'economy' THEN 1e0 ELSE 0.5e0 END AS priority_score,
             CASE vehicle_type WHEN 'electric' THEN 0.04e0 WHEN 'hybrid' THEN 0.12e0 WHEN 'diesel_truck' THEN 0.35e0
                 WHEN 'van' THEN 0.22e0 ELSE 0.18e0 END AS fuel_cost_per_mile,
             CASE WHEN estimated_delay_hours > 24 THEN 50e0 WHEN estimated_delay_hours > 12 THEN 25e0
                 WHEN estimated_delay_hours > 4 THEN 10e0 WHEN estimated_delay_hours > 1 THEN 5e0 ELSE 0e0 END
                 AS late_penalty,
             CASE WHEN lead_time_days > 30 THEN 4 WHEN lead_time_days > 14 THEN 3 WHEN lead_time_days > 7 THEN 2
                 WHEN lead_time_days > 3 THEN 1 ELSE 0 END AS supplier_risk
             FROM warehouse_loads w LEFT JOIN deliveries d ON w.warehouse_id = d.warehouse_id
             LEFT JOIN fleet f ON w.warehouse_id = f.warehouse_id)""",
)

# Telecom

DOMAIN["usage"] = """
    SELECT o_orderkey AS customer_id, CAST(o_custkey % 120 AS DOUBLE) AS monthly_charge,
           CAST(o_custkey % 90 AS DOUBLE) / 2 AS data_usage_gb,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey % 700 END AS call_minutes,
           DATE '2001-11-04' + CAST(o_orderkey % 200 - 130 AS INT) AS contract_end_date,
           CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE DATE '2001-11-04' - CAST(o_custkey % 120 AS INT) END
               AS last_complaint_date
    FROM {orders}"""
score(
    "churn_features", lambda usage: telecom.churn_features(usage, AS_OF), "usage",
    "customer_id:l contract_days:l yearly_charge:d daily_gb:d call_band:l contract_band:l gb_per_charge:d "
    "complaint_age_days:l churn_risk:s",
    """SELECT *, CASE WHEN contract_band >= 3 AND call_band = 3 AND complaint_age_days < 30 THEN 'HIGH'
           WHEN contract_band >= 2 AND call_band >= 2 AND complaint_age_days < 60 THEN 'MEDIUM'
           WHEN contract_band >= 3 AND gb_per_charge < 0.5e0 THEN 'HIGH'
           WHEN contract_band >= 2 OR complaint_age_days < 90 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk
       FROM (SELECT *, CASE WHEN contract_days < -30 THEN 0 WHEN contract_days < 0 THEN 1 WHEN contract_days < 30 THEN 2
                 WHEN contract_days < 90 THEN 3 ELSE 4 END AS contract_band
       FROM (SELECT *, DATE_DIFF('day', contract_end_date, DATE '2001-11-04') AS contract_days,
             monthly_charge * 12 AS yearly_charge, data_usage_gb / 30e0 AS daily_gb,
             CASE WHEN call_minutes > 500 THEN 1 WHEN call_minutes > 200 THEN 2 ELSE 3 END AS call_band,
             data_usage_gb / (monthly_charge + 0.01e0) AS gb_per_charge,
             CASE WHEN last_complaint_date IS NOT NULL THEN DATE_DIFF('day', last_complaint_date, DATE '2001-11-04')
                 ELSE 999 END AS complaint_age_days FROM usage))""",
)

DOMAIN["call_records"] = """
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS cdr_id, l_orderkey AS subscriber_id,
           CAST(l_quantity * 180 AS BIGINT) AS duration_seconds, CAST(FLOOR(l_extendedprice * 100000) AS BIGINT) AS data_bytes,
           CASE l_linenumber WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS sms_flag,
           CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS roaming_flag,
           CAST(l_discount * 60 AS DOUBLE) AS rated_amount, 'region ' || CAST(l_suppkey % 20 AS STRING) AS region,
           CASE l_linenumber WHEN 1 THEN 'unlimited' WHEN 2 THEN 'tiered' WHEN 3 THEN 'prepaid' ELSE 'family' END
               AS plan_type, 'Name ' || CAST(l_orderkey AS STRING) AS customer_name,
           's' || CAST(l_orderkey AS STRING) || '@mail.example.com' AS customer_email,
           '555' || CAST(l_orderkey AS STRING) AS customer_phone, CAST(l_partkey AS STRING) AS customer_ssn
    FROM {lineitem}"""
DOMAIN["invoices"] = """
    SELECT o_orderkey AS subscriber_id, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_custkey % 60 AS DOUBLE) END
           AS billed_amount FROM {orders}"""
DOMAIN["payments"] = "SELECT o_orderkey AS subscriber_id, o_orderpriority AS payment_state FROM {orders}"
DOMAIN["plan_rates"] = """
    SELECT CASE r_regionkey WHEN 0 THEN 'unlimited' WHEN 1 THEN 'tiered' WHEN 2 THEN 'prepaid' ELSE r_name END
           AS plan_type, r_regionkey AS rate_class
    FROM {region}"""
score(
    "revenue_assurance", telecom.revenue_assurance, "call_records invoices payments plan_rates",
    "cdr_id:s subscriber_id:l region:s payment_state:s rate_class:l expected_voice_charge:d expected_data_charge:d "
    "expected_sms_charge:d expected_total:d leakage_pct:d leakage_flag:s revenue_impact:d fraud_indicator:l",
    """SELECT *, CASE WHEN ABS(leakage_pct) > 25 THEN 'CRITICAL' WHEN ABS(leakage_pct) > 10 THEN 'HIGH'
           WHEN ABS(leakage_pct) > 5 THEN 'MEDIUM' ELSE 'OK' END AS leakage_flag
       FROM (SELECT *, (expected_total - billed_amount) / (expected_total + 0.001e0) * 100 AS leakage_pct,
             expected_total - billed_amount AS revenue_impact
       FROM (SELECT *, expected_voice_charge + expected_data_charge + expected_sms_charge AS expected_total
       FROM (SELECT c.*, billed_amount, payment_state, rate_class,
             CASE WHEN roaming_flag THEN duration_seconds / 60e0 * 0.35e0 ELSE duration_seconds / 60e0 * 0.05e0 END
                 AS expected_voice_charge,
             CASE WHEN roaming_flag THEN data_bytes / 1048576e0 * 0.02e0 ELSE data_bytes / 1073741824e0 * 8.5e0 END
                 AS expected_data_charge,
             CASE WHEN sms_flag THEN CASE WHEN roaming_flag THEN 0.25e0 ELSE 0.05e0 END ELSE 0e0 END
                 AS expected_sms_charge,
             CASE WHEN duration_seconds > 7200 AND rated_amount < 1 THEN 4
                 WHEN data_bytes > 5368709120 AND rated_amount < 5 THEN 4 WHEN rated_amount = 0 THEN 3 ELSE 0 END
                 AS fraud_indicator
             FROM call_records c LEFT JOIN invoices i ON c.subscriber_id = i.subscriber_id
             LEFT JOIN payments p ON c.subscriber_id = p.subscriber_id
             LEFT JOIN plan_rates r ON c.plan_type = r.plan_type)))""",
)

DOMAIN["offer_customers"] = """
    SELECT o_orderkey AS customer_id, CAST(o_totalprice / 2500 AS DOUBLE) AS monthly_arpu, o_custkey % 48 AS tenure_months,
           CAST(o_custkey % 101 AS DOUBLE) / 100 AS propensity_to_churn,
           'c' || CAST(o_orderkey AS STRING) || '@mail.example.com' AS email,
           '555' || CAST(o_orderkey AS STRING) AS phone_number, CAST(o_custkey AS STRING) AS ssn,
           CAST(o_orderkey AS STRING) AS credit_card_number
    FROM {orders}"""
DOMAIN["offer_usage"] = """
    SELECT o_orderkey AS customer_id, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_custkey % 60 AS DOUBLE) END
           AS data_usage_gb, CAST(o_orderkey % 1200 AS DOUBLE) AS call_minutes
    FROM {orders}"""
DOMAIN["offer_campaigns"] = """
    SELECT o_orderkey AS customer_id, o_custkey % 55 AS total_interactions,
           CAST(o_orderkey % 5 AS DOUBLE) AS propensity_to_upgrade
    FROM {orders}"""
DOMAIN["offer_browsing"] = """
    SELECT o_orderkey AS customer_id, CAST(o_orderkey % 50 AS DOUBLE) AS streaming_hours FROM {orders}"""
score(
    "personalised_offers", telecom.personalised_offers, "offer_customers offer_usage offer_campaigns offer_browsing",
    "customer_id:l monthly_arpu:d value_tier:s engagement_score:l data_affinity:l voice_affinity:l "
    "streaming_affinity:l upgrade_score:d recommended_offer:s discount_amount:d",
    """SELECT *, CASE recommended_offer WHEN 'retention_discount_20pct' THEN monthly_arpu * 0.2e0
           WHEN 'loyalty_reward' THEN 15e0 WHEN 'premium_bundle' THEN 25e0 ELSE 0e0 END AS discount_amount
       FROM (SELECT *, CASE WHEN value_tier = 'platinum' AND upgrade_score > 15 THEN 'premium_bundle'
                 WHEN data_affinity >= 4 AND streaming_affinity >= 4 THEN 'unlimited_data_streaming'
                 WHEN voice_affinity >= 4 AND data_affinity <= 2 THEN 'voice_focused_plan'
                 WHEN propensity_to_churn > 0.6e0 THEN 'retention_discount_20pct'
                 WHEN tenure_months > 24 THEN 'loyalty_reward' ELSE 'standard_offer' END AS recommended_offer
       FROM (SELECT *, propensity_to_upgrade * 4e0 + engagement_score * 1.5e0 + data_affinity * 2e0
                 - propensity_to_churn * 3e0 AS upgrade_score
       FROM (SELECT c.*, propensity_to_upgrade,
             CASE WHEN monthly_arpu >= 150 THEN 'platinum' WHEN monthly_arpu >= 100 THEN 'gold'
                 WHEN monthly_arpu >= 60 THEN 'silver' WHEN monthly_arpu >= 30 THEN 'bronze' ELSE 'basic' END AS value_tier,
             CASE WHEN total_interactions >= 50 THEN 5 WHEN total_interactions >= 25 THEN 4
                 WHEN total_interactions >= 10 THEN 3 WHEN total_interactions >= 5 THEN 2
                 WHEN total_interactions >= 1 THEN 1 ELSE 0 END AS engagement_score,
             CASE WHEN data_usage_gb > 50 THEN 5 WHEN data_usage_gb > 20 THEN 4 WHEN data_usage_gb > 10 THEN 3
                 WHEN data_usage_gb > 5 THEN 2 ELSE 1 END AS data_affinity,
             CASE WHEN call_minutes > 1000 THEN 5 WHEN call_minutes > 500 THEN 4 WHEN call_minutes > 200 THEN 3
                 ELSE 1 END AS voice_affinity,
             CASE WHEN streaming_hours > 40 THEN 5 WHEN streaming_hours > 20 THEN 4 WHEN streaming_hours > 10 THEN 3
                 ELSE 1 END AS streaming_affinity
             FROM offer_customers c LEFT JOIN offer_usage u ON c.customer_id = u.customer_id
             LEFT JOIN offer_campaigns p ON c.customer_id = p.customer_id
             LEFT JOIN offer_browsing b ON c.customer_id = b.customer_id)))""",
)

DOMAIN["subscribers"] = """
    SELECT l_orderkey AS subscriber_id, CASE l_linenumber WHEN 1 THEN 'online' WHEN 2 THEN 'retail_store'
           WHEN 3 THEN 'call_center' WHEN 4 THEN 'ivr' WHEN 5 THEN 'fax' END AS channel,
           CAST(l_quantity AS INT) AS short_call_count_1h, l_linenumber * 3 AS unique_numbers_1h,
           CAST(l_quantity * 2 AS INT) AS account_age_days, CAST(l_discount * 1000 AS DOUBLE) AS intl_usage_pct,
           350 + l_linenumber * 50 AS credit_score, '555' || CAST(l_orderkey AS STRING) AS msisdn,
           'Name ' || CAST(l_orderkey AS STRING) AS customer_name,
           's' || CAST(l_orderkey AS STRING) || '@mail.example.com' AS customer_email,
           '556' || CAST(l_orderkey AS STRING) AS customer_phone, CAST(l_partkey AS STRING) AS customer_ssn,
           CAST(l_partkey AS STRING) || CAST(l_orderkey AS STRING) AS credit_card_number
    FROM {lineitem}"""
DOMAIN["sim_changes"] = """
    SELECT o_orderkey AS subscriber_id, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_custkey % 5 END AS sim_changes_30d
    FROM {orders}"""
DOMAIN["device_changes"] = "SELECT o_orderkey AS subscriber_id, o_orderkey % 6 AS device_changes_30d FROM {orders}"
DOMAIN["international_calls"] = """
    SELECT CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderkey END AS subscriber_id,
           o_custkey % 60 AS intl_call_count_24h
    FROM {orders}"""
score(
    "subscriber_fraud", telecom.subscriber_fraud, "subscribers sim_changes device_changes international_calls",
    "subscriber_id:l channel:s sim_swap_count_30d:l sim_swap_risk:l device_risk:l irsf_risk:l wangiri_risk:l "
    "sub_fraud_risk:l fraud_score:d fraud_probability:d",
    """SELECT *, CASE WHEN fraud_score > 35 THEN 0.95e0 WHEN fraud_score > 25 THEN 0.8e0 WHEN fraud_score > 15 THEN 0.55e0
           WHEN fraud_score > 8 THEN 0.3e0 ELSE 0.05e0 END AS fraud_probability
       FROM (SELECT *, sim_swap_risk * 4.5e0 + device_risk * 2e0 + irsf_risk * 5e0 + wangiri_risk * 3.5e0
                 + sub_fraud_risk * 3e0 AS fraud_score
       FROM (SELECT s.*, COALESCE(sim_changes_30d, 0) AS sim_swap_count_30d,
             CASE WHEN sim_changes_30d >= 3 THEN 5 WHEN sim_changes_30d >= 2 THEN 4 WHEN sim_changes_30d >= 1 THEN 2
                 ELSE 0 END AS sim_swap_risk,
             CASE WHEN device_changes_30d >= 4 THEN 5 WHEN device_changes_30d >= 3 THEN 4
                 WHEN device_changes_30d >= 2 THEN 3 WHEN device_changes_30d >= 1 THEN 1 ELSE 0 END AS device_risk,
             CASE WHEN intl_call_count_24h > 50 THEN 5 WHEN intl_call_count_24h > 20 THEN 4
                 WHEN intl_call_count_24h > 10 THEN 3 WHEN intl_call_count_24h > 5 THEN 2 ELSE 0 END AS irsf_risk,
             CASE WHEN short_call_count_1h > 20 AND unique_numbers_1h > 15 THEN 5
                 WHEN short_call_count_1h > 10 AND unique_numbers_1h > 8 THEN 4
                 WHEN short_call_count_1h > 5 THEN 2 ELSE 0 END AS wangiri_risk,
             CASE WHEN account_age_days < 30 AND intl_usage_pct > 80 THEN 5
                 WHEN account_age_days < 60 AND intl_usage_pct > 60 THEN 4
                 WHEN account_age_days < 90 AND credit_score < 500 THEN 3 ELSE 0 END AS sub_fraud_risk
             FROM subscribers s LEFT JOIN sim_changes c ON s.subscriber_id = c.subscriber_id
             LEFT JOIN device_changes d ON s.subscriber_id = d.subscriber_id
             LEFT JOIN international_calls i ON s.subscriber_id = i.subscriber_id))""",
)

DOMAIN["cells"] = """
    SELECT l_partkey AS cell_id, l_suppkey AS market_id,
           CASE l_linenumber WHEN 1 THEN '5G_NR' WHEN 2 THEN 'LTE' WHEN 3 THEN '3G' WHEN 4 THEN '2G' END AS technology,
           CAST(l_extendedprice / 700 AS DOUBLE) AS avg_throughput_mbps, CAST(l_discount * 60 AS DOUBLE) AS drop_call_rate,
           CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(l_quantity * 2 AS DOUBLE) END AS prb_utilization_pct,
           CAST(l_linenumber * 20 AS DOUBLE) AS connected_users,
           'Eng ' || CAST(l_suppkey AS STRING) AS engineer_name,
           'eng' || CAST(l_suppkey AS STRING) || '@mail.example.com' AS engineer_email,
           '5557' || CAST(l_suppkey AS STRING) AS engineer_phone, CAST(l_orderkey AS STRING) AS engineer_ssn
    FROM {lineitem}"""
DOMAIN["cell_traffic"] = "SELECT p_partkey AS cell_id, CAST(p_size * 2 AS DOUBLE) AS max_capacity FROM {part}"
DOMAIN["cell_complaints"] = "SELECT p_partkey AS cell_id, p_type AS main_complaint FROM {part}"
DOMAIN["speed_tests"] = """
    SELECT CASE p_type WHEN 'PROMO' THEN NULL ELSE p_partkey END AS cell_id,
           CAST(-120 + p_size AS DOUBLE) AS interference_level_dbm
    FROM {part}"""
score(
    "network_quality", telecom.network_quality, "cells cell_traffic cell_complaints speed_tests",
    "cell_id:l market_id:l technology:s main_complaint:s throughput_score:l drop_rate_score:l utilization_score:l "
    "congestion_risk:s interference_flag:l nqi_score:d",
    """SELECT *, throughput_score * 3e0 + drop_rate_score * 4.5e0 + utilization_score * 2.5e0 + 5
           - interference_flag * 1.5e0 AS nqi_score
       FROM (SELECT c.*, main_complaint,
             CASE WHEN avg_throughput_mbps >= 100 THEN 5 WHEN avg_throughput_mbps >= 50 THEN 4
                 WHEN avg_throughput_mbps >= 25 THEN 3 WHEN avg_throughput_mbps >= 10 THEN 2
                 WHEN avg_throughput_mbps >= 5 THEN 1 ELSE 0 END AS throughput_score,
             CASE WHEN drop_call_rate < 0.5e0 THEN 5 WHEN drop_call_rate < 1 THEN 4 WHEN drop_call_rate < 2 THEN 3
                 WHEN drop_call_rate < 3 THEN 2 WHEN drop_call_rate < 5 THEN 1 ELSE 0 END AS drop_rate_score,
             CASE WHEN prb_utilization_pct < 40 THEN 5 WHEN prb_utilization_pct < 60 THEN 4
                 WHEN prb_utilization_pct < 75 THEN 3 WHEN prb_utilization_pct < 85 THEN 2
                 WHEN prb_utilization_pct < 95 THEN 1 ELSE 0 END AS utilization_score,
             CASE WHEN prb_utilization_pct > 85 AND connected_users > max_capacity * 0.9e0 THEN 'CRITICAL'
                 WHEN prb_utilization_pct > 70 AND connected_users > max_capacity * 0.7e0 THEN 'HIGH'
                 WHEN prb_utilization_pct > 60 THEN 'MEDIUM' ELSE 'LOW' END AS congestion_risk,
             CASE WHEN interference_level_dbm > -80 THEN 4 WHEN interference_level_dbm > -90 THEN 3
                 WHEN interference_level_dbm > -100 THEN 2 WHEN interference_level_dbm > -110 THEN 1 ELSE 0 END
                 AS interference_flag
             FROM cells c LEFT JOIN cell_traffic t ON c.cell_id = t.cell_id
             LEFT JOIN cell_complaints p ON c.cell_id = p.cell_id LEFT JOIN speed_tests s ON c.cell_id = s.cell_id)""",
)

# Finance

DOMAIN["loan_applications"] = """
    SELECT o_orderkey AS customer_id, CAST(o_totalprice * 2 AS DOUBLE) AS loan_amount,
           CAST((o_custkey % 250) * 1000 AS DOUBLE) AS annual_income,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE 550 + CAST(o_custkey % 250 AS INT) END AS credit_score,
           360 AS loan_term, CAST(o_custkey % 9 AS DOUBLE) AS interest_rate, CAST(o_totalprice * 3 AS DOUBLE) AS property_value,
           CASE o_orderpriority WHEN '5-LOW' THEN 'AB123' ELSE CAST(10000 + o_custkey AS STRING) END AS zip_code
    FROM {orders}"""


def _rounded_payment(applications: DataFrame) -> DataFrame:
    # Powers may differ in the last digit between engines.
    scored = finance.loan_features(applications)
    return scored.withColumn("monthly_payment", F.round("monthly_payment", 3))


score(
    "loan_features", _rounded_payment, "loan_applications",
    "customer_id:l dti_ratio:d risk_bucket:l income_bracket:s ltv_ratio:d monthly_payment:d zip_risk:l",
    """SELECT *, loan_amount / NULLIF(annual_income, 0) AS dti_ratio,
       CASE WHEN credit_score >= 750 THEN 0 WHEN credit_score >= 700 THEN 1 WHEN credit_score >= 650 THEN 2
           WHEN credit_score >= 600 THEN 3 ELSE 4 END AS risk_bucket,
       CASE WHEN annual_income > 200000 THEN 'high' WHEN annual_income > 80000 THEN 'medium' ELSE 'low' END
           AS income_bracket,
       loan_amount / (property_value * 0.95e0) AS ltv_ratio,
       ROUND(loan_amount * (interest_rate / 12 / 100) * POW(1 + interest_rate / 12 / 100, 360)
           / NULLIF(POW(1 + interest_rate / 12 / 100, 360) - 1, 0), 3) AS monthly_payment,
       TRY_CAST(SUBSTRING(zip_code, 1, 3) AS INTEGER) % 5 AS zip_risk
       FROM loan_applications""",
)

DOMAIN["claims"] = """
    SELECT l_orderkey * 10 + l_linenumber AS claim_id, l_orderkey AS policy_number,
           CAST(l_extendedprice AS DOUBLE) AS claim_amount, CAST(l_shipdate AS DATE) AS claim_date,
           CAST(l_linenumber - 1 AS INT) AS witness_count,
           CASE l_returnflag WHEN 'R' THEN FALSE WHEN 'A' THEN TRUE END AS police_report_filed,
           CAST(FLOOR(l_quantity / 10) AS INT) AS prior_claims_count, l_suppkey AS agent_id,
           'Name ' || CAST(l_orderkey AS STRING) AS claimant_name, CAST(l_partkey AS STRING) AS claimant_ssn
    FROM {lineitem}"""
DOMAIN["claim_history"] = "SELECT o_orderkey AS policy_number, o_orderpriority AS history_class FROM {orders}"
DOMAIN["policies"] = """
    SELECT o_orderkey AS policy_number, CAST(o_totalprice / 100 AS DOUBLE) AS annual_premium,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) - 60 END AS policy_start_date
    FROM {orders}"""
DOMAIN["agents"] = "SELECT s_suppkey AS agent_id, s_name AS agent_name FROM {supplier}"
score(
    "claim_features", finance.claim_features, "claims claim_history policies agents",
    "claim_id:l history_class:s agent_name:s claim_to_premium_ratio:d velocity_flag:l amount_flag:l timing_flag:l "
    "suspicious_score:d",
    """SELECT *, velocity_flag * 2.5e0 + amount_flag * 1.8e0 + timing_flag * 2e0
           + CASE WHEN NOT police_report_filed THEN 1.5e0 ELSE 0e0 END + CASE WHEN witness_count = 0 THEN 1.2e0 ELSE 0e0 END
           AS suspicious_score
       FROM (SELECT c.*, history_class, agent_name, claim_amount / (annual_premium + 0.01e0) AS claim_to_premium_ratio,
             CASE WHEN prior_claims_count >= 3 THEN 1 ELSE 0 END AS velocity_flag,
             CASE WHEN claim_amount > 50000 THEN 3 WHEN claim_amount > 25000 THEN 2 WHEN claim_amount > 10000 THEN 1
                 ELSE 0 END AS amount_flag,
             CASE WHEN DATE_DIFF('day', policy_start_date, claim_date) < 90 THEN 2
                 WHEN DATE_DIFF('day', policy_start_date, claim_date) < 180 THEN 1 ELSE 0 END AS timing_flag
             FROM claims c LEFT JOIN claim_history h ON c.policy_number = h.policy_number
             LEFT JOIN policies p ON c.policy_number = p.policy_number LEFT JOIN agents a ON c.agent_id = a.agent_id)""",
)

# Health

DOMAIN["cohort"] = """
    SELECT o_orderkey AS person_id, CAST(o_custkey % 100 AS INT) AS age, 'First' || CAST(o_custkey AS STRING) AS first_name,
           'Last' || CAST(o_custkey AS STRING) AS last_name, CAST(o_orderkey AS STRING) AS social_security_number
    FROM {orders}"""
DOMAIN["measurements"] = """
    SELECT o_orderkey AS person_id, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(40 + o_custkey % 70 AS DOUBLE) / 10 END
           AS value_as_number, CAST(90 + o_orderkey % 110 AS INT) AS systolic
    FROM {orders}"""
DOMAIN["drug_exposure"] = "SELECT o_orderkey AS person_id, o_orderpriority AS drug_class FROM {orders}"
DOMAIN["conditions"] = "SELECT o_orderkey AS person_id, CAST(o_custkey % 7 AS INT) AS comorbidity_count FROM {orders}"
DOMAIN["visits"] = """
    SELECT CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderkey END AS person_id,
           CAST(o_orderkey % 5 AS INT) AS visit_count_30d
    FROM {orders}"""
score(
    "patient_outcomes", health.patient_outcomes, "cohort measurements drug_exposure conditions visits",
    "person_id:l age:l drug_class:s hba1c_risk:s bp_category:s readmission_risk:d",
    """SELECT c.*, drug_class,
       CASE WHEN value_as_number > 9 THEN 'uncontrolled' WHEN value_as_number > 7 THEN 'above_target'
           WHEN value_as_number >= 5.7e0 THEN 'prediabetic' ELSE 'normal' END AS hba1c_risk,
       CASE WHEN systolic >= 180 THEN 'crisis' WHEN systolic >= 140 THEN 'stage2' WHEN systolic >= 130 THEN 'stage1'
           WHEN systolic >= 120 THEN 'elevated' ELSE 'normal' END AS bp_category,
       CASE WHEN visit_count_30d >= 3 AND age > 65 THEN 0.85 WHEN visit_count_30d >= 2 AND comorbidity_count > 3 THEN 0.72
           WHEN visit_count_30d >= 2 THEN 0.55 WHEN age > 75 THEN 0.45 ELSE 0.15 END AS readmission_risk
       FROM cohort c LEFT JOIN measurements m ON c.person_id = m.person_id
       LEFT JOIN drug_exposure d ON c.person_id = d.person_id LEFT JOIN conditions k ON c.person_id = k.person_id
       LEFT JOIN visits v ON c.person_id = v.person_id""",
)

DOMAIN["trial_patients"] = """
    SELECT l_orderkey * 10 + l_linenumber AS patient_id, NULLIF('First' || CAST(l_suppkey AS STRING), 'First0') AS first_name,
           'Last' || CAST(l_partkey AS STRING) AS last_name, CAST(l_quantity AS DOUBLE) - 1 AS dosage,
           CAST(FLOOR(l_quantity * 1.6) AS INT) AS age, CAST(l_quantity + 30 AS DOUBLE) AS weight,
           CASE l_tax WHEN 0 THEN 0 ELSE CAST(140 + l_linenumber * 8 AS DOUBLE) END AS height,
           l_linenumber AS visit_count,
           CASE l_returnflag WHEN 'R' THEN 'completed' WHEN 'A' THEN 'active' ELSE 'dropped' END AS status,
           l_linenumber + 1 AS adverse_events, l_partkey AS site_id,
           CAST(l_discount AS DECIMAL(6, 2)) AS efficacy_score
    FROM {lineitem}"""
_TRIAL_OUT = "patient_id:l full_name:s age:l bmi:d risk_score:d adjusted_dosage:d"
_TRIAL_COLUMNS = """patient_id, first_name || ' ' || last_name AS full_name, age,
    weight / NULLIF(POW(height / 100, 2), 0) AS bmi,
    CASE WHEN age > 60 THEN 1.5 WHEN age > 40 THEN 1.2 ELSE 1 END AS risk_score,
    dosage * 0.85e0 + 12.5e0 AS adjusted_dosage"""


def _trial(plan: health.TrialPlan):
    return lambda patients: health.trial_results(patients, plan)


for _name, _plan, _where in (
    (
        "trial_phase_1",
        health.TrialPlan(1, include_adverse=True, blinding="double", interim=True, min_age=21, max_age=60),
        "age BETWEEN 18 AND 65 AND dosage > 0 AND weight >= 45.5 AND visit_count >= 3 AND age >= 21 AND age <= 60",
    ),
    ("trial_phase_1_open", health.TrialPlan(1, include_adverse=True, blinding="open"), "TRUE"),
    ("trial_phase_2", health.TrialPlan(2), "status IN ('active', 'completed') AND adverse_events <= 5"),
    ("trial_phase_3", health.TrialPlan(3), "status = 'completed'"),
):
    add(
        _name, _trial(_plan), "trial_patients", _TRIAL_OUT,
        f"SELECT {_TRIAL_COLUMNS} FROM trial_patients WHERE {_where}",
    )
