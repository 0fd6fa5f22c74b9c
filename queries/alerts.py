"""Summaries, masked row alerts and segment rollups of the scoring jobs.

Scores that are not whole multiples of a small unit are turned into decimals before they are summed, so that
the totals do not depend on the order of the rows.
"""

from __future__ import annotations

from queries.common import add, exact, mean
from queries.scoring import SCORED
from tallymark.plans.scoring import energy, health, retail, telecom


def on(job: str, step, *decimals: str, scale: int = 4):
    """A follow-up step on the scored rows of a job."""
    build = SCORED[job].build
    return lambda *frames: step(exact(build(*frames), scale, *decimals) if decimals else build(*frames))


def follow(name: str, job: str, step, out: str, sql: str, *decimals: str, scale: int = 4) -> None:
    source = SCORED[job]
    add(name, on(job, step, *decimals, scale=scale), source.uses, out, sql.replace("SCORED", f"({source.sql})"))


def total(c: str, scale: int = 4) -> str:
    return f"SUM(CAST({c} AS DECIMAL(18, {scale})))"


# How contact columns are shown, in SQL.
def sha(c: str) -> str:
    return f"sha256(TRIM({c}))"


def mail(c: str) -> str:
    return f"SUBSTRING(LOWER(TRIM({c})), 1, 1) || '***@' || string_split(LOWER(TRIM({c})), '@')[2]"


def tel(c: str) -> str:
    return f"'******' || SUBSTRING({c}, -4, 4)"


def idn(c: str) -> str:
    return f"'XXXXXXXX' || SUBSTRING({c}, -4, 4)"


def people(prefix: str, kinds: str) -> tuple[str, str]:
    """Output kinds and SQL of the masked contact columns of one person, e.g. customer_name to customer_ssn."""
    mask = {"name": sha, "email": mail, "phone": tel, "ssn": idn}
    names = kinds.split()
    out = " ".join(f"{prefix}_{k}_masked:s" for k in names)
    return out, ", ".join(f"{mask[k](f'{prefix}_{k}')} AS {prefix}_{k}_masked" for k in names)


# Grid
follow(
    "grid_alerts", "grid_features", energy.grid_alerts, "sensor_id:s risk_index:d operator_name_masked:s",
    f"SELECT sensor_id, risk_index, {sha('operator_name')} AS operator_name_masked FROM SCORED WHERE risk_index > 8",
)

# Meter theft
follow(
    "meter_theft_summary", "meter_theft", energy.meter_theft_summary, "suspects:l tampered:l total_loss:d",
    f"""SELECT COUNT(*) FILTER (theft_probability > 0.7) AS suspects, COUNT(*) FILTER (tamper_flag) AS tampered,
        {total('est_monthly_loss')} AS total_loss FROM SCORED""",
    "est_monthly_loss",
)
_out, _sql = people("customer", "name email phone ssn")
follow(
    "meter_theft_alerts", "meter_theft", energy.meter_theft_alerts,
    f"meter_id:l account_id:l theft_probability:d est_monthly_loss:d {_out}",
    f"SELECT meter_id, account_id, theft_probability, est_monthly_loss, {_sql} FROM SCORED WHERE theft_probability > 0.7",
)
follow(
    "meter_theft_rollup", "meter_theft", energy.meter_theft_rollup, "district_id:l rate_class:s total_loss:d",
    f"""WITH s AS (SELECT * FROM SCORED WHERE theft_probability > 0.5),
        t AS (SELECT district_id, {total('est_monthly_loss')} AS total_loss FROM s GROUP BY district_id)
        SELECT DISTINCT s.district_id, rate_class, total_loss FROM s JOIN t ON s.district_id = t.district_id
        WHERE total_loss > 5000 AND rate_class IN ('residential', 'commercial', 'industrial')""",
    "est_monthly_loss",
)

# Outage
follow(
    "outage_summary", "outage_risk", energy.outage_summary, "emergencies:l large_outages:l total:l",
    """SELECT COUNT(*) FILTER (dispatch_priority = 'EMERGENCY') AS emergencies,
       COUNT(*) FILTER (customers_affected > 5000) AS large_outages, COUNT(*) AS total FROM SCORED""",
)
_out, _sql = people("crew_lead", "name email phone ssn")
follow(
    "outage_alerts", "outage_risk", energy.outage_alerts,
    f"feeder_id:l dispatch_priority:s customers_affected:l {_out}",
    f"""SELECT feeder_id, dispatch_priority, customers_affected, {_sql} FROM SCORED
        WHERE dispatch_priority = 'EMERGENCY'""",
)
follow(
    "outage_rollup", "outage_risk", energy.outage_rollup, "district_id:l fault_type:s total_affected:l",
    """WITH s AS (SELECT * FROM SCORED WHERE dispatch_priority = 'EMERGENCY'),
       t AS (SELECT district_id, SUM(customers_affected) AS total_affected FROM s GROUP BY district_id)
       SELECT DISTINCT s.district_id, fault_type, total_affected FROM s JOIN t ON s.district_id = t.district_id
       WHERE total_affected > 10000 AND fault_type IN ('tree_contact', 'equipment_failure', 'lightning', 'animal')""",
)

# Renewable output
follow(
    "renewable_summary", "renewable_forecast", energy.renewable_summary, "low_output:l high_output:l",
    """SELECT COUNT(*) FILTER (forecast_mw < capacity_mw * 0.2e0) AS low_output,
       COUNT(*) FILTER (forecast_mw > capacity_mw * 0.8e0) AS high_output FROM SCORED""",
)
_out, _sql = people("operator", "name email ssn")
follow(
    "renewable_alerts", "renewable_forecast", energy.renewable_alerts, f"plant_id:l forecast_mw:d {_out}",
    f"SELECT plant_id, forecast_mw, {_sql} FROM SCORED WHERE forecast_mw < 10",
)
follow(
    "renewable_rollup", "renewable_forecast", energy.renewable_rollup, "plant_type:s region:s total_forecast:d",
    f"""SELECT plant_type, region, {total('forecast_mw', 12)} AS total_forecast FROM SCORED
        WHERE plant_type IN ('solar', 'wind') AND region IS NOT NULL GROUP BY plant_type, region
        HAVING {total('forecast_mw', 12)} < 100""",
    "forecast_mw", scale=12,
)

# Transformers
follow(
    "transformer_summary", "transformer_health", energy.transformer_summary, "poor_health:l likely_failures:l",
    """SELECT COUNT(*) FILTER (health_index < 40) AS poor_health, COUNT(*) FILTER (failure_prob > 0.5) AS likely_failures
       FROM SCORED""",
)
_out, _sql = people("operator", "name email phone ssn")
follow(
    "transformer_alerts", "transformer_health", energy.transformer_alerts,
    f"asset_id:l health_index:d failure_prob:d {_out}",
    f"SELECT asset_id, health_index, failure_prob, {_sql} FROM SCORED WHERE failure_prob > 0.5",
)
follow(
    "transformer_rollup", "transformer_health", energy.transformer_rollup,
    "zone_id:l manufacturer:s avg_health_index:d assets:l",
    f"""SELECT zone_id, manufacturer, {mean('health_index', 2, 6)} AS avg_health_index, COUNT(*) AS assets FROM SCORED
        WHERE health_index < 30 AND manufacturer IN ('ABB', 'Siemens', 'GE', 'Hitachi')
        GROUP BY zone_id, manufacturer""",
    "health_index", scale=2,
)

# Customer value
follow(
    "customer_value_share", "customer_value", retail.customer_value_share, "notable_share:d",
    """SELECT COUNT(*) FILTER (segment IN ('VIP', 'At_Risk', 'Lost')) / (COUNT(*) + 0.001e0) AS notable_share
       FROM SCORED""",
)
follow(
    "customer_value_alerts", "customer_value", retail.customer_value_alerts,
    "customer_id:l segment:s clv_estimate:d churn_prob:d email_masked:s phone_number_masked:s ssn_masked:s",
    f"""SELECT customer_id, segment, clv_estimate, churn_prob, {mail('email')} AS email_masked,
        {tel('phone_number')} AS phone_number_masked, {idn('ssn')} AS ssn_masked FROM SCORED WHERE churn_prob > 0.6""",
)
follow(
    "customer_value_rollup", "customer_value", retail.customer_value_rollup,
    "segment:s preferred_channel:s avg_clv:d customers:l",
    f"""WITH s AS (SELECT * FROM SCORED WHERE segment IN ('VIP', 'Loyal', 'At_Risk', 'Lost')),
       v AS (SELECT segment, {mean('clv_estimate', 0, 6)} AS avg_clv
             FROM s GROUP BY segment)
       SELECT s.segment, preferred_channel, ANY_VALUE(avg_clv) AS avg_clv, COUNT(*) AS customers
       FROM s JOIN v ON s.segment = v.segment
       WHERE avg_clv > 5000 AND preferred_channel IN ('online', 'in_store', 'mobile_app')
       GROUP BY s.segment, preferred_channel HAVING COUNT(*) > 10""",
    "clv_estimate", scale=0,
)

# Pricing
follow(
    "pricing_summary", "pricing", retail.pricing_summary, "price_cuts:l markdowns:l total:l",
    """SELECT COUNT(*) FILTER (comp_action = 'price_cut') AS price_cuts, COUNT(*) FILTER (markdown_pct > 0) AS markdowns,
       COUNT(*) AS total FROM SCORED""",
)
follow(
    "pricing_alerts", "pricing", retail.pricing_alerts,
    "sku:l retail_price:d optimal_price:d comp_action:s customer_email_masked:s customer_ssn_masked:s",
    f"""SELECT sku, retail_price, optimal_price, comp_action, {mail('customer_email')} AS customer_email_masked,
        {idn('customer_ssn')} AS customer_ssn_masked FROM SCORED WHERE ABS(optimal_price - retail_price) > 10""",
)
follow(
    "pricing_rollup", "pricing", retail.pricing_rollup, "category:s comp_action:s products:l avg_margin:d",
    """SELECT category, comp_action, COUNT(*) AS products, AVG(margin_pct) AS avg_margin FROM SCORED
       WHERE category IN ('electronics', 'apparel', 'home', 'grocery', 'beauty')
         AND comp_action IN ('price_cut', 'margin_opportunity')
       GROUP BY category, comp_action HAVING COUNT(*) > 10 AND AVG(margin_pct) < 15""",
)

# Point of sale
follow(
    "pos_summary", "pos_checks", retail.pos_summary, "flagged:l clean:l",
    """SELECT COUNT(*) FILTER (fraud_flag >= 2) AS flagged, COUNT(*) FILTER (fraud_flag < 2) AS clean FROM SCORED""",
)
follow(
    "pos_alerts", "pos_checks", retail.pos_alerts, "txn_id:s total:d fraud_flag:l",
    "SELECT txn_id, total, fraud_flag FROM SCORED WHERE fraud_flag >= 2",
)
follow(
    "pos_rollup", "pos_checks", retail.pos_rollup, "region:s category:s transactions:l avg_total:d frauds:l",
    f"""SELECT region, category, COUNT(*) AS transactions, {mean('CAST(total AS DECIMAL(18, 3))', 3, 7)} AS avg_total,
        COUNT(*) FILTER (fraud_flag >= 2) AS frauds FROM SCORED
        WHERE region IS NOT NULL AND category IN ('electronics', 'apparel', 'grocery', 'home')
        GROUP BY region, category
        HAVING COUNT(*) > 50 AND AVG(total) > 200 AND COUNT(*) FILTER (fraud_flag >= 2) > 5""",
    "total", scale=3,
)

# Deliveries
follow(
    "delivery_summary", "delivery_cost", retail.delivery_summary, "urgent:l risky_suppliers:l late:l",
    """SELECT COUNT(*) FILTER (priority_score >= 4) AS urgent, COUNT(*) FILTER (supplier_risk >= 3) AS risky_suppliers,
       COUNT(*) FILTER (late_penalty > 0) AS late FROM SCORED""",
)
follow(
    "delivery_alerts", "delivery_cost", retail.delivery_alerts,
    "warehouse_id:l delivery_cost:d late_penalty:d manager_ssn_masked:s supplier_contact_email_masked:s",
    f"""SELECT warehouse_id, delivery_cost, late_penalty, {idn('manager_ssn')} AS manager_ssn_masked,
        {mail('supplier_contact_email')} AS supplier_contact_email_masked FROM SCORED WHERE late_penalty > 20""",
)
follow(
    "delivery_rollup", "delivery_cost", retail.delivery_rollup, "warehouse_id:l delivery_type:s avg_cost:d",
    f"""SELECT warehouse_id, delivery_type, {mean('CAST(delivery_cost AS DECIMAL(18, 8))', 8, 12)} AS avg_cost FROM SCORED
        WHERE delivery_type IN ('same_day', 'next_day', 'standard') GROUP BY warehouse_id, delivery_type
        HAVING AVG(CAST(delivery_cost AS DECIMAL(18, 8))) > 50""",
    "delivery_cost", scale=8,
)

# Churn
follow(
    "churn_summary", "churn_features", telecom.churn_summary, "high:l medium:l",
    """SELECT COUNT(*) FILTER (churn_risk = 'HIGH') AS high, COUNT(*) FILTER (churn_risk = 'MEDIUM') AS medium
       FROM SCORED""",
)
follow(
    "churn_high_risk", "churn_features", telecom.churn_high_risk, "customer_id:l contract_band:l gb_per_charge:d",
    "SELECT customer_id, contract_band, gb_per_charge FROM SCORED WHERE churn_risk = 'HIGH'",
)

# Revenue assurance
follow(
    "assurance_summary", "revenue_assurance", telecom.assurance_summary, "critical:l fraudulent:l total_impact:d",
    f"""SELECT COUNT(*) FILTER (leakage_flag = 'CRITICAL') AS critical,
        COUNT(*) FILTER (fraud_indicator >= 3) AS fraudulent, {total('revenue_impact')} AS total_impact FROM SCORED""",
    "revenue_impact",
)
_out, _sql = people("customer", "name email phone ssn")
follow(
    "assurance_alerts", "revenue_assurance", telecom.assurance_alerts,
    f"cdr_id:s subscriber_id:l leakage_flag:s revenue_impact:d {_out}",
    f"""SELECT cdr_id, subscriber_id, leakage_flag, revenue_impact, {_sql} FROM SCORED
        WHERE leakage_flag = 'CRITICAL'""",
)
follow(
    "assurance_rollup", "revenue_assurance", telecom.assurance_rollup, "region:s plan_type:s total_leak:d",
    f"""WITH s AS (SELECT * FROM SCORED WHERE leakage_flag = 'CRITICAL' AND region IS NOT NULL),
        t AS (SELECT region, {total('revenue_impact')} AS total_leak FROM s GROUP BY region)
        SELECT DISTINCT s.region, plan_type, total_leak FROM s JOIN t ON s.region = t.region
        WHERE ABS(total_leak) > 10000 AND plan_type IN ('unlimited', 'tiered', 'prepaid')""",
    "revenue_impact",
)

# Offers
follow(
    "offers_summary", "personalised_offers", telecom.offers_summary, "likely_churners:l upgrade_candidates:l platinum:l",
    """SELECT COUNT(*) FILTER (propensity_to_churn > 0.7e0) AS likely_churners,
       COUNT(*) FILTER (upgrade_score > 15) AS upgrade_candidates, COUNT(*) FILTER (value_tier = 'platinum') AS platinum
       FROM SCORED""",
)
follow(
    "offers_alerts", "personalised_offers", telecom.offers_alerts,
    "customer_id:l recommended_offer:s discount_amount:d propensity_to_churn:d email_masked:s phone_number_masked:s "
    "ssn_masked:s credit_card_number_masked:s",
    f"""SELECT customer_id, recommended_offer, discount_amount, propensity_to_churn, {mail('email')} AS email_masked,
        {tel('phone_number')} AS phone_number_masked, {idn('ssn')} AS ssn_masked,
        {idn('credit_card_number')} AS credit_card_number_masked FROM SCORED WHERE propensity_to_churn > 0.7e0""",
)
follow(
    "offers_rollup", "personalised_offers", telecom.offers_rollup,
    "value_tier:s recommended_offer:s customers:l avg_arpu:d",
    f"""SELECT value_tier, recommended_offer, COUNT(*) AS customers,
        {mean('CAST(monthly_arpu AS DECIMAL(18, 6))', 6, 10)} AS avg_arpu FROM SCORED
        WHERE recommended_offer IN ('premium_bundle', 'retention_discount_20pct', 'unlimited_data_streaming')
        GROUP BY value_tier, recommended_offer HAVING COUNT(*) > 100 AND AVG(monthly_arpu) > 80""",
    "monthly_arpu", scale=6,
)

# Subscriber fraud
follow(
    "fraud_summary", "subscriber_fraud", telecom.fraud_summary, "likely_fraud:l sim_swaps:l revenue_share:l total:l",
    """SELECT COUNT(*) FILTER (fraud_probability > 0.8e0) AS likely_fraud, COUNT(*) FILTER (sim_swap_risk >= 4) AS sim_swaps,
       COUNT(*) FILTER (irsf_risk >= 4) AS revenue_share, COUNT(*) AS total FROM SCORED""",
)
_out, _sql = people("customer", "name email phone ssn")
follow(
    "fraud_alerts", "subscriber_fraud", telecom.fraud_alerts,
    f"subscriber_id:l fraud_probability:d fraud_score:d msisdn_masked:s credit_card_number_masked:s {_out}",
    f"""SELECT subscriber_id, fraud_probability, fraud_score, {tel('msisdn')} AS msisdn_masked,
        {idn('credit_card_number')} AS credit_card_number_masked, {_sql} FROM SCORED WHERE fraud_probability > 0.8e0""",
)
follow(
    "fraud_rollup", "subscriber_fraud", telecom.fraud_rollup, "fraud_type:s channel:s avg_score:d subscribers:l",
    """WITH s AS (SELECT * FROM SCORED),
       typed AS (SELECT 'sim_swap' AS fraud_type, channel, fraud_score FROM s WHERE sim_swap_risk >= 4
                 UNION ALL SELECT 'irsf', channel, fraud_score FROM s WHERE irsf_risk >= 4
                 UNION ALL SELECT 'wangiri', channel, fraud_score FROM s WHERE wangiri_risk >= 4
                 UNION ALL SELECT 'subscription', channel, fraud_score FROM s WHERE sub_fraud_risk >= 3)
       SELECT fraud_type, channel, AVG(fraud_score) AS avg_score, COUNT(*) AS subscribers FROM typed
       WHERE channel IN ('online', 'retail_store', 'call_center', 'ivr') GROUP BY fraud_type, channel
       HAVING AVG(fraud_score) > 20""",
)

# Network
follow(
    "network_summary", "network_quality", telecom.network_summary, "critical:l poor_quality:l total:l",
    """SELECT COUNT(*) FILTER (congestion_risk = 'CRITICAL') AS critical, COUNT(*) FILTER (nqi_score < 10) AS poor_quality,
       COUNT(*) AS total FROM SCORED""",
)
_out, _sql = people("engineer", "name email phone ssn")
follow(
    "network_alerts", "network_quality", telecom.network_alerts, f"cell_id:l nqi_score:d congestion_risk:s {_out}",
    f"SELECT cell_id, nqi_score, congestion_risk, {_sql} FROM SCORED WHERE congestion_risk = 'CRITICAL'",
)
follow(
    "network_rollup", "network_quality", telecom.network_rollup, "market_id:l technology:s avg_nqi:d cells:l",
    """SELECT market_id, technology, AVG(nqi_score) AS avg_nqi, COUNT(*) AS cells FROM SCORED
       WHERE congestion_risk = 'CRITICAL' AND technology IN ('5G_NR', 'LTE', '3G') GROUP BY market_id, technology""",
)

# Patients and trial sites
follow(
    "patient_alerts", "patient_outcomes", health.patient_alerts,
    "person_id:l readmission_risk:d first_name_masked:s last_name_masked:s social_security_number_masked:s",
    f"""SELECT person_id, readmission_risk, {sha('first_name')} AS first_name_masked,
        {sha('last_name')} AS last_name_masked, {idn('social_security_number')} AS social_security_number_masked
        FROM SCORED WHERE readmission_risk > 0.7""",
)
add(
    "small_sites", health.small_sites, "trial_patients", "site_id:l cnt:l avg_eff:d",
    f"""SELECT site_id, COUNT(*) AS cnt, {mean('efficacy_score', 2, 6)} AS avg_eff FROM trial_patients
        WHERE status = 'completed' GROUP BY site_id HAVING COUNT(*) < 30""",
)
