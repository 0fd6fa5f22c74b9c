"""Bronze-to-silver builders on projections of orders, lineitem and events.

Several source rows share a business key, so every builder has versions to choose from.
"""

from __future__ import annotations

from queries.common import DOMAIN, add
from tallymark.plans import banking_silver, retail_silver

AS_OF = "2001-11-04"
EVENTS_AS_OF = "2024-01-30"

# Deleted, unset and live versions; failed, warned, passed and unset quality.
_ORDER_STATE = """
    CASE o_orderpriority WHEN '5-LOW' THEN 'DELETED' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'ACTIVE' END
        AS record_status,
    CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'WARN' END AS data_quality_flag,
    'core' AS source_system, CAST(o_orderkey AS STRING) AS ingestion_batch_id, o_orderdate AS data_load_ts,
    'raw' AS raw_payload"""
_LINE_STATE = """
    CASE l_linenumber WHEN 7 THEN 'DELETED' WHEN 6 THEN NULL ELSE 'ACTIVE' END AS record_status,
    CASE l_returnflag WHEN 'A' THEN 'PASS' WHEN 'N' THEN 'WARN' END AS data_quality_flag,
    'core' AS source_system,
    CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
        || '-' || CAST(l_suppkey AS STRING) AS ingestion_batch_id,
    l_shipdate AS data_load_ts, 'raw' AS raw_payload"""
_EVENT_STATE = """
    CASE WHEN value < 5 THEN 'DELETED' WHEN value > 100 THEN NULL ELSE 'ACTIVE' END AS record_status,
    CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'click' THEN 'WARN' WHEN 'view' THEN 'PASS' END
        AS data_quality_flag,
    'core' AS source_system, CAST(event_id AS STRING) AS ingestion_batch_id, ts AS data_load_ts,
    'raw' AS raw_payload"""

DOMAIN["bank_customers"] = f"""
    SELECT CAST(o_custkey AS STRING) AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'CORPORATE' ELSE 'RETAIL' END AS customer_type,
           NULLIF('First' || CAST(o_custkey % 97 AS STRING), 'First0') AS first_name,
           CASE o_orderpriority WHEN '1-URGENT' THEN NULL ELSE 'Mid' END AS middle_name,
           'Last' || CAST(o_custkey % 89 AS STRING) AS last_name,
           CASE o_orderstatus WHEN 'P' THEN 'no address' ELSE 'c' || CAST(o_custkey AS STRING) || '@mail.example.com'
               END AS email,
           CASE o_orderstatus WHEN 'O' THEN 's' || CAST(o_orderkey AS STRING) || '@alt.example.com' END
               AS secondary_email,
           '555' || CAST(o_orderkey AS STRING) AS mobile_number, CAST(o_orderkey AS STRING) AS alternate_phone,
           'PAN' || CAST(o_orderkey AS STRING) AS pan_number, 'ID' || CAST(o_custkey AS STRING) AS aadhaar_number,
           CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'PENDING' END AS kyc_status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'MEDIUM' WHEN '3-MEDIUM' THEN 'LOW' END
               AS risk_category,
           DATE '1950-01-01' + CAST(o_custkey % 15000 AS INT) AS date_of_birth, {_ORDER_STATE}
    FROM {{orders}}"""
DOMAIN["bank_accounts"] = f"""
    SELECT CAST(o_custkey AS STRING) || '-' || o_orderstatus AS account_id,
           NULLIF(CAST(o_custkey AS STRING), '7') AS customer_id, 'SAVINGS' AS account_type,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'DORMANT' WHEN '2-HIGH' THEN NULL ELSE 'ACTIVE' END
               AS account_status,
           'B1' AS branch_code, 'USD' AS currency_code, 'IFSC0' AS ifsc_code, 'P' || o_orderstatus AS product_code,
           CASE o_orderstatus WHEN 'P' THEN CAST(o_orderkey AS STRING) END AS joint_holder_customer_id,
           o_totalprice AS current_balance, o_totalprice - 100 AS available_balance,
           CAST(o_orderdate AS DATE) AS account_open_date,
           CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) + 200 END AS account_close_date,
           CASE o_orderpriority WHEN '3-MEDIUM' THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END
               AS account_last_txn_date, {_ORDER_STATE}
    FROM {{orders}}"""
DOMAIN["bank_transactions"] = f"""
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
           CAST(l_suppkey AS STRING) AS account_id, CAST(l_partkey AS STRING) AS customer_id,
           'TYPE' || l_linestatus AS transaction_type, 'CH' || CAST(l_linenumber AS STRING) AS transaction_channel,
           CASE l_returnflag WHEN 'R' THEN 'DEBIT' WHEN 'A' THEN 'CREDIT' END AS debit_credit_indicator,
           'USD' AS transaction_currency, CAST(l_orderkey AS STRING) AS transaction_reference,
           CAST(l_partkey AS STRING) AS counterparty_account, 'IFSC1' AS counterparty_ifsc, 'M1' AS merchant_id,
           CASE l_linenumber WHEN 1 THEN 'FAILED' WHEN 2 THEN 'REVERSED' WHEN 3 THEN NULL ELSE 'SUCCESS' END
               AS transaction_status,
           CASE WHEN l_tax = 0 AND l_linenumber = 5 THEN NULL
                ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) * 2 END AS transaction_amount,
           l_shipdate AS transaction_timestamp, {_LINE_STATE}
    FROM {{lineitem}}"""
DOMAIN["bank_loans"] = f"""
    SELECT CAST(o_custkey AS STRING) || '-' || o_orderpriority AS loan_id,
           NULLIF(CAST(o_custkey AS STRING), '11') AS customer_id, 'LT' || o_orderstatus AS loan_type,
           CASE o_orderstatus WHEN 'F' THEN 'DEFAULTED' WHEN 'O' THEN 'DISBURSED' END AS loan_status,
           'home' AS loan_purpose,
           CASE o_orderstatus WHEN 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18, 2)) END AS sanctioned_amount,
           CAST(o_custkey * 25 AS DECIMAL(18, 2)) AS outstanding_amount,
           CAST(o_custkey % 12 AS DOUBLE) AS interest_rate, CAST(o_orderkey % 700 AS DOUBLE) AS emi_amount,
           NULLIF(500 + CAST(o_custkey % 300 AS INT), 505) AS credit_score, 240 AS tenure_months,
           CAST(o_orderdate AS DATE) AS application_date, CAST(o_orderdate AS DATE) + 10 AS disbursement_date,
           CAST(o_orderdate AS DATE) + 400 AS emi_due_date, {_ORDER_STATE}
    FROM {{orders}}"""
DOMAIN["bank_cards"] = f"""
    SELECT CAST(o_custkey AS STRING) || '-' || o_orderstatus || o_orderpriority AS card_id,
           CAST(o_custkey AS STRING) AS customer_id, CAST(o_custkey AS STRING) || '-' || o_orderstatus AS account_id,
           'CT' || o_orderstatus AS card_type, 'NET' AS card_network, 'XXXX' AS card_number_masked,
           CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'BLOCKED' END AS card_status, 'GOLD' AS card_tier,
           CASE o_orderpriority WHEN '1-URGENT' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18, 2)) END AS credit_limit,
           CAST(o_custkey * 3 AS DECIMAL(18, 2)) AS available_credit_limit,
           CAST(o_orderdate AS DATE) AS issue_date, CAST(o_orderdate AS DATE) + 700 AS expiry_date,
           CAST(o_orderdate AS DATE) + 5 AS last_transaction_date, 15 AS billing_cycle_day, {_ORDER_STATE}
    FROM {{orders}}"""
DOMAIN["bank_compliance_alerts"] = f"""
    SELECT CAST(user_id AS STRING) || '-' || props AS alert_id, NULLIF(CAST(user_id AS STRING), '3') AS customer_id,
           CAST(user_id AS STRING) AS account_id, CAST(event_id AS STRING) AS transaction_id,
           NULLIF(event_type, 'signup') AS alert_type,
           CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'click' THEN 'HIGH' WHEN 'view' THEN 'LOW' END
               AS alert_severity,
           CASE event_type WHEN 'error' THEN 'OPEN' WHEN 'click' THEN 'ESCALATED' WHEN 'view' THEN 'CLOSED' END
               AS alert_status,
           'rule' AS rule_triggered, 'none' AS investigation_status, CAST(value AS DECIMAL(8, 2)) AS risk_score,
           ts AS alert_generated_ts,
           CASE event_type WHEN 'click' THEN CAST(ts AS DATE) + 3 END AS resolution_date,
           CASE event_type WHEN 'error' THEN TRUE WHEN 'click' THEN FALSE END AS sar_filed_flag,
           CASE event_type WHEN 'view' THEN TRUE END AS reported_to_regulator_flag, {_EVENT_STATE}
    FROM {{events}}"""

DOMAIN["shop_customers"] = f"""
    SELECT NULLIF(CAST(o_custkey AS STRING), '5') AS customer_id, ' Name ' || CAST(o_custkey AS STRING) AS full_name,
           CASE o_orderstatus WHEN 'P' THEN 'broken' WHEN 'F' THEN ' C' || CAST(o_custkey AS STRING) || '@Mail.Example.com '
               ELSE 'c' || CAST(o_custkey AS STRING) || '@mail.example.com' END AS email,
           CASE o_orderpriority WHEN '1-URGENT' THEN ' active ' WHEN '2-HIGH' THEN 'CHURNED'
               WHEN '3-MEDIUM' THEN 'other' END AS customer_status, {_ORDER_STATE}
    FROM {{orders}}"""
DOMAIN["shop_products"] = f"""
    SELECT NULLIF(CAST(l_partkey AS STRING), '8') AS sku_id,
           CASE WHEN l_linenumber = 5 THEN NULL ELSE ' Product ' || CAST(l_partkey AS STRING) END AS product_name,
           ' Brand' || CAST(l_partkey % 25 AS STRING) || ' ' AS brand_name, ' usd' AS currency_code,
           'live ' AS product_status, 'Category ' || CAST(l_partkey % 6 AS STRING) AS category_name,
           CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 100 - 1 END AS unit_price, {_LINE_STATE}
    FROM {{lineitem}}"""
DOMAIN["shop_sales"] = f"""
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
           CASE l_linenumber WHEN 1 THEN 'pos ' WHEN 2 THEN 'ECOM' WHEN 3 THEN 'mobile' WHEN 4 THEN 'FAX' ELSE 'BOPIS'
               END AS sales_channel,
           CASE l_returnflag WHEN 'R' THEN 'return' WHEN 'A' THEN ' Sale' ELSE 'SALE' END AS transaction_type,
           NULLIF(CAST(l_suppkey AS STRING), '9') AS store_id, CAST(l_partkey AS STRING) AS sku_id,
           CAST(l_orderkey % 1000 AS STRING) AS customer_id,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS transaction_amount,
           CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18, 2)) END AS discount_amount,
           CASE WHEN l_tax = 0 THEN 0 ELSE l_extendedprice / l_quantity END AS unit_price,
           CAST(l_quantity AS INT) - 1 AS quantity_sold, l_shipdate AS transaction_timestamp, {_LINE_STATE}
    FROM {{lineitem}}"""
DOMAIN["shop_inventory"] = f"""
    SELECT CAST(l_partkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS inventory_record_id,
           CASE l_linestatus WHEN 'F' THEN 'store ' ELSE 'DC' END AS inventory_location_type,
           CASE l_linenumber WHEN 1 THEN 'receipt' WHEN 2 THEN 'LOST' ELSE 'ISSUE' END AS stock_movement_type,
           CAST(l_quantity AS INT) - 2 AS stock_on_hand,
           CASE l_returnflag WHEN 'R' THEN NULL ELSE 3 END AS reserved_quantity,
           CASE l_returnflag WHEN 'A' THEN 1 END AS damaged_quantity,
           CASE l_returnflag WHEN 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) + 60 END AS expiry_date, {_LINE_STATE}
    FROM {{lineitem}}"""
DOMAIN["shop_vendor_compliance"] = f"""
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS compliance_record_id,
           CAST(l_suppkey AS STRING) AS vendor_id, 'Vendor ' || CAST(l_suppkey AS STRING) AS vendor_name,
           'logistics ' AS vendor_category, ' region' || CAST(l_suppkey % 5 AS STRING) AS vendor_region,
           CAST(l_orderkey AS STRING) AS audit_id,
           CASE l_linenumber WHEN 1 THEN 'esg' WHEN 2 THEN 'PARTY' ELSE 'QUALITY' END AS audit_type,
           CASE l_returnflag WHEN 'R' THEN 'non_compliant' WHEN 'A' THEN 'Compliant ' ELSE 'EXPIRED' END
               AS compliance_status,
           CAST(l_quantity * 2 + l_linenumber AS DOUBLE) AS compliance_score,
           CASE l_linestatus WHEN 'F' THEN TRUE END AS corrective_action_required,
           CASE l_linestatus WHEN 'O' THEN CAST(l_shipdate AS DATE) + 365 END AS certificate_expiry_date,
           l_shipdate AS audit_timestamp, {_LINE_STATE}
    FROM {{lineitem}}"""
DOMAIN["shop_operations"] = f"""
    SELECT CAST(user_id AS STRING) || '-' || props AS operation_event_id,
           CASE WHEN user_id = 4 THEN '' WHEN user_id = 5 THEN NULL ELSE CAST(user_id AS STRING) END AS store_id,
           'north' || CAST(user_id % 4 AS STRING) || ' ' AS store_region, ' E' || CAST(user_id AS STRING) AS employee_id,
           CASE event_type WHEN 'error' THEN 'incident' WHEN 'click' THEN 'PARTY' ELSE ' AUDIT' END AS operation_type,
           CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'success' END AS operation_status,
           CASE event_type WHEN 'error' THEN ' theft ' WHEN 'view' THEN '' WHEN 'signup' THEN '  ' END
               AS incident_category,
           CAST(value AS DECIMAL(8, 2)) AS store_compliance_score,
           CASE event_type WHEN 'view' THEN NULL WHEN 'signup' THEN 0 ELSE CAST(value AS DECIMAL(8, 2)) - 20 END
               AS cash_variance_amount,
           CAST(ts AS DATE) AS business_date, {_EVENT_STATE}
    FROM {{events}}"""


# SQL pieces shared by the results below: mask, latest version, gates.


def _latest(source: str, key: str, order: str) -> str:
    return f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}
        ORDER BY {order} DESC NULLS LAST, ingestion_batch_id DESC NULLS LAST) AS rn FROM {source}) WHERE rn = 1"""


def _bank_good(source: str, key: str, mandatory: str, order: str = "data_load_ts") -> str:
    live = f"(SELECT * FROM {source} WHERE record_status <> 'DELETED')"
    checks = " AND ".join(f"{c} IS NOT NULL" for c in mandatory.split())
    return f"(SELECT * FROM ({_latest(live, key, order)}) WHERE {checks})"


def _shop_good(source: str, key: str) -> str:
    return f"""(SELECT * FROM ({_latest(source, key, 'data_load_ts')}) WHERE record_status <> 'DELETED'
        AND (data_quality_flag IS NULL OR data_quality_flag <> 'FAIL'))"""


def _id4(c: str) -> str:
    return f"'XXXXXXXX' || SUBSTRING({c}, -4, 4)"


def _email(c: str) -> str:
    return f"SUBSTRING({c}, 1, 1) || '***@' || string_split({c}, '@')[2]"


BANK_CUSTOMERS = f"""
    SELECT customer_id, customer_type, TRIM(first_name || ' ' || COALESCE(middle_name, '') || ' ' || last_name)
           AS full_name, first_name, last_name, date_of_birth,
           FLOOR(DATE_DIFF('day', date_of_birth, DATE '{AS_OF}') / 365.25) AS age_years,
           {_email('email')} AS email_masked, {_email('secondary_email')} AS secondary_email_masked,
           '******' || SUBSTRING(mobile_number, -4, 4) AS mobile_number_masked,
           '******' || SUBSTRING(alternate_phone, -4, 4) AS alternate_phone_masked,
           {_id4('pan_number')} AS pan_number_masked, {_id4('aadhaar_number')} AS aadhaar_number_masked,
           kyc_status, kyc_status = 'VERIFIED' AS kyc_verified_flag, risk_category,
           risk_category = 'HIGH' AS high_risk_customer_flag, source_system, data_quality_flag,
           ingestion_batch_id AS source_batch_id, data_load_ts, TIMESTAMP '{AS_OF} 00:00:00' AS silver_load_ts
    FROM {_bank_good('bank_customers', 'customer_id', 'customer_id first_name last_name')}"""
BANK_ACCOUNTS = f"""
    SELECT account_id, customer_id, account_type, account_status, branch_code, currency_code, account_open_date,
           account_close_date,
           DATE_DIFF('day', account_open_date, COALESCE(account_close_date, DATE '{AS_OF}')) AS account_age_days,
           CAST(current_balance AS DECIMAL(18, 2)) AS current_balance,
           CAST(available_balance AS DECIMAL(18, 2)) AS available_balance,
           CAST(current_balance AS DECIMAL(18, 2)) - CAST(available_balance AS DECIMAL(18, 2)) AS held_funds_amount,
           ifsc_code, joint_holder_customer_id IS NOT NULL AS is_joint_account,
           {_id4('joint_holder_customer_id')} AS joint_holder_customer_id_masked, product_code, account_last_txn_date,
           account_status = 'DORMANT' OR DATE_DIFF('day', account_last_txn_date, DATE '{AS_OF}') > 365
               AS dormant_flag, source_system, data_quality_flag, ingestion_batch_id AS source_batch_id, data_load_ts
    FROM {_bank_good('bank_accounts', 'account_id', 'account_id customer_id')}"""
BANK_TRANSACTIONS = f"""
    SELECT transaction_id, account_id, customer_id, transaction_type, transaction_channel, transaction_amount,
           CASE WHEN debit_credit_indicator = 'DEBIT' THEN -transaction_amount ELSE transaction_amount END
               AS signed_amount, debit_credit_indicator, transaction_currency, transaction_timestamp,
           CAST(transaction_timestamp AS DATE) AS transaction_date, transaction_reference,
           {_id4('counterparty_account')} AS counterparty_account_masked, counterparty_ifsc, merchant_id,
           transaction_status, transaction_status = 'SUCCESS' AS is_successful,
           transaction_amount >= 200000 AS high_value_txn_flag, source_system, data_quality_flag,
           ingestion_batch_id AS source_batch_id, data_load_ts
    FROM {_bank_good('bank_transactions', 'transaction_id', 'transaction_id account_id transaction_amount',
                     'transaction_timestamp')}"""


def ratio4(numerator: str, denominator: str) -> str:
    """SQL for a quotient of two amounts with two digits, rounded to four; NULL unless the denominator is above 0."""
    n, d = f"CAST({numerator} * 100 AS HUGEINT)", f"CAST({denominator} * 100 AS HUGEINT)"
    return f"""CASE WHEN {denominator} > 0 THEN SIGN({n}) *
        CAST((2 * ABS({n}) * 10000 + {d}) // (2 * {d}) AS DOUBLE) / 10000 END"""


BANK_LOANS = f"""
    SELECT loan_id, customer_id, loan_type, loan_status, application_date, disbursement_date, sanctioned_amount,
           outstanding_amount, {ratio4('outstanding_amount', 'sanctioned_amount')} AS outstanding_to_sanctioned_ratio,
           interest_rate, emi_amount, emi_due_date, emi_due_date < DATE '{AS_OF}' AS is_overdue_flag,
           loan_status = 'DEFAULTED' AS is_defaulted_flag, credit_score,
           CASE WHEN credit_score >= 750 THEN 'EXCELLENT' WHEN credit_score >= 650 THEN 'GOOD'
                WHEN credit_score >= 550 THEN 'FAIR' ELSE 'POOR' END AS credit_score_band,
           tenure_months, loan_purpose, source_system, data_quality_flag, ingestion_batch_id AS source_batch_id,
           data_load_ts
    FROM {_bank_good('bank_loans', 'loan_id', 'loan_id customer_id')}"""
BANK_CARDS = f"""
    SELECT card_id, customer_id, account_id, card_type, card_network, card_number_masked, card_status,
           card_status = 'ACTIVE' AS is_active_flag, issue_date, expiry_date,
           expiry_date <= DATE '{AS_OF}' + INTERVAL 3 MONTH AS expiring_soon_flag, credit_limit,
           available_credit_limit, {ratio4('(credit_limit - available_credit_limit)', 'credit_limit')}
           AS credit_utilization_ratio, billing_cycle_day, card_tier, last_transaction_date, source_system,
           data_quality_flag, ingestion_batch_id AS source_batch_id, data_load_ts
    FROM {_bank_good('bank_cards', 'card_id', 'card_id customer_id')}"""
BANK_ALERTS = f"""
    SELECT alert_id, customer_id, account_id, transaction_id, alert_type, alert_severity,
           alert_severity IN ('HIGH', 'CRITICAL') AS is_high_severity_flag, alert_status,
           alert_status IN ('OPEN', 'UNDER_REVIEW', 'ESCALATED') AS is_open_flag, alert_generated_ts, rule_triggered,
           risk_score, COALESCE(sar_filed_flag, FALSE) AS sar_filed_flag, investigation_status,
           COALESCE(reported_to_regulator_flag, FALSE) AS reported_to_regulator_flag, resolution_date,
           DATE_DIFF('day', CAST(alert_generated_ts AS DATE), COALESCE(resolution_date, DATE '{EVENTS_AS_OF}'))
               AS alert_age_days, source_system, data_quality_flag, ingestion_batch_id AS source_batch_id, data_load_ts
    FROM {_bank_good('bank_compliance_alerts', 'alert_id', 'alert_id alert_type', 'alert_generated_ts')}"""


def bank(table: str, as_of: str = AS_OF):
    return lambda bronze: banking_silver.build(table, bronze, as_of, ["ingestion_batch_id"])[0]


def rejected(table: str, as_of: str = AS_OF):
    return lambda bronze: banking_silver.build(table, bronze, as_of, ["ingestion_batch_id"])[1]


def shop(table: str, as_of: str = AS_OF):
    return lambda bronze: retail_silver.build(table, bronze, as_of, ["ingestion_batch_id"])[0]


_AUDIT = "source_system:s data_quality_flag:s source_batch_id:s data_load_ts:t"
add(
    "silver_bank_customers", bank("customers"), "bank_customers",
    "customer_id:s customer_type:s full_name:s first_name:s last_name:s date_of_birth:D age_years:l email_masked:s "
    "secondary_email_masked:s mobile_number_masked:s alternate_phone_masked:s pan_number_masked:s "
    "aadhaar_number_masked:s kyc_status:s kyc_verified_flag:b risk_category:s high_risk_customer_flag:b "
    f"{_AUDIT} silver_load_ts:t",
    BANK_CUSTOMERS,
)
add(
    "silver_bank_accounts", bank("accounts"), "bank_accounts",
    "account_id:s customer_id:s account_type:s account_status:s branch_code:s currency_code:s account_open_date:D "
    "account_close_date:D account_age_days:l current_balance:d available_balance:d held_funds_amount:d ifsc_code:s "
    f"is_joint_account:b joint_holder_customer_id_masked:s product_code:s account_last_txn_date:D dormant_flag:b {_AUDIT}",
    BANK_ACCOUNTS,
)
add(
    "silver_bank_transactions", bank("transactions"), "bank_transactions",
    "transaction_id:s account_id:s customer_id:s transaction_type:s transaction_channel:s transaction_amount:d "
    "signed_amount:d debit_credit_indicator:s transaction_currency:s transaction_timestamp:t transaction_date:D "
    "transaction_reference:s counterparty_account_masked:s counterparty_ifsc:s merchant_id:s transaction_status:s "
    f"is_successful:b high_value_txn_flag:b {_AUDIT}",
    BANK_TRANSACTIONS,
)
add(
    "silver_bank_loans", bank("loans"), "bank_loans",
    "loan_id:s customer_id:s loan_type:s loan_status:s application_date:D disbursement_date:D sanctioned_amount:d "
    "outstanding_amount:d outstanding_to_sanctioned_ratio:d interest_rate:d emi_amount:d emi_due_date:D "
    f"is_overdue_flag:b is_defaulted_flag:b credit_score:l credit_score_band:s tenure_months:l loan_purpose:s {_AUDIT}",
    BANK_LOANS,
)
add(
    "silver_bank_cards", bank("cards"), "bank_cards",
    "card_id:s customer_id:s account_id:s card_type:s card_network:s card_number_masked:s card_status:s "
    "is_active_flag:b issue_date:D expiry_date:D expiring_soon_flag:b credit_limit:d available_credit_limit:d "
    f"credit_utilization_ratio:d billing_cycle_day:l card_tier:s last_transaction_date:D {_AUDIT}",
    BANK_CARDS,
)
add(
    "silver_bank_compliance_alerts", bank("compliance_alerts", EVENTS_AS_OF), "bank_compliance_alerts",
    "alert_id:s customer_id:s account_id:s transaction_id:s alert_type:s alert_severity:s is_high_severity_flag:b "
    "alert_status:s is_open_flag:b alert_generated_ts:t rule_triggered:s risk_score:d sar_filed_flag:b "
    f"investigation_status:s reported_to_regulator_flag:b resolution_date:D alert_age_days:l {_AUDIT}",
    BANK_ALERTS,
)
add(
    "quarantine_bank_transactions", rejected("transactions"), "bank_transactions",
    "transaction_id:s account_id:s ingestion_batch_id:s quarantine_reason:s quarantine_ts:t",
    f"""SELECT transaction_id, account_id, ingestion_batch_id, 'failed_not_null_dq_check' AS quarantine_reason,
        TIMESTAMP '{AS_OF} 00:00:00' AS quarantine_ts
        FROM ({_latest("(SELECT * FROM bank_transactions WHERE record_status <> 'DELETED')", 'transaction_id',
                       'transaction_timestamp')})
        WHERE transaction_id IS NULL OR account_id IS NULL OR transaction_amount IS NULL""",
)
add(
    "quarantine_bank_alerts", rejected("compliance_alerts", EVENTS_AS_OF), "bank_compliance_alerts",
    "alert_id:s ingestion_batch_id:s quarantine_reason:s quarantine_ts:t",
    f"""SELECT alert_id, ingestion_batch_id, 'failed_not_null_dq_check' AS quarantine_reason,
        TIMESTAMP '{EVENTS_AS_OF} 00:00:00' AS quarantine_ts
        FROM ({_latest("(SELECT * FROM bank_compliance_alerts WHERE record_status <> 'DELETED')", 'alert_id',
                       'alert_generated_ts')})
        WHERE alert_id IS NULL OR alert_type IS NULL""",
)

SHOP_PRODUCTS = f"""
    SELECT sku_id, TRIM(product_name) AS product_name, TRIM(brand_name) AS brand_name,
           UPPER(TRIM(currency_code)) AS currency_code, UPPER(TRIM(product_status)) AS product_status, category_name,
           unit_price, unit_price IS NOT NULL AND unit_price > 0 AS is_valid_price, data_quality_flag,
           'products_bronze' AS _source_bronze_table, ingestion_batch_id
    FROM {_shop_good('shop_products', 'sku_id')} WHERE sku_id IS NOT NULL AND product_name IS NOT NULL"""
SHOP_SALES = f"""
    SELECT * FROM (
        SELECT transaction_id, UPPER(TRIM(sales_channel)) AS sales_channel,
               UPPER(TRIM(transaction_type)) AS transaction_type, store_id, sku_id, customer_id, transaction_amount,
               COALESCE(discount_amount, 0) AS discount_amount,
               transaction_amount - COALESCE(discount_amount, 0) AS net_amount, unit_price, quantity_sold,
               CAST(transaction_timestamp AS DATE) AS transaction_date, ingestion_batch_id
        FROM {_shop_good('shop_sales', 'transaction_id')})
    WHERE sales_channel IN ('POS', 'ECOM', 'MARKETPLACE', 'MOBILE', 'BOPIS', 'CURBSIDE')
      AND transaction_type IN ('SALE', 'RETURN', 'EXCHANGE', 'REFUND') AND quantity_sold > 0 AND unit_price > 0
      AND transaction_id IS NOT NULL"""
SHOP_VENDORS = f"""
    SELECT * FROM (
        SELECT compliance_record_id, vendor_id, vendor_name, UPPER(TRIM(vendor_category)) AS vendor_category,
               UPPER(TRIM(vendor_region)) AS vendor_region, audit_id, UPPER(TRIM(audit_type)) AS audit_type,
               UPPER(TRIM(compliance_status)) AS compliance_status,
               CASE WHEN compliance_score BETWEEN 0 AND 100 THEN compliance_score END AS compliance_score,
               corrective_action_required, certificate_expiry_date,
               certificate_expiry_date IS NOT NULL AND certificate_expiry_date < DATE '{AS_OF}'
                   AS is_certificate_expired, audit_timestamp, ingestion_batch_id
        FROM {_shop_good('shop_vendor_compliance', 'compliance_record_id')})
    WHERE compliance_status IN ('COMPLIANT', 'NON_COMPLIANT', 'PENDING', 'EXPIRED', 'UNDER_REVIEW')
      AND audit_type IN ('QUALITY', 'SAFETY', 'ESG', 'REGULATORY', 'FOOD_SAFETY')
      AND vendor_category IN ('RAW_MATERIAL', 'PACKAGING', 'LOGISTICS', 'MANUFACTURER', 'SERVICE')"""
SHOP_OPERATIONS = f"""
    SELECT * FROM (
        SELECT operation_event_id, store_id, UPPER(TRIM(store_region)) AS store_region,
               UPPER(TRIM(operation_type)) AS operation_type, UPPER(TRIM(operation_status)) AS operation_status,
               sha256(TRIM(employee_id)) AS employee_id_hash,
               CASE WHEN incident_category = '' THEN NULL ELSE UPPER(TRIM(incident_category)) END AS incident_category,
               CASE WHEN store_compliance_score BETWEEN 0 AND 100 THEN store_compliance_score END
                   AS store_compliance_score,
               cash_variance_amount, cash_variance_amount IS NOT NULL AND cash_variance_amount <> 0
                   AS has_cash_variance, business_date, ingestion_batch_id
        FROM {_shop_good('shop_operations', 'operation_event_id')})
    WHERE store_id IS NOT NULL AND store_id <> ''
      AND operation_type IN ('STORE_OPEN', 'STORE_CLOSE', 'CASHIER_LOGIN', 'CASHIER_LOGOUT', 'SHIFT_START',
                             'SHIFT_END', 'AUDIT', 'INCIDENT', 'BREAK_START', 'MAINTENANCE')
      AND operation_status IN ('SUCCESS', 'FAILED', 'PENDING', 'CANCELLED')"""

add(
    "silver_shop_customers", shop("customers"), "shop_customers",
    "customer_id:s customer_status:s full_name_hash:s email_masked:s is_valid_email:b data_quality_flag:s "
    "_source_bronze_table:s _silver_load_ts:t ingestion_batch_id:s",
    f"""SELECT customer_id, CASE WHEN UPPER(TRIM(customer_status)) IN ('ACTIVE', 'INACTIVE', 'CHURNED', 'PROSPECT')
        THEN UPPER(TRIM(customer_status)) ELSE 'UNKNOWN' END AS customer_status,
        sha256(TRIM(full_name)) AS full_name_hash, {_email('LOWER(TRIM(email))')} AS email_masked,
        regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') AS is_valid_email, data_quality_flag,
        'customers_bronze' AS _source_bronze_table, TIMESTAMP '{AS_OF} 00:00:00' AS _silver_load_ts,
        ingestion_batch_id
        FROM {_shop_good('shop_customers', 'customer_id')} WHERE customer_id IS NOT NULL""",
)
add(
    "silver_shop_products", shop("products"), "shop_products",
    "sku_id:s product_name:s brand_name:s currency_code:s product_status:s category_name:s unit_price:d "
    "is_valid_price:b data_quality_flag:s _source_bronze_table:s ingestion_batch_id:s",
    SHOP_PRODUCTS,
)
add(
    "silver_shop_sales", shop("sales_transactions"), "shop_sales",
    "transaction_id:s sales_channel:s transaction_type:s store_id:s sku_id:s customer_id:s transaction_amount:d "
    "discount_amount:d net_amount:d unit_price:d quantity_sold:l transaction_date:D ingestion_batch_id:s",
    SHOP_SALES,
)
add(
    "silver_shop_inventory", shop("inventory"), "shop_inventory",
    "inventory_record_id:s inventory_location_type:s stock_movement_type:s stock_on_hand:l reserved_quantity:l "
    "damaged_quantity:l available_quantity:l expiry_date:D is_expiring_soon:b ingestion_batch_id:s",
    f"""SELECT * FROM (
            SELECT inventory_record_id, UPPER(TRIM(inventory_location_type)) AS inventory_location_type,
                   UPPER(TRIM(stock_movement_type)) AS stock_movement_type, stock_on_hand,
                   COALESCE(reserved_quantity, 0) AS reserved_quantity,
                   COALESCE(damaged_quantity, 0) AS damaged_quantity,
                   stock_on_hand - COALESCE(reserved_quantity, 0) - COALESCE(damaged_quantity, 0)
                       AS available_quantity, expiry_date,
                   expiry_date IS NOT NULL AND DATE_DIFF('day', DATE '{AS_OF}', expiry_date) <= 30
                       AS is_expiring_soon, ingestion_batch_id
            FROM {_shop_good('shop_inventory', 'inventory_record_id')})
        WHERE inventory_location_type IN ('STORE', 'DC', 'WAREHOUSE', 'TRANSIT')
          AND stock_movement_type IN ('RECEIPT', 'ISSUE', 'TRANSFER', 'ADJUSTMENT', 'RETURN') AND stock_on_hand >= 0""",
)
add(
    "silver_shop_vendor_compliance", shop("vendor_compliance"), "shop_vendor_compliance",
    "compliance_record_id:s vendor_id:s vendor_name:s vendor_category:s vendor_region:s audit_id:s audit_type:s "
    "compliance_status:s compliance_score:d corrective_action_required:b certificate_expiry_date:D "
    "is_certificate_expired:b audit_timestamp:t ingestion_batch_id:s",
    SHOP_VENDORS,
)
add(
    "silver_shop_store_operations", shop("store_operations"), "shop_operations",
    "operation_event_id:s store_id:s store_region:s operation_type:s operation_status:s employee_id_hash:s "
    "incident_category:s store_compliance_score:d cash_variance_amount:d has_cash_variance:b business_date:D "
    "ingestion_batch_id:s",
    SHOP_OPERATIONS,
)
