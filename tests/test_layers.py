from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.sources import writers
from tallymark.plans import banking_gold, banking_silver, medallion, retail_gold, retail_silver

AS_OF = "2024-06-30"
STATE = "record_status string, data_quality_flag string, source_system string, ingestion_batch_id string, data_load_ts timestamp, raw_payload string"


def state(status="ACTIVE", flag="PASS", day=1):
    return (status, flag, "core", f"b{day}", datetime(2024, 1, day), "raw")


def bank_customers(spark):
    schema = f"""customer_id string, customer_type string, first_name string, middle_name string, last_name string,
        email string, secondary_email string, mobile_number string, alternate_phone string, pan_number string,
        aadhaar_number string, kyc_status string, risk_category string, date_of_birth string, {STATE}"""

    def person(key, last="Lee", **kw):
        return (
            key, "RETAIL", "Ann", kw.get("middle"), last, kw.get("email", "ann@example.com"), None, "5550001234", "12",
            "PAN0001", None, kw.get("kyc", "VERIFIED"), kw.get("risk"), kw.get("born", "1990-07-01"),
        )

    return spark.createDataFrame(
        [
            person("c1", "Old") + state(day=1),
            person("c1", "Live", middle="B") + state(day=2),
            person("c1", "Gone") + state("DELETED", day=3),
            person("c2", email="no-at", kyc=None, risk="HIGH", born="not a date") + state(),
            person("c3", last=None) + state(),
            person("c4") + state(None),
        ],
        schema,
    )


def test_bank_customers(spark):
    silver, bad = banking_silver.build("customers", bank_customers(spark), AS_OF)
    assert silver.columns == banking_silver.COLUMNS["customers"]
    c1, c2 = silver.orderBy("customer_id").collect()
    # The newest version is deleted, so the previous one is the current one.
    assert (c1["full_name"], c1["age_years"], c1["email_masked"]) == ("Ann B Live", 33, "a***@example.com")
    assert (c1["mobile_number_masked"], c1["alternate_phone_masked"], c1["pan_number_masked"]) == (
        "******1234", "******12", "XXXXXXXX0001",
    )
    assert (c1["kyc_verified_flag"], c1["high_risk_customer_flag"]) == (True, None)
    assert (c2["full_name"], c2["age_years"], c2["email_masked"]) == ("Ann  Lee", None, None)
    assert (c2["kyc_verified_flag"], c2["high_risk_customer_flag"]) == (None, True)
    assert [r["customer_id"] for r in bad.collect()] == ["c3"]


def bank_accounts(spark):
    schema = f"""account_id string, customer_id string, account_type string, account_status string, branch_code string,
        currency_code string, ifsc_code string, product_code string, joint_holder_customer_id string,
        current_balance string, available_balance double, account_open_date string, account_close_date string,
        account_last_txn_date string, {STATE}"""

    def account(key, status, last, closed=None, balance="100.005"):
        return (key, "c1", "SAVINGS", status, "b", "USD", "i", "p", None, balance, 40.0, "2024-01-01", closed, last) + state()

    return spark.createDataFrame(
        [
            account("a1", "ACTIVE", "2023-07-01"), account("a2", "ACTIVE", "2023-06-30"),
            account("a3", None, "2024-06-01"), account("a4", "DORMANT", None, "2024-01-31", "broken"),
        ],
        schema,
    )


def test_bank_accounts(spark, rows):
    silver, _ = banking_silver.build("accounts", bank_accounts(spark), AS_OF)
    got = rows(silver, "account_id", "account_age_days", "held_funds_amount", "dormant_flag", "is_joint_account")
    held = Decimal("60.01")
    assert got == [("a1", 181, held, False, False), ("a2", 181, held, True, False), ("a3", 181, held, None, False), ("a4", 30, None, True, False)]


def bank_loans(spark):
    schema = f"""loan_id string, customer_id string, loan_type string, loan_status string, loan_purpose string,
        sanctioned_amount double, outstanding_amount double, interest_rate double, emi_amount double, credit_score int,
        tenure_months int, application_date date, disbursement_date date, emi_due_date date, {STATE}"""

    def loan(key, sanctioned, score, due, status="DISBURSED"):
        day = date(2024, 1, 1)
        return (key, "c1", "HOME", status, "x", sanctioned, 500.0, 5.5, 10.0, score, 12, day, day, due) + state()

    return spark.createDataFrame(
        [
            loan("l1", 1000.0, 750, date(2024, 6, 29)), loan("l2", 0.0, 749, date(2024, 6, 30)),
            loan("l3", 3000.0, None, None, "DEFAULTED"), loan("l4", None, 550, None),
        ],
        schema,
    )


def test_bank_loans(spark, rows):
    silver, _ = banking_silver.build("loans", bank_loans(spark), AS_OF)
    got = rows(silver, "loan_id", "outstanding_to_sanctioned_ratio", "credit_score_band", "is_overdue_flag", "is_defaulted_flag")
    assert got == [
        ("l1", Decimal("0.5000"), "EXCELLENT", True, False), ("l2", None, "GOOD", False, False),
        ("l3", Decimal("0.1667"), "POOR", None, True), ("l4", None, "FAIR", None, False),
    ]


def bank_cards(spark):
    schema = f"""card_id string, customer_id string, account_id string, card_type string, card_network string,
        card_number_masked string, card_status string, card_tier string, credit_limit double,
        available_credit_limit double, issue_date date, expiry_date date, last_transaction_date date,
        billing_cycle_day int, {STATE}"""

    def card(key, limit, expiry):
        return (key, "c1", "a1", "CREDIT", "n", "X", "ACTIVE", "GOLD", limit, 250.0, None, expiry, None, 5) + state()

    return spark.createDataFrame([card("k1", 1000.0, date(2024, 9, 30)), card("k2", 0.0, date(2024, 10, 1))], schema)


def test_bank_cards(spark, rows):
    silver, _ = banking_silver.build("cards", bank_cards(spark), AS_OF)
    got = rows(silver, "card_id", "credit_utilization_ratio", "expiring_soon_flag")
    assert got == [("k1", Decimal("0.7500"), True), ("k2", None, False)]


def bank_transactions(spark):
    schema = f"""transaction_id string, account_id string, customer_id string, transaction_type string,
        transaction_channel string, debit_credit_indicator string, transaction_currency string,
        transaction_reference string, counterparty_account string, counterparty_ifsc string, merchant_id string,
        transaction_status string, transaction_amount double, transaction_timestamp timestamp, {STATE}"""

    def txn(key, amount, side, day=1):
        return (key, "a1", "c1", "T", "CH", side, "USD", "r", "99887766", "i", "m", "SUCCESS", amount, datetime(2024, 2, day, 23, 30)) + state()

    return spark.createDataFrame(
        [txn("t1", 1.0, "DEBIT"), txn("t1", 200000.0, "DEBIT", 5), txn("t2", 199999.99, None), txn("t3", None, "DEBIT")], schema
    )


def test_bank_transactions(spark, rows):
    silver, bad = banking_silver.build("transactions", bank_transactions(spark), AS_OF)
    got = rows(silver, "transaction_id", "transaction_date", "signed_amount", "high_value_txn_flag", "counterparty_account_masked")
    assert got == [
        ("t1", date(2024, 2, 5), Decimal("-200000.00"), True, "XXXXXXXX7766"),
        ("t2", date(2024, 2, 1), Decimal("199999.99"), False, "XXXXXXXX7766"),
    ]
    assert [r["transaction_id"] for r in bad.collect()] == ["t3"]


def bank_alerts(spark):
    schema = f"""alert_id string, customer_id string, account_id string, transaction_id string, alert_type string,
        alert_severity string, alert_status string, rule_triggered string, investigation_status string, risk_score double,
        alert_generated_ts timestamp, resolution_date date, sar_filed_flag boolean, reported_to_regulator_flag boolean, {STATE}"""
    made = datetime(2024, 6, 1, 12)
    return spark.createDataFrame(
        [
            ("w1", "c1", "a1", "t1", "AML", "CRITICAL", "ESCALATED", "r", "n", 12.345, made, None, None, True) + state(),
            ("w2", None, "a1", "t1", "AML", None, "CLOSED", "r", "n", None, made, date(2024, 6, 11), True, None) + state(),
        ],
        schema,
    )


def test_bank_alerts(spark, rows):
    silver, _ = banking_silver.build("compliance_alerts", bank_alerts(spark), AS_OF)
    got = rows(silver, "alert_id", "risk_score", "alert_age_days", "is_open_flag", "is_high_severity_flag", "sar_filed_flag", "reported_to_regulator_flag")
    assert got == [
        ("w1", Decimal("12.35"), 29, True, True, False, True), ("w2", None, 10, False, None, True, False),
    ]


def bronze_tables(spark):
    return {
        "customers": bank_customers(spark), "accounts": bank_accounts(spark), "transactions": bank_transactions(spark),
        "loans": bank_loans(spark), "cards": bank_cards(spark), "compliance_alerts": bank_alerts(spark),
    }


def test_bank_layers_end_to_end(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bank_bronze")
    for name, df in bronze_tables(spark).items():
        df.write.mode("overwrite").saveAsTable(f"bank_bronze.{name}")
    written = medallion.run_banking_silver(spark, "bank_bronze", "bank_silver", "bank_bad", AS_OF)
    assert [spark.table(t).count() for t in written] == [2, 4, 2, 4, 2, 2]
    assert spark.table("bank_bad.customers").count() == 1 and not spark.catalog.tableExists("bank_bad.loans")
    silver = {t.split(".")[1]: spark.table(t) for t in written}
    marts = {
        "customer_360": banking_gold.customer_360(
            silver["customers"], silver["accounts"], silver["cards"], silver["loans"], silver["compliance_alerts"], AS_OF
        ),
        "daily_transaction_summary": banking_gold.daily_transaction_summary(silver["transactions"], AS_OF),
        "loan_portfolio_risk_summary": banking_gold.loan_portfolio_risk_summary(silver["loans"], AS_OF),
    }
    gold = medallion.write_marts(marts, "bank_gold", banking_gold.PARTITIONS)
    rich = spark.table(gold[0]).filter("customer_id = 'c1'").first()
    assert (rich["total_accounts"], rich["dormant_accounts"], rich["total_loans"], rich["defaulted_loans"]) == (4, 2, 4, 1)
    assert (rich["total_current_balance"], rich["total_outstanding_amount"]) == (Decimal("300.03"), Decimal("2000.00"))
    assert (rich["latest_credit_score"], rich["total_compliance_alerts"], rich["customer_value_tier"]) == (750, 1, "STANDARD")
    empty = spark.table(gold[0]).filter("customer_id = 'c2'").first()
    assert (empty["total_cards"], empty["avg_credit_utilization_ratio"], empty["max_risk_score"]) == (0, None, None)


@pytest.mark.parametrize(
    "amount, tier", [(5000000, "PLATINUM"), (4999999, "GOLD"), (1000000, "GOLD"), (100000, "SILVER"), (99999, "STANDARD")]
)
def test_value_tiers(spark, amount, tier):
    from tallymark.functions.conditional import band

    df = spark.createDataFrame([(amount,)], "x int")
    assert df.select(band("x", banking_gold.VALUE_TIERS, banking_gold.VALUE_TIER_DEFAULT)).first()[0] == tier


RETAIL = "record_status string, data_quality_flag string, data_load_ts timestamp, raw_payload string"


def shop(status="ACTIVE", flag=None, day=1):
    return (status, flag, datetime(2024, 1, day), "raw")


def shop_customers(spark):
    return spark.createDataFrame(
        [
            ("c1", " Ann ", "ann@example.com", "active") + shop(day=1),
            ("c1", " Ann ", "ann@example.com", "active") + shop("DELETED", day=2),
            ("c2", "Bo", " BO@Example.com", " vip") + shop(flag="WARN"),
            ("c3", "Cy", None, None) + shop(flag="FAIL"),
            (None, "Di", None, None) + shop(),
        ],
        f"customer_id string, full_name string, email string, customer_status string, {RETAIL}",
    )


def test_shop_customers(spark):
    silver, bad = retail_silver.build("customers", shop_customers(spark), AS_OF)
    # The newest version of c1 is deleted, so the key is gone; c3 failed; one key is NULL.
    (row,) = silver.collect()
    assert (row["customer_id"], row["customer_status"], row["email_masked"], row["is_valid_email"]) == ("c2", "UNKNOWN", "b***@example.com", False)
    assert "email" not in silver.columns and "raw_payload" not in silver.columns and bad.isEmpty()
    assert row["_source_bronze_table"] == "customers_bronze"


def shop_sales(spark):
    schema = f"""transaction_id string, sales_channel string, transaction_type string, store_id string, sku_id string,
        customer_id string, transaction_amount double, discount_amount double, unit_price double, quantity_sold int,
        transaction_timestamp timestamp, {RETAIL}"""

    def sale(key, kind="SALE", channel=" pos", qty=1, price=1.0, amount=10.0, discount=None, day=1, store="s1"):
        return (key, channel, kind, store, "k1", "c1", amount, discount, price, qty, datetime(2024, 6, day)) + shop()

    return spark.createDataFrame(
        [
            sale("t1"), sale("t2", "return", amount=4.0, discount=0.5), sale("t3", channel="fax"), sale("t4", qty=0),
            sale("t5", price=0.0), sale("t6", "gift"), sale("t7", day=9, amount=7.0), sale("t8", store=None),
        ],
        schema,
    )


def shop_operations(spark):
    schema = f"""operation_event_id string, store_id string, store_region string, employee_id string,
        operation_type string, operation_status string, incident_category string, store_compliance_score double,
        cash_variance_amount double, business_date date, {RETAIL}"""

    def op(key, store, kind="audit", score=90.0, cash=0.0, incident=None):
        return (key, store, " north", " e1", kind, "success ", incident, score, cash, date(2024, 6, 1)) + shop()

    return spark.createDataFrame(
        [
            op("o1", "s1", score=101.0, cash=-2.5, incident=""), op("o2", "s1", score=70.0, incident="  "),
            op("o3", "s2", "incident", incident="theft"), op("o4", ""), op("o5", None), op("o6", "s1", "party"),
        ],
        schema,
    )


def test_shop_sales_and_operations(spark, rows):
    sales, _ = retail_silver.build("sales_transactions", shop_sales(spark), AS_OF)
    assert rows(sales, "transaction_id", "transaction_type", "net_amount") == [
        ("t1", "SALE", 10.0), ("t2", "RETURN", 3.5), ("t7", "SALE", 7.0), ("t8", "SALE", 10.0),
    ]
    operations, _ = retail_silver.build("store_operations", shop_operations(spark), AS_OF)
    assert rows(operations, "operation_event_id", "incident_category", "store_compliance_score", "has_cash_variance") == [
        ("o1", None, None, True), ("o2", "", 70.0, False), ("o3", "THEFT", 90.0, False),
    ]
    daily = retail_gold.store_operations_daily(operations, sales)
    assert rows(daily, "business_date", "store_id", "store_region", "incident_count", "net_revenue", "store_health_flag") == [
        (date(2024, 6, 1), None, "UNKNOWN", 0, 10.0, "HEALTHY"),
        (date(2024, 6, 1), "s1", "NORTH", 0, 6.5, "NEEDS_ATTENTION"),
        (date(2024, 6, 1), "s2", "NORTH", 1, 0.0, "NEEDS_ATTENTION"),
        (date(2024, 6, 9), "s1", "UNKNOWN", 0, 7.0, "HEALTHY"),
    ]


def test_sales_performance_rolls_over_rows_or_days(spark, rows):
    sales, _ = retail_silver.build("sales_transactions", shop_sales(spark), AS_OF)
    products = spark.createDataFrame([("k1", "food", "brand")], "sku_id string, category_name string, brand_name string")
    for calendar, last in ((False, 20.5), (True, 7.0)):
        mart = retail_gold.sales_performance_daily(sales, products, AS_OF, calendar_days=calendar)
        got = rows(mart.filter("store_id = 's1'"), "transaction_date", "transaction_count", "net_revenue", "units_returned", "avg_order_value", "rolling_7day_store_revenue")
        assert got == [(date(2024, 6, 1), 2, 6.5, 1, 10.0, 13.5), (date(2024, 6, 9), 1, 7.0, 0, 7.0, last)]
        unknown = mart.filter("store_id IS NULL").first()
        assert (unknown["net_revenue"], unknown["rolling_7day_store_revenue"]) == (10.0, 10.0)
    assert retail_gold.sales_performance_daily(sales, products, "2026-01-01").isEmpty()


def shop_vendors(spark):
    schema = f"""compliance_record_id string, vendor_id string, vendor_name string, vendor_category string,
        vendor_region string, audit_id string, audit_type string, compliance_status string, compliance_score double,
        corrective_action_required boolean, certificate_expiry_date date, audit_timestamp timestamp, {RETAIL}"""

    def audit(key, vendor, score, status="compliant", expiry=None):
        return (key, vendor, "V", "logistics", "r1", key, "esg", status, score, None, expiry, datetime(2024, 1, 1)) + shop()

    return spark.createDataFrame(
        [
            audit("1", "v1", 90.0), audit("2", "v1", 100.0, "expired", date(2024, 6, 29)), audit("3", "v1", 101.0),
            audit("4", "v2", 75.0, expiry=date(2024, 6, 30)), audit("5", "v3", None), audit("6", "v3", 1.0, "odd"),
        ],
        schema,
    )


def test_vendor_scorecard(spark, rows):
    audits, _ = retail_silver.build("vendor_compliance", shop_vendors(spark), AS_OF)
    card = retail_gold.vendor_compliance_scorecard(audits)
    assert rows(card, "vendor_id", "total_audits", "avg_compliance_score", "compliant_pct", "expired_certificate_count", "vendor_risk_tier") == [
        ("v1", 3, 95.0, 66.67, 1, "LOW_RISK"), ("v2", 1, 75.0, 100.0, 0, "MEDIUM_RISK"), ("v3", 1, None, 100.0, 0, "HIGH_RISK"),
    ]


def test_comments_are_not_read_as_sql(spark):
    text = "it's a \\ \"quoted\" -- text"
    writers.write_table(spark.range(1), "commented", comment=text)
    rows = spark.sql("DESCRIBE TABLE EXTENDED commented").collect()
    assert {r["col_name"]: r["data_type"] for r in rows}["Comment"] == text


def test_shop_marts_are_written_with_comments(spark):
    audits, _ = retail_silver.build("vendor_compliance", shop_vendors(spark), AS_OF)
    name = "vendor_compliance_scorecard"
    marts = {name: retail_gold.vendor_compliance_scorecard(audits)}
    for _ in range(2):
        (table,) = medallion.write_marts(marts, "shop_gold", retail_gold.PARTITIONS, retail_gold.COMMENTS)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert described["Comment"] == retail_gold.COMMENTS[name] and spark.table(table).count() == 3


def test_shop_inventory_and_products(spark, rows):
    inventory = spark.createDataFrame(
        [
            ("i1", "store", " issue", 10, None, 2, date(2024, 7, 30)) + shop(), ("i2", "DC", "RETURN", 0, 1, None, date(2024, 7, 31)) + shop(),
            ("i3", "dc", "receipt", -1, 0, 0, None) + shop(), ("i4", "moon", "receipt", 1, 0, 0, None) + shop(),
            ("i5", "dc", "receipt", 5, 0, 0, date(2020, 1, 1)) + shop(),
        ],
        f"""inventory_record_id string, inventory_location_type string, stock_movement_type string, stock_on_hand int,
        reserved_quantity int, damaged_quantity int, expiry_date date, {RETAIL}""",
    )
    silver, _ = retail_silver.build("inventory", inventory, AS_OF)
    assert rows(silver, "inventory_record_id", "available_quantity", "is_expiring_soon") == [("i1", 8, True), ("i2", -1, False), ("i5", 5, True)]
    products = spark.createDataFrame(
        [("k1", " Tea ", "b ", " eur", "live", 0.0) + shop(), ("k2", None, "b", "eur", "live", 1.0) + shop(), ("k3", "Jam", None, None, None, None) + shop()],
        f"sku_id string, product_name string, brand_name string, currency_code string, product_status string, unit_price double, {RETAIL}",
    )
    silver, _ = retail_silver.build("products", products, AS_OF)
    assert rows(silver, "sku_id", "product_name", "currency_code", "is_valid_price") == [("k1", "Tea", "EUR", False), ("k3", "Jam", None, False)]


def test_shop_layer_stops_at_an_empty_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_bronze")
    shop_customers(spark).write.mode("overwrite").saveAsTable("shop_bronze.customers_bronze")
    empty = spark.createDataFrame([], f"sku_id string, product_name string, brand_name string, currency_code string, product_status string, unit_price double, {RETAIL}")
    empty.write.mode("overwrite").saveAsTable("shop_bronze.products_bronze")
    with pytest.raises(ValueError, match="products_silver"):
        medallion.run_retail_silver(spark, "shop_bronze", "shop_silver", AS_OF)
    assert spark.table("shop_silver.customers_silver").filter(F.col("customer_id") == "c2").count() == 1
