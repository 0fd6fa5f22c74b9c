"""Retail bronze to silver.

The newest version of each key is taken first and then has to pass the gate, so a key whose newest version is
deleted or failed disappears. All remaining bronze columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.privacy import hash_pii, mask_email_normalised
from tallymark.operators import quality as dq
from tallymark.operators.windows import dedupe_latest

# Valid codes and limits.
CUSTOMER_STATUSES = ["ACTIVE", "INACTIVE", "CHURNED", "PROSPECT"]
SALES_CHANNELS = ["POS", "ECOM", "MARKETPLACE", "MOBILE", "BOPIS", "CURBSIDE"]
TRANSACTION_TYPES = ["SALE", "RETURN", "EXCHANGE", "REFUND"]
LOCATION_TYPES = ["STORE", "DC", "WAREHOUSE", "TRANSIT"]
MOVEMENT_TYPES = ["RECEIPT", "ISSUE", "TRANSFER", "ADJUSTMENT", "RETURN"]
COMPLIANCE_STATUSES = ["COMPLIANT", "NON_COMPLIANT", "PENDING", "EXPIRED", "UNDER_REVIEW"]
AUDIT_TYPES = ["QUALITY", "SAFETY", "ESG", "REGULATORY", "FOOD_SAFETY"]
VENDOR_CATEGORIES = ["RAW_MATERIAL", "PACKAGING", "LOGISTICS", "MANUFACTURER", "SERVICE"]
OPERATION_TYPES = [
    "STORE_OPEN", "STORE_CLOSE", "CASHIER_LOGIN", "CASHIER_LOGOUT", "SHIFT_START", "SHIFT_END", "AUDIT",
    "INCIDENT", "BREAK_START", "MAINTENANCE",
]
OPERATION_STATUSES = ["SUCCESS", "FAILED", "PENDING", "CANCELLED"]
EXPIRING_DAYS = 30
PARTITIONS = {"sales_transactions": ["transaction_date"]}


def conform_customers(df: DataFrame, as_of=None) -> DataFrame:
    status = dq.conform_enum("customer_status", CUSTOMER_STATUSES, dq.UNKNOWN)
    return (
        df.filter(F.col("customer_id").isNotNull())
        .withColumns(
            {
                "full_name_hash": hash_pii("full_name"),
                "email_masked": mask_email_normalised("email"),
                "is_valid_email": dq.valid_email("email"),
                "customer_status": status,
            }
        )
        .drop("full_name", "email")
    )


def conform_products(df: DataFrame, as_of=None) -> DataFrame:
    return df.filter(F.col("sku_id").isNotNull() & F.col("product_name").isNotNull()).withColumns(
        {
            "product_name": F.trim("product_name"),
            "brand_name": F.trim("brand_name"),
            "currency_code": dq.cleaned("currency_code"),
            "product_status": dq.cleaned("product_status"),
            "is_valid_price": dq.positive("unit_price"),
        }
    )


def conform_sales_transactions(df: DataFrame, as_of=None) -> DataFrame:
    discount = F.coalesce("discount_amount", F.lit(0))
    shaped = df.withColumns(
        {
            "sales_channel": dq.cleaned("sales_channel"),
            "transaction_type": dq.cleaned("transaction_type"),
            "discount_amount": discount,
            "net_amount": F.round(F.col("transaction_amount") - discount, 2),
            "transaction_date": F.to_date("transaction_timestamp"),
        }
    )
    return shaped.filter(
        F.col("sales_channel").isin(SALES_CHANNELS)
        & F.col("transaction_type").isin(TRANSACTION_TYPES)
        & (F.col("quantity_sold") > 0)
        & (F.col("unit_price") > 0)
        & F.col("transaction_id").isNotNull()
    )


def conform_inventory(df: DataFrame, as_of=None) -> DataFrame:
    reserved, damaged = (F.coalesce(c, F.lit(0)) for c in ("reserved_quantity", "damaged_quantity"))
    shaped = df.withColumns(
        {
            "inventory_location_type": dq.cleaned("inventory_location_type"),
            "stock_movement_type": dq.cleaned("stock_movement_type"),
            "reserved_quantity": reserved,
            "damaged_quantity": damaged,
            "available_quantity": F.col("stock_on_hand") - reserved - damaged,
            "is_expiring_soon": dq.set_and_within_days("expiry_date", dq.as_of_date(as_of), EXPIRING_DAYS),
        }
    )
    return shaped.filter(
        F.col("inventory_location_type").isin(LOCATION_TYPES)
        & F.col("stock_movement_type").isin(MOVEMENT_TYPES)
        & (F.col("stock_on_hand") >= 0)
    )


def conform_vendor_compliance(df: DataFrame, as_of=None) -> DataFrame:
    shaped = df.withColumns(
        {
            **{c: dq.cleaned(c) for c in ("compliance_status", "audit_type", "vendor_category", "vendor_region")},
            "compliance_score": dq.null_out_of_range("compliance_score"),
            "is_certificate_expired": dq.set_and_before("certificate_expiry_date", dq.as_of_date(as_of)),
        }
    )
    return shaped.filter(
        F.col("compliance_status").isin(COMPLIANCE_STATUSES)
        & F.col("audit_type").isin(AUDIT_TYPES)
        & F.col("vendor_category").isin(VENDOR_CATEGORIES)
        & F.col("compliance_record_id").isNotNull()
    )


def conform_store_operations(df: DataFrame, as_of=None) -> DataFrame:
    shaped = df.withColumns(
        {
            **{c: dq.cleaned(c) for c in ("operation_type", "operation_status", "store_region")},
            "employee_id_hash": hash_pii("employee_id"),
            "incident_category": dq.blank_to_null("incident_category"),
            "store_compliance_score": dq.null_out_of_range("store_compliance_score"),
            "has_cash_variance": dq.set_and_not_zero("cash_variance_amount"),
        }
    ).drop("employee_id")
    return shaped.filter(
        F.col("store_id").isNotNull()
        & (F.col("store_id") != "")
        & F.col("operation_type").isin(OPERATION_TYPES)
        & F.col("operation_status").isin(OPERATION_STATUSES)
    )


# Table, key and conforming step.
TABLES = {
    "customers": ("customer_id", conform_customers),
    "products": ("sku_id", conform_products),
    "sales_transactions": ("transaction_id", conform_sales_transactions),
    "inventory": ("inventory_record_id", conform_inventory),
    "vendor_compliance": ("compliance_record_id", conform_vendor_compliance),
    "store_operations": ("operation_event_id", conform_store_operations),
}


def build(
    table: str, bronze: DataFrame, as_of=None, tie_breakers: Sequence[str] = (), order_col: str = "data_load_ts"
) -> tuple[DataFrame, DataFrame]:
    """Silver rows of one table; the second result, the quarantine, is always empty here."""
    key, conform = TABLES[table]
    narrow = dq.blank_failing(bronze, [key, order_col, *tie_breakers])
    newest = dedupe_latest(narrow, [key], order_col, tie_breakers)
    gated = dq.base_clean(newest, f"{table}_bronze", as_of)
    return conform(gated, as_of), bronze.limit(0)
