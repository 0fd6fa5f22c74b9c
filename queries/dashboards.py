"""Dashboards and indicator jobs on orders, lineitem, part, supplier and customer."""

from __future__ import annotations

from queries.common import DOMAIN, add, mean, quotient
from tallymark.plans import dashboards as d

DOMAIN["consumer_billing"] = """
    SELECT o_orderkey AS billing_id, o_custkey AS consumer_id,
           SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS billing_month,
           o_orderpriority AS consumer_type,
           CAST(FLOOR(o_totalprice / 250) AS BIGINT) AS units_consumed,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS total_amount,
           CASE o_orderstatus WHEN 'O' THEN 'Pending' WHEN 'F' THEN 'Paid' ELSE 'Partial' END AS payment_status
    FROM {orders}"""
DOMAIN["power_generation"] = """
    SELECT l_suppkey AS plant_id, CAST(l_quantity AS DECIMAL(18, 2)) AS energy_generated_mwh,
           CAST(l_discount AS DECIMAL(6, 2)) * 100 AS efficiency_percentage
    FROM {lineitem}"""
DOMAIN["power_plant_master"] = """
    SELECT s_suppkey AS plant_id, 'Plant ' || CAST(s_nationkey AS STRING) AS plant_name FROM {supplier}"""
DOMAIN["fuel_inventory"] = """
    SELECT p_type AS fuel_type, p_size AS quantity_available, CAST(p_retailprice AS DECIMAL(18, 2)) AS unit_cost
    FROM {part}"""
DOMAIN["revenue_fact"] = """
    SELECT l_suppkey AS plant_id, CAST(l_extendedprice AS DECIMAL(18, 2)) AS revenue_amount,
           CAST(l_shipdate AS DATE) AS revenue_date
    FROM {lineitem}"""
DOMAIN["sales_fact"] = """
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
           || '-' || CAST(l_suppkey AS STRING) AS sales_id,
           l_orderkey AS customer_order_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS sales_date,
           CAST(l_quantity AS BIGINT) AS quantity_sold, CAST(l_extendedprice AS DECIMAL(18, 2)) AS sales_amount,
           CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(4, 2)) AS profit_amount,
           l_returnflag || '-' || l_linestatus AS region
    FROM {lineitem}"""
DOMAIN["customer_orders"] = "SELECT o_orderkey AS customer_order_id, o_custkey AS customer_id FROM {orders}"
DOMAIN["purchase_orders"] = """
    SELECT l_orderkey AS purchase_order_id, l_suppkey AS supplier_id,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS total_amount
    FROM {lineitem}"""
DOMAIN["supplier_master"] = """
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, CAST(s_acctbal / 2000 AS DOUBLE) AS supplier_rating
    FROM {supplier}"""
# The ten tables of the supply chain view: every join after the first table finds at most one row.
DOMAIN["chain_batches"] = """
    SELECT l_orderkey AS batch_id, CAST(l_shipdate AS DATE) AS production_date, l_suppkey AS plant_id,
           l_partkey AS product_id
    FROM {lineitem}"""
DOMAIN["chain_plants"] = """
    SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey END AS plant_id, s_name AS plant_name,
           'City ' || CAST(s_nationkey AS STRING) AS city,
           CASE WHEN s_acctbal > 5000 THEN 'State' END AS state
    FROM {supplier}"""
DOMAIN["chain_quality"] = """
    SELECT o_orderkey AS batch_id, CAST(o_totalprice / 5000 AS DOUBLE) AS quality_score,
           CASE o_orderstatus WHEN 'F' THEN 3 ELSE 0 END AS defect_count
    FROM {orders}"""
DOMAIN["chain_entries"] = """
    SELECT o_orderkey AS batch_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS material_id,
           o_orderpriority AS warehouse_id, o_orderstatus AS storage_location
    FROM {orders}"""
DOMAIN["chain_materials"] = """
    SELECT c_custkey AS material_id, c_mktsegment AS material_name, c_nationkey AS quantity_available
    FROM {customer}"""
DOMAIN["chain_purchases"] = """
    SELECT c_custkey + 1 AS purchase_order_id, c_custkey AS material_id,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS supplier_id,
           CAST(c_acctbal AS DECIMAL(18, 2)) AS total_amount
    FROM {customer}"""
DOMAIN["chain_orders"] = """
    SELECT p_partkey + 7 AS customer_order_id, p_size AS customer_id, p_partkey AS product_id,
           CAST(p_retailprice AS DECIMAL(18, 2)) AS order_amount
    FROM {part}"""
DOMAIN["chain_shipments"] = """
    SELECT p_partkey + 100 AS shipment_id, CASE p_type WHEN 'PROMO' THEN NULL ELSE p_partkey + 7 END
           AS customer_order_id, p_type AS shipment_status, CAST(p_size * 1.5 AS DOUBLE) AS shipping_cost
    FROM {part}"""
DOMAIN["chain_sales"] = """
    SELECT p_partkey + 1000 AS sales_id, CASE p_type WHEN 'LARGE' THEN NULL ELSE p_partkey + 7 END
           AS customer_order_id, CAST(p_retailprice * 2 AS DECIMAL(18, 2)) AS sales_amount,
           CAST(p_retailprice AS DECIMAL(18, 2)) AS profit_amount
    FROM {part}"""

AS_OF = "2001-11-04"

add(
    "billing_overview", d.billing_overview, "consumer_billing",
    "billing_id:l consumer_id:l billing_month:s units_consumed:l total_amount:d payment_status:s",
    """SELECT billing_id, consumer_id, billing_month, units_consumed, total_amount, payment_status
       FROM consumer_billing""",
)
add(
    "billing_by_month", d.billing_by_month, "consumer_billing",
    "billing_month:s total_bills:l total_units:l total_revenue:d",
    """SELECT billing_month, COUNT(*) AS total_bills, SUM(units_consumed) AS total_units,
       SUM(total_amount) AS total_revenue FROM consumer_billing GROUP BY billing_month""",
)
add(
    "billing_by_consumer_type", d.billing_by_consumer_type, "consumer_billing",
    "consumer_type:s consumer_count:l revenue:d average_units:d",
    """SELECT consumer_type, COUNT(*) AS consumer_count, SUM(total_amount) AS revenue,
       AVG(units_consumed) AS average_units FROM consumer_billing GROUP BY consumer_type""",
)
add(
    "billing_by_status", d.billing_by_status, "consumer_billing", "payment_status:s bills:l amount:d",
    """SELECT payment_status, COUNT(*) AS bills, SUM(total_amount) AS amount
       FROM consumer_billing GROUP BY payment_status""",
)
add(
    "highest_bills", d.highest_bills, "consumer_billing",
    "consumer_id:l consumer_type:s units_consumed:l total_amount:d",
    """SELECT consumer_id, consumer_type, units_consumed, total_amount FROM consumer_billing
       ORDER BY total_amount DESC, billing_id LIMIT 10""",
)
add(
    "pending_payments", d.pending_payments, "consumer_billing",
    "billing_id:l consumer_id:l billing_month:s total_amount:d",
    """SELECT billing_id, consumer_id, billing_month, total_amount FROM consumer_billing
       WHERE payment_status = 'Pending'""",
)
add(
    "billing_ranking", d.billing_ranking, "consumer_billing",
    "consumer_id:l billing_month:s total_amount:d bill_rank:l",
    """SELECT consumer_id, billing_month, total_amount, DENSE_RANK() OVER (ORDER BY total_amount DESC) AS bill_rank
       FROM consumer_billing""",
)
add(
    "billing_kpi", d.billing_kpi, "consumer_billing",
    "total_bills:l total_revenue:d average_bill_amount:d highest_bill:d lowest_bill:d",
    f"""SELECT COUNT(*) AS total_bills, SUM(total_amount) AS total_revenue,
        {mean('total_amount', 2, 6)} AS average_bill_amount, MAX(total_amount) AS highest_bill,
        MIN(total_amount) AS lowest_bill FROM consumer_billing""",
)
add(
    "plant_generation", d.plant_generation, "power_generation power_plant_master",
    "plant_name:s total_generation:d average_efficiency:d",
    f"""SELECT plant_name, SUM(energy_generated_mwh) AS total_generation,
        {mean('efficiency_percentage', 2, 2)} AS average_efficiency
        FROM power_generation g JOIN power_plant_master m ON g.plant_id = m.plant_id GROUP BY plant_name""",
)
add(
    "fuel_inventory_value", d.fuel_inventory_value, "fuel_inventory",
    "fuel_type:s stock_quantity:l inventory_value:d",
    """SELECT fuel_type, SUM(quantity_available) AS stock_quantity,
       SUM(quantity_available * unit_cost) AS inventory_value FROM fuel_inventory GROUP BY fuel_type""",
)
add(
    "consumer_revenue", d.consumer_revenue, "consumer_billing", "consumer_type:s consumers:l revenue:d",
    """SELECT consumer_type, COUNT(*) AS consumers, SUM(total_amount) AS revenue
       FROM consumer_billing GROUP BY consumer_type""",
)
add(
    "revenue_by_plant", d.revenue_by_plant, "revenue_fact", "plant_id:l total_revenue:d",
    "SELECT plant_id, SUM(revenue_amount) AS total_revenue FROM revenue_fact GROUP BY plant_id",
)
add(
    "revenue_by_month", d.revenue_by_month, "revenue_fact", "revenue_year:l revenue_month:l monthly_revenue:d",
    """SELECT YEAR(revenue_date) AS revenue_year, MONTH(revenue_date) AS revenue_month,
       SUM(revenue_amount) AS monthly_revenue FROM revenue_fact GROUP BY 1, 2""",
)
add(
    "plant_revenue_rank", d.plant_revenue_rank, "revenue_fact", "plant_id:l total_revenue:d revenue_rank:l",
    """SELECT plant_id, SUM(revenue_amount) AS total_revenue,
       DENSE_RANK() OVER (ORDER BY SUM(revenue_amount) DESC) AS revenue_rank FROM revenue_fact GROUP BY plant_id""",
)
add(
    "executive_kpi", d.executive_kpi,
    "power_plant_master fuel_inventory power_generation consumer_billing revenue_fact",
    "total_plants:l inventory_records:l total_generation:d billing_revenue:d total_revenue:d",
    """SELECT (SELECT COUNT(*) FROM power_plant_master) AS total_plants,
       (SELECT COUNT(*) FROM fuel_inventory) AS inventory_records,
       (SELECT SUM(energy_generated_mwh) FROM power_generation) AS total_generation,
       (SELECT SUM(total_amount) FROM consumer_billing) AS billing_revenue,
       (SELECT SUM(revenue_amount) FROM revenue_fact) AS total_revenue""",
)
add(
    "supply_chain_view", d.supply_chain_view,
    "chain_batches chain_plants chain_quality chain_entries chain_materials chain_purchases supplier_master "
    "chain_orders chain_shipments chain_sales",
    "batch_id:l production_date:D plant_id:l plant_name:s city:s state:s supplier_id:l supplier_name:s "
    "supplier_rating:d material_name:s quantity_available:l purchase_order_id:l purchase_amount:d quality_score:d "
    "defect_count:l warehouse_id:s storage_location:s shipment_id:l shipment_status:s shipping_cost:d "
    "customer_order_id:l customer_id:l order_amount:d sales_id:l sales_amount:d profit_amount:d",
    """WITH upstream AS (
           SELECT m.material_id, material_name, quantity_available, purchase_order_id, total_amount AS purchase_amount,
                  s.supplier_id, supplier_name, supplier_rating
           FROM chain_materials m LEFT JOIN (chain_purchases p LEFT JOIN supplier_master s USING (supplier_id))
           ON p.material_id = m.material_id),
       downstream AS (
           SELECT o.product_id, o.customer_order_id, customer_id, order_amount, shipment_id, shipment_status,
                  shipping_cost, sales_id, sales_amount, profit_amount
           FROM chain_orders o LEFT JOIN chain_shipments h ON h.customer_order_id = o.customer_order_id
           LEFT JOIN chain_sales t ON t.customer_order_id = o.customer_order_id),
       stored AS (SELECT * EXCLUDE (material_id) FROM chain_entries LEFT JOIN upstream USING (material_id))
       SELECT * EXCLUDE (plant_id, known_plant), known_plant AS plant_id
       FROM chain_batches LEFT JOIN downstream USING (product_id) LEFT JOIN chain_quality USING (batch_id)
       LEFT JOIN stored USING (batch_id) LEFT JOIN (SELECT *, plant_id AS known_plant FROM chain_plants)
       USING (plant_id)""",
)
add(
    "sales_details", d.sales_details, "sales_fact",
    "sales_id:s customer_order_id:l product_id:l sales_date:D quantity_sold:l sales_amount:d profit_amount:d region:s",
    "SELECT * FROM sales_fact",
)
add(
    "sales_summary", d.sales_summary, "sales_fact",
    "total_sales_transactions:l total_sales:d total_profit:d average_sales:d",
    f"""SELECT COUNT(*) AS total_sales_transactions, SUM(sales_amount) AS total_sales,
        SUM(profit_amount) AS total_profit, {mean('sales_amount', 2, 6)} AS average_sales FROM sales_fact""",
)
add(
    "sales_by_region", d.sales_by_region, "sales_fact", "region:s transactions:l total_sales:d total_profit:d",
    """SELECT region, COUNT(*) AS transactions, SUM(sales_amount) AS total_sales, SUM(profit_amount) AS total_profit
       FROM sales_fact GROUP BY region""",
)
add(
    "product_performance", d.product_performance, "sales_fact", "product_id:l units_sold:l revenue:d profit:d",
    """SELECT product_id, SUM(quantity_sold) AS units_sold, SUM(sales_amount) AS revenue,
       SUM(profit_amount) AS profit FROM sales_fact GROUP BY product_id""",
)
_MONTHLY_SALES = """SELECT YEAR(sales_date) AS sales_year, MONTH(sales_date) AS sales_month,
    SUM(sales_amount) AS total_sales, SUM(profit_amount) AS total_profit FROM sales_fact GROUP BY 1, 2"""
add(
    "sales_by_month", d.sales_by_month, "sales_fact",
    "sales_year:l sales_month:l total_sales:d total_profit:d", _MONTHLY_SALES,
)
add(
    "highest_sales", d.highest_sales, "sales_fact",
    "sales_id:s customer_order_id:l sales_amount:d profit_amount:d",
    """SELECT sales_id, customer_order_id, sales_amount, profit_amount FROM sales_fact
       ORDER BY sales_amount DESC, sales_id LIMIT 10""",
)
# Both amounts are whole units of their scale (4 and 2 digits), so the percentage is a quotient of integers.
add(
    "profit_margin", d.profit_margin, "sales_fact",
    "sales_id:s sales_amount:d profit_amount:d profit_margin_percentage:d",
    f"""SELECT sales_id, sales_amount, profit_amount, {quotient('CAST(profit_amount * 10000 AS BIGINT)',
        'CAST(sales_amount * 100 AS BIGINT)', 2, 2)} AS profit_margin_percentage
        FROM sales_fact WHERE sales_amount > 0""",
)
add(
    "billing_summary", lambda bills: d.billing_summary(bills, AS_OF), "consumer_billing",
    "payment_status:s bill_count:l total_collection:d average_bill:d processed_timestamp:t",
    f"""SELECT payment_status, COUNT(*) AS bill_count, SUM(total_amount) AS total_collection,
        {mean('total_amount', 2, 2)} AS average_bill, TIMESTAMP '{AS_OF} 00:00:00' AS processed_timestamp
        FROM consumer_billing GROUP BY payment_status""",
)
add(
    "revenue_summary", lambda revenue: d.revenue_summary(revenue, AS_OF), "revenue_fact",
    "plant_id:l total_revenue:d average_revenue:d processed_timestamp:t",
    f"""SELECT plant_id, SUM(revenue_amount) AS total_revenue, {mean('revenue_amount', 2, 2)} AS average_revenue,
        TIMESTAMP '{AS_OF} 00:00:00' AS processed_timestamp FROM revenue_fact GROUP BY plant_id""",
)
add(
    "regional_kpi", d.regional_kpi, "sales_fact",
    "region:s transactions:l total_sales:d total_profit:d average_sales:d",
    f"""SELECT region, COUNT(sales_id) AS transactions, SUM(sales_amount) AS total_sales,
        SUM(profit_amount) AS total_profit, {mean('sales_amount', 2, 2)} AS average_sales
        FROM sales_fact GROUP BY region""",
)
_CUSTOMER_SALES = """SELECT customer_id, SUM(sales_amount) AS customer_sales, SUM(profit_amount) AS customer_profit
    FROM sales_fact s JOIN customer_orders o ON s.customer_order_id = o.customer_order_id GROUP BY customer_id"""
add(
    "customer_sales", d.customer_sales, "sales_fact customer_orders",
    "customer_id:l customer_sales:d customer_profit:d", _CUSTOMER_SALES,
)
add(
    "top_customers", d.top_customers, "sales_fact customer_orders",
    "customer_id:l customer_sales:d customer_profit:d",
    f"SELECT * FROM ({_CUSTOMER_SALES}) ORDER BY customer_sales DESC, customer_id LIMIT 10",
)
add(
    "sales_trend_sql", lambda sales: d.sales_trend_sql(sales.sparkSession, sales), "sales_fact",
    "sales_year:l sales_month:l total_sales:d total_profit:d", _MONTHLY_SALES,
)
_SUPPLIERS = f"""SELECT s.supplier_id, supplier_name, supplier_rating, COUNT(purchase_order_id) AS total_orders,
    SUM(total_amount) AS purchase_amount, {mean('total_amount', 2, 2)} AS average_order_value,
    CASE WHEN supplier_rating >= 4.5 THEN 'Excellent' WHEN supplier_rating >= 4.0 THEN 'Good'
         WHEN supplier_rating >= 3.0 THEN 'Average' ELSE 'Needs Improvement' END AS supplier_grade
    FROM purchase_orders p JOIN supplier_master s ON p.supplier_id = s.supplier_id
    GROUP BY s.supplier_id, supplier_name, supplier_rating"""
add(
    "supplier_performance", d.supplier_performance, "purchase_orders supplier_master",
    "supplier_id:l supplier_name:s supplier_rating:d total_orders:l purchase_amount:d average_order_value:d "
    "supplier_grade:s",
    _SUPPLIERS,
)
add(
    "supplier_grades",
    lambda purchases, suppliers: d.supplier_grades_sql(
        purchases.sparkSession, d.supplier_performance(purchases, suppliers)
    ),
    "purchase_orders supplier_master", "supplier_grade:s suppliers:l total_purchase:d",
    f"""SELECT supplier_grade, COUNT(*) AS suppliers, SUM(purchase_amount) AS total_purchase
        FROM ({_SUPPLIERS}) GROUP BY supplier_grade""",
)
