"""Catalog side of the lakehouse: schemas, declared tables, curated views.

DDL comes from the TableSpecs; the KPI views are SQL over whatever tables
(or temp views) hold the facts and dimensions, written in the same
aggregate-before-join form as ``lakeloom.operators.curated`` so that Catalyst
plans a map-side partial aggregate of the facts before the dimension join.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakeloom.operators.curated import EXCLUSIVE, MULTI_STORE
from lakeloom.specs import ALL_SPECS, TableSpec


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, spec: TableSpec, using: str = "parquet", location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS from the spec (defaults, comments, partitioning,
    tags as ``tag.*`` and ``coltag.<column>.*`` properties)."""
    ensure_schema(spark, spec.schema)
    spark.sql(spec.ddl(using, location))


def create_all(spark: SparkSession, specs=ALL_SPECS) -> None:
    for s in specs:
        create_table(spark, s)


def curated_view_sql(facts: str, customers: str, products: str) -> dict[str, str]:
    """Bodies of the three curated views over the named relations."""
    return {
        "v_customer_summary": f"""
WITH per_customer AS (
  SELECT customer_id, SUM(quantity * unit_price) AS rev, COUNT(invoice_id) AS n_inv,
         COUNT(quantity * unit_price) AS n_rev
  FROM {facts} GROUP BY customer_id)
SELECT concat(c.first_name, ' ', c.last_name) AS customer_name,
       CAST(SUM(f.rev) AS DECIMAL(38,2)) AS Total_Revenue,
       CAST(SUM(f.n_inv) AS BIGINT) AS Number_of_Purchases,
       try_divide(CAST(SUM(f.rev) AS DOUBLE), SUM(f.n_rev)) AS Average_Order_Value,
       try_divide(CAST(SUM(f.rev) AS DOUBLE), SUM(f.n_rev)) * SUM(f.n_inv) AS Customer_Lifetime_Value,
       MAX(c.loyalty_points) AS Loyalty_Points,
       MAX(c.membership_status) AS Membership_Status
FROM per_customer f JOIN {customers} c ON f.customer_id = c.customer_id
GROUP BY concat(c.first_name, ' ', c.last_name)
ORDER BY Total_Revenue DESC NULLS LAST, customer_name""",
        "v_product_sales_summary": f"""
WITH per_product AS (
  SELECT product_id, SUM(quantity * unit_price) AS rev, SUM(quantity) AS units,
         SUM(unit_price) AS price_sum, COUNT(unit_price) AS price_n
  FROM {facts} GROUP BY product_id)
SELECT p.product_name,
       CAST(SUM(f.rev) AS DECIMAL(38,2)) AS Total_Sales_Revenue,
       CAST(SUM(f.units) AS BIGINT) AS Units_Sold,
       try_divide(CAST(SUM(f.price_sum) AS DOUBLE), SUM(f.price_n)) AS Average_Selling_Price
FROM per_product f JOIN {products} p ON f.product_id = p.product_id
GROUP BY p.product_name
ORDER BY Total_Sales_Revenue DESC NULLS LAST, product_name""",
        "v_customer_store_loyalty": f"""
WITH per_customer AS (
  SELECT customer_id, COUNT(DISTINCT store_id) AS store_count FROM {facts} GROUP BY customer_id)
SELECT CASE WHEN store_count = 1 THEN '{EXCLUSIVE}' ELSE '{MULTI_STORE}' END AS shopper_type,
       COUNT(customer_id) AS customer_count
FROM per_customer
GROUP BY CASE WHEN store_count = 1 THEN '{EXCLUSIVE}' ELSE '{MULTI_STORE}' END""",
    }


def create_curated_views(spark: SparkSession, facts: str, customers: str, products: str,
                         schema: str | None = None, temporary: bool = False) -> list[str]:
    """CREATE OR REPLACE [TEMP] VIEW for each KPI view; returns their names."""
    names = []
    if schema and not temporary:
        ensure_schema(spark, schema)
    for name, body in curated_view_sql(facts, customers, products).items():
        full = name if temporary or not schema else f"{schema}.{name}"
        kind = "TEMPORARY VIEW" if temporary else "VIEW"
        spark.sql(f"CREATE OR REPLACE {kind} {full} AS {body}")
        names.append(full)
    return names
