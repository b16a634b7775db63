"""Curated KPI views over the sales facts.

Each view aggregates the fact table *before* joining the dimension (partial
sums per dimension key), then finishes the aggregation on the dimension's
grouping column.  SUM and COUNT distribute over the join, so the result is
exactly the join-then-aggregate of the SQL definition, including the fan-out
over duplicate dimension rows; averages are rebuilt from the exact sums.
The big side therefore never shuffles row by row: a hot key collapses in the
map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Loyalty class labels.
EXCLUSIVE = "Exclusive Shoppers"
MULTI_STORE = "Multi-Store Shoppers"


def _avg(total: str, n: str):
    return F.try_divide(F.col(total).cast("double"), F.col(n))


def product_partials(facts: DataFrame, *by: str) -> DataFrame:
    """Additive product KPIs per ``by`` and product: sums and counts only."""
    revenue = F.col("quantity") * F.col("unit_price")
    return facts.groupBy(*by, "product_id").agg(
        F.sum(revenue).alias("_rev"),
        F.sum("quantity").alias("_units"),
        F.sum("unit_price").alias("_price_sum"),
        F.count("unit_price").alias("_price_n"),
    )


def product_sales_summary(facts: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    return product_sales_summary_of(product_partials(facts), products, ordered)


def product_sales_summary_of(per_product: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """The summary from partial sums; a product may have several rows of them."""
    joined = per_product.join(products.select("product_id", "product_name"), "product_id")
    out = joined.groupBy("product_name").agg(
        F.sum("_rev").cast("decimal(38,2)").alias("Total_Sales_Revenue"),
        F.sum("_units").cast("bigint").alias("Units_Sold"),
        F.sum("_price_sum").alias("_ps"),
        F.sum("_price_n").alias("_pn"),
    ).select("product_name", "Total_Sales_Revenue", "Units_Sold",
             _avg("_ps", "_pn").alias("Average_Selling_Price"))
    return out.orderBy(F.desc_nulls_last("Total_Sales_Revenue"), "product_name") if ordered else out


def customer_summary(facts: DataFrame, customers: DataFrame, current_only: bool = False,
                     ordered: bool = True) -> DataFrame:
    """Revenue per customer name.  ``current_only=False`` keeps the SQL
    definition's join against every SCD2 version (revenue counted once per
    version); ``True`` joins the active version only."""
    return customer_summary_of(customer_partials(facts), customers, current_only, ordered)


def customer_partials(facts: DataFrame, *by: str) -> DataFrame:
    """Additive customer KPIs per ``by`` and customer."""
    revenue = F.col("quantity") * F.col("unit_price")
    return facts.groupBy(*by, "customer_id").agg(
        F.sum(revenue).alias("_rev"),
        F.count("invoice_id").alias("_n_inv"),
        F.count(revenue).alias("_n_rev"),
    )


def customer_summary_of(per_customer: DataFrame, customers: DataFrame, current_only: bool = False,
                        ordered: bool = True) -> DataFrame:
    """The summary from partial sums; a customer may have several rows of them."""
    dim = customers
    if current_only:
        dim = dim.where(F.col("active_flag"))
    dim = dim.select("customer_id", "first_name", "last_name", "loyalty_points", "membership_status")
    joined = per_customer.join(dim, "customer_id")
    name = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name")
    agg = joined.groupBy(name).agg(
        F.sum("_rev").cast("decimal(38,2)").alias("Total_Revenue"),
        F.sum("_n_inv").cast("bigint").alias("Number_of_Purchases"),
        F.sum("_n_rev").alias("_nr"),
        F.max("loyalty_points").alias("Loyalty_Points"),
        F.max("membership_status").alias("Membership_Status"),
    )
    aov = _avg("Total_Revenue", "_nr")
    out = agg.select(
        "customer_name", "Total_Revenue", "Number_of_Purchases",
        aov.alias("Average_Order_Value"),
        (aov * F.col("Number_of_Purchases")).alias("Customer_Lifetime_Value"),
        "Loyalty_Points", "Membership_Status",
    )
    return out.orderBy(F.desc_nulls_last("Total_Revenue"), "customer_name") if ordered else out


def customer_store_loyalty(facts: DataFrame) -> DataFrame:
    """Customers classed by how many distinct stores they bought in.

    ``countDistinct`` is planned as a dedup on (customer, store) first, so a
    customer with a third of all rows is reduced map-side before the
    per-customer shuffle."""
    return shopper_classes(facts.groupBy("customer_id").agg(F.countDistinct("store_id").alias("store_count")))


def shopper_classes(per_customer: DataFrame) -> DataFrame:
    """Customers by class, from ``customer_id, store_count``."""
    shopper = F.when(F.col("store_count") == 1, F.lit(EXCLUSIVE)).otherwise(F.lit(MULTI_STORE))
    return (per_customer.select(shopper.alias("shopper_type"), "customer_id")
            .groupBy("shopper_type").agg(F.count("customer_id").alias("customer_count")))


def store_bitmaps(facts: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """Per ``by``, customer and bucket of 32,768 store numbers the bitmap of the
    stores bought in: mergeable by OR, exact.  ``numbers``: ``store_id, number``
    (from 1).  Rows without a store give an empty bitmap, so their customer
    stays countable."""
    numbered = facts.join(numbers.select("store_id", "number"), "store_id", "left")
    return (numbered.withColumn("bucket", F.bitmap_bucket_number("number"))
            .groupBy(*by, "customer_id", "bucket")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("stores")))


def store_counts(bitmaps: DataFrame) -> DataFrame:
    """Distinct stores per customer from ``store_bitmaps`` of any number of months."""
    return (bitmaps.groupBy("customer_id", "bucket").agg(F.bitmap_or_agg("stores").alias("stores"))
            .groupBy("customer_id").agg(F.sum(F.bitmap_count("stores")).alias("store_count")))
