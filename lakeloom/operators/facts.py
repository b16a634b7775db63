"""Denormalised sales facts (line grain) and their month partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.hashing import dealt_packed
from lakeloom.functions.predicates import month_of

FACT_COLUMNS = (
    "invoice_id", "line_item_id", "store_id", "customer_id", "employee_id", "product_id",
    "payment_type", "transaction_date_time", "transaction_month", "quantity", "unit_price",
    "total_price", "discount_applied", "total_amount",
)
LINE_COLUMNS = ("line_item_id", "invoice_id", "product_id", "quantity", "unit_price",
                "total_price", "discount_applied")
HEADER_COLUMNS = ("invoice_id", "store_id", "customer_id", "employee_id", "payment_type",
                  "transaction_date_time", "transaction_month", "total_amount")


def with_transaction_month(transactions: DataFrame) -> DataFrame:
    """Add the generated partition column when the header table lacks it."""
    if "transaction_month" in transactions.columns:
        return transactions
    return transactions.withColumn("transaction_month", month_of("transaction_date_time"))


def build_sales_facts(line_items: DataFrame, transactions: DataFrame) -> DataFrame:
    """Line items joined to their invoice header (inner: orphan lines and
    headers without lines are dropped), projected to the 14 fact columns.

    Both inputs are fact-sized, so this is a shuffle join on ``invoice_id``;
    AQE splits a hot invoice's partition (skew join) and the header side has
    one row per invoice, so the replicated part stays small.  Line ids cross the
    shuffle packed.
    """
    li = line_items.select(*LINE_COLUMNS)
    tx = with_transaction_month(transactions).select(*HEADER_COLUMNS)
    return dealt_packed(li, lambda t: t.join(tx, "invoice_id", "inner")).select(*FACT_COLUMNS)
