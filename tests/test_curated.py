import datetime as dt
from decimal import Decimal

from lakeloom.operators import curated, facts

FSCHEMA = "invoice_id string, customer_id string, store_id string, product_id string, quantity int, " \
          "unit_price decimal(10,2)"
CSCHEMA = "customer_id string, first_name string, last_name string, loyalty_points int, " \
          "membership_status string, active_flag boolean"


def test_customer_summary_edges(spark):
    f = spark.createDataFrame([
        ("i1", "c1", "s", "p", 2, Decimal("10.00")), ("i2", "c2", "s", "p", 1, Decimal("5.00")),
        ("i3", "c3", "s", "p", 1, Decimal("1.00")), ("i4", "c4", "s", "p", 3, Decimal("2.00")),
        ("i5", "c5", "s", "p", 1, Decimal("7.00")),
    ], FSCHEMA)
    c = spark.createDataFrame([
        ("c1", "Ann", "Lee", 5, "Gold", True), ("c2", "Ann", "Lee", 9, "Silver", True),   # homonyms merge
        ("c3", "Bo", None, 1, "Bronze", True),                                               # NULL name
        ("c4", "Cy", "Ng", 1, "Bronze", False), ("c4", "Cy", "Ng", 2, "Gold", True),       # two versions
        ("c5", "Di", "Ox", 0, "Bronze", True),
    ], CSCHEMA)
    out = {r.customer_name: r for r in curated.customer_summary(f, c).collect()}
    ann = out["Ann Lee"]
    assert ann.Total_Revenue == Decimal("25.00") and ann.Number_of_Purchases == 2
    assert ann.Membership_Status == "Silver" and ann.Loyalty_Points == 9      # MAX is lexicographic
    assert out[None].Total_Revenue == Decimal("1.00")
    assert out["Cy Ng"].Total_Revenue == Decimal("12.00")                      # fan-out over 2 versions
    assert out["Cy Ng"].Number_of_Purchases == 2
    assert abs(out["Cy Ng"].Customer_Lifetime_Value - 12.0) < 1e-9
    cur = {r.customer_name: r for r in curated.customer_summary(f, c, current_only=True).collect()}
    assert cur["Cy Ng"].Total_Revenue == Decimal("6.00")
    ordered = [r.customer_name for r in curated.customer_summary(f, c).collect()]
    assert ordered[0] == "Ann Lee"                                             # ORDER BY revenue DESC


def test_product_summary_homonyms_and_unsold(spark):
    f = spark.createDataFrame([("i1", "c", "s", "p1", 2, Decimal("3.00")), ("i2", "c", "s", "p2", 1, Decimal("5.00"))],
                              FSCHEMA)
    p = spark.createDataFrame([("p1", "bolt"), ("p2", "bolt"), ("p3", "nut")], "product_id string, product_name string")
    out = [tuple(r) for r in curated.product_sales_summary(f, p).collect()]
    assert out == [("bolt", Decimal("11.00"), 3, 4.0)]                          # unweighted average


def test_store_loyalty_edges(spark):
    f = spark.createDataFrame([
        ("i1", "a", "s1", "p", 1, Decimal(1)), ("i2", "a", "s1", "p", 1, Decimal(1)),   # one store, many times
        ("i3", "b", "s1", "p", 1, Decimal(1)), ("i4", "b", "s2", "p", 1, Decimal(1)),   # two stores
        ("i5", "c", None, "p", 1, Decimal(1)),                                          # all stores NULL
        ("i6", None, "s1", "p", 1, Decimal(1)),                                         # NULL customer
    ], FSCHEMA)
    out = {r.shopper_type: r.customer_count for r in curated.customer_store_loyalty(f).collect()}
    assert out == {"Exclusive Shoppers": 1, "Multi-Store Shoppers": 2}


def test_sales_facts_drops_orphans_and_derives_month(spark):
    li = spark.createDataFrame([("l1", "i1", "p", 1, Decimal(1), Decimal(1), Decimal(0)),
                                ("l2", "orphan", "p", 1, Decimal(1), Decimal(1), Decimal(0))],
                               "line_item_id string, invoice_id string, product_id string, quantity int, "
                               "unit_price decimal(10,2), total_price decimal(10,2), discount_applied decimal(10,2)")
    tx = spark.createDataFrame([("i1", dt.datetime(2021, 1, 31, 23, 59), "s", "c", "e", "cash", Decimal(1)),
                                ("i2", dt.datetime(2021, 2, 1), "s", "c", "e", "cash", Decimal(1))],
                               "invoice_id string, transaction_date_time timestamp_ntz, store_id string, "
                               "customer_id string, employee_id string, payment_type string, "
                               "total_amount decimal(10,2)")
    out = facts.build_sales_facts(li, tx).collect()
    assert len(out) == 1 and out[0].line_item_id == "l1"
    assert out[0].transaction_month == dt.date(2021, 1, 1)
    assert tuple(facts.build_sales_facts(li, tx).columns) == facts.FACT_COLUMNS
