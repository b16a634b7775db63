import datetime as dt
from decimal import Decimal

from lakeloom import specs
from lakeloom.operators.casting import cast_to_spec


def test_typed_products_edge_values(spark):
    raw = spark.createDataFrame([
        ("1", "n", "b", "c", "g", "s", "col", "12.345", "7", "2021-02-03", "yes", "u", dt.datetime(2024, 1, 1)),
        ("2", "n", "b", "c", "g", "s", "col", "123456789.99", "7.5", "2021-02-31", "1", "u", dt.datetime(2024, 1, 1)),
        ("3", "n", "b", "c", "g", "s", "col", "abc", "x", "bad", "TRUE", "u", dt.datetime(2024, 1, 1)),
    ], "product_id string, product_name string, brand string, category string, gender string, size string, "
       "color string, price string, availability string, added_date string, is_active string, "
       "update_timestamp string, r_insert_timestamp timestamp_ntz")
    out = {r.product_id: r for r in cast_to_spec(raw, specs.PRODUCTS, "2025-01-01 00:00:00", "j").collect()}
    assert out["1"].price == Decimal("12.35")            # HALF_UP
    assert out["1"].availability == 7 and out["1"].added_date == dt.date(2021, 2, 3)
    assert out["1"].is_active is True and out["2"].is_active is True and out["3"].is_active is True
    assert out["2"].price is None                         # over DECIMAL(10,2)
    assert out["2"].availability is None and out["2"].added_date is None
    assert out["3"].price is None and out["3"].availability is None
    assert out["1"].h_insert_timestamp == dt.datetime(2025, 1, 1) and out["1"].job_id == "j"


def test_store_dates_use_their_format(spark):
    raw = spark.createDataFrame([("1", "n", "l", "m", "05-01-2021", dt.datetime(2024, 1, 1)),
                                 ("2", "n", "l", "m", "31-02-2021", dt.datetime(2024, 1, 1)),
                                 ("3", "n", "l", "m", "2021-01-05", dt.datetime(2024, 1, 1))],
                                "store_id string, store_name string, location string, manager_id string, "
                                "opening_date string, r_insert_timestamp timestamp_ntz")
    out = {r.store_id: r.opening_date for r in cast_to_spec(raw, specs.STORES, "2025-01-01", "j").collect()}
    assert out == {"1": dt.date(2021, 1, 5), "2": None, "3": None}


def test_transaction_month_from_parsed_time(spark):
    raw = spark.createDataFrame([("1", "2021-01-31 23:59:59", "s", "c", "e", "p", "10", dt.datetime(2024, 1, 1)),
                                 ("2", "2021-02-01 00:00:00", "s", "c", "e", "p", "10", dt.datetime(2024, 1, 1))],
                                "invoice_id string, transaction_date_time string, store_id string, customer_id string, "
                                "employee_id string, payment_type string, total_amount string, "
                                "r_insert_timestamp timestamp_ntz")
    out = {r.invoice_id: r.transaction_month
           for r in cast_to_spec(raw, specs.TRANSACTIONS, "2025-01-01", "j").collect()}
    assert out == {"1": dt.date(2021, 1, 1), "2": dt.date(2021, 2, 1)}
