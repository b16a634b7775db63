"""DuckDB oracle SQL for every registered query.

The CTEs below restate ``lakeloom.sources.retail`` in plain SQL over the
pre-registered test tables; the final SELECTs restate each operator's
definition the direct way (join first, then aggregate; MERGE as explicit
outer joins), so the Spark plans are checked against an independent
formulation rather than a copy of themselves.
"""

from __future__ import annotations

SEED_TS = "TIMESTAMP '2024-01-01 00:00:00'"
RUN_TS = "TIMESTAMP '2025-01-01 00:00:00'"
AS_OF = "DATE '2025-01-01'"


def hash_sql(cols) -> str:
    """SQL twin of ``lakeloom.functions.hashing.row_hash``."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(2))" for c in cols)
    return f"md5(concat_ws(chr(1), {parts}))"


TRACKED = ("customer_id", "first_name", "last_name", "email", "phone_number",
           "loyalty_points", "membership_status", "address")

AUDIT_SEED = f"{SEED_TS} AS batch_r_timestamp, {SEED_TS} AS h_insert_timestamp, " \
             f"{SEED_TS} AS h_update_timestamp, 'seed' AS job_id"

CTE = {
    "products": f"""products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS brand,
         p_type AS category,
         CASE p_partkey % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE 'Unisex' END AS gender,
         CAST(p_size AS VARCHAR) AS size, split_part(p_name, ' ', 1) AS color,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(p_partkey % 100 AS INTEGER) AS availability,
         DATE '2020-01-01' + CAST(p_partkey % 365 AS INTEGER) AS added_date,
         p_partkey % 10 <> 0 AS is_active, {AUDIT_SEED}
  FROM part)""",
    "stores": f"""stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS location,
         'M' || CAST(s_suppkey AS VARCHAR) AS manager_id,
         DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS opening_date, {AUDIT_SEED}
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "customers_base": """customers_base AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 11 = 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '.example.com'
              ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number,
         CAST(floor(abs(c_acctbal)) AS INTEGER) AS loyalty_points,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'Gold' WHEN 'BUILDING' THEN 'Silver'
              ELSE 'Bronze' END AS membership_status,
         CAST(c_custkey AS VARCHAR) || ' Main St, ' || n_name AS address,
         true AS active_flag, DATE '2020-01-01' AS begin_effective_date,
         DATE '9999-12-31' AS end_effective_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
    "customers": f"""customers AS (
  SELECT *, {hash_sql(TRACKED)} AS s_customer_key, {AUDIT_SEED} FROM customers_base)""",
    "customers2": """customers2 AS (
  SELECT * FROM customers
  UNION ALL
  SELECT customer_id, first_name, last_name, email, phone_number, loyalty_points - 100,
         'Bronze', address, false, DATE '2019-01-01', DATE '2020-01-01', s_customer_key,
         batch_r_timestamp, h_insert_timestamp, h_update_timestamp, job_id
  FROM customers WHERE CAST(customer_id AS BIGINT) % 5 = 0)""",
    "transactions": f"""transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id,
         CAST(o_orderdate AS TIMESTAMP) AS transaction_date_time,
         CAST(CASE WHEN o_custkey % 4 = 0 THEN o_custkey % 10 ELSE o_orderkey % 10 END AS VARCHAR) AS store_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         'E' || CAST(o_orderkey % 50 AS VARCHAR) AS employee_id,
         o_orderpriority AS payment_type,
         CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS transaction_month, {AUDIT_SEED}
  FROM orders)""",
    "line_items": f"""line_items AS (
  SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
             CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d'),
             CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR))) AS line_item_id,
         CAST(l_orderkey AS VARCHAR) AS invoice_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS total_price,
         CAST(l_discount AS DECIMAL(10,2)) AS discount_applied, {AUDIT_SEED}
  FROM lineitem)""",
    "facts": """facts AS (
  SELECT t.invoice_id, l.line_item_id, t.store_id, t.customer_id, t.employee_id, l.product_id,
         t.payment_type, t.transaction_date_time, t.transaction_month, l.quantity, l.unit_price,
         l.total_price, l.discount_applied, t.total_amount
  FROM line_items l JOIN transactions t ON l.invoice_id = t.invoice_id)""",
    "raw_products_base": f"""raw_products_base AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 53 = 7 THEN NULL ELSE p_name END AS product_name,
         p_brand AS brand, p_type AS category,
         CASE p_partkey % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE 'Unisex' END AS gender,
         CAST(p_size AS VARCHAR) AS size,
         CASE WHEN p_partkey % 59 = 11 THEN NULL ELSE split_part(p_name, ' ', 1) END AS color,
         CASE p_partkey % 41 WHEN 5 THEN '-1' WHEN 6 THEN '.5' WHEN 7 THEN '1e3' WHEN 8 THEN ''
              WHEN 9 THEN NULL WHEN 10 THEN '12.345'
              ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price,
         CASE WHEN p_partkey % 43 = 4 THEN 'n/a' ELSE CAST(p_partkey % 100 AS VARCHAR) END AS availability,
         CASE WHEN p_partkey % 47 = 3 THEN '2021-02-31'
              ELSE CAST(DATE '2020-01-01' + CAST(p_partkey % 365 AS INTEGER) AS VARCHAR) END AS added_date,
         CASE WHEN p_partkey % 10 = 0 THEN (CASE WHEN p_partkey % 20 = 0 THEN 'false' ELSE '0' END)
              ELSE (CASE p_partkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'yes' ELSE '1' END) END AS is_active,
         '2024-01-01 00:00:00' AS update_timestamp,
         {SEED_TS} + to_days(CAST(p_partkey % 3 AS INTEGER)) AS r_insert_timestamp,
         p_partkey AS _k
  FROM part)""",
    "raw_products": """raw_products AS (
  SELECT * EXCLUDE (_k) FROM raw_products_base
  UNION ALL SELECT * EXCLUDE (_k) FROM raw_products_base WHERE _k % 31 = 0
  UNION ALL SELECT * EXCLUDE (_k, r_insert_timestamp), r_insert_timestamp + INTERVAL 1 DAY
            FROM raw_products_base WHERE _k % 37 = 0)""",
    "raw_stores": f"""raw_stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS location,
         'M' || CAST(s_suppkey AS VARCHAR) AS manager_id,
         CASE s_suppkey % 7 WHEN 3 THEN '31-02-2021' WHEN 5 THEN '2021-01-05'
              ELSE strftime(DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER), '%d-%m-%Y') END AS opening_date,
         {SEED_TS} + to_days(CAST(s_suppkey % 3 AS INTEGER)) AS r_insert_timestamp
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "raw_customers": f"""raw_customers AS (
  SELECT customer_id, first_name, last_name, email,
         CASE WHEN CAST(customer_id AS BIGINT) % 23 = 7 THEN '5550000000' ELSE phone_number END AS phone_number,
         CAST(loyalty_points AS VARCHAR) AS loyalty_points,
         CASE WHEN CAST(customer_id AS BIGINT) % 29 = 1 THEN 'Platinum' ELSE membership_status END AS membership_status,
         address, '2024-01-01 00:00:00' AS update_timestamp,
         {SEED_TS} + to_days(CAST(CAST(customer_id AS BIGINT) % 3 AS INTEGER)) AS r_insert_timestamp
  FROM customers)""",
    "raw_transactions": f"""raw_transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id,
         CASE WHEN o_orderkey % 61 = 2 THEN 'not a time' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_date_time,
         CAST(CASE WHEN o_custkey % 4 = 0 THEN o_custkey % 10 ELSE o_orderkey % 10 END AS VARCHAR) AS store_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         'E' || CAST(o_orderkey % 50 AS VARCHAR) AS employee_id,
         o_orderpriority AS payment_type,
         CASE WHEN o_orderkey % 67 = 3 THEN '123456789.99'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS total_amount,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS insert_timestamp,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS update_timestamp,
         {SEED_TS} + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS r_insert_timestamp
  FROM orders)""",
    "raw_line_items": f"""raw_line_items AS (
  SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
             CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d'),
             CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR))) AS line_item_id,
         CAST(l_orderkey AS VARCHAR) AS invoice_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_orderkey % 71 = 5 THEN 'x' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_price,
         CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS VARCHAR) AS total_price,
         CAST(CAST(l_discount AS DECIMAL(10,2)) AS VARCHAR) AS discount_applied,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS insert_timestamp,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS update_timestamp,
         {SEED_TS} + to_days(CAST(l_orderkey % 3 AS INTEGER)) AS r_insert_timestamp
  FROM lineitem)""",
}

# CTE dependencies, so a query only lists what it reads directly.
DEPS = {
    "customers": ["customers_base"],
    "customers2": ["customers"],
    "facts": ["line_items", "transactions"],
    "raw_products": ["raw_products_base"],
    "raw_customers": ["customers"],
}


def with_(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n"
