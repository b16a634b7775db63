"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the provided test tables, with its
DuckDB oracle in ``ORACLE``.

Registered queries expose *unordered* results with deterministic values
(injected run stamps); the library functions keep the reference's
ORDER BY where it has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.operators import curated, facts
from lakeloom.plans.daily import PRODUCT_CHECK_COLUMNS, PRODUCT_RULES
from lakeloom.plans.oracle import with_
from lakeloom.sources import retail as R

REGISTRY: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sales_facts_df(spark: SparkSession, d: str) -> DataFrame:
    return facts.build_sales_facts(R.harmonized_line_items(spark, d), R.harmonized_transactions(spark, d))


# ------------------------------------------------------------ facts and KPIs

@register("sales_facts", with_("facts") + "SELECT * FROM facts")
def q_sales_facts(spark, d):
    return sales_facts_df(spark, d)


@register("product_sales_summary", with_("facts", "products") + """
SELECT p.product_name,
       CAST(SUM(s.quantity * s.unit_price) AS DECIMAL(38,2)) AS Total_Sales_Revenue,
       CAST(SUM(s.quantity) AS BIGINT) AS Units_Sold,
       CAST(SUM(s.unit_price) AS DOUBLE) / COUNT(s.unit_price) AS Average_Selling_Price
FROM facts s JOIN products p ON s.product_id = p.product_id
GROUP BY p.product_name""")
def q_product_sales_summary(spark, d):
    return curated.product_sales_summary(sales_facts_df(spark, d), R.harmonized_products(spark, d), ordered=False)


def _customer_summary_sql(dim: str, where: str = "") -> str:
    return f"""
SELECT c.first_name || ' ' || c.last_name AS customer_name,
       CAST(SUM(s.quantity * s.unit_price) AS DECIMAL(38,2)) AS Total_Revenue,
       COUNT(s.invoice_id) AS Number_of_Purchases,
       CAST(SUM(s.quantity * s.unit_price) AS DOUBLE) / COUNT(s.quantity * s.unit_price) AS Average_Order_Value,
       CAST(SUM(s.quantity * s.unit_price) AS DOUBLE) / COUNT(s.quantity * s.unit_price)
         * COUNT(s.invoice_id) AS Customer_Lifetime_Value,
       MAX(c.loyalty_points) AS Loyalty_Points,
       MAX(c.membership_status) AS Membership_Status
FROM facts s JOIN {dim} c ON s.customer_id = c.customer_id {where}
GROUP BY c.first_name || ' ' || c.last_name"""


@register("customer_summary", with_("facts", "customers") + _customer_summary_sql("customers"))
def q_customer_summary(spark, d):
    return curated.customer_summary(sales_facts_df(spark, d), R.harmonized_customers(spark, d), ordered=False)


@register("customer_summary_scd2_fanout", with_("facts", "customers2") + _customer_summary_sql("customers2"))
def q_customer_summary_fanout(spark, d):
    return curated.customer_summary(sales_facts_df(spark, d), R.customers_two_versions(spark, d), ordered=False)


@register("customer_summary_current",
          with_("facts", "customers2") + _customer_summary_sql("customers2", "WHERE c.active_flag"))
def q_customer_summary_current(spark, d):
    return curated.customer_summary(sales_facts_df(spark, d), R.customers_two_versions(spark, d),
                                    current_only=True, ordered=False)


@register("customer_store_loyalty", with_("facts") + """
SELECT CASE WHEN store_count = 1 THEN 'Exclusive Shoppers' ELSE 'Multi-Store Shoppers' END AS shopper_type,
       COUNT(customer_id) AS customer_count
FROM (SELECT customer_id, COUNT(DISTINCT store_id) AS store_count FROM facts GROUP BY customer_id) x
GROUP BY 1""")
def q_customer_store_loyalty(spark, d):
    return curated.customer_store_loyalty(sales_facts_df(spark, d))


# --------------------------------------------------------- typed projections
from pyspark.sql import functions as F  # noqa: E402

from lakeloom import specs as S  # noqa: E402
from lakeloom.operators import increment, quality, scd1, scd2  # noqa: E402
from lakeloom.functions.predicates import NUMBER_PATTERN  # noqa: E402
from lakeloom.operators.casting import cast_to_spec  # noqa: E402
from lakeloom.plans.oracle import AS_OF, RUN_TS, SEED_TS, hash_sql  # noqa: E402

RUN = "2025-01-01 00:00:00"
AS_OF_DATE = "2025-01-01"
JOB = "harmonize"
AUDIT_SQL = f"r_insert_timestamp AS batch_r_timestamp, {RUN_TS} AS h_insert_timestamp, " \
            f"{RUN_TS} AS h_update_timestamp, '{JOB}' AS job_id"

TYPED_SQL = {
    "products": f"""SELECT product_id, product_name, brand, category, gender, size, color,
       TRY_CAST(price AS DECIMAL(10,2)) AS price, TRY_CAST(availability AS INTEGER) AS availability,
       TRY_CAST(added_date AS DATE) AS added_date, TRY_CAST(is_active AS BOOLEAN) AS is_active, {AUDIT_SQL}
FROM raw_products""",
    "stores": f"""SELECT store_id, store_name, location, manager_id,
       CAST(try_strptime(opening_date, '%d-%m-%Y') AS DATE) AS opening_date, {AUDIT_SQL}
FROM raw_stores""",
    "transactions": f"""SELECT invoice_id, TRY_CAST(transaction_date_time AS TIMESTAMP) AS transaction_date_time,
       store_id, customer_id, employee_id, payment_type,
       TRY_CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
       CAST(date_trunc('month', TRY_CAST(transaction_date_time AS TIMESTAMP)) AS DATE) AS transaction_month,
       {AUDIT_SQL}
FROM raw_transactions""",
    "line_items": f"""SELECT line_item_id, invoice_id, product_id, TRY_CAST(quantity AS INTEGER) AS quantity,
       TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price, TRY_CAST(total_price AS DECIMAL(10,2)) AS total_price,
       TRY_CAST(discount_applied AS DECIMAL(10,2)) AS discount_applied, {AUDIT_SQL}
FROM raw_line_items""",
    "customers": f"""SELECT customer_id, first_name, last_name, email, phone_number,
       TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, membership_status, address, {AUDIT_SQL}
FROM raw_customers""",
}
RAW_READERS = {
    "products": (R.raw_products, S.PRODUCTS),
    "stores": (R.raw_stores, S.STORES),
    "transactions": (R.raw_transactions, S.TRANSACTIONS),
    "line_items": (R.raw_line_items, S.LINE_ITEMS),
    "customers": (R.raw_customers, S.CUSTOMERS),
}


def typed(spark, d, name, raw=None):
    reader, spec = RAW_READERS[name]
    return cast_to_spec(raw if raw is not None else reader(spark, d), spec, RUN, JOB)


def _typed_query(name):
    def q(spark, d):
        return typed(spark, d, name)
    q.__name__ = f"q_typed_{name}"
    return q


for _n in ("products", "stores", "transactions", "line_items"):
    register(f"typed_{_n}", with_(f"raw_{_n}") + TYPED_SQL[_n])(_typed_query(_n))


# ------------------------------------------------------------ data quality
# Fixed value: the number pattern.
NUM_RE = NUMBER_PATTERN
DUP_SQL = """SELECT product_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Duplicate product_id' AS issue
FROM raw_products GROUP BY product_id, r_insert_timestamp HAVING count(*) > 1"""
FMT_SQL = f"""SELECT product_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Invalid price format' AS issue
FROM raw_products WHERE NOT regexp_matches(price, '{NUM_RE}')"""
NULL_PRED = " OR ".join(f"{c} IS NULL" for c in PRODUCT_CHECK_COLUMNS)
NULL_SQL = f"""SELECT product_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Null value in one or more columns' AS issue
FROM raw_products WHERE {NULL_PRED}"""


@register("dq_duplicates", with_("raw_products") + DUP_SQL)
def q_dq_duplicates(spark, d):
    return quality.dq_duplicates(R.raw_products(spark, d), "product_id", "r_insert_timestamp",
                                 "Duplicate product_id")


@register("dq_format", with_("raw_products") + FMT_SQL)
def q_dq_format(spark, d):
    return quality.dq_format(R.raw_products(spark, d), "product_id", "r_insert_timestamp", "price",
                             issue="Invalid price format")


@register("dq_nulls", with_("raw_products") + NULL_SQL)
def q_dq_nulls(spark, d):
    return quality.dq_nulls(R.raw_products(spark, d), "product_id", "r_insert_timestamp",
                            PRODUCT_CHECK_COLUMNS)


@register("dq_findings", with_("raw_products") + f"{DUP_SQL}\nUNION ALL\n{FMT_SQL}\nUNION ALL\n{NULL_SQL}")
def q_dq_findings(spark, d):
    return quality.dq_findings(R.raw_products(spark, d), "product_id", "r_insert_timestamp", PRODUCT_RULES)


@register("dq_findings_logged", with_("raw_products") + f"""
SELECT *, {RUN_TS} AS logged_at FROM ({DUP_SQL}\nUNION ALL\n{FMT_SQL}\nUNION ALL\n{NULL_SQL}) f""")
def q_dq_findings_logged(spark, d):
    f = quality.dq_findings(R.raw_products(spark, d), "product_id", "r_insert_timestamp", PRODUCT_RULES)
    return quality.with_logged_at(f, RUN)


@register("dq_constraints", with_("raw_customers") + """
SELECT customer_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Null value in one or more columns' AS issue
FROM raw_customers WHERE customer_id IS NULL OR first_name IS NULL OR last_name IS NULL
UNION ALL
SELECT customer_id, r_insert_timestamp, 'Duplicate customer_id' FROM raw_customers
GROUP BY customer_id, r_insert_timestamp HAVING count(*) > 1
UNION ALL
SELECT r.customer_id, r.r_insert_timestamp, 'Duplicate email' FROM raw_customers r
WHERE r.email IS NOT NULL AND (SELECT count(*) FROM raw_customers x
      WHERE x.email = r.email AND x.r_insert_timestamp = r.r_insert_timestamp) > 1
UNION ALL
SELECT r.customer_id, r.r_insert_timestamp, 'Duplicate phone_number' FROM raw_customers r
WHERE r.phone_number IS NOT NULL AND (SELECT count(*) FROM raw_customers x
      WHERE x.phone_number = r.phone_number AND x.r_insert_timestamp = r.r_insert_timestamp) > 1
UNION ALL
SELECT customer_id, r_insert_timestamp, 'Invalid membership_status value' FROM raw_customers
WHERE membership_status NOT IN ('Gold', 'Silver', 'Bronze')""")
def q_dq_constraints(spark, d):
    raw = R.raw_customers(spark, d)
    rules = quality.constraint_rules(S.CUSTOMERS, raw.columns)
    return quality.dq_findings(raw, "customer_id", "r_insert_timestamp", rules)


@register("dq_quarantine", with_("raw_products") + f"""
SELECT r.* FROM raw_products r
WHERE NOT coalesce(NOT regexp_matches(r.price, '{NUM_RE}'), false)
  AND NOT ({NULL_PRED.replace('product_name', 'r.product_name')})
  AND NOT EXISTS (SELECT 1 FROM raw_products x
                  WHERE x.product_id IS NOT DISTINCT FROM r.product_id
                    AND x.r_insert_timestamp = r.r_insert_timestamp
                  GROUP BY x.product_id, x.r_insert_timestamp HAVING count(*) > 1)""")
def q_dq_quarantine(spark, d):
    passed, _ = quality.dq_gate(R.raw_products(spark, d), "product_id", "r_insert_timestamp",
                                PRODUCT_RULES, mode="quarantine")
    return passed


# ------------------------------------------------------- incremental reads
# The "already merged" target holds the first two ingest days.
CUT = "2024-01-02 00:00:00"


def _loaded_target(spark, d):
    raw = R.raw_products(spark, d)
    return typed(spark, d, "products", increment.incremental_batch(raw, upper=CUT))


@register("max_watermark", with_("raw_products") + f"""
SELECT max(r_insert_timestamp) AS max_batch_timestamp FROM raw_products
WHERE r_insert_timestamp <= TIMESTAMP '{CUT}'""")
def q_max_watermark(spark, d):
    return increment.watermark_df(_loaded_target(spark, d))


@register("incremental_batch", with_("raw_products") + f"""
SELECT * FROM raw_products
WHERE r_insert_timestamp > (SELECT max(r_insert_timestamp) FROM raw_products
                            WHERE r_insert_timestamp <= TIMESTAMP '{CUT}')
  AND r_insert_timestamp <= (SELECT max(r_insert_timestamp) FROM raw_products)""")
def q_incremental_batch(spark, d):
    """Read from a landed raw table, partitioned by ingest date as the ingest
    writes it: the bounds prune partitions and reach the scan."""
    from lakeloom.session import scratch_path
    path = scratch_path(spark, "raw-products")
    raw = R.raw_products(spark, d)
    raw.withColumn("r_insert_date", F.to_date("r_insert_timestamp")).write.partitionBy("r_insert_date").parquet(path)
    landed = spark.read.parquet(path)
    hwm = increment.max_watermark(_loaded_target(spark, d))
    hi = increment.pin_upper_bound(landed, after=hwm)
    return increment.incremental_batch(landed, hwm, hi).select(*raw.columns)


# ------------------------------------------------------------- SCD1 upserts
# Target: the harmonized mapping without the keys where ``key % 4 = 3``;
# source: every typed raw row of those keys (they arrive as inserts) and the
# rows newer than the first ingest day of the others (keys of day 0 stay
# untouched).  Every key is in the target or the source, so the result holds
# all of them.  Source NULLs (unparseable text) overwrite target values, as
# MERGE's SET does.
SCD1 = {
    # name: (harmonized reader, CTE, key, numeric key expression for the split)
    "products": (R.harmonized_products, "products", "product_id", "CAST(product_id AS BIGINT)"),
    "stores": (R.harmonized_stores, "stores", "store_id", "CAST(store_id AS BIGINT)"),
    "transactions": (R.harmonized_transactions, "transactions", "invoice_id", "CAST(invoice_id AS BIGINT)"),
    "line_items": (R.harmonized_line_items, "line_items", "line_item_id", "CAST(invoice_id AS BIGINT)"),
}


# the source's own number for the split (a line item's is its invoice's)
KNUM = {n: v[3] for n, v in SCD1.items()}


def _scd1_source(spark, d, name):
    """Typed raw rows of the absent keys, and the later days' of the others."""
    src = typed(spark, d, name)
    return src.where((F.col("batch_r_timestamp") > R.SEED_TS)
                     | (F.pmod(F.expr(KNUM[name]), F.lit(4)) == 3))


def _scd1_sql(name: str) -> str:
    reader, cte, key, knum = SCD1[name]
    spec = RAW_READERS[name][1]
    cols = [c.name for c in spec.columns if c.name not in scd1.AUDIT_TAIL]
    sel = [f"coalesce(t.{key}, s.{key}) AS {key}"]
    for c in cols:
        if c != key:
            sel.append(f"CASE WHEN s._here THEN s.{c} ELSE t.{c} END AS {c}")
    sel += [
        "CASE WHEN s._here THEN s.batch_r_timestamp ELSE t.batch_r_timestamp END AS batch_r_timestamp",
        f"CASE WHEN t._here THEN t.h_insert_timestamp ELSE {RUN_TS} END AS h_insert_timestamp",
        f"CASE WHEN s._here THEN {RUN_TS} ELSE t.h_update_timestamp END AS h_update_timestamp",
        f"CASE WHEN s._here THEN '{JOB}' ELSE t.job_id END AS job_id",
    ]
    src = f"SELECT * FROM ({TYPED_SQL[name]}) WHERE batch_r_timestamp > {SEED_TS} OR {KNUM[name]} % 4 = 3"
    if name == "products":  # re-sent rows: keep the latest batch per key
        src = f"SELECT * FROM ({src}) QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY batch_r_timestamp DESC) = 1"
    return (with_(cte, f"raw_{name}") + f""", tgt AS (SELECT *, true AS _here FROM {cte} WHERE {knum} % 4 <> 3),
src AS (SELECT *, true AS _here FROM ({src}))
SELECT {', '.join(sel)} FROM tgt t FULL OUTER JOIN src s ON t.{key} = s.{key}""")


def _scd1_query(name):
    reader, _, key, _ = SCD1[name]

    def q(spark, d):
        tgt = reader(spark, d)
        knum = F.col("invoice_id" if name == "line_items" else key).cast("bigint")
        tgt = tgt.where(F.pmod(knum, F.lit(4)) != 3)
        src = _scd1_source(spark, d, name)
        return scd1.scd1_upsert(tgt, src, key, run_ts=RUN, job_id=JOB,
                                on_duplicate="latest" if name == "products" else "error")
    q.__name__ = f"q_scd1_{name}"
    return q


for _n in SCD1:
    register(f"scd1_upsert_{_n}", _scd1_sql(_n))(_scd1_query(_n))


# --------------------------------------------------------------- SCD2 merge
# Target history: the two-version customer dimension, without customers
# ``k % 7 = 6`` (they arrive new) and with customers ``k % 11 = 5`` closed
# entirely (inactive only).  Source: typed raw customers newer than day 0 and
# every row of the absent ones, with 7 more loyalty points for ``k % 6 = 1`` (changed rows besides the
# re-tiered and re-numbered ones).

def _scd2_target(spark, d):
    t = R.customers_two_versions(spark, d)
    k = F.col("customer_id").cast("bigint")
    t = t.where(F.pmod(k, F.lit(7)) != 6)
    return t.withColumn("active_flag", F.when(F.pmod(k, F.lit(11)) == 5, F.lit(False))
                        .otherwise(F.col("active_flag")))


def _scd2_source(spark, d):
    k = F.col("customer_id").cast("bigint")
    src = typed(spark, d, "customers").where((F.col("batch_r_timestamp") > R.SEED_TS) | (F.pmod(k, F.lit(7)) == 6))
    return src.withColumn("loyalty_points", F.when(F.pmod(k, F.lit(6)) == 1, F.col("loyalty_points") + 7)
                          .otherwise(F.col("loyalty_points")))


SCD2_CTES = with_("customers2", "raw_customers") + f""", tgt AS (
  SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 11 = 5 THEN false ELSE active_flag END AS active_flag)
  FROM customers2 WHERE CAST(customer_id AS BIGINT) % 7 <> 6),
src0 AS (SELECT * FROM ({TYPED_SQL['customers']})
         WHERE batch_r_timestamp > {SEED_TS} OR CAST(customer_id AS BIGINT) % 7 = 6),
src AS (SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 6 = 1 THEN loyalty_points + 7
                                ELSE loyalty_points END AS loyalty_points) FROM src0),
hsrc AS (SELECT *, {hash_sql(scd2.TRACKED_CUSTOMER_COLUMNS)} AS hash_value FROM src),
hist AS (SELECT customer_id, max(CAST(active_flag AS INTEGER)) AS has_active,
                max(CASE WHEN active_flag THEN s_customer_key END) AS active_hash
         FROM tgt WHERE customer_id IN (SELECT customer_id FROM hsrc) GROUP BY customer_id),
chg AS (SELECT s.*, CASE WHEN h.has_active IS NULL THEN 'new' WHEN h.has_active = 0 THEN 'inactive_only'
                         WHEN h.active_hash IS NOT DISTINCT FROM s.hash_value THEN 'unchanged'
                         ELSE 'changed' END AS change_type
        FROM hsrc s LEFT JOIN hist h ON s.customer_id = h.customer_id)
"""


@register("scd2_change_set", SCD2_CTES + """
SELECT customer_id, hash_value, change_type,
       CASE WHEN change_type = 'new' THEN customer_id END AS merge_key FROM chg""")
def q_scd2_change_set(spark, d):
    ch = scd2.scd2_change_set(_scd2_target(spark, d), _scd2_source(spark, d))
    return ch.select("customer_id", "hash_value", "change_type", "merge_key")


@register("scd2_merge_customers", SCD2_CTES + f"""
SELECT t.customer_id, t.first_name, t.last_name, t.email, t.phone_number, t.loyalty_points,
       t.membership_status, t.address,
       CASE WHEN c.customer_id IS NOT NULL AND t.active_flag THEN false ELSE t.active_flag END AS active_flag,
       t.begin_effective_date,
       CASE WHEN c.customer_id IS NOT NULL AND t.active_flag THEN {AS_OF} ELSE t.end_effective_date END
         AS end_effective_date,
       t.s_customer_key, t.batch_r_timestamp, t.h_insert_timestamp, t.h_update_timestamp, t.job_id
FROM tgt t LEFT JOIN (SELECT customer_id FROM chg WHERE change_type = 'changed') c
  ON t.customer_id = c.customer_id
UNION ALL
SELECT customer_id, first_name, last_name, email, phone_number, loyalty_points, membership_status, address,
       true, {AS_OF}, DATE '9999-12-31', hash_value, batch_r_timestamp, {RUN_TS}, {RUN_TS}, 'scd2'
FROM chg WHERE change_type IN ('new', 'changed')""")
def q_scd2_merge_customers(spark, d):
    return scd2.scd2_merge(_scd2_target(spark, d), _scd2_source(spark, d), as_of=AS_OF_DATE, run_ts=RUN)


@register("row_hash", with_("raw_customers") + f"""
SELECT customer_id, {hash_sql(scd2.TRACKED_CUSTOMER_COLUMNS)} AS row_hash
FROM raw_customers""")
def q_row_hash(spark, d):
    from lakeloom.functions.hashing import row_hash
    return R.raw_customers(spark, d).select("customer_id", row_hash(*scd2.TRACKED_CUSTOMER_COLUMNS).alias("row_hash"))


# ---------------------------------------------------------------- governance
from lakeloom.operators import defaults as DF  # noqa: E402
from lakeloom.operators import governance, layout  # noqa: E402

CUSTOMER_COLS = ("customer_id, first_name, last_name, email, phone_number, loyalty_points, membership_status, "
                 "address, active_flag, begin_effective_date, end_effective_date, s_customer_key, "
                 "batch_r_timestamp, h_insert_timestamp, h_update_timestamp, job_id")


@register("masked_customers", with_("customers") + "SELECT " + CUSTOMER_COLS.replace(
    "email, phone_number", "'***' || substr(email, instr(email, '@')) AS email, '**********' AS phone_number").replace(
    "address, active_flag", "string_split(address, ',')[-1] AS address, active_flag") + " FROM customers")
def q_masked_customers(spark, d):
    return governance.masked_view(R.harmonized_customers(spark, d), roles=())


@register("masked_customers_crm", with_("customers") + f"SELECT {CUSTOMER_COLS} FROM customers")
def q_masked_customers_crm(spark, d):
    return governance.masked_view(R.harmonized_customers(spark, d), roles=("CRM", "Sales"))


@register("masked_customers_sql", with_("customers") + """
SELECT customer_id, '**********' AS phone_number, '***' || substr(email, instr(email, '@')) AS email,
       string_split(address, ',')[-1] AS address FROM customers""")
def q_masked_customers_sql(spark, d):
    """The SQL-function form: ``masking_*`` registered for a caller without the role."""
    from lakeloom.functions.masks import register_mask_functions
    register_mask_functions(spark, roles=())
    R.harmonized_customers(spark, d).createOrReplaceTempView("lakeloom_customers")
    return spark.sql("""SELECT customer_id, masking_phone(phone_number) AS phone_number,
                        masking_email(email) AS email, masking_address(address) AS address
                        FROM lakeloom_customers""")


@register("masked_by_tag", with_("customers") + "SELECT " + CUSTOMER_COLS.replace(
    "email, phone_number", "'***' || substr(email, instr(email, '@')) AS email, '**********' AS phone_number").replace(
    "last_name,", "'**********' AS last_name,") + " FROM customers")
def q_masked_by_tag(spark, d):
    """Customers through a view whose masks follow the catalog's column tags: as
    declared, but with the address untagged and the last name tagged as a phone."""
    import uuid
    from dataclasses import replace

    from lakeloom.plans.catalog import create_table
    from lakeloom.session import scratch_path
    spec = replace(S.CUSTOMERS, schema=f"lakeloom_{uuid.uuid4().hex[:12]}")
    path = scratch_path(spark, "t_customers")
    R.harmonized_customers(spark, d).select(*spec.names).write.parquet(path)
    create_table(spark, spec, location=path)
    governance.set_column_tag(spark, spec.qualified, "address", "pii", None)
    governance.set_column_tag(spark, spec.qualified, "last_name", "pii", "phone")
    return governance.masked_by_tags(spark.table(spec.qualified), governance.catalog_column_tags(spark, spec.schema),
                                     spec.qualified, roles=())


# ------------------------------------------------------------ column defaults
def _defaults_input(spark, d):
    src = typed(spark, d, "customers").drop("membership_status")
    k = F.col("customer_id").cast("bigint")
    return src.withColumn("loyalty_points", F.when(F.pmod(k, F.lit(9)) == 0, F.lit(None).cast("int"))
                          .otherwise(F.col("loyalty_points")))


DEFAULT_COLS = ["customer_id", "loyalty_points", "membership_status", "active_flag",
                "begin_effective_date", "end_effective_date"]


def _defaults_sql(fill: bool) -> str:
    lp = "coalesce(loyalty_points, 0)" if fill else "loyalty_points"
    return with_("raw_customers") + f"""
SELECT customer_id, {lp} AS loyalty_points, 'Bronze' AS membership_status, true AS active_flag,
       {AS_OF} AS begin_effective_date, DATE '9999-12-31' AS end_effective_date
FROM (SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 9 = 0 THEN NULL
                               ELSE TRY_CAST(loyalty_points AS INTEGER) END AS loyalty_points
      FROM raw_customers) x"""


@register("column_defaults", _defaults_sql(False))
def q_column_defaults(spark, d):
    out = DF.apply_defaults(_defaults_input(spark, d), S.CUSTOMERS, as_of=AS_OF_DATE, run_ts=RUN)
    return out.select(*DEFAULT_COLS)


@register("column_defaults_fill", _defaults_sql(True))
def q_column_defaults_fill(spark, d):
    out = DF.apply_defaults(_defaults_input(spark, d), S.CUSTOMERS, as_of=AS_OF_DATE, run_ts=RUN,
                            fill_nulls=True)
    return out.select(*DEFAULT_COLS)


# --------------------------------------------------------------- z-order
@register("zorder_facts", with_("facts") + "SELECT * FROM facts")
def q_zorder_facts(spark, d):
    """The stored month-partitioned fact table, clustered: files from its bytes
    (small here, so that the small table still makes several)."""
    from lakeloom.plans.publish import write_partitioned
    from lakeloom.session import scratch_path
    path = scratch_path(spark, "t_sales_facts")
    write_partitioned(sales_facts_df(spark, d), path, "transaction_month", order_col=("invoice_id", "line_item_id"))
    stored = spark.read.schema(S.SALES_FACTS.struct()).parquet(path)
    n = layout.files_for(spark, path, target_bytes=1024 * 1024)
    return layout.cluster_by_zorder(stored, ["customer_id", "product_id", "store_id"], n_files=n,
                                    partition_col="transaction_month").select(*facts.FACT_COLUMNS)


@register("zorder_compacted_facts", with_("facts") + "SELECT * FROM facts")
def q_zorder_compacted_facts(spark, d):
    """Three loads of the facts, each one segment a month, then a compaction that
    packs small segments and unstacks deep ones (target small here, so that the
    first load's segments are left alone)."""
    import uuid

    from lakeloom.plans.segments import SegmentedTable
    from lakeloom.session import scratch_path
    table = SegmentedTable(spark, f"lakeloom_{uuid.uuid4().hex[:12]}.t_sales_facts", S.SALES_FACTS.struct(),
                           scratch_path(spark, "segments"), "transaction_month",
                           ["customer_id", "product_id", "store_id"], target_bytes=64 * 1024)
    rows = sales_facts_df(spark, d)         # a load joins its own invoices only
    load = F.coalesce(F.pmod(F.col("invoice_id").cast("bigint"), F.lit(8)), F.lit(0))
    table.append(rows.where(load < 6), 1)
    table.append(rows.where(load == 6), 2)
    table.append(rows.where(load == 7), 3)
    table.compact(4)
    return table.read().select(*facts.FACT_COLUMNS)


# ---------------------------------------------------------- file ingest
def _quarantine_sql(src: str) -> str:
    """Rows of CTE ``src`` that pass the product rules (quarantine mode)."""
    return f"""SELECT r.* FROM {src} r
WHERE NOT coalesce(NOT regexp_matches(r.price, '{NUM_RE}'), false)
  AND NOT ({NULL_PRED.replace('product_name', 'r.product_name')})
  AND NOT EXISTS (SELECT 1 FROM {src} x
                  WHERE x.product_id IS NOT DISTINCT FROM r.product_id
                    AND x.r_insert_timestamp = r.r_insert_timestamp
                  GROUP BY x.product_id, x.r_insert_timestamp HAVING count(*) > 1)"""


STORE_RAW_COLS = ("store_id", "store_name", "location", "manager_id", "opening_date")


@register("ingest_csv_incremental", with_("raw_stores") + """
SELECT store_id, store_name, location, manager_id, opening_date FROM raw_stores
UNION ALL
SELECT store_id, store_name || ', renamed', location, manager_id, opening_date FROM raw_stores
WHERE CAST(store_id AS BIGINT) % 3 = 0""")
def q_ingest_csv_incremental(spark, d):
    """Land stores as CSV in two day folders, ingest; ingest again (nothing
    new); land a third folder of renamed stores (a quoted comma in every
    name), ingest; return the raw table's business columns."""
    from lakeloom.session import scratch_path
    from lakeloom.streaming.file_ingest import ingest_files, read_raw
    base = scratch_path(spark, "ingest")
    stores = R.raw_stores(spark, d).select(*STORE_RAW_COLS)
    k = F.col("store_id").cast("bigint")
    csv = {"header": True, "quoteAll": False}
    stores.where(F.pmod(k, F.lit(2)) == 0).write.options(**csv).csv(f"{base}/landing/partition_1")
    stores.where(F.pmod(k, F.lit(2)) == 1).write.options(**csv).csv(f"{base}/landing/partition_2")
    glob, target, ckpt = f"{base}/landing/partition_*/*.csv", f"{base}/raw/t_stores", f"{base}/ckpt"
    ingest_files(spark, glob, STORE_RAW_COLS, target, ckpt)
    ingest_files(spark, glob, STORE_RAW_COLS, target, ckpt)        # re-run: no new files
    (stores.where(F.pmod(k, F.lit(3)) == 0)
     .withColumn("store_name", F.concat("store_name", F.lit(", renamed")))
     .write.options(**csv).csv(f"{base}/landing/partition_3"))
    ingest_files(spark, glob, STORE_RAW_COLS, target, ckpt)
    return read_raw(spark, target, STORE_RAW_COLS).select(*STORE_RAW_COLS)


# ------------------------------------------------------ end-to-end harmonize
RUN1, RUN2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


def _typed_products_sql(src: str, run_ts: str) -> str:
    return f"""SELECT product_id, product_name, brand, category, gender, size, color,
       TRY_CAST(price AS DECIMAL(10,2)) AS price, TRY_CAST(availability AS INTEGER) AS availability,
       TRY_CAST(added_date AS DATE) AS added_date, TRY_CAST(is_active AS BOOLEAN) AS is_active,
       r_insert_timestamp AS batch_r_timestamp, TIMESTAMP '{run_ts}' AS h_insert_timestamp,
       TIMESTAMP '{run_ts}' AS h_update_timestamp, '{JOB}' AS job_id
FROM ({src}) QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY r_insert_timestamp DESC) = 1"""


PRODUCT_VALUE_COLS = ("product_name", "brand", "category", "gender", "size", "color", "price",
                      "availability", "added_date", "is_active")

HARMONIZE_SQL = with_("raw_products") + f""",
b1 AS (SELECT * FROM raw_products WHERE r_insert_timestamp <= {SEED_TS}),
t1 AS ({_typed_products_sql(_quarantine_sql('b1'), RUN1)}),
b2 AS (SELECT * FROM raw_products
       WHERE r_insert_timestamp > (SELECT max(batch_r_timestamp) FROM t1)
         AND r_insert_timestamp <= (SELECT max(r_insert_timestamp) FROM raw_products)),
t2 AS ({_typed_products_sql(_quarantine_sql('b2'), RUN2)})
SELECT coalesce(t.product_id, s.product_id) AS product_id,
       {', '.join(f'CASE WHEN s.product_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in PRODUCT_VALUE_COLS)},
       CASE WHEN s.product_id IS NOT NULL THEN s.batch_r_timestamp ELSE t.batch_r_timestamp END AS batch_r_timestamp,
       CASE WHEN t.product_id IS NOT NULL THEN t.h_insert_timestamp ELSE TIMESTAMP '{RUN2}' END AS h_insert_timestamp,
       CASE WHEN s.product_id IS NOT NULL THEN TIMESTAMP '{RUN2}' ELSE t.h_update_timestamp END AS h_update_timestamp,
       '{JOB}' AS job_id
FROM t1 t FULL OUTER JOIN t2 s ON t.product_id = s.product_id"""


@register("harmonize_products", HARMONIZE_SQL)
def q_harmonize_products(spark, d):
    """Two daily runs of the products job: first load up to the first ingest
    day into an empty table, then everything newer; quarantine mode."""
    from lakeloom.plans.publish import cut_lineage
    from lakeloom.plans.harmonize import TableJob, harmonize
    job = TableJob(S.PRODUCTS, rules=PRODUCT_RULES, mode="quarantine")
    raw = R.raw_products(spark, d)
    first = harmonize(job, raw, None, RUN1, JOB, upper=R.SEED_TS)
    state = cut_lineage(spark, first.state)          # the daily run writes its table
    second = harmonize(job, raw, state, RUN2, JOB)
    return second.state


@register("harmonize_run_log", with_("raw_products") + f""",
b1 AS (SELECT * FROM raw_products WHERE r_insert_timestamp <= {SEED_TS}),
b2 AS (SELECT * FROM raw_products WHERE r_insert_timestamp > {SEED_TS}),
f AS ({DUP_SQL}\nUNION ALL\n{FMT_SQL}\nUNION ALL\n{NULL_SQL})
SELECT 1 AS run_no, (SELECT max(r_insert_timestamp) FROM ({_quarantine_sql('b1')})) AS watermark,
       (SELECT count(*) FROM b1) AS n_rows, (SELECT count(*) FROM f WHERE r_batch_timestamp <= {SEED_TS}) AS n_findings
UNION ALL
SELECT 2, (SELECT max(r_insert_timestamp) FROM ({_quarantine_sql('b2')})), (SELECT count(*) FROM b2),
       (SELECT count(*) FROM f WHERE r_batch_timestamp > {SEED_TS})""")
def q_harmonize_run_log(spark, d):
    """The run log of two runs of the products job: rows read, findings logged and
    the new watermark, each taken while something else was written."""
    from lakeloom.plans.harmonize import RunLog, TableJob, harmonize
    from lakeloom.plans.located import ByInsertRun
    from lakeloom.session import scratch_path
    job, place = TableJob(S.PRODUCTS, rules=PRODUCT_RULES, mode="quarantine"), ByInsertRun()
    table, base = _located(spark, "t_products", place, S.PRODUCTS, "product_id"), scratch_path(spark, "run-log")
    log = RunLog(spark, f"{base}/run_log")
    for run, upper in ((1, R.SEED_TS), (2, None)):
        result = harmonize(job, R.raw_products(spark, d), table.before(run), RUN, JOB, upper=upper, run_log=log, table_name="t_products",
                           dq_log_path=f"{base}/dq_log", placement=place, run_no=run)
        table.publish(result.state, run, result.touched)
        log.record("t_products", result, RUN, run)
    return spark.read.schema(log.SCHEMA).parquet(log.path).select("run_no", "watermark", "n_rows", "n_findings")


# --------------------------------------------- SQL views and the facts refresh
def _register_retail_views(spark, d) -> None:
    sales_facts_df(spark, d).createOrReplaceTempView("lakeloom_sales_facts")
    R.harmonized_customers(spark, d).createOrReplaceTempView("lakeloom_customers")
    R.harmonized_products(spark, d).createOrReplaceTempView("lakeloom_products")


def _view_query(view):
    def q(spark, d):
        from lakeloom.plans.catalog import create_curated_views
        _register_retail_views(spark, d)
        create_curated_views(spark, "lakeloom_sales_facts", "lakeloom_customers", "lakeloom_products",
                             temporary=True)
        return spark.table(view)
    q.__name__ = f"q_{view}"
    return q


register("curated_view_customer_summary", ORACLE["customer_summary"])(_view_query("v_customer_summary"))
register("curated_view_product_sales_summary", ORACLE["product_sales_summary"])(
    _view_query("v_product_sales_summary"))
register("curated_view_customer_store_loyalty", ORACLE["customer_store_loyalty"])(
    _view_query("v_customer_store_loyalty"))


def _persistent_view_query(view):
    def q(spark, d):
        import uuid

        from lakeloom.plans.catalog import create_curated_views
        from lakeloom.session import scratch_path
        schema = f"lakeloom_{uuid.uuid4().hex[:12]}"      # a schema of its own, stored in the shared folder
        base = scratch_path(spark, "schema")
        spark.sql(f"CREATE SCHEMA {schema} LOCATION '{base}'")
        for name, df in (("t_sales_facts", sales_facts_df(spark, d)), ("t_customers", R.harmonized_customers(spark, d)),
                         ("t_products", R.harmonized_products(spark, d))):
            df.write.option("path", f"{base}/{name}").saveAsTable(f"{schema}.{name}")
        create_curated_views(spark, f"{schema}.t_sales_facts", f"{schema}.t_customers", f"{schema}.t_products", schema)
        return spark.table(f"{schema}.{view}")
    q.__name__ = f"q_persistent_{view}"
    return q


for _v in ("customer_summary", "product_sales_summary", "customer_store_loyalty"):
    register(f"curated_view_persistent_{_v}", ORACLE[_v])(_persistent_view_query(f"v_{_v}"))


HARMONIZE_OMITTED_SQL = with_("raw_customers") + f"""
SELECT customer_id, TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, 'Bronze' AS membership_status
FROM raw_customers WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY r_insert_timestamp DESC) = 1"""


@register("harmonize_omitted_columns", HARMONIZE_OMITTED_SQL)
def q_harmonize_omitted_columns(spark, d):
    """The customers job as an upsert over a raw table without
    ``membership_status``: first load of the first ingest day, then the rest;
    inserts take the declared default in both."""
    from lakeloom.plans.harmonize import TableJob, harmonize
    from lakeloom.session import cut_lineage
    job = TableJob(S.CUSTOMERS)
    raw = R.raw_customers(spark, d).drop("membership_status").where("customer_id IS NOT NULL")
    first = cut_lineage(spark, harmonize(job, raw, None, RUN1, JOB, as_of="2025-01-01", upper=R.SEED_TS).state)
    return harmonize(job, raw, first, RUN2, JOB, as_of="2025-01-02").state.select(
        "customer_id", "loyalty_points", "membership_status")


@register("sales_facts_refresh", with_("facts") + "SELECT * FROM facts")
def q_sales_facts_refresh(spark, d):
    """Full refresh (INSERT OVERWRITE) of the month-partitioned fact table in
    the shared scratch folder, read back from disk."""
    from lakeloom.plans.publish import write_partitioned
    from lakeloom.session import scratch_path
    path = scratch_path(spark, "t_sales_facts")
    write_partitioned(sales_facts_df(spark, d), path, "transaction_month", order_col=("invoice_id", "line_item_id"))
    out = spark.read.parquet(path)
    return out.select(*facts.FACT_COLUMNS)


# ---------------------------------------------- cast failures as DQ findings
@register("dq_cast_failures", with_("raw_transactions", "raw_line_items") + """
SELECT invoice_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Value does not parse to its declared type' AS issue
FROM raw_transactions
WHERE (transaction_date_time IS NOT NULL AND TRY_CAST(transaction_date_time AS TIMESTAMP) IS NULL)
   OR (total_amount IS NOT NULL AND TRY_CAST(total_amount AS DECIMAL(10,2)) IS NULL)
UNION ALL
SELECT line_item_id, r_insert_timestamp, 'Value does not parse to its declared type'
FROM raw_line_items
WHERE (quantity IS NOT NULL AND TRY_CAST(quantity AS INTEGER) IS NULL)
   OR (unit_price IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL)
   OR (total_price IS NOT NULL AND TRY_CAST(total_price AS DECIMAL(10,2)) IS NULL)
   OR (discount_applied IS NOT NULL AND TRY_CAST(discount_applied AS DECIMAL(10,2)) IS NULL)""")
def q_dq_cast_failures(spark, d):
    tx = quality.dq_findings(R.raw_transactions(spark, d), "invoice_id", "r_insert_timestamp",
                             [quality.Castable(S.TRANSACTIONS)])
    li = quality.dq_findings(R.raw_line_items(spark, d), "line_item_id", "r_insert_timestamp",
                             [quality.Castable(S.LINE_ITEMS)])
    return tx.unionByName(li)


# ------------------------------- SCD1 on a month-partitioned table, in place
@register("scd1_partitioned_transactions", ORACLE["scd1_upsert_transactions"])
def q_scd1_partitioned_transactions(spark, d):
    """The transactions upsert run against a month-partitioned parquet table:
    only partitions the batch touches (new months and the old months of
    updated keys) are rewritten, by a dynamic partition overwrite from a
    staged copy; the whole table is then read back."""
    from lakeloom.plans.publish import overwrite_partitions, write_partitioned
    from lakeloom.session import scratch_path
    path = scratch_path(spark, "t_sales_transactions")
    tgt = R.harmonized_transactions(spark, d)
    tgt = tgt.where(F.pmod(F.col("invoice_id").cast("bigint"), F.lit(4)) != 3)
    write_partitioned(tgt, path, "transaction_month", order_col="invoice_id")
    src = _scd1_source(spark, d, "transactions")
    table = spark.read.parquet(path)
    touched = scd1.touched_partitions(table, src, "invoice_id", "transaction_month")
    new_parts = scd1.scd1_upsert(scd1.restrict_to(table, "transaction_month", touched), src, "invoice_id",
                                 run_ts=RUN, job_id=JOB)
    overwrite_partitions(spark, new_parts, path, "transaction_month", touched=touched)
    return spark.read.parquet(path).select(*[c.name for c in S.TRANSACTIONS.columns])


# --------------------------------------- streaming: files -> gate -> upsert
def _stream_products(spark, d):
    """Raw products land as CSV, one folder per ingest day; after each landing an
    ``availableNow`` stream runs the products job on the new files via
    ``foreachBatch``: raw rows landed, findings logged, held-back rows kept in
    the quarantine table, the rest upserted into the partitions that hold their
    keys."""
    from lakeloom.plans.harmonize import TableJob
    from lakeloom.plans.located import ByInsertRun
    from lakeloom.session import scratch_path
    from lakeloom.streaming.file_ingest import harmonize_files
    base = scratch_path(spark, "stream-products")
    raw = R.raw_products(spark, d)
    cols = list(S.RAW_COLUMNS["t_products"])
    job = TableJob(S.PRODUCTS, rules=PRODUCT_RULES, mode="quarantine")
    place = ByInsertRun()
    state = _located(spark, "t_products", place, S.PRODUCTS, "product_id")
    marks = (None, R.SEED_TS, CUT, "2024-01-03 00:00:00", None)
    for i, (lo, hi) in enumerate(zip(marks, marks[1:])):                # four landings
        increment.incremental_batch(raw, lo, hi).select(*cols).write.option("header", True).csv(f"{base}/landing/day_{i}")
        harmonize_files(spark, f"{base}/landing/day_*/*.csv", cols, f"{base}/ckpt", job, state, JOB,
                        f"{base}/raw", f"{base}/dq_log", f"{base}/quarantine", placement=place)
    return base, state


@register("harmonize_stream_products", with_("raw_products") + f"""
SELECT product_id, product_name, brand, category, gender, size, color,
       TRY_CAST(price AS DECIMAL(10,2)) AS price, TRY_CAST(availability AS INTEGER) AS availability,
       TRY_CAST(added_date AS DATE) AS added_date, TRY_CAST(is_active AS BOOLEAN) AS is_active,
       '{JOB}' AS job_id
FROM ({_quarantine_sql('raw_products')})
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY r_insert_timestamp DESC) = 1""")
def q_harmonize_stream_products(spark, d):
    """The stream's state.  Run stamps are wall-clock here, so the result is
    compared on the business columns."""
    out = _stream_products(spark, d)[1].current()
    return out.select("product_id", *PRODUCT_VALUE_COLS, "job_id")


RAW_PRODUCT_COLS = ", ".join(S.RAW_COLUMNS["t_products"])


@register("stream_quarantined_rows", with_("raw_products") + f"""
SELECT * REPLACE (nullif(price, '') AS price) FROM (      -- an empty CSV field is read as NULL
  SELECT {RAW_PRODUCT_COLS} FROM raw_products EXCEPT ALL
  SELECT {RAW_PRODUCT_COLS} FROM ({_quarantine_sql('raw_products')}) p) x""")
def q_stream_quarantined_rows(spark, d):
    """The rows the stream's gate held back, read from its quarantine table."""
    from lakeloom.streaming.file_ingest import read_epochs
    return read_epochs(spark, f"{_stream_products(spark, d)[0]}/quarantine").select(*S.RAW_COLUMNS["t_products"])


@register("dq_log_appended", with_("raw_products") + f"""
SELECT *, {RUN_TS} AS logged_at FROM ({DUP_SQL}\nUNION ALL\n{FMT_SQL}\nUNION ALL\n{NULL_SQL}) f""")
def q_dq_log_appended(spark, d):
    """All findings appended to the log by two runs over the same batch (the
    second adds nothing), read back."""
    from lakeloom.plans.harmonize import log_once
    from lakeloom.session import scratch_path
    path = scratch_path(spark, "dq_log")
    for _ in range(2):
        f = quality.dq_findings(R.raw_products(spark, d), "product_id", "r_insert_timestamp", PRODUCT_RULES)
        log_once(f, RUN, path)
    return spark.read.parquet(path)


@register("dq_conflicts", with_("raw_customers") + f"""
, sent AS (SELECT customer_id, r_insert_timestamp, address FROM raw_customers
  UNION ALL SELECT customer_id, r_insert_timestamp, CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN 'moved' ELSE address END
  FROM raw_customers WHERE CAST(customer_id AS BIGINT) % 29 < 2)
SELECT customer_id AS unique_identifier, r_insert_timestamp AS r_batch_timestamp,
       'Conflicting rows for customer_id' AS issue
FROM sent GROUP BY customer_id, r_insert_timestamp HAVING count(DISTINCT coalesce(address, chr(2))) > 1""")
def q_dq_conflicts(spark, d):
    """Customers of which some are sent twice in one batch: the even ones with
    another address (a conflict), the odd ones unchanged (none)."""
    raw = R.raw_customers(spark, d)
    number = F.col("customer_id").cast("bigint")
    again = raw.where(number % 29 < 2).withColumn("address", F.when(number % 2 == 0, "moved").otherwise(F.col("address")))
    sent = raw.unionByName(again)
    return quality.dq_findings(sent, "customer_id", "r_insert_timestamp", [quality.Conflict(("address",))])


def _history_sql(column: str) -> str:
    return f"""SELECT r.customer_id AS unique_identifier, r.r_insert_timestamp AS r_batch_timestamp,
       '{column} belongs to another customer_id' AS issue FROM raw_customers r
WHERE r.r_insert_timestamp > {SEED_TS} AND EXISTS (SELECT 1 FROM raw_customers x WHERE x.{column} = r.{column}
      AND x.r_insert_timestamp < r.r_insert_timestamp AND x.customer_id IS DISTINCT FROM r.customer_id)"""


@register("dq_constraints_history", with_("raw_customers") + f"{_history_sql('email')}\nUNION ALL\n{_history_sql('phone_number')}")
def q_dq_constraints_history(spark, d):
    """UNIQUE against stored state: the first ingest day's customers are stored,
    the later days' batches share phone numbers with them and with each other."""
    raw = R.raw_customers(spark, d)
    first = F.col("r_insert_timestamp") == F.lit(R.SEED_TS).cast("timestamp_ntz")
    stored = cast_to_spec(raw.where(first), S.CUSTOMERS, RUN, JOB)
    return quality.history_findings(raw.where(~first), stored, "customer_id", "r_insert_timestamp", S.CUSTOMERS)


# ------------------------------------------- ingest that holds malformed lines
def _checked_stores(spark, d):
    """Stores landed as CSV in three loads: in declared order; with the columns in
    reverse; and, for every third store, malformed lines (an id alone, a field too
    many) and a file with an unknown header.  Returns the raw table and folder."""
    import uuid
    from dataclasses import replace

    from lakeloom.session import scratch_path
    from lakeloom.streaming.checked_ingest import ingest_checked
    base = scratch_path(spark, "checked")
    spec = replace(S.raw_spec("t_stores"), schema=f"lakeloom_{uuid.uuid4().hex[:12]}")
    stores, k = R.raw_stores(spark, d).select(*STORE_RAW_COLS), F.col("store_id").cast("bigint")

    def land(rows, folder, columns):
        rows.select(*columns).write.option("header", True).csv(f"{base}/landing/{folder}")

    def land_lines(line, header, folder, rows):      # whole lines under a header line (no field holds \x01)
        rows.select(line.alias(header)).write.option("header", True).option("sep", "\x01").csv(f"{base}/landing/{folder}")

    def load():
        ingest_checked(spark, f"{base}/landing/*/*.csv", spec, f"{base}/raw", f"{base}/ledger")

    land(stores.where(F.pmod(k, F.lit(2)) == 0), "declared", STORE_RAW_COLS)
    load()
    land(stores.where(F.pmod(k, F.lit(2)) == 1), "reversed", STORE_RAW_COLS[::-1])
    load()
    third = stores.where(F.pmod(k, F.lit(3)) == 0)
    land_lines(F.col("store_id"), ",".join(STORE_RAW_COLS), "short", third)
    land_lines(F.concat("store_id", F.lit(",a,b,c,d,e")), ",".join(STORE_RAW_COLS), "long", third)
    land_lines(F.concat("store_id", F.lit(",x")), "store_id,nickname", "unknown", third)
    load()
    load()                                            # nothing new
    return spark.table(spec.qualified), f"{base}/raw"


@register("ingest_malformed_rows", with_("raw_stores") + """
SELECT store_id AS line, 'Wrong number of fields' AS reason FROM raw_stores WHERE CAST(store_id AS BIGINT) % 3 = 0
UNION ALL SELECT store_id || ',a,b,c,d,e', 'Wrong number of fields' FROM raw_stores WHERE CAST(store_id AS BIGINT) % 3 = 0
UNION ALL SELECT store_id || ',x', 'Unknown header' FROM raw_stores WHERE CAST(store_id AS BIGINT) % 3 = 0""")
def q_ingest_malformed_rows(spark, d):
    from lakeloom.streaming.checked_ingest import held_lines
    return held_lines(spark, _checked_stores(spark, d)[1]).select("line", "reason")


@register("ingest_mapped_rows", with_("raw_stores") + """
SELECT store_id, store_name, location, manager_id, opening_date, CAST(store_id AS BIGINT) % 2 AS load, 1 AS n_stamps
FROM raw_stores""")
def q_ingest_mapped_rows(spark, d):
    """The rows that landed, by name whatever the file's column order, with their
    load and the number of ingest stamps that load has."""
    table = _checked_stores(spark, d)[0]
    stamps = table.groupBy("r_batch").agg(F.countDistinct("r_insert_timestamp").cast("int").alias("n_stamps"))
    return table.join(stamps, "r_batch").select(*STORE_RAW_COLS, F.col("r_batch").alias("load"), "n_stamps")


@register("incremental_by_ledger", with_("raw_products") + f"""
SELECT product_id, r_insert_timestamp, CASE WHEN r_insert_timestamp <= TIMESTAMP '{CUT}'
       AND CAST(product_id AS BIGINT) % 5 <> 2 THEN 1 ELSE 2 END AS run FROM raw_products""")
def q_incremental_by_ledger(spark, d):
    """Two runs by file ledger.  The files of every fifth product land after the
    first run with stamps it has already read, the watermark's own among them;
    the second run reads exactly these and what is newer."""
    from lakeloom.session import scratch_path
    k = F.col("product_id").cast("bigint")
    raw = R.raw_products(spark, d).withColumn("r_source_file", F.concat(
        F.lit("part-"), F.pmod(k, F.lit(5)).cast("string"), F.lit("/"), F.to_date("r_insert_timestamp").cast("string")))
    ledger = increment.FileLedger(spark, scratch_path(spark, "files"))
    early, files = ledger.batch(raw.where((F.col("r_insert_timestamp") <= F.lit(CUT).cast("timestamp_ntz"))
                                          & (F.pmod(k, F.lit(5)) != 2)), 1)
    ledger.record(files, 1)
    late = ledger.batch(raw, 2)[0]
    cols = ("product_id", "r_insert_timestamp")
    return early.select(*cols, F.lit(1).alias("run")).unionByName(late.select(*cols, F.lit(2).alias("run")))


# ------------------------------------------------- merge: NULL keys, several batches
@register("scd1_null_keys", with_("stores", "raw_stores") + f"""
, src AS (SELECT * FROM ({TYPED_SQL['stores']})),
tgt AS (SELECT * FROM stores)
SELECT t.* FROM tgt t WHERE t.store_id NOT IN (SELECT store_id FROM src WHERE CAST(store_id AS BIGINT) % 5 <> 0)
UNION ALL
SELECT s.store_id, s.store_name, s.location, s.manager_id, s.opening_date, s.batch_r_timestamp, t.h_insert_timestamp,
       {RUN_TS}, '{JOB}' FROM src s JOIN tgt t ON s.store_id = t.store_id WHERE CAST(s.store_id AS BIGINT) % 5 <> 0
UNION ALL
SELECT NULL, store_name, location, manager_id, opening_date, batch_r_timestamp, {RUN_TS}, {RUN_TS}, '{JOB}'
FROM src WHERE CAST(store_id AS BIGINT) % 5 = 0""")
def q_scd1_null_keys(spark, d):
    """The stores upsert with the key of every fifth source row lost: these
    match nothing and are all inserted, in ``latest`` mode too."""
    src = typed(spark, d, "stores")
    key = F.when(F.pmod(F.col("store_id").cast("bigint"), F.lit(5)) != 0, F.col("store_id"))
    return scd1.scd1_upsert(R.harmonized_stores(spark, d), src.withColumn("store_id", key), "store_id", run_ts=RUN,
                            job_id=JOB, on_duplicate="latest")


# -------------------------------------------- end-to-end SCD2 (customers job)
def _raw_customers_resent(spark, d):
    """Raw customers plus, on the third ingest day, a re-send of every
    ``k % 4 = 1`` customer of the first day with 50 more loyalty points."""
    raw = R.raw_customers(spark, d)
    k = F.col("customer_id").cast("bigint")
    resent = (raw.where((F.col("r_insert_timestamp") == F.lit(R.SEED_TS).cast("timestamp_ntz"))
                        & (F.pmod(k, F.lit(4)) == 1))
              .withColumn("loyalty_points", (F.col("loyalty_points").try_cast("int") + 50).cast("string"))
              .withColumn("r_insert_timestamp",
                          F.timestamp_add("DAY", F.lit(2), F.col("r_insert_timestamp"))))
    return raw.unionByName(resent)


_CUST_TYPED = """customer_id, first_name, last_name, email, phone_number,
       TRY_CAST(loyalty_points AS INTEGER) AS loyalty_points, membership_status, address,
       r_insert_timestamp AS batch_r_timestamp"""
_H = hash_sql(scd2.TRACKED_CUSTOMER_COLUMNS)
_SCD2_COLS = ("customer_id, first_name, last_name, email, phone_number, loyalty_points, membership_status, "
              "address")

HARMONIZE_SCD2_SQL = with_("raw_customers") + f""",
rc AS (SELECT * FROM raw_customers
       UNION ALL
       SELECT customer_id, first_name, last_name, email, phone_number,
              CAST(TRY_CAST(loyalty_points AS INTEGER) + 50 AS VARCHAR), membership_status, address,
              update_timestamp, r_insert_timestamp + INTERVAL 2 DAY
       FROM raw_customers WHERE r_insert_timestamp = {SEED_TS} AND CAST(customer_id AS BIGINT) % 4 = 1),
b1 AS (SELECT {_CUST_TYPED} FROM rc WHERE r_insert_timestamp <= {SEED_TS}),
s1 AS (SELECT {_SCD2_COLS}, true AS active_flag, DATE '2025-01-01' AS begin_effective_date,
              DATE '9999-12-31' AS end_effective_date, {_H} AS s_customer_key, batch_r_timestamp,
              TIMESTAMP '{RUN1}' AS h_insert_timestamp, TIMESTAMP '{RUN1}' AS h_update_timestamp,
              '{JOB}' AS job_id
       FROM b1),
b2 AS (SELECT {_CUST_TYPED} FROM rc
       WHERE r_insert_timestamp > (SELECT max(batch_r_timestamp) FROM s1)
         AND r_insert_timestamp <= (SELECT max(r_insert_timestamp) FROM rc)),
h2 AS (SELECT *, {_H} AS hash_value FROM b2),
chg AS (SELECT h2.*, CASE WHEN s1.customer_id IS NULL THEN 'new'
                          WHEN s1.s_customer_key = h2.hash_value THEN 'unchanged' ELSE 'changed' END AS change_type
        FROM h2 LEFT JOIN s1 ON h2.customer_id = s1.customer_id)
SELECT s1.customer_id, s1.first_name, s1.last_name, s1.email, s1.phone_number, s1.loyalty_points,
       s1.membership_status, s1.address,
       CASE WHEN c.customer_id IS NOT NULL THEN false ELSE s1.active_flag END AS active_flag,
       s1.begin_effective_date,
       CASE WHEN c.customer_id IS NOT NULL THEN DATE '2025-01-02' ELSE s1.end_effective_date END AS end_effective_date,
       s1.s_customer_key, s1.batch_r_timestamp, s1.h_insert_timestamp, s1.h_update_timestamp, s1.job_id
FROM s1 LEFT JOIN (SELECT customer_id FROM chg WHERE change_type = 'changed') c ON s1.customer_id = c.customer_id
UNION ALL
SELECT {_SCD2_COLS}, true, DATE '2025-01-02', DATE '9999-12-31', hash_value, batch_r_timestamp,
       TIMESTAMP '{RUN2}', TIMESTAMP '{RUN2}', '{JOB}'
FROM chg WHERE change_type IN ('new', 'changed')"""


@register("harmonize_customers_scd2", HARMONIZE_SCD2_SQL)
def q_harmonize_customers_scd2(spark, d):
    """The customers SCD2 job twice: first load of the first ingest day into
    an empty history, then the later days (new customers and re-sent,
    changed ones) one day later."""
    from lakeloom.plans.publish import cut_lineage
    from lakeloom.plans.harmonize import TableJob, harmonize
    job = TableJob(S.CUSTOMERS, scd=2)
    raw = _raw_customers_resent(spark, d)
    first = harmonize(job, raw, None, RUN1, JOB, as_of="2025-01-01", upper=R.SEED_TS)
    state = cut_lineage(spark, first.state)          # the daily run writes its table
    second = harmonize(job, raw, state, RUN2, JOB, as_of="2025-01-02")
    return second.state


@register("scd2_multi_batch", HARMONIZE_SCD2_SQL[:HARMONIZE_SCD2_SQL.index("b1 AS (SELECT")] + f"""
v AS (SELECT *, {_H} AS hv FROM (SELECT {_CUST_TYPED} FROM rc)),
w AS (SELECT *, lag(hv) OVER (PARTITION BY customer_id ORDER BY batch_r_timestamp) AS before FROM v),
x AS (SELECT *, lead(1) OVER (PARTITION BY customer_id ORDER BY batch_r_timestamp) IS NULL AS newest
      FROM w WHERE before IS NULL OR before <> hv)
SELECT {_SCD2_COLS}, newest AS active_flag, DATE '2025-01-01' AS begin_effective_date,
       CASE WHEN newest THEN DATE '9999-12-31' ELSE DATE '2025-01-01' END AS end_effective_date,
       hv AS s_customer_key, batch_r_timestamp, TIMESTAMP '{RUN1}' AS h_insert_timestamp,
       TIMESTAMP '{RUN1}' AS h_update_timestamp, '{JOB}' AS job_id
FROM x""")
def q_scd2_multi_batch(spark, d):
    """The customers SCD2 job over all ingest days in one run: re-sent customers
    come in two batches and get one version each, in stamp order."""
    from lakeloom.plans.harmonize import TableJob, harmonize
    return harmonize(TableJob(S.CUSTOMERS, scd=2), _raw_customers_resent(spark, d), None, RUN1, JOB,
                     as_of="2025-01-01").state


@register("scd1_bucketed_products", ORACLE["scd1_upsert_products"])
def q_scd1_bucketed_products(spark, d):
    """The products upsert against a dimension stored in 16 hash buckets of
    the key (``pmod(xxhash64(product_id), 16)`` as the partition column):
    only the buckets holding batch keys are read, merged and rewritten."""
    from lakeloom.plans.publish import overwrite_partitions
    from lakeloom.session import scratch_path
    buckets, part = 16, "_bucket"
    path = scratch_path(spark, "t_products")
    tgt = R.harmonized_products(spark, d)
    tgt = tgt.where(F.pmod(F.col("product_id").cast("bigint"), F.lit(4)) != 3)
    tgt.withColumn(part, scd1.key_bucket("product_id", buckets)).write.partitionBy(part).parquet(path)
    src = _scd1_source(spark, d, "products")
    src = src.withColumn(part, scd1.key_bucket("product_id", buckets))
    table = spark.read.parquet(path)
    touched = [r[0] for r in src.select(part).distinct().collect()]     # at most 16 values
    new_parts = scd1.scd1_upsert(scd1.restrict_to(table, part, touched), src, "product_id",
                                 run_ts=RUN, job_id=JOB, on_duplicate="latest")
    overwrite_partitions(spark, new_parts, path, part, touched=touched)
    return spark.read.parquet(path).select(*[c.name for c in S.PRODUCTS.columns])


# ------------------------- tables switched by partition location, two runs each
def _located(spark, name, place, spec, key=None):
    """A new located table in a schema and folder of its own."""
    import uuid

    from lakeloom.plans.located import LocatedTable
    from lakeloom.session import scratch_path
    return LocatedTable(spark, f"lakeloom_{uuid.uuid4().hex[:12]}.{name}", place.struct(spec.struct()), place.column,
                        scratch_path(spark, name), key)


def _two_runs(table, place, spec, first, source, key, merge):
    """Run 1 loads ``first``; run 2 merges ``source`` into the partitions it touches."""
    from lakeloom.session import cut_lineage
    table.publish(place.place(first, 1), 1, place.first(1))
    source = cut_lineage(source.sparkSession, source)
    scope, touched = place.scope(table.before(2), source, key, 2)
    table.publish(place.place(merge(scope, source), 2), 2, touched)
    return table.read().select(*spec.names)


@register("scd1_located_transactions", ORACLE["scd1_upsert_transactions"])
def q_scd1_located_transactions(spark, d):
    """The transactions upsert on a month-partitioned catalog table: new folders
    for the touched months, switched by location."""
    from lakeloom.plans.located import ByColumn
    place, tgt = ByColumn("transaction_month"), R.harmonized_transactions(spark, d)
    return _two_runs(_located(spark, "t_sales_transactions", place, S.TRANSACTIONS, "invoice_id"), place, S.TRANSACTIONS,
                     tgt.where(F.pmod(F.col("invoice_id").cast("bigint"), F.lit(4)) != 3),
                     _scd1_source(spark, d, "transactions"), "invoice_id",
                     lambda t, s: scd1.scd1_upsert(t, s, "invoice_id", run_ts=RUN, job_id=JOB, cut=False))


@register("scd1_pruned_line_items", ORACLE["scd1_upsert_line_items"])
def q_scd1_pruned_line_items(spark, d):
    """The line items upsert on key-sorted files with Bloom filters, placed by the
    run that inserted the key: the batch's keys are looked up in the key column
    alone, and only partitions that hold one are read whole and rewritten."""
    from lakeloom.plans.located import ByInsertRun
    place, tgt = ByInsertRun(), R.harmonized_line_items(spark, d)
    return _two_runs(_located(spark, "t_sales_line_items", place, S.LINE_ITEMS, "line_item_id"), place, S.LINE_ITEMS,
                     tgt.where(F.pmod(F.col("invoice_id").cast("bigint"), F.lit(4)) != 3),
                     _scd1_source(spark, d, "line_items"), "line_item_id",
                     lambda t, s: scd1.scd1_upsert(t, s, "line_item_id", run_ts=RUN, job_id=JOB, cut=False))


@register("scd2_located_customers", ORACLE["scd2_merge_customers"])
def q_scd2_located_customers(spark, d):
    """The customers history with its active versions in hash buckets and closed
    ones in a partition per run: a merge rewrites touched active buckets only."""
    from lakeloom.plans.located import ByHistory
    place = ByHistory("customer_id")
    return _two_runs(_located(spark, "t_customers", place, S.CUSTOMERS, "customer_id"), place, S.CUSTOMERS,
                     _scd2_target(spark, d).select(*S.CUSTOMERS.names), _scd2_source(spark, d), "customer_id",
                     lambda t, s: scd2.scd2_merge(t, s, as_of=AS_OF_DATE, run_ts=RUN))


# --------------------------------------------- KPIs from stored partial sums
def _kpi_state(spark, d, *states):
    """Facts stored by month; run 1 lacks every fourth invoice of the odd months,
    run 2 brings them: the stored rows of these months and the late ones are their
    new contents.  Only these months' partial sums are computed again."""
    import uuid

    from lakeloom.functions.hashing import dealt_packed
    from lakeloom.plans.kpi_state import KpiState
    from lakeloom.plans.located import ByColumn
    from lakeloom.session import cut_lineage, scratch_path
    all_facts = sales_facts_df(spark, d)
    month, odd = F.col("transaction_month"), F.month("transaction_month") % 2 == 1
    late = odd & (F.pmod(F.col("invoice_id").cast("bigint"), F.lit(4)) == 3)
    table = _located(spark, "t_sales_facts", ByColumn("transaction_month"), S.SALES_FACTS)
    kpis = KpiState(spark, f"lakeloom_{uuid.uuid4().hex[:12]}", scratch_path(spark, "kpi-state"), states)
    table.publish(all_facts.where(~F.coalesce(late, F.lit(False))), 1)
    kpis.refresh(table.read(), None, 1)
    new = cut_lineage(spark, all_facts.where(late))
    months = [r[0] for r in new.select(month).distinct().collect()]      # one value per month
    stored = scd1.restrict_to(table.read(), "transaction_month", months)
    new = dealt_packed(new, lambda t: t.hint("rebalance", month))        # stored rows lie by month already
    table.publish(stored.select(*new.columns).unionByName(new), 2, months, arranged=True)
    kpis.refresh(table.read(), months, 2)
    return kpis


@register("kpi_state_product_sales", ORACLE["product_sales_summary"])
def q_kpi_state_product_sales(spark, d):
    return _kpi_state(spark, d, "products").product_sales_summary(R.harmonized_products(spark, d), ordered=False)


@register("kpi_state_customer_summary", ORACLE["customer_summary_scd2_fanout"])
def q_kpi_state_customer_summary(spark, d):
    return _kpi_state(spark, d, "customers").customer_summary(R.customers_two_versions(spark, d), ordered=False)


@register("kpi_state_store_loyalty", ORACLE["customer_store_loyalty"])
def q_kpi_state_store_loyalty(spark, d):
    """Distinct stores from bitmaps per customer and month, merged without the facts."""
    return _kpi_state(spark, d, "stores").customer_store_loyalty()


# ---------------------------------------------- the daily run, end to end
@register("daily_run_facts", with_("raw_line_items", "raw_transactions") + f"""
SELECT t.invoice_id, l.line_item_id, t.store_id, t.customer_id, t.employee_id, l.product_id, t.payment_type,
       t.transaction_date_time, t.transaction_month, l.quantity, l.unit_price, l.total_price, l.discount_applied,
       t.total_amount
FROM ({TYPED_SQL['line_items']}) l JOIN ({TYPED_SQL['transactions']}) t ON l.invoice_id = t.invoice_id""")
def q_daily_run_facts(spark, d):
    """All raw tables land as compressed CSV in two parts; the daily run is made after each:
    ingest, gate and harmonize every table, clustered facts, views.  Returns the facts."""
    return daily_runs(spark, d)[1]["t_sales_facts"]


#: Rows of a landing file: a compressed one is read by one task.
LANDING_ROWS = 250_000


def daily_runs(spark, d):
    """The folder and the tables of the two daily runs."""
    import uuid

    from lakeloom.plans.daily import daily_run
    from lakeloom.session import scratch_path
    base = scratch_path(spark, "daily")
    schema = f"lakeloom_{uuid.uuid4().hex[:12]}"          # a schema of its own
    readers = {"t_products": "products", "t_stores": "stores", "t_customers": "customers",
               "t_sales_transactions": "transactions", "t_sales_line_items": "line_items"}
    for run, (lo, hi) in enumerate(((None, CUT), (CUT, None)), 1):
        globs = {}
        for name, short in readers.items():
            raw = increment.incremental_batch(RAW_READERS[short][0](spark, d), lo, hi)
            globs[name] = f"{name}/run_*/*.csv.gz"
            (raw.select(*S.RAW_COLUMNS[name]).write.option("header", True).option("compression", "gzip")
             .option("maxRecordsPerFile", LANDING_ROWS).csv(f"{base}/landing/{name}/run_{run}"))
        out = daily_run(spark, f"{base}/landing", f"{base}/tables", RUN, JOB, AS_OF_DATE, run, globs=globs, views=run == 2,
                        schema=schema)
    return f"{base}/tables", out
