"""Map the provided star-schema test tables onto the retail lakehouse model.

Two views of the same data are derived here, lazily and column-pruned:

* ``harmonized_*`` — typed tables as the harmonized layer would hold them;
* ``raw_*`` — the all-string raw layer with an ingest stamp, including
  deliberately dirty text (chosen by a rule on the key) so that the quality
  and casting operators have something to find.

The DuckDB twins of every mapping live in ``lakeloom.plans.oracle``; both
must produce identical text for identical input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (shared with the SQL oracle).
SEED_TS = "2024-01-01 00:00:00"        # first ingest instant of the raw layer
SEED_JOB = "seed"
EPOCH_DATE = "2020-01-01"              # products.added_date = EPOCH_DATE + key % 365
N_BATCHES = 3                          # raw rows are spread over 3 daily ingest batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def batch_stamp(key: Column) -> Column:
    """Ingest stamp of a raw row: day ``key % N_BATCHES`` after SEED_TS."""
    return F.timestamp_add("DAY", F.pmod(key, F.lit(N_BATCHES)).cast("int"), _ts(SEED_TS))


def _audit(df: DataFrame) -> DataFrame:
    seed = _ts(SEED_TS)
    return df.withColumns({
        "batch_r_timestamp": seed,
        "h_insert_timestamp": seed,
        "h_update_timestamp": seed,
        "job_id": F.lit(SEED_JOB),
    })


# ---------------------------------------------------------------- harmonized

def gender_of(key: Column) -> Column:
    m = F.pmod(key, F.lit(3))
    return F.when(m == 0, "Men").when(m == 1, "Women").otherwise("Unisex")


def membership_of(segment: Column) -> Column:
    return (F.when(segment == "MACHINERY", "Gold")
            .when(segment == "BUILDING", "Silver").otherwise("Bronze"))


def email_of(key: Column) -> Column:
    return (F.when(F.pmod(key, F.lit(13)) == 0, F.lit(None).cast("string"))
            .when(F.pmod(key, F.lit(11)) == 0, F.concat(F.lit("c"), _s(key), F.lit(".example.com")))
            .otherwise(F.concat(F.lit("c"), _s(key), F.lit("@example.com"))))


def store_of(orderkey: Column, custkey: Column) -> Column:
    return F.when(F.pmod(custkey, F.lit(4)) == 0, F.pmod(custkey, F.lit(10))) \
        .otherwise(F.pmod(orderkey, F.lit(10))).cast("string")


def harmonized_products(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return _audit(p.select(
        _s(k).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        gender_of(k).alias("gender"),
        _s("p_size").alias("size"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("color"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.pmod(k, F.lit(100)).cast("int").alias("availability"),
        F.date_add(F.lit(EPOCH_DATE).cast("date"), F.pmod(k, F.lit(365)).cast("int")).alias("added_date"),
        (F.pmod(k, F.lit(10)) != 0).alias("is_active"),
    ))


def harmonized_stores(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")  # 25 rows by definition of the schema
    k = F.col("s_suppkey")
    return _audit(s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        _s(k).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("location"),
        F.concat(F.lit("M"), _s(k)).alias("manager_id"),
        F.date_add(F.lit(EPOCH_DATE).cast("date"), F.pmod(k, F.lit(1000)).cast("int")).alias("opening_date"),
    ))


def harmonized_customers(spark, sf_dir) -> DataFrame:
    """Single-version customer dimension (every row active)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    df = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        _s(k).alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        email_of(k).alias("email"),
        F.lpad(_s(k), 10, "0").alias("phone_number"),
        F.floor(F.abs("c_acctbal")).cast("int").alias("loyalty_points"),
        membership_of(F.col("c_mktsegment")).alias("membership_status"),
        F.concat(_s(k), F.lit(" Main St, "), F.col("n_name")).alias("address"),
        F.lit(True).alias("active_flag"),
        F.lit(EPOCH_DATE).cast("date").alias("begin_effective_date"),
        F.lit("9999-12-31").cast("date").alias("end_effective_date"),
    )
    from lakeloom.functions.hashing import row_hash
    from lakeloom.operators.scd2 import TRACKED_CUSTOMER_COLUMNS
    return _audit(df.withColumn("s_customer_key", row_hash(*TRACKED_CUSTOMER_COLUMNS)))


def customers_two_versions(spark, sf_dir) -> DataFrame:
    """SCD2 customer dimension where every 5th customer also has a closed,
    older version (Bronze, 100 fewer points) ending where the current begins."""
    cur = harmonized_customers(spark, sf_dir)
    old = (cur.where(F.pmod(F.col("customer_id").cast("bigint"), F.lit(5)) == 0)
           .withColumns({
               "loyalty_points": F.col("loyalty_points") - 100,
               "membership_status": F.lit("Bronze"),
               "active_flag": F.lit(False),
               "begin_effective_date": F.lit("2019-01-01").cast("date"),
               "end_effective_date": F.lit(EPOCH_DATE).cast("date"),
           }))
    return cur.unionByName(old)


def harmonized_transactions(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    from lakeloom.functions.predicates import month_of
    return _audit(o.select(
        _s("o_orderkey").alias("invoice_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_date_time"),
        store_of(F.col("o_orderkey"), F.col("o_custkey")).alias("store_id"),
        _s("o_custkey").alias("customer_id"),
        F.concat(F.lit("E"), _s(F.pmod("o_orderkey", F.lit(50)))).alias("employee_id"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        month_of(F.col("o_orderdate")).alias("transaction_month"),
    ))


def line_item_id(li: DataFrame | None = None) -> Column:
    """Deterministic line id: md5 over the six columns that are unique together."""
    return F.md5(F.concat_ws(
        "|",
        _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        _s(F.col("l_extendedprice").cast("decimal(10,2)")),
    ))


def harmonized_line_items(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    up = F.col("l_extendedprice").cast("decimal(10,2)")
    return _audit(li.select(
        line_item_id().alias("line_item_id"),
        _s("l_orderkey").alias("invoice_id"),
        _s("l_partkey").alias("product_id"),
        q.alias("quantity"),
        up.alias("unit_price"),
        (q * up).cast("decimal(10,2)").alias("total_price"),
        F.col("l_discount").cast("decimal(10,2)").alias("discount_applied"),
    ))


# ----------------------------------------------------------------------- raw

def raw_products(spark, sf_dir) -> DataFrame:
    """Raw products as text, with dirty values, over 3 batches, plus re-sent
    rows: every 31st part twice in its batch (a duplicate finding) and every
    37th part once more in the next batch (not a duplicate)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    m41 = F.pmod(k, F.lit(41))
    price_txt = (F.when(m41 == 5, "-1").when(m41 == 6, ".5").when(m41 == 7, "1e3")
                 .when(m41 == 8, "").when(m41 == 9, F.lit(None).cast("string"))
                 .when(m41 == 10, "12.345")
                 .otherwise(_s(F.col("p_retailprice").cast("decimal(10,2)"))))
    active_txt = (F.when(F.pmod(k, F.lit(10)) == 0,
                         F.when(F.pmod(k, F.lit(20)) == 0, "false").otherwise("0"))
                  .otherwise(F.when(F.pmod(k, F.lit(3)) == 0, "true")
                             .when(F.pmod(k, F.lit(3)) == 1, "yes").otherwise("1")))
    base = p.select(
        _s(k).alias("product_id"),
        F.when(F.pmod(k, F.lit(53)) == 7, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        gender_of(k).alias("gender"),
        _s("p_size").alias("size"),
        F.when(F.pmod(k, F.lit(59)) == 11, F.lit(None).cast("string"))
         .otherwise(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))).alias("color"),
        price_txt.alias("price"),
        F.when(F.pmod(k, F.lit(43)) == 4, "n/a").otherwise(_s(F.pmod(k, F.lit(100)))).alias("availability"),
        F.when(F.pmod(k, F.lit(47)) == 3, "2021-02-31")
         .otherwise(_s(F.date_add(F.lit(EPOCH_DATE).cast("date"), F.pmod(k, F.lit(365)).cast("int")))).alias("added_date"),
        active_txt.alias("is_active"),
        F.lit(SEED_TS).alias("update_timestamp"),
        batch_stamp(k).alias("r_insert_timestamp"),
        k.alias("_k"),
    )
    dup_same = base.where(F.pmod("_k", F.lit(31)) == 0)
    dup_next = base.where(F.pmod("_k", F.lit(37)) == 0).withColumn(
        "r_insert_timestamp", F.timestamp_add("DAY", F.lit(1), F.col("r_insert_timestamp")))
    return base.unionByName(dup_same).unionByName(dup_next).drop("_k")


def raw_stores(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    opening = F.date_format(F.date_add(F.lit(EPOCH_DATE).cast("date"), F.pmod(k, F.lit(1000)).cast("int")), "dd-MM-yyyy")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        _s(k).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("location"),
        F.concat(F.lit("M"), _s(k)).alias("manager_id"),
        F.when(F.pmod(k, F.lit(7)) == 3, "31-02-2021").when(F.pmod(k, F.lit(7)) == 5, "2021-01-05")
         .otherwise(opening).alias("opening_date"),
        batch_stamp(k).alias("r_insert_timestamp"),
    )


def raw_customers(spark, sf_dir) -> DataFrame:
    h = harmonized_customers(spark, sf_dir)
    k = F.col("customer_id").cast("bigint")
    return h.select(
        "customer_id", "first_name", "last_name", "email",
        F.when(F.pmod(k, F.lit(23)) == 7, "5550000000").otherwise(F.col("phone_number")).alias("phone_number"),
        _s("loyalty_points").alias("loyalty_points"),
        F.when(F.pmod(k, F.lit(29)) == 1, "Platinum").otherwise(F.col("membership_status")).alias("membership_status"),
        "address",
        F.lit(SEED_TS).alias("update_timestamp"),
        batch_stamp(k).alias("r_insert_timestamp"),
    )


def raw_transactions(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ts_txt = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        _s(k).alias("invoice_id"),
        F.when(F.pmod(k, F.lit(61)) == 2, "not a time").otherwise(ts_txt).alias("transaction_date_time"),
        store_of(k, F.col("o_custkey")).alias("store_id"),
        _s("o_custkey").alias("customer_id"),
        F.concat(F.lit("E"), _s(F.pmod(k, F.lit(50)))).alias("employee_id"),
        F.col("o_orderpriority").alias("payment_type"),
        F.when(F.pmod(k, F.lit(67)) == 3, "123456789.99")
         .otherwise(_s(F.col("o_totalprice").cast("decimal(10,2)"))).alias("total_amount"),
        ts_txt.alias("insert_timestamp"),
        ts_txt.alias("update_timestamp"),
        batch_stamp(k).alias("r_insert_timestamp"),
    )


def raw_line_items(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    q_txt = F.when(F.pmod(k, F.lit(71)) == 5, "x").otherwise(_s(F.col("l_quantity").cast("int")))
    up = F.col("l_extendedprice").cast("decimal(10,2)")
    return li.select(
        line_item_id().alias("line_item_id"),
        _s(k).alias("invoice_id"),
        _s("l_partkey").alias("product_id"),
        q_txt.alias("quantity"),
        _s(up).alias("unit_price"),
        _s((F.col("l_quantity").cast("int") * up).cast("decimal(10,2)")).alias("total_price"),
        _s(F.col("l_discount").cast("decimal(10,2)")).alias("discount_applied"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("insert_timestamp"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("update_timestamp"),
        batch_stamp(k).alias("r_insert_timestamp"),
    )
