"""Declared table schemas (the DDL of the lakehouse, as data).

A ``TableSpec`` carries what a CREATE TABLE statement would: column types,
nullability, defaults, the business key, per-column parse formats for raw
strings, table tags.  Operators read these instead of hard-coding columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str                      # Spark SQL type string, e.g. "decimal(10,2)"
    required: bool = False          # NOT NULL
    default: str | None = None      # SQL literal used when the column is omitted
    fmt: str | None = None          # parse pattern for date/timestamp raw strings
    comment: str | None = None
    tags: dict = field(default_factory=dict)


@dataclass(frozen=True)
class TableSpec:
    schema: str
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()                    # extra UNIQUE columns
    allowed: dict = field(default_factory=dict)     # column -> allowed values (CHECK IN)
    tags: dict = field(default_factory=dict)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    def struct(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(c.dtype), not c.required)
            for c in self.columns
        ])

    def ddl(self, using: str = "parquet", location: str | None = None) -> str:
        cols = []
        for c in self.columns:
            piece = f"`{c.name}` {c.dtype}" + (" NOT NULL" if c.required else "")
            if c.default is not None:
                piece += f" DEFAULT {c.default}"
            if c.comment:
                piece += " COMMENT '" + c.comment.replace("'", "\\'") + "'"
            cols.append(piece)
        sql = f"CREATE TABLE IF NOT EXISTS {self.qualified} ({', '.join(cols)}) USING {using}"
        if self.partition_by:
            sql += f" PARTITIONED BY ({', '.join(self.partition_by)})"
        if location:
            sql += f" LOCATION '{location}'"
        tags = [f"'tag.{k}' = '{v}'" for k, v in self.tags.items()]
        tags += [f"'coltag.{c.name}.{k}' = '{v}'" for c in self.columns for k, v in c.tags.items()]
        if tags:
            sql += f" TBLPROPERTIES ({', '.join(tags)})"
        return sql


# Audit tail every harmonized table carries.
AUDIT = (
    Column("batch_r_timestamp", "timestamp_ntz"),
    Column("h_insert_timestamp", "timestamp_ntz"),
    Column("h_update_timestamp", "timestamp_ntz"),
    Column("job_id", "string", required=True),
)

# Fixed values of the retail model (schema names, tag values, allowed
# membership tiers, open-ended SCD2 end date).
RAW_SCHEMA = "raw"
HARMONIZED_SCHEMA = "harmonized"
CURATED_SCHEMA = "curated"
AUDIT_SCHEMA = "audit"
MEMBERSHIP_TIERS = ("Gold", "Silver", "Bronze")
OPEN_END_DATE = "9999-12-31"
PII_TAGS = {"sensitivity": "PII", "data_owner": "sales_team"}

PRODUCTS = TableSpec(
    HARMONIZED_SCHEMA, "t_products",
    (
        Column("product_id", "string", required=True),
        Column("product_name", "string", required=True),
        Column("brand", "string", required=True),
        Column("category", "string", required=True),
        Column("gender", "string", required=True),
        Column("size", "string", required=True),
        Column("color", "string", required=True),
        Column("price", "decimal(10,2)", required=True),
        Column("availability", "int", required=True),
        Column("added_date", "date", required=True),
        Column("is_active", "boolean", required=True, default="true"),
    ) + AUDIT,
    key=("product_id",),
)

STORES = TableSpec(
    HARMONIZED_SCHEMA, "t_stores",
    (
        Column("store_id", "string", required=True),
        Column("store_name", "string", required=True),
        Column("location", "string", required=True),
        Column("manager_id", "string", required=True),
        Column("opening_date", "date", fmt="dd-MM-yyyy"),
    ) + AUDIT,
    key=("store_id",),
)

CUSTOMERS = TableSpec(
    HARMONIZED_SCHEMA, "t_customers",
    (
        Column("customer_id", "string", required=True),
        Column("first_name", "string", required=True),
        Column("last_name", "string", required=True),
        Column("email", "string", tags={"pii": "email"}),
        Column("phone_number", "string", tags={"pii": "phone"}),
        Column("loyalty_points", "int", default="0"),
        Column("membership_status", "string", default="'Bronze'"),
        Column("address", "string", tags={"pii": "address"}),
        Column("active_flag", "boolean", default="true"),
        Column("begin_effective_date", "date", default="current_date()"),
        Column("end_effective_date", "date", default=f"DATE'{OPEN_END_DATE}'"),
        Column("s_customer_key", "string"),
    ) + AUDIT,
    key=("customer_id",),
    unique=("email", "phone_number"),
    allowed={"membership_status": MEMBERSHIP_TIERS},
    tags=PII_TAGS,
)

TRANSACTIONS = TableSpec(
    HARMONIZED_SCHEMA, "t_sales_transactions",
    (
        Column("invoice_id", "string", required=True),
        Column("transaction_date_time", "timestamp_ntz", required=True),
        Column("store_id", "string", required=True),
        Column("customer_id", "string"),
        Column("employee_id", "string"),
        Column("payment_type", "string"),
        Column("total_amount", "decimal(10,2)"),
        Column("transaction_month", "date"),
    ) + AUDIT,
    key=("invoice_id",),
    partition_by=("transaction_month",),
)

LINE_ITEMS = TableSpec(
    HARMONIZED_SCHEMA, "t_sales_line_items",
    (
        Column("line_item_id", "string", required=True),
        Column("invoice_id", "string", required=True),
        Column("product_id", "string", required=True),
        Column("quantity", "int"),
        Column("unit_price", "decimal(10,2)"),
        Column("total_price", "decimal(10,2)"),
        Column("discount_applied", "decimal(10,2)"),
    ) + AUDIT,
    key=("line_item_id",),
)

SALES_FACTS = TableSpec(
    HARMONIZED_SCHEMA, "t_sales_facts",
    (
        Column("invoice_id", "string", required=True),
        Column("line_item_id", "string", required=True),
        Column("store_id", "string"),
        Column("customer_id", "string"),
        Column("employee_id", "string"),
        Column("product_id", "string"),
        Column("payment_type", "string"),
        Column("transaction_date_time", "timestamp_ntz"),
        Column("transaction_month", "date"),
        Column("quantity", "int"),
        Column("unit_price", "decimal(10,2)"),
        Column("total_price", "decimal(10,2)"),
        Column("discount_applied", "decimal(10,2)"),
        Column("total_amount", "decimal(10,2)"),
    ),
    key=("line_item_id",),
    partition_by=("transaction_month",),
)

DQ_LOGS = TableSpec(
    AUDIT_SCHEMA, "dq_logs",
    (
        Column("unique_identifier", "string"),
        Column("r_batch_timestamp", "timestamp_ntz"),
        Column("issue", "string"),
        Column("logged_at", "timestamp_ntz"),
    ),
)

# Raw twins: same business columns as text plus the ingest stamp.
RAW_COLUMNS = {
    "t_products": ("product_id", "product_name", "brand", "category", "gender", "size",
                   "color", "price", "availability", "added_date", "is_active",
                   "update_timestamp"),
    "t_stores": ("store_id", "store_name", "location", "manager_id", "opening_date"),
    "t_customers": ("customer_id", "first_name", "last_name", "email", "phone_number",
                    "loyalty_points", "membership_status", "address", "update_timestamp"),
    "t_sales_transactions": ("invoice_id", "transaction_date_time", "store_id", "customer_id",
                             "employee_id", "payment_type", "total_amount",
                             "insert_timestamp", "update_timestamp"),
    "t_sales_line_items": ("line_item_id", "invoice_id", "product_id", "quantity",
                           "unit_price", "total_price", "discount_applied",
                           "insert_timestamp", "update_timestamp"),
}


def raw_spec(name: str) -> TableSpec:
    cols = tuple(Column(c, "string") for c in RAW_COLUMNS[name])
    # as the ingest writes them: stamp, source file; ingest date and batch number as partition
    cols += (Column("r_insert_timestamp", "timestamp_ntz", default="current_timestamp()"),
             Column("r_source_file", "string"), Column("r_insert_date", "date"), Column("r_batch", "bigint"))
    tags = PII_TAGS if name == "t_customers" else {}
    return TableSpec(RAW_SCHEMA, name, cols, partition_by=("r_insert_date", "r_batch"), tags=tags)


HARMONIZED = {s.name: s for s in (PRODUCTS, STORES, CUSTOMERS, TRANSACTIONS, LINE_ITEMS, SALES_FACTS)}
ALL_SPECS = tuple(raw_spec(n) for n in RAW_COLUMNS) + tuple(HARMONIZED.values()) + (DQ_LOGS,)
