"""PII governance: masked views and tag-based discovery.

Catalog-enforced column masks and GRANTs are metastore features outside
open-source Spark; here a mask policy is a projection applied when the view
is built, and tags are data (a ``map<string,string>`` column) that can be
queried like any other table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.masks import mask_address, mask_email, mask_phone, role_column

# The customer table's mask policy (column -> mask function).
CUSTOMER_MASKS = {"phone_number": mask_phone, "email": mask_email, "address": mask_address}

# The mask function of each value of the column tag ``pii``.
MASKS = {"phone": mask_phone, "email": mask_email, "address": mask_address}
COLUMN_TAG_SCHEMA = "schema_name string, table_name string, column_name string, tag string, value string"

TAG_SCHEMA = T.StructType([
    T.StructField("schema_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def masked_view(df: DataFrame, policies=None, roles=()) -> DataFrame:
    """Apply each column's mask unless the caller holds the privileged role.
    Column order and every other column are unchanged."""
    policies = CUSTOMER_MASKS if policies is None else policies
    has_role = role_column(list(roles))
    return df.select(*[policies[c](c, has_role).alias(c) if c in policies else F.col(c)
                       for c in df.columns])


def tag_catalog(spark: SparkSession, specs) -> DataFrame:
    """One row per declared table with its tags (``information_schema``-like)."""
    rows = [(s.schema, s.name, dict(s.tags)) for s in specs]
    return spark.createDataFrame(rows, TAG_SCHEMA)


def tagged_tables(tags: DataFrame, key: str = "sensitivity", value: str = "PII") -> DataFrame:
    """Tables whose tag ``key`` equals ``value`` (missing key -> not matched)."""
    return tags.where(F.col("tags")[key] == value)


def set_table_tags(spark: SparkSession, table: str, tags: dict) -> None:
    """Store tags as table properties ``tag.<key>`` of a catalog table."""
    props = ", ".join(f"'tag.{k}' = '{v}'" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")


def catalog_tags(spark: SparkSession, schema: str) -> DataFrame:
    """Tags of every table of a catalog schema, read from table properties.
    Metadata only: one small row per table."""
    rows = []
    for t in spark.catalog.listTables(schema):
        if t.isTemporary:          # session temp views are listed too; they carry no properties
            continue
        props = spark.sql(f"SHOW TBLPROPERTIES {schema}.{t.name}").collect()
        tags = {r["key"][4:]: r["value"] for r in props if r["key"].startswith("tag.")}
        rows.append((schema, t.name, tags))
    return spark.createDataFrame(rows, TAG_SCHEMA)


# ------------------------------------------------------------------ column tags
def column_tags(spark: SparkSession, specs) -> DataFrame:
    """Declared column tags: ``schema_name, table_name, column_name, tag, value``."""
    return spark.createDataFrame([(s.schema, s.name, c.name, k, v) for s in specs for c in s.columns for k, v in c.tags.items()],
                                 COLUMN_TAG_SCHEMA)


def set_column_tag(spark: SparkSession, table: str, column: str, tag: str, value: str | None) -> None:
    """Set a column's tag on a catalog table, or with None take it away.  Tags are
    table properties ``coltag.<column>.<tag>``."""
    name = f"coltag.{column}.{tag}".replace("'", "\\'")
    if value is None:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{name}')")
    else:
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{text}')")


def catalog_column_tags(spark: SparkSession, schema: str) -> DataFrame:
    """Column tags of every table of a catalog schema, as ``column_tags`` has them.
    Metadata only: one small row per tagged column."""
    rows = []
    for t in spark.catalog.listTables(schema):
        if not t.isTemporary:
            for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.{t.name}").collect():
                if r["key"].startswith("coltag."):
                    column, _, tag = r["key"][len("coltag."):].rpartition(".")
                    rows.append((schema, t.name, column, tag, r["value"]))
    return spark.createDataFrame(rows, COLUMN_TAG_SCHEMA)


def mask_policies(tags: DataFrame, table: str, tag: str = "pii", masks=None) -> dict:
    """Mask function per column of ``table`` (``schema.name``) from its tags.  A
    tag value without a mask function is an error: the column must not show."""
    masks = MASKS if masks is None else masks
    schema, _, name = table.rpartition(".")
    rows = tags.where((F.col("schema_name") == schema) & (F.col("table_name") == name) & (F.col("tag") == tag)).collect()
    unknown = sorted({r["value"] for r in rows} - set(masks))
    if unknown:
        raise ValueError(f"{table}: no mask for {tag} = {', '.join(unknown)}")
    return {r["column_name"]: masks[r["value"]] for r in rows}


def masked_by_tags(df: DataFrame, tags: DataFrame, table: str, roles=(), tag: str = "pii") -> DataFrame:
    """``masked_view`` with the masks that the tags of ``table`` ask for when the
    view is built: re-tagging a column changes the next view, no code."""
    return masked_view(df, mask_policies(tags, table, tag), roles)
