"""PII masks as Column functions plus their SQL-function twins.

``has_role`` is a boolean Column (typically ``array_contains(roles, 'CRM')``
over a literal role list of the caller), evaluated per query.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# What a masked phone shows, the email prefix, the privileged group.
PHONE_MASK = "**********"
EMAIL_MASK_PREFIX = "***"
PRIVILEGED_ROLE = "CRM"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_phone(c, has_role: Column) -> Column:
    return F.when(has_role, _c(c)).otherwise(F.lit(PHONE_MASK))


def mask_email(c, has_role: Column, strict: bool = False) -> Column:
    col = _c(c)
    # instr is 0 when there is no '@'; substr from 0 then keeps the whole value.
    masked = F.concat(F.lit(EMAIL_MASK_PREFIX), F.substr(col, F.instr(col, "@")))
    if strict:
        # no '@': hide the whole value (NULL stays NULL)
        masked = F.when(F.instr(col, "@") > 0, masked).when(col.isNotNull(), F.lit(EMAIL_MASK_PREFIX))
    return F.when(has_role, col).otherwise(masked)


def mask_address(c, has_role: Column) -> Column:
    col = _c(c)
    return F.when(has_role, col).otherwise(F.element_at(F.split(col, ","), -1))


def role_column(roles) -> Column:
    """``True`` when the caller's roles include the privileged group."""
    arr = F.array(*[F.lit(r) for r in roles]) if roles else F.array().cast("array<string>")
    return F.array_contains(arr, PRIVILEGED_ROLE)


def register_mask_functions(spark: SparkSession, roles) -> None:
    """Register SQL functions ``masking_phone/email/address`` for SQL users.

    The role set is baked into the function body as a literal array, the
    open-source stand-in for a catalog group-membership test."""
    quoted = ["'" + r.replace("\\", "\\\\").replace("'", "\\'") + "'" for r in roles]
    arr = f"array({', '.join(quoted)})" if quoted else "cast(array() as array<string>)"
    member = f"array_contains({arr}, '{PRIVILEGED_ROLE}')"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION masking_phone(phone_number STRING)
        RETURNS STRING RETURN CASE WHEN {member} THEN phone_number ELSE '{PHONE_MASK}' END""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION masking_email(email STRING)
        RETURNS STRING RETURN CASE WHEN {member} THEN email
        ELSE concat('{EMAIL_MASK_PREFIX}', substr(email, instr(email, '@'))) END""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION masking_address(address STRING)
        RETURNS STRING RETURN CASE WHEN {member} THEN address
        ELSE element_at(split(address, ','), -1) END""")
