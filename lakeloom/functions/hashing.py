"""Change-detection hash over a row's tracked columns; digest texts packed for a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field separator and NULL sentinel inside the hashed text.
# chr(1) between fields keeps ('ab','c') apart from ('a','bc'); chr(2) keeps
# NULL apart from the empty string, so a NULL never hides a change.
FIELD_SEP = "\u0001"
NULL_MARK = "\u0002"


def row_hash(*cols: str | Column) -> Column:
    """md5 of the columns' text, delimited and NULL-safe."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))
             for c in cols]
    return F.md5(F.concat_ws(FIELD_SEP, *parts))


#: Text keys that are hex digests as a rule: packed while rows are shuffled.
DIGESTS = ("line_item_id",)


def pack_hex(column) -> Column:
    """Text as bytes: lower-case hex of even length as the bytes it names (half
    the room), any other text as it is; a first byte tells which."""
    c = F.col(column) if isinstance(column, str) else column
    is_hex = (F.translate(c, "0123456789abcdef", "") == "") & (F.length(c) % 2 == 0)
    return F.when(is_hex, F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpack_hex(column) -> Column:
    """The text that ``pack_hex`` packed."""
    c = F.col(column) if isinstance(column, str) else column
    rest = F.substring(c, F.lit(2), F.length(c))
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def dealt_packed(df: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``deal(df)``, a join or a new distribution, with the text columns of
    ``DIGESTS`` packed while it shuffles them."""
    names = [c for c, t in df.dtypes if c in DIGESTS and t == "string"]
    return deal(df.withColumns({c: pack_hex(c) for c in names})).withColumns({c: unpack_hex(c) for c in names})
