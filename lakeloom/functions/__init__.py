"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from lakeloom.functions.hashing import row_hash
from lakeloom.functions.masks import mask_address, mask_email, mask_phone, register_mask_functions
from lakeloom.functions.predicates import any_null, invalid_number, month_of

__all__ = [
    "row_hash", "mask_phone", "mask_email", "mask_address", "register_mask_functions",
    "any_null", "invalid_number", "month_of",
]
