"""A fixed-size membership filter over CRC-32 values.

The filter is a bitmap of ``2 ** bits`` bits (8 MB by default) however many
keys it holds, so broadcasting it has a proven bound.  A key that is in the
set is always found; others pass now and then and are sorted out by the join
that follows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26
#: Bits of one page, the unit in which the bitmap is gathered.
PAGE = 16


def bitmap(keys: DataFrame, key: Column, bits: int = BITS) -> np.ndarray:
    """Bitmap of the CRC-32 of ``key`` (string or binary) over all rows."""
    slot = F.shiftrightunsigned(F.crc32(key.cast("binary")), 32 - bits)
    slots = keys.where(key.isNotNull()).select(slot.alias("slot")).distinct()

    def page(pdf):
        on = np.zeros(1 << PAGE, np.uint8)
        on[pdf["slot"].to_numpy() & ((1 << PAGE) - 1)] = 1
        return pd.DataFrame({"page": [pdf["slot"].iloc[0] >> PAGE], "data": [np.packbits(on).tobytes()]})

    out = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << PAGE) // 8
    pages = slots.groupBy(F.shiftright("slot", PAGE)).applyInPandas(page, "page long, data binary")
    for row in pages.collect():             # at most 2 ** (bits - PAGE) pages of 8 KB: the bitmap itself
        out[row.page * size:(row.page + 1) * size] = np.frombuffer(row.data, np.uint8)
    return out


def found(bits_on: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Positions in ``crc`` (uint32) whose slot is set."""
    slot = crc >> np.uint32(32 - int(len(bits_on) * 8).bit_length() + 1)
    return np.flatnonzero((bits_on[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
