"""Filters of fixed size for hashes that are worth a shuffle.

Most hashes of a corpus occur once and join nothing. The ones that matter are found by an aggregate;
a bit for each of them, in a map whose size does not depend on the data, then tells tasks which rows
to send on. The filter lets some others through, the more the more hashes there are, but loses none,
so that whatever comes after must and can be exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter: 16 MB of bits.
BITS = 27
# Fixed value: bits of a place in one of Spark's bitmaps.
PLACE = 15


def bits_of(hashes: DataFrame) -> np.ndarray:
    """The map of a table with one column of 64-bit hashes."""
    slot = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << BITS) - 1))
    place = F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << PLACE) - 1)))
    found = np.zeros(1 << (BITS - 3), np.uint8)
    for row in hashes.groupBy(F.shiftright(slot, PLACE).alias("part")).agg(place.alias("bits")).collect():
        start = row["part"] << (PLACE - 3)
        found[start : start + (1 << (PLACE - 3))] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return found


def among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the table."""
    slots = hashes.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
