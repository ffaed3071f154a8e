"""Hashes that other engines have too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of ``even_hash``.
HASH_BITS = 60


def even_hash(*parts: Column) -> Column:
    """The first 60 bits of the md5 of the parts as text, joined by colons; null counts as empty."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, HASH_BITS // 4), 16, 10).cast("long")
