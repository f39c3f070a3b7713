"""Deterministic pseudo-random numbers from row keys.

A row keeps its number on any partitioning and after any task retry, so random
choices need no stored state and agree between repeated scans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = float(16**13)


def key_hash(key: Column, seed: int | str) -> Column:
    """A 52-bit integer (exact in a double) from the key and a seed."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def key_uniform(key: Column, seed: int | str) -> Column:
    """Uniform in [0, 1)."""
    return key_hash(key, seed) / F.lit(RANGE)
