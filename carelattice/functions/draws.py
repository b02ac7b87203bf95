"""Repeatable random draws: bits of an md5 over row key, seed and field name.

Unlike `rand(seed)` these do not depend on partitioning, so a retried task or a different cluster
size gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 4294967296.0  # 2**32: eight hex digits


def digest(key: Column, seed: int, field: str = "") -> Column:
    """32 hex digits for (key, seed, field)."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(field)))


def bits(key: Column, seed: int, field: str) -> Column:
    """A whole number in [0, 2**32)."""
    return F.conv(F.substring(digest(key, seed, field), 1, 8), 16, 10).cast("bigint")


def uniform(key: Column, seed: int, field: str) -> Column:
    """A double in [0, 1)."""
    return bits(key, seed, field) / F.lit(SCALE)


def below(key: Column, seed: int, field: str, n: Column) -> Column:
    """A whole number in [0, n)."""
    return F.pmod(bits(key, seed, field), n.cast("bigint")).cast("int")
