"""Repeatable samples and splits from md5 draws; no sorting, no window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import digest, uniform

_STEP = 3  # hex digits looked at per job: 4096 cells
_PAST_ALL = "g"  # sorts after every hex digit


def digest_bound(keys: DataFrame, key_digest: Column, m: int) -> str:
    """A text such that exactly `m` of the (distinct) keys have a digest below it.

    Counts digests by their leading digits, finds the cell in which the m-th one falls, and looks into
    that cell with the next digits. Each job returns at most 4096 counts; three to four jobs suffice
    for 10**12 keys.
    """
    start, left = "", m
    hashed = keys.select(key_digest.alias("__d"))
    while True:
        cells = (
            hashed.where(F.col("__d").startswith(start))
            .groupBy(F.substring("__d", 1, len(start) + _STEP).alias("cell"))
            .count()
            .orderBy("cell")
            .collect()
        )
        for cell in cells:
            if left == 0 or (cell["count"] > left and len(cell["cell"]) >= 32):
                return cell["cell"]
            if cell["count"] > left:
                start = cell["cell"]
                break
            left -= cell["count"]
        else:
            # All of this cell is taken; the next text after the cell closes it.
            return start + _PAST_ALL


def sample_exact(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Exactly round(fraction * n) rows by lowest digest of the unique `key`. Runs small jobs."""
    drawn = digest(F.col(key), seed, "sample")
    bound = digest_bound(df, drawn, round(fraction * df.count()))
    return df.where(drawn < bound)


def sample_threshold(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """About fraction * n rows; one pass, no job beforehand."""
    return df.where(uniform(F.col(key), seed, "sample") < fraction)


def split_groups(
    df: DataFrame, group: str, test_fraction: float, seed: int, exact: bool = False, name: str = "is_test"
) -> DataFrame:
    """Add a flag that is equal for all rows of a group.

    By default each group is drawn on its own, a narrow step. With `exact`, ceil(fraction * groups)
    groups are test groups, which takes a distinct and a few small jobs.
    """
    if not exact:
        return df.withColumn(name, uniform(F.col(group), seed, "split") < test_fraction)
    groups = df.select(group).distinct()
    drawn = digest(F.col(group), seed, "split")
    bound = digest_bound(groups, drawn, math.ceil(test_fraction * groups.count()))
    return df.withColumn(name, drawn < bound)
