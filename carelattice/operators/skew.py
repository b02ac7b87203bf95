"""Finding keys that hold too large a share of the rows, and cutting them into ordered chunks.

AQE splits skewed joins, but a window or a grouped sort needs all rows of a key in one task. A key
that may hold a third of the table is therefore cut along its sort order into chunks of about the
size of an ordinary partition. Every quantity that reaches the driver here is bounded by `parts`,
never by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "__chunk"


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as heavy.

    `floor`: rows (or other weight) a single task may always take.
    `parts`: number of shares the whole is divided into; default is the shuffle partition number.
    """

    floor: int = 1_000_000
    parts: int | None = None

    def shares(self, spark: SparkSession) -> int:
        if self.parts is not None:
            return self.parts
        return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class HeavyKey:
    """One key value (possibly compound), its weight, and the number of chunks to cut it into."""

    key: tuple
    weight: float
    splits: int
    extra: tuple = ()


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    weight: Column | None = None,
    extra: Sequence[str] = (),
) -> list[HeavyKey]:
    """Keys above the floor and above one share of the total. Runs one job over the key columns, and
    one more if any key is above the floor.

    Only the `parts` largest keys are looked at: any key left out holds less than one share. So the
    list is bounded by `parts` and the splits add up to at most twice that. A null in a key column
    is a key value of its own. `extra` columns are returned with each key (their maximum).
    """
    return weighed_keys(df, keys, policy, weight, extra)[0]


def weighed_keys(
    df: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    weight: Column | None = None,
    extra: Sequence[str] = (),
) -> tuple[list[HeavyKey], float]:
    """`heavy_keys`, and the weight of all rows. One job, and another if any key is above the floor."""
    parts = policy.shares(df.sparkSession)
    weight = F.lit(1) if weight is None else weight
    rows = df.select(*keys, *extra, weight.cast("double").alias("__w"))
    sums = rows.groupBy(*keys).agg(F.sum("__w").alias("__w"), *[F.max(c).alias(c) for c in extra])
    total, most = sums.agg(F.sum("__w"), F.max("__w")).first()
    if most is None or most <= policy.floor:
        return [], total or 0.0
    top: list[Row] = sums.where(F.col("__w") > policy.floor).orderBy(F.desc("__w")).limit(parts).collect()
    share = max(policy.floor, total / parts)
    heavy = [
        HeavyKey(
            tuple(r[k] for k in keys), r["__w"], min(parts, -int(-r["__w"] // share)), tuple(r[c] for c in extra)
        )
        for r in top
        if r["__w"] > share
    ]
    return heavy, total


#: Rows a task sorts: a few hundred megabytes of a timeline, so that it need not spill.
ROWS_PER_TASK = 1_000_000


def dealt(df: DataFrame, keys: Sequence[str], rows: float) -> DataFrame:
    """`df`, of about `rows` rows, for a window by `keys`: where the session's partitions would hold more than
    `ROWS_PER_TASK` each, as many as are needed."""
    n = math.ceil(rows / ROWS_PER_TASK)
    return df if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(n, *keys)


def key_frame(df: DataFrame, keys: Sequence[str], rows: Sequence[tuple], extra: str = "") -> DataFrame:
    """A small frame with the key columns of `df` (same types) and the extra columns of a DDL string."""
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    if extra:
        fields += T.StructType.fromDDL(extra).fields
    return df.sparkSession.createDataFrame(list(rows), T.StructType(fields))


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all key columns."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def split_off(df: DataFrame, keys: Sequence[str], heavy: Sequence[HeavyKey]) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys). The list of heavy keys is bounded, see above."""
    listed = F.broadcast(key_frame(df, keys, [h.key for h in heavy]))
    condition = same_key(df, listed, keys)
    return df.join(listed, condition, "left_anti"), df.join(listed, condition, "left_semi")


def chunk_edges(df: DataFrame, keys: Sequence[str], order: str, heavy: Sequence[HeavyKey]) -> list[tuple]:
    """(key..., chunk, low, high] bounds along `order` for every heavy key. Runs one job.

    Edges are quantiles from a mergeable sketch, so the job pre-aggregates before its shuffle. They
    only decide where chunks are cut; results do not depend on how exact they are.
    """
    most = max(h.splits for h in heavy)
    if most < 2:
        return []
    fractions = [i / most for i in range(1, most)]
    _, rows = split_off(df, keys, [h for h in heavy if h.splits > 1])
    quantiles = F.percentile_approx(order, fractions, 20 * most).alias("__edges")
    bounds = []
    wanted = {h.key: h.splits for h in heavy}
    for row in rows.groupBy(*keys).agg(quantiles).collect():
        key = tuple(row[k] for k in keys)
        step = most / wanted[key]
        picked = sorted({row["__edges"][min(len(fractions), int(step * i)) - 1] for i in range(1, wanted[key])})
        ends = [None, *picked, None]
        bounds += [(*key, i, ends[i], ends[i + 1]) for i in range(len(picked) + 1)]
    return bounds


def add_chunks(df: DataFrame, keys: Sequence[str], order: str, heavy: Sequence[HeavyKey]) -> DataFrame:
    """`df` with a chunk number: null for ordinary keys, 0, 1, ... along `order` for heavy ones.

    Equal values of `order` always share a chunk.
    """
    bounds = chunk_edges(df, keys, order, heavy)
    if not bounds:
        return df.withColumn(CHUNK, F.lit(None).cast("int"))
    kind = df.schema[order].dataType.simpleString()
    table = F.broadcast(key_frame(df, keys, bounds, f"{CHUNK} int, __low {kind}, __high {kind}"))
    inside = (
        same_key(df, table, keys)
        & (table["__low"].isNull() | (df[order] > table["__low"]))
        & (table["__high"].isNull() | (df[order] <= table["__high"]))
    )
    return df.join(table, inside, "left").select(*[df[c] for c in df.columns], table[CHUNK])
