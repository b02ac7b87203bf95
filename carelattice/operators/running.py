"""Running sums and last values along an order, without a task that must hold a whole key."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import CHUNK, DEFAULT_POLICY, ROWS_PER_TASK, HeavyKey, SkewPolicy, add_chunks, heavy_keys, same_key, split_off


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    tie: Sequence[str] = (),
    heavy: Sequence[HeavyKey] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add one column per entry of `sums` and `latest`, taken over all rows up to the current one.

    `sums` adds up, `latest` keeps the last non-null value; both run along (`order`, `tie`) within
    `keys`. Rows equal in both are in no defined order, so callers either make the pair unique or use
    measures for which it does not matter. `order` must be a number.

    Ordinary keys cost one shuffle and one sort. Heavy keys (see `skew`) are cut into chunks along
    `order`: a window inside each chunk, plus what earlier chunks carry over. The carried table has
    one row per chunk of a heavy key, at most twice the number of shares, so it can be broadcast.

    Pass `heavy` if the heavy keys are known already; otherwise one job looks for them.
    """
    sums, latest = dict(sums or {}), dict(latest or {})
    keys = list(keys)
    if not keys:
        df = df.withColumn("__all", F.lit(0))
        return running(df, ["__all"], order, sums, latest, tie, heavy, policy).drop("__all")
    if heavy is None:
        heavy = heavy_keys(df, keys, policy)
    sort = [order, *tie]
    if not heavy:
        return df.select("*", *_window_columns(keys, sort, sums, latest))

    chunked = add_chunks(df, keys, order, heavy)
    local = chunked.select("*", *_window_columns([*keys, CHUNK], sort, sums, latest))
    carried = F.broadcast(_carry(chunked, keys, sort, sums, latest))
    joined = local.join(carried, same_key(local, carried, keys) & (local[CHUNK] == carried[CHUNK]), "left")
    return joined.select(
        *[local[c] for c in df.columns],
        *[(local[n] + F.coalesce(carried[f"__carry_{n}"], F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(local[n], carried[f"__carry_{n}"]).alias(n) for n in latest],
    )


def _window_columns(
    keys: Sequence[str], sort: Sequence[str], sums: Mapping[str, Column], latest: Mapping[str, Column]
) -> list[Column]:
    w = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for n, c in sums.items()]
    kept = [F.last(c, ignorenulls=True).over(w).alias(n) for n, c in latest.items()]
    return added + kept


def _carry(
    chunked: DataFrame, keys: Sequence[str], sort: Sequence[str], sums: Mapping[str, Column], latest: Mapping[str, Column]
) -> DataFrame:
    """Per heavy key and chunk: totals and last values of all earlier chunks."""
    at = F.struct(*sort)
    per_chunk = (
        chunked.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(
            *[F.sum(c).alias(n) for n, c in sums.items()],
            *[F.max_by(c, F.when(c.isNotNull(), at)).alias(n) for n, c in latest.items()],
        )
    )
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *keys,
        CHUNK,
        *[F.sum(n).over(before).alias(f"__carry_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(before).alias(f"__carry_{n}") for n in latest],
    )


def dense_ids(df: DataFrame, name: str, policy: SkewPolicy = DEFAULT_POLICY, copies_per_row: int = 100_000) -> DataFrame:
    """Add surrogate keys 1..n in a repeatable order.

    The order is that of a digest over the exact text of all columns (instants to the microsecond), so ids
    depend on the rows alone, not on files, partitions or retries. Digests are evenly spread, so equal ranges of them make even chunks; how many
    rows lie in each chunk is counted first, without moving the rows. Identical rows get a run of consecutive ids. Where
    a chunk is too large for a task, they are merged, so a group of copies is one row until the very end; it is then unfolded
    in blocks of at most `copies_per_row` ids, spread over tasks.
    """
    columns = df.columns
    # Chunks are small against a task, so that tasks get about as much each.
    tasks = max(policy.shares(df.sparkSession), math.ceil(df.count() / ROWS_PER_TASK))
    parts = 8 * tasks
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    formats = {"ignoreNullFields": "false", "timestampFormat": exact + "XXX", "timestampNTZFormat": exact}
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), formats))
    leading = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")  # 48 bits
    chunked = df.withColumn(CHUNK, F.floor(leading / F.lit(2**48 / parts)).cast("int"))
    inside = Window.partitionBy(CHUNK).orderBy("__hash", *[F.col(f"`{c}`") for c in columns]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = {r[0]: r[1] for r in chunked.groupBy(CHUNK).count().collect()}  # at most `parts` rows
    offsets, total = [], 0
    for c in sorted(sizes):
        offsets.append((c, total))
        total += sizes[c]
    starts = df.sparkSession.createDataFrame(offsets, f"{CHUNK} int, __start long")
    if max(sizes.values(), default=0) <= max(policy.floor, 8 * total / parts):
        # No group of copies is large: rows are moved once, and their digest is worked out again instead of moved.
        placed = chunked.repartition(tasks, CHUNK).withColumn("__hash", digest)
        numbered = placed.withColumn("__upto", F.row_number().over(inside)).join(F.broadcast(starts), CHUNK)
        return numbered.select((F.col("__start") + F.col("__upto")).alias(name), *columns)
    hashed = chunked.withColumn("__hash", digest)
    counted = hashed.groupBy(*columns, "__hash", CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    upto = (
        counted.withColumn("__upto", F.sum("__n").over(inside))
        .join(F.broadcast(starts), CHUNK)
        .select(*columns, "__n", (F.col("__start") + F.col("__upto")).alias("__upto"))
    )
    first = F.col("__upto") - F.col("__n") + 1
    single = upto.where(F.col("__n") == 1).select(F.col("__upto").alias(name), *columns)
    blocks = (
        upto.where(F.col("__n") > 1)
        .select(*columns, "__upto", F.explode(F.sequence(first, F.col("__upto"), F.lit(copies_per_row))).alias("__from"))
        .repartition("__from")
    )
    last = F.least(F.col("__from") + copies_per_row - 1, F.col("__upto"))
    copies = blocks.select(F.explode(F.sequence(F.col("__from"), last)).alias(name), *columns)
    return single.unionByName(copies)


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str], kind: str) -> DataFrame:
    """Non-null values of the columns as rows (by..., feature, value)."""
    typed = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot(list(by), list(columns), "feature", "value").where(F.col("value").isNotNull())


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    by: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (by..., feature, n, fraction, value).

    The built-in exact percentile merges all distinct values of a group in one task. Here values are
    counted first, and running counts find the one or two at each rank. Totals of ordinary groups come from the
    window that counts; those of heavy groups, at most as many as there are shares, are broadcast. So the
    counted values are shuffled once.
    """
    groups = [*by, "feature"]
    counts = long_values(df, columns, by, "double").groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("__n"))
    heavy = heavy_keys(counts, groups, policy)
    rest, hot = split_off(counts, groups, heavy) if heavy else (counts, None)
    upto = {"__upto": F.col("__n")}
    ranked = running(rest, groups, "value", upto, heavy=[]).withColumn("n", F.sum("__n").over(Window.partitionBy(*groups)))
    if hot is not None:
        totals = F.broadcast(hot.groupBy(*groups).agg(F.sum("__n").alias("n")))
        ranks = running(hot, groups, "value", upto, heavy=heavy)
        placed = ranks.join(totals, same_key(ranks, totals, groups)).select(ranks["*"], totals["n"])
        ranked = ranked.unionByName(placed.select(*ranked.columns))
    before = F.col("__upto") - F.col("__n")
    covers = lambda rank: (before < rank) & (rank <= F.col("__upto"))
    asked = F.transform(
        _near(sorted(map(float, fractions)), before, F.col("__upto"), F.col("n")),
        lambda f: F.struct(f.alias("fraction"), ((F.col("n") - 1) * f).alias("place")),
    )
    low = lambda w: F.floor(w["place"]) + 1
    hits = F.filter(asked, lambda w: covers(low(w)) | covers(F.least(low(w) + 1, F.col("n"))))
    found = ranked.select(*groups, "value", "n", F.explode(hits).alias("__w"))
    least, most, part = F.min("value"), F.max("value"), F.first("__w.place") - F.floor(F.first("__w.place"))
    return found.groupBy(*groups, "n", F.col("__w.fraction").alias("fraction")).agg(
        (least + (most - least) * part).alias("value")
    )


def _near(fractions: Sequence[float], before: Column, upto: Column, n: Column) -> Column:
    """Array of those ascending fractions of n - 1 that may lie between `before` - 1 and `upto`, and a few beside them: a
    value is not held against all of them. Where in the list they are is looked up by cells of equal width."""
    cells = len(fractions)
    below = F.lit([bisect_left(fractions, c, key=lambda f: int(f * cells)) for c in range(cells + 2)])
    per = F.lit(float(cells)) / F.greatest(n - 1, F.lit(1))
    # A cell more on both sides, as quotients are rounded.
    first = F.greatest(F.floor(per * (before - 1)) - 1, F.lit(0)).cast("int")
    last = F.least(F.floor(per * upto) + 1, F.lit(cells)).cast("int")
    start, end = F.element_at(below, first + 1), F.element_at(below, last + 2)
    return F.slice(F.lit(list(fractions)), start + 1, end - start)


def prefix_sums(df: DataFrame, keys: Sequence[str], value: Column, name: str, parts: int) -> tuple[DataFrame, float]:
    """(`df` with the sum of `value` over all rows before it, the sum over all rows), in some fixed order of the unique
    `keys`.

    Two levels: rows are dealt to `parts` buckets by a hash of the keys; the buckets' sums come to the driver and become
    offsets, and a window adds up inside each bucket. `df` is read twice, so it should be checkpointed.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    rows = df.withColumn("__bucket", bucket).withColumn("__value", value)
    sums = {r["__bucket"]: r["__sum"] for r in rows.groupBy("__bucket").agg(F.sum("__value").alias("__sum")).collect()}
    offsets, total = [], 0
    for b in sorted(sums):
        offsets.append((b, total))
        total += sums[b] or 0
    kind = "double" if isinstance(total, float) else "long"
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, f"__bucket int, __offset {kind}"))
    w = Window.partitionBy("__bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__value").over(w), F.lit(0))
    inner = rows.withColumn("__before", before).join(table, "__bucket")
    return inner.select(*df.columns, (F.col("__before") + F.col("__offset")).alias(name)), total


def medians(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Exact medians: rows (by..., feature, n, median)."""
    return quantiles(df, columns, [0.5], by, policy).select(*by, "feature", "n", F.col("value").alias("median"))


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value of each column as text; the smallest one among equals."""
    counts = long_values(df, columns, by, "string").groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*by, "feature").agg(
        F.min_by("value", F.struct(-F.col("__n"), F.col("value"))).alias("mode"), F.max("__n").alias("n")
    )


def describe_all(df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row per column: count; mean, std, min, quartiles and max of numbers; unique, top and freq of
    everything else."""
    is_number = lambda kind: kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("dec")
    numbers = [c for c, kind in df.dtypes if is_number(kind)]
    others = [c for c, kind in df.dtypes if not is_number(kind)]
    parts = []
    if numbers:
        moments = long_values(df, numbers, [], "double").groupBy("feature").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
        at = quantiles(df, numbers, list(names), policy=policy).groupBy("feature").agg(
            *[F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(n) for f, n in names.items()]
        )
        parts.append(moments.join(at, "feature"))
    if others:
        counts = long_values(df, others, [], "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("__n"))
        parts.append(
            counts.groupBy("feature").agg(
                F.sum("__n").alias("count"),
                F.count(F.lit(1)).alias("unique"),
                F.min_by("value", F.struct(-F.col("__n"), F.col("value"))).alias("top"),
                F.max("__n").alias("freq"),
            )
        )
    columns = "feature count unique top freq mean std min q25 q50 q75 max".split()
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return out.select(*[c for c in columns if c in out.columns])
