"""Exact duplicates: immutable snapshots screened by static binary-fuse filters, then exact buckets and bytes.

Documents come in batches (ranges of doc_id, as they were taken in). Every batch but the last is an immutable
snapshot with one filter per bucket of digests, built once and stored. A batch's distinct digests are screened by
the filters of the snapshots before it: what no filter knows is new. Positives join the exact digests of those
snapshots, which removes the filter's false alarms. Copies inside one batch are grouped before any of this, so a
group of copies travels as one row per batch. Last, texts of one digest are compared byte by byte, by grouping on
the text itself; every text is shuffled once for this, merged per task before, the same at every size. Two texts are equal if they are identical after each run of `[\\x20\\x09-\\x0D]` became one space.

Null texts are empty, and empty texts are copies of each other. A null doc_id counts as the smallest. Repeated rows are
rows of one group. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, mix, prepare, stored

#: Texts are equal up to the amount and kind of this white space.
SPACE = r"[\x20\x09-\x0D]+"


# -- binary fuse filter ------------------------------------------------------------------------


def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments for each key, and its fingerprint."""
    h = mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    inside = [(mix(h + np.uint64(i + 1)) % np.uint64(segment)).astype(np.int64) for i in range(3)]
    return np.stack([(first + i) * segment + inside[i] for i in range(3)]), (h & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> bytes:
    """A static filter of distinct 64-bit keys with 8-bit fingerprints, about 9 to 10 bits a key when large.

    Keys are peeled in rounds, all at once: a slot that only one key uses settles that key. The rounds in
    reverse give every key a slot of its own to balance its fingerprint in.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    if n == 0:
        return b""
    segment = max(4, 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    room = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    segments = max(1, -(-int(n * room + 8) // segment) - 2)
    for seed in range(1000):
        slots, prints = _slots(keys, seed, segment, segments)
        size = (segments + 2) * segment
        used = np.bincount(slots.reshape(-1), minlength=size)
        owner = np.zeros(size, np.int64)  # exclusive or of the keys that use a slot
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(n))
        left, rounds = n, []
        while left:
            single = np.flatnonzero(used == 1)
            who, at = np.unique(owner[single], return_index=True)
            if not len(who):
                break
            rounds.append((who, single[at]))
            for row in slots[:, who]:
                np.subtract.at(used, row, 1)
                np.bitwise_xor.at(owner, row, who)
            left -= len(who)
        if left:
            continue
        table = np.zeros(size, np.uint8)
        for who, own in reversed(rounds):
            table[own] = 0
            others = np.bitwise_xor.reduce(table[slots[:, who]], axis=0)
            table[own] = others ^ prints[who]
        return np.array([seed, segment, segments], np.int64).tobytes() + table.tobytes()
    raise ValueError("no seed gives a filter for these keys")


def in_filter(data: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter knows; one in 256 of the others too."""
    if not data:
        return np.zeros(len(keys), bool)
    seed, segment, segments = np.frombuffer(data, np.int64, 3).tolist()
    table = np.frombuffer(data, np.uint8, offset=24)
    slots, prints = _slots(keys, seed, segment, segments)
    return np.bitwise_xor.reduce(table[slots], axis=0) == prints


# -- groups of copies --------------------------------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, normalised text, and its SHA-256."""
    norm = documents(docs).select("doc_id", F.regexp_replace("text", SPACE, " ").alias("norm"))
    return norm.withColumn("sha", F.sha2("norm", 256))


def batch_starts(docs: DataFrame, batches: int) -> list[int]:
    """Smallest doc_ids of the second and later batches."""
    at = [i / batches for i in range(1, batches)]
    cuts = docs.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", at, 0.01) if at else []
    return sorted({int(c) for c in cuts})


def snapshot_filters(distinct: DataFrame, last: int) -> DataFrame:
    """(bucket, batch, filter) for every batch before `last`."""

    def build(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        batch, key = table.column("batch").to_numpy(), table.column("key").to_numpy().view(np.uint64)
        own = np.unique(batch).tolist()
        made = [build_filter(key[batch == b]) for b in own]
        return pa.table({"bucket": pa.array([bucket] * len(own), pa.int32()), "batch": pa.array(own, pa.int32()),
                         "filter": pa.array(made, pa.binary())})

    old = distinct.where(F.col("batch") < last).select("bucket", "batch", "key")
    return old.groupBy("bucket").applyInArrow(build, "bucket int, batch int, filter binary")


def screened(distinct: DataFrame, filters: DataFrame) -> DataFrame:
    """The digests that a filter of an earlier snapshot knows."""

    def screen(rows: pa.Table, known: pa.Table) -> pa.Table:
        hit = np.zeros(rows.num_rows, bool)
        if rows.num_rows:
            batch, key = rows.column("batch").to_numpy(), rows.column("key").to_numpy().view(np.uint64)
            for b, data in zip(known.column("batch").to_pylist(), known.column("filter").to_pylist(), strict=True):
                later = np.flatnonzero(batch > b)
                hit[later] |= in_filter(data, key[later])
        return rows.select(["sha"]).filter(pa.array(hit))

    rows = distinct.select("bucket", "batch", "key", "sha")
    return rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(screen, "sha string")


def exact_groups(docs: DataFrame, batches: int = 4) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    n = prepare(docs.sparkSession)
    cuts = batch_starts(docs, batches)
    batch = sum((F.col("doc_id") >= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    known = stored(digests(docs).select("doc_id", "sha", F.coalesce(batch, F.lit(0)).alias("batch")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("set"), "doc_id")).alias("first")
    key = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    distinct = known.groupBy("sha", "batch").agg(first, F.count("*").alias("n"))
    distinct = stored(distinct.select("*", key.alias("key"), F.pmod(key, F.lit(n)).cast("int").alias("bucket")), "batches")
    filters = stored(snapshot_filters(distinct, len(cuts)), "filters")

    # Exact buckets: a positive whose digest no earlier snapshot holds meets only itself and is dropped by the size.
    positive = screened(distinct, filters).distinct()
    across = distinct.join(positive, "sha", "left_semi").select("sha", "first", "n")
    inside = distinct.where("n > 1").join(positive, "sha", "left_anti").select("sha", "first", "n")
    groups = across.unionByName(inside).groupBy("sha").agg(F.min("first").alias("first"), F.sum("n").alias("size"))
    groups = stored(groups.where("size > 1"), "groups")

    # Byte check: the texts of each digest, merged per task before they meet, so that a group of copies is one row a
    # task. Only a digest that several texts share is left, and such a digest is always among the groups.
    texts = digests(docs).select("sha", "norm").distinct()
    clash = texts.groupBy("sha").agg(F.count("*").alias("texts")).where("texts > 1").select("sha")
    clash = stored(clash, "clashes")
    if clash.isEmpty():
        found = known.join(groups, "sha", "left")
    else:
        # Digests that several texts share: these rows are grouped by their texts instead.
        rows = digests(docs).join(clash, "sha", "left_semi")
        split = rows.groupBy("sha", "norm").agg(first, F.count("*").alias("size"))
        found = (
            known.join(clash, "sha", "left_anti").join(groups, "sha", "left").drop("batch")
        ).unionByName(rows.join(split, ["sha", "norm"]).select("sha", "doc_id", "first", "size"))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, batches: int = 4) -> DataFrame:
    """The rows of `docs` that stay, with all columns: of equal texts the row with the smallest doc_id. Where several
    rows share that doc_id, the one whose columns sort first in order (nulls first, maps aside) stays alone."""
    row_key = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256")
    kept = exact_groups(docs, batches).where("kept").select(row_key.alias("__row_key"))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " "), 256)
    own = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), sha)
    named = next(f"__row_key_{i}" for i in range(len(docs.columns) + 1) if f"__row_key_{i}" not in docs.columns)
    rows = docs.withColumn(named, own).join(kept.withColumnRenamed("__row_key", named), named, "left_semi")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sortable = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    one = F.min_by(F.struct(*columns), F.struct(*sortable)).alias("__one")
    return rows.groupBy(named).agg(one).select(*[F.col("__one")[c].alias(c) for c in docs.columns])
