"""Documents whose word shingles overlap: a rare-first prefix-filtered Jaccard join, and its components.

A document's set is its distinct runs of `size` words (lower case A-Z; the whole sequence if it is shorter). Two sets link
when 100 * intersection >= percent * union. Equal sets are one class from the start, so copies are never
compared. Shingles are ordered by the number of documents that have them, then by hash. Of a set of n
shingles, a partner must share one of the rarest n - ceil(percent n / 100) + 1. Shingles of one document only come
first and have no partner, so a set with that many of its own is out at once and sends nothing.

Within a prefix shingle, the class where it stands earliest is the hub of a star; the stars' pairs are verified first and
joined to components. Only classes of different components under one shingle are then paired. So a group of near copies costs about
one pair a class, and yet no link between components is lost. Pairs pass the length filter, the positional filter
(what both sets have left after the shared shingle) and the suffix filter (parts of both sets on either side of a pivot), and are
verified once. Shingles are compared by 64-bit hashes, sets by 128-bit ones.

Null and empty texts have the empty set: they link with nothing and are their own component. A null doc_id counts as
no number: a component of nothing else has a null id. Repeated rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_documents, grams, in_blocks, key_counts, prepare, rows_of, stored, texts_hashes, tidy_both, total_counts

SETS = "doc_id long, row long, n_shingles long, digest binary, shared binary"
ROW = "__row"


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    return [np.unique(grams(h, min(size, len(h)))) if len(h) else h for h in texts_hashes(texts, lower=True)]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shingle_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row (its number in column `__row`, if there is one): size and digest of its set, and, where its prefix holds shingles of other documents, all shingles that
    others have too, the rarest first."""
    n = prepare(docs.sparkSession)
    row = F.col(ROW) if ROW in docs.columns else F.lit(None)
    blocks = in_blocks(docs.select(*as_documents(), row.cast("long").alias("row")), "row")

    def keys_of(rows: list[tuple]) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *shingles([r[1] for r in rows], size)])

    def describe(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows_of(table, "row")
        sets = shingles([r[1] for r in rows], size)
        keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets])), total_counts(replies)
        shared = []
        for s in sets:
            c = counts[np.searchsorted(keys, s)]
            common = c > 1
            if len(s) and len(s) - common.sum() < prefix_length(len(s), percent):
                shared.append(s[common][np.lexsort((s[common], c[common]))].tobytes())
            else:
                shared.append(None)
        return pa.table(
            {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "row": pa.array([r[2] for r in rows], pa.int64()),
             "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
             "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
             "shared": pa.array(shared, pa.binary())}
        )

    replies = key_counts(blocks, keys_of, n)
    found = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(tidy_both(describe), SETS)
    return stored(found, "shingle-sets")


# -- pairs of classes --------------------------------------------------------------------------


def _prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(key, digest, n, at) of every prefix shingle that other documents have."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, n, shared in zip(*(batch.column(c).to_pylist() for c in ("digest", "n", "shared")), strict=True):
                keys = np.frombuffer(shared, np.int64)
                own = n - len(keys)  # shingles of no other document come before
                keys = keys[: prefix_length(n, percent) - own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([digest] * len(keys), pa.binary()),
                     pa.array(np.full(len(keys), n)), pa.array(own + np.arange(len(keys)))],
                    ["key", "digest", "n", "at"],
                )

    return classes.mapInArrow(emit, "key long, digest binary, n long, at long")


def needed(a, b, percent: int):
    """Smallest intersection of linked sets of sizes a and b (columns or numbers)."""
    return -((-percent * (a + b)) // (100 + percent))


def _filtered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs that the length and positional filters let pass; columns a, na, at_a, b, nb, at_b."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    rest = F.least(F.col("na") - F.col("at_a"), F.col("nb") - F.col("at_b"))
    fits = (100 * small >= percent * large) & ((100 + percent) * rest >= percent * (F.col("na") + F.col("nb")))
    first, second = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return pairs.where(fits & (F.col("a") != F.col("b"))).select(first, second).distinct()


def suffix_fits(x: np.ndarray, y: np.ndarray, need: int, depth: int = 3) -> bool:
    """Whether sorted arrays can share `need` values, judged by the sizes on either side of pivots."""

    def most(a: np.ndarray, b: np.ndarray, depth: int) -> int:
        if not depth or not len(a) or not len(b):
            return min(len(a), len(b))
        pivot = a[len(a) // 2]
        i, j = len(a) // 2, int(np.searchsorted(b, pivot))
        return most(a[:i], b[:j], depth - 1) + most(a[i:], b[j:], depth - 1)

    return most(x, y, depth) >= need


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    one = classes.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("shared").alias("xa"))
    two = classes.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("xb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for na, xa, nb, xb in zip(*(batch.column(c).to_pylist() for c in ("na", "xa", "nb", "xb")), strict=True):
                x, y = np.sort(np.frombuffer(xa, np.uint64)), np.sort(np.frombuffer(xb, np.uint64))
                need = needed(na, nb, percent)
                good.append(suffix_fits(x, y, need) and len(np.intersect1d(x, y, assume_unique=True)) >= need)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").mapInArrow(check, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (a, b): the smallest node reachable. Alternates between hanging
    larger neighbours and smaller neighbours on the smallest one; hubs cost one row a link and no task holds a component."""
    edges = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        small_least = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(small_least, "v")
        edges = hung.select(F.col("m").alias("u"), "v").unionByName(
            hung.where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        )
        edges = stored(edges.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).head()
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def linked_classes(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links between classes (a, b), enough to connect all that are linked, and the components of the linked
    classes (node, root)."""
    candidates = sets.where("shared is not null")
    classes = candidates.groupBy("digest").agg(F.first("n_shingles").alias("n"), F.first("shared").alias("shared"))
    classes = stored(classes, "classes")
    prefixes = stored(_prefixes(classes, percent), "prefixes")

    star = stored(_filtered(_starred(prefixes), percent), "stars")
    links = stored(_verified(star, classes, percent), "links-1")
    found = components(links)

    # Whatever shares a shingle across components.
    member = prefixes.join(found, F.col("digest") == F.col("node"), "left")
    member = stored(member.select("key", "digest", "n", "at", F.coalesce("root", "digest").alias("root")), "members")
    # What a component has under a shingle decides whether a class could link with any of it.
    slack = F.max((100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")).alias("slack")
    present = member.groupBy("key", "root").agg(F.min("n").alias("low"), F.max("n").alias("high"), slack)
    mixed = present.groupBy("key").agg(F.count("*").alias("roots")).where("roots > 1").select("key")
    present = present.join(mixed, "key").withColumnRenamed("root", "other")
    n, least = F.col("n"), F.greatest(F.col("low"), F.ceil(F.col("n") * percent / 100))
    possible = (100 * n >= percent * F.col("low")) & (100 * F.col("high") >= percent * n) & (F.col("slack") >= percent * n)
    rest = (100 + percent) * (n - F.col("at")) >= percent * (n + least)
    left = member.join(present, (member["key"] == present["key"]) & (F.col("root") < F.col("other")) & possible & rest)
    left = left.drop(present["key"])
    right = member.select("key", F.col("root").alias("other"), F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("at").alias("at_b"))
    pairs = left.select("key", "other", F.col("digest").alias("a"), F.col("n").alias("na"), F.col("at").alias("at_a"))
    crossing = _filtered(pairs.join(right, ["key", "other"]), percent).join(star, ["a", "b"], "left_anti")
    more = stored(_verified(crossing, classes, percent), "links-2")
    if more.isEmpty():
        return links, found
    return links.unionByName(more), components(links.unionByName(more))


def _starred(prefixes: DataFrame) -> DataFrame:
    """Under every shingle, each class with the class that stands there earliest for its size: the fewer rare shingles
    a set has before it, the more sets it can link with."""
    place = (F.col("at") / F.col("n")).alias("place")
    first = prefixes.groupBy("key").agg(F.min(F.struct(place, "digest", "n", "at")).alias("hub"))
    return prefixes.join(first, "key").select(
        F.col("digest").alias("a"), F.col("n").alias("na"), F.col("at").alias("at_a"),
        F.col("hub.digest").alias("b"), F.col("hub.n").alias("nb"), F.col("hub.at").alias("at_b"),
    )


def _rooted(sets: DataFrame, percent: int) -> DataFrame:
    """(digest, first, root): per set that is not empty its smallest doc_id and its component."""
    _, found = linked_classes(sets, percent)
    own = sets.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"))
    rooted = own.join(found, F.col("digest") == F.col("node"), "left")
    return stored(rooted.select("digest", "first", F.coalesce("root", "digest").alias("root")), "rooted")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    sets = shingle_sets(docs, size, percent)
    rooted = _rooted(sets, percent)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    class_of = rooted.join(lowest, "root").select("digest", "component")
    joined = sets.where("n_shingles > 0").join(class_of, "digest")
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.select("doc_id", "n_shingles", F.col("component").alias("component_id")).unionByName(empty)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of `docs`, with all columns: the one with the smallest doc_id (nulls last), of several the
    one that comes first in the stored table. Rows without a word are components of their own and all stay.

    Rows are told apart by their number in a stored copy of `docs`, so repeated and missing doc_ids make no difference.
    """
    named = next(f"{ROW}_{i}" for i in range(len(docs.columns) + 1) if f"{ROW}_{i}" not in docs.columns)
    numbered = stored(docs.withColumn(named, F.monotonically_increasing_id()), "rows")
    sets = shingle_sets(numbered.select("doc_id", "text", F.col(named).alias(ROW)), size, percent)
    rooted = _rooted(sets, percent).select("digest", "root")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    firsts = sets.where("n_shingles > 0").join(rooted, "digest").groupBy("root").agg(F.min(order).alias("first"))
    kept = firsts.select("first.row").unionByName(sets.where("n_shingles = 0").select("row"))
    return numbered.join(kept.withColumnRenamed("row", named), named, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
