"""Fixity audit of two replicas of a web archive by Merkle trees over records and ordered ranges of records.

A record is its WARC bytes: a header with the target URI and the length, and the body. Record numbers order the
archive; FILE_RECORDS consecutive numbers are one file, in which records have offsets. A leaf is the SHA-256 of a record
under its number; a node covers FANOUT consecutive nodes below it and hashes their numbers and digests in order. Numbers, not
positions, place a record, so a lost record changes its own branch only.

The audit compares the roots, then only the children of nodes that differ: each step joins the two trees' nodes
of one level with the differing parents. Trees are stored level by level, each a sixteenth of the one below; intact
branches are never read further. Found are corrupt, missing and extra records with file, offset and length.

Null urls and bodies are empty. Rows without a record number have no place in the archive and are reported as
"unnumbered" by replica. A number that occurs more than once is a leaf over all its records. Empty replicas have no
root; everything in the other one is then missing or extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

FANOUT_BITS = 4
FILE_BITS = 12  # a file holds 4096 numbers


def records(pages: DataFrame, number: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """number, length and digest of every record of a replica."""
    text = F.coalesce(F.col(body), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(text).cast("string"),
        F.lit("\r\n\r\n"),
    ).cast("binary")
    data = F.concat(head, text, F.lit("\r\n\r\n").cast("binary"))
    return pages.select(
        F.col(number).cast("long").alias("number"), F.octet_length(data).cast("long").alias("length"), F.sha2(data, 256).alias("digest")
    )


def tree(rows: DataFrame, depth: int) -> list[DataFrame]:
    """The levels of a replica's tree from the records (0) to the root; columns node, digest (and length at the leaves)."""
    # One record is its own digest; several under one number are hashed together, as counts of each digest.
    each = rows.where("number is not null").groupBy("number", "digest").agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    part = F.concat_ws(":", "digest", F.col("n").cast("string"))
    leaves = each.groupBy(F.col("number").alias("node")).agg(
        F.sum("length").alias("length"), F.array_join(F.array_sort(F.collect_list(part)), ",").alias("parts")
    )
    levels = [stored(leaves.select("node", "length", F.sha2("parts", 256).alias("digest")), "leaves")]
    for _ in range(depth):
        below = levels[-1].select(
            F.shiftright("node", FANOUT_BITS).alias("up"), F.struct("node", "digest").alias("child")
        )
        # At most 16 children a node.
        children = below.groupBy("up").agg(F.array_sort(F.collect_list("child")).alias("c"))
        text = F.array_join(F.transform("c", lambda c: F.concat_ws("=", c["node"].cast("string"), c["digest"])), ",")
        levels.append(stored(children.select(F.col("up").alias("node"), F.sha2(text, 256).alias("digest")), "nodes"))
    return levels


def differing(one: DataFrame, two: DataFrame, parents: DataFrame | None) -> DataFrame:
    """Nodes of a level whose digests differ or that only one tree has, below the differing `parents`."""
    if parents is not None:
        up = F.shiftright("node", FANOUT_BITS)
        one, two = (
            t.withColumn("__up", up).join(parents.select(F.col("node").alias("__up")), "__up", "left_semi").drop("__up")
            for t in (one, two)
        )
    a, b = (t.select("node", F.col("digest").alias(c)) for t, c in ((one, "a"), (two, "b")))
    return a.join(b, "node", "full").where(~F.col("a").eqNullSafe(F.col("b")))


def audit(first: DataFrame, second: DataFrame, **columns: str) -> DataFrame:
    """Damage of `second` against `first`: number, file, offset (in `first`; null for extra records), length, status."""
    prepare(first.sparkSession)
    rows = [stored(records(r, **columns), "records") for r in (first, second)]
    low, high = 0, 0
    for r in rows:
        bounds = r.agg(F.min("number"), F.max("number")).head()
        low, high = min(low, bounds[0] or 0), max(high, bounds[1] or 0)
    depth = 1
    while high >> (FANOUT_BITS * depth) != 0 or low >> (FANOUT_BITS * depth) not in (0, -1):
        depth += 1
    trees = [tree(r, depth) for r in rows]
    parents = None
    for level in range(depth, -1, -1):
        parents = stored(differing(trees[0][level], trees[1][level], parents), "differing")
        if parents.isEmpty():
            break
    damaged = parents if level == 0 else parents.limit(0)
    status = (
        F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt").alias("status")
    )
    # Offsets of the files that have damage: a file has at most 4096 numbers.
    file = F.shiftright("number", FILE_BITS).alias("file")
    hurt = damaged.select(F.col("node").alias("number")).select(file).distinct()
    lengths = trees[0][0].select(F.col("node").alias("number"), "length").select("*", file).join(hurt, "file", "left_semi")
    before = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select("number", "length", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    other = trees[1][0].select(F.col("node").alias("number"), F.col("length").alias("other_length"))
    found = damaged.select(F.col("node").alias("number"), status).join(offsets, "number", "left").join(other, "number", "left")
    length = F.coalesce("length", "other_length").alias("length")
    known = found.select("number", file, "offset", length, "status")
    lost = [
        r.where("number is null").select("number", F.lit(None).cast("long").alias("file"), F.lit(None).cast("long").alias("offset"), "length", F.lit(f"unnumbered in {name}").alias("status"))
        for r, name in zip(rows, ("first", "second"), strict=True)
    ]
    return known.unionByName(lost[0]).unionByName(lost[1])
