"""What the text operators share: words and their hashes, documents dealt into blocks, packed key arrays.

Several operators ask one question about very many small keys (words, n-grams, shingles): how often does each
occur anywhere? Exploding them into rows would shuffle one row per word. Here a *block* of documents (a hash
of the row, about `BLOCK_BYTES` of text each) reduces its keys to sorted distinct arrays, sends each
*bucket* (a range of key hashes) one compressed slice, and gets back a slice of answers in the same order.
Hot keys cost one entry per block, so no key can fill a task.
"""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.session import shared_folder



def prepare(spark: SparkSession) -> int:
    """Let Python workers of a local session import this package; return the number of shuffle partitions.
    On a cluster the package is installed on the executors, like any other. Rows hold whole texts, so fewer of them go to
    Python at a time than Spark's default of 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    if root not in sys.path:
        sys.path.insert(0, root)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a table below the shared folder (`spark.checkpoint.dir`)."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.startswith("local"):
        root = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        return f"{root}/.scratch/{name}-{uuid.uuid4().hex}"
    return shared_folder(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: later steps neither repeat nor lose it."""
    path = scratch(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_documents() -> tuple[Column, Column]:
    """`doc_id` and `text`, null texts as empty ones."""
    return F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")


def documents(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` of `docs`, null texts as empty ones; other columns are left behind."""
    return docs.select(*as_documents())


def remainder(column: str, modulus: int):
    """crc32 of a column as text, modulo `modulus`; null where the column is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# -- memory of a worker ------------------------------------------------------------------------

_HELD: dict[object, object] = {}


def held(key: object, make: Callable[[], object]):
    """What a Python worker keeps between batches under `key`. Workers are used again by other operators; each holds one
    such thing at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next block should hold nothing of the last."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


Batches = Iterator[pa.RecordBatch]


def tidy_batches(work: Callable[[Batches], Batches], own: object = None) -> Callable[[Batches], Batches]:
    """`work` on a task's batches in a worker that holds nothing but what is kept under `own`, with `release` after it."""

    def run(batches: Batches) -> Batches:
        if own not in _HELD:
            _HELD.clear()
        try:
            yield from work(batches)
        finally:
            release()

    return run


def tidy(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`work` on one group in a worker that holds nothing else, with `release` after it."""

    def run(table: pa.Table) -> pa.Table:
        _HELD.clear()
        try:
            return work(table)
        finally:
            release()

    return run


def tidy_both(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for two grouped tables."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _HELD.clear()
        try:
            return work(left, right)
        finally:
            release()

    return run


# -- words -------------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ROOT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
#: Bytes that are hashed at once, and the longest word hashed this way.
_STRETCH, _LONG = 1 << 18, 256


def _powers(base: int) -> np.ndarray:
    factors = np.full(_STRETCH + _LONG + 1, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_UP, _DOWN = _powers(_ROOT), _powers(pow(_ROOT, -1, 1 << 64))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of all texts in a row, and the number of words of each text. With
    `lower`, A-Z count as a-z.

    A word's hash is the value of its bytes as a polynomial, mixed with its length. All words of a stretch come from one
    running sum, without a look at single words; longer words are hashed one by one.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if lower:
        data = _LOWER[data]
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_IS_SPACE[data]
    step = np.diff(solid)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    counts = np.diff(np.searchsorted(starts, np.append(begins, len(data))))
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + _STRETCH, _STRETCH))
    for k, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if i < j:
            low = k * _STRETCH
            part = data[low : low + _STRETCH + _LONG].astype(np.uint64)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
            a, b = starts[i:j] - low, np.minimum(ends[i:j] - low, len(part))
            out[i:j] = (sums[b] - sums[a]) * _DOWN[a]
    lengths = ends - starts
    out = mix(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(lengths > _LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    return out, counts


def texts_hashes(texts: list[bytes], lower: bool = False) -> list[np.ndarray]:
    """The word hashes of each text."""
    hashes, counts = word_hashes(texts, lower)
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(texts) else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of `n` consecutive word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    count = len(h) - n + 1
    out = mix(h[:count] + np.uint64(n))
    for i in range(1, n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + count])
    return out


# -- packed arrays -----------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array, one plane per byte of its type, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack(data: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """A sorted uint64 array as packed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of `n` equal ranges of the key space begins and ends in sorted `keys`."""
    starts = np.array([(b << 64) // n for b in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, starts), [len(keys)]]).astype(np.int64)


def positions(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted key in `sorted_keys`, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


# -- blocks ------------------------------------------------------------------------------------


#: Bytes of text in a block of documents: what one Python worker holds at a time, in some thirty times as much memory.
BLOCK_BYTES = 6 << 20


def in_blocks(docs: DataFrame, *extra: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` (doc_id, text, ...) with their block, texts as bytes. The number of blocks follows the bytes of all texts,
    not the session's settings; counting them reads the texts once."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"),
        "doc_id",
        F.col("text").cast("binary").alias("text"),
        *extra,
    )


def rows_of(table: pa.Table, *extra: str) -> list[tuple]:
    """(doc_id, text, ...) of a block in an order that depends on nothing but the rows: nulls first."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "text", *extra)), strict=True))
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return rows


REQUEST = "bucket int, block int, data binary"
REPLY = "block int, bucket int, data binary"


def request_table(rows: Iterable[tuple[int, int, bytes]], names=("bucket", "block", "data")) -> pa.Table:
    a, b, c = zip(*rows, strict=True) if (rows := list(rows)) else ((), (), ())
    return pa.table([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], names=list(names))


def requests_of(table: pa.Table) -> list[tuple[int, bytes]]:
    """(block, data) of one bucket, by block."""
    return sorted(zip(table.column("block").to_pylist(), table.column("data").to_pylist(), strict=True))


def replies_of(table: pa.Table) -> list[bytes]:
    """The answers to one block, by bucket."""
    return [
        d
        for _, d in sorted(zip(table.column("bucket").to_pylist(), table.column("data").to_pylist(), strict=True))
    ]


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and how often each occurs (or the sums of `weights`)."""
    if not len(keys):
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if weights is None:
        counts = np.diff(np.append(first, len(keys)))
    else:
        counts = np.add.reduceat(weights[order], first)
    return keys[first], counts.astype(np.uint32)


def key_counts(blocks: DataFrame, keys_of: Callable[[list[tuple]], np.ndarray], n: int, *extra: str) -> DataFrame:
    """How often each key of each block occurs in all blocks together.

    `keys_of(rows)` gives a block's keys, with repeats. The replies to a block, in bucket order, are packed
    uint32 counts in the order of its sorted distinct keys (`total_counts`).
    """

    def ask(table: pa.Table) -> pa.Table:
        rows = rows_of(table, *extra)
        keys, counts = counted(keys_of(rows))
        edges = bucket_edges(keys, n)
        block = table.column("block")[0].as_py()
        return request_table(
            (b, block, _joined(pack_sorted(keys[i:j]), pack(counts[i:j])))
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if j > i
        )

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        asked = requests_of(table)
        parts = [_parted(d) for _, d in asked]
        keys = [unpack_sorted(p[0]) for p in parts]
        total, sums = counted(np.concatenate(keys), np.concatenate([unpack(p[1], np.uint32) for p in parts]))
        return request_table(
            ((block, bucket, pack(sums[np.searchsorted(total, k)])) for (block, _), k in zip(asked, keys, strict=True)),
            ("block", "bucket", "data"),
        )

    asked = blocks.groupBy("block").applyInArrow(tidy(ask), REQUEST)
    return asked.groupBy("bucket").applyInArrow(tidy(answer), REPLY)


def total_counts(replies: pa.Table) -> np.ndarray:
    """The counts for a block's sorted distinct keys."""
    parts = [unpack(d, np.uint32) for d in replies_of(replies)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _joined(*parts: bytes) -> bytes:
    return np.array([len(parts), *map(len, parts)], np.uint32).tobytes() + b"".join(parts)


def _parted(data: bytes) -> list[bytes]:
    (n,) = np.frombuffer(data, np.uint32, 1)
    sizes = np.frombuffer(data, np.uint32, n, 4)
    ends = 4 + 4 * int(n) + np.cumsum(sizes, dtype=np.int64)
    return [data[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]


joined, parted = _joined, _parted


def table_batches(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of the named columns."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
