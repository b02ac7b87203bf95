"""Token ids of a corpus in files with Elias-Fano document boundaries, and reading them back.

The format is a Parquet table of *segments*, about `segment_tokens` ids each, in ascending doc_id order
(nulls first; rows with one doc_id by a hash of their text). A segment holds the concatenated ids (two bytes
each where the vocabulary allows), its document ids, and the ends of its documents as an Elias-Fano sequence:
`l` low bits of every end side by side, the high parts as a unary bit vector, and the position of every 64th
set bit. `ends` decodes all boundaries, `select` any single one without decoding the others. Of n documents with
U ids a segment spends about 2 + log2(U / n) bits a document. No 64-bit offset table exists: a document's
start is shard offset + segment base + select.

An empty or null text is a document of one id, the end id. A document longer than a segment is a segment of its own.
An empty table gives an empty file set. Repeated rows are documents of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare, stored, tidy_batches
from .tokens import encoder

SAMPLE = 64

SEGMENTS = (
    "shard int, segment int, base long, n_docs int, n_tokens long, doc_ids binary, doc_nulls int, "
    "low_bits int, low binary, high binary, samples binary, width int, ids binary"
)
SPANS = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass
class EliasFano:
    """A non-decreasing sequence of n integers below or equal to a bound."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bound = int(values[-1]) if n else 0
        low_bits = max(0, (bound // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return EliasFano(
            n,
            low_bits,
            np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            at[::SAMPLE].astype(np.uint32).tobytes(),
        )

    def _low(self, first: int, count: int) -> np.ndarray:
        """`count` low parts from `first` on."""
        if not self.low_bits:
            return np.zeros(count, np.int64)
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        raw = np.frombuffer(self.low, np.uint8)[begin // 8 : (end + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[begin % 8 : begin % 8 + end - begin]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        return ((at - np.arange(self.n)) << self.low_bits) | self._low(0, self.n)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sampled bit on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        bit = int(np.frombuffer(self.samples, np.uint32)[i // SAMPLE])
        left = i % SAMPLE
        byte, value = bit // 8, self.high[bit // 8] >> bit % 8
        at = bit
        while left >= value.bit_count():
            left -= value.bit_count()
            byte += 1
            at, value = byte * 8, self.high[byte]
        for _ in range(left):
            value &= value - 1
        at += (value & -value).bit_length() - 1
        return ((at - i) << self.low_bits) | int(self._low(i, 1)[0])


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, segment_tokens: int = 1 << 20, vocabulary_size: int = 1 << 32
) -> DataFrame:
    """Write the ids of all documents, each followed by `end_id`, and return the table of segments."""
    n = prepare(docs.sparkSession)
    width = 2 if vocabulary_size <= 1 << 16 else 4
    ordered = documents(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        shard = TaskContext.get().partitionId()
        segment, base = 0, 0
        ids: list[bytes] = []
        doc_ids: list[int] = []
        nulls = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, base, nulls, size
            ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
            ef = EliasFano.of(ends)
            flat = np.frombuffer(b"".join(ids), "<u4")
            row = [
                *(shard, segment, base, len(ids), size),
                np.array(doc_ids, "<i8").tobytes(),
                nulls,
                *(ef.low_bits, ef.low, ef.high, ef.samples, width),
                (flat.astype("<u2") if width == 2 else flat).tobytes(),
            ]
            segment, base = segment + 1, base + size
            nulls = size = 0
            ids.clear()
            doc_ids.clear()
            return _batch(SEGMENTS, [[x] for x in row])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = encode(text) + end
                if ids and size + len(data) // 4 > segment_tokens:
                    yield flush()
                ids.append(data)
                doc_ids.append(doc_id or 0)
                nulls += doc_id is None  # nulls come first
                size += len(data) // 4
        if ids:
            yield flush()

    return stored(ordered.select("doc_id", "text").mapInArrow(tidy_batches(segments, ("encoder", vocabulary)), SEGMENTS), "token-files")


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for (_, kind), c in zip(named, columns, strict=True)], [name for name, _ in named]
    )


def read_spans(files: DataFrame) -> DataFrame:
    """Per document of the files: its span in the whole id sequence, and the crc32 of its ids as unsigned
    little-endian 32-bit integers."""
    prepare(files.sparkSession)
    # One row a shard, so as many as partitions wrote the files.
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    before, offsets = 0, {}
    for shard, n in sorted(totals):
        offsets[shard] = before
        before += n

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ef = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
                ends = ef.all()
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
                doc_ids = np.frombuffer(row["doc_ids"], "<i8").tolist()
                doc_ids[: row["doc_nulls"]] = [None] * row["doc_nulls"]
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                first = offsets[row["shard"]] + row["base"]
                yield _batch(SPANS, [[row["shard"]] * len(ends), doc_ids, starts + first, ends - starts, crcs])

    return files.mapInArrow(spans, SPANS)
