"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm on islands.

A document is its ids and an end id; only a document longer than a sequence is cut. Pieces of full length fill a
sequence each. The others are dealt by a hash into groups of about `group_pieces`, and every group is packed by
several islands. An island keeps a few solutions. Crossover injects the best-filled sequences of one
solution into another, removes the sequences that then hold a piece twice, and best-fits the displaced pieces, longest
first. After each epoch an island's best solution also goes to the next island of its group. A group's best
solution counts, so a result never has more sequences than best-fit decreasing.

All choices come from seeds made of group and island, so a lost task is repeated alike. Memory of a task is one group.
Null texts are empty: one piece of one id. Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, pack, prepare, stored, tidy_batches, unpack
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long"
STATE = "group int, island int, solution binary"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most `capacity` ids; with `keep_ids` also the ids (little-endian 32 bits)."""
    prepare(docs.sparkSession)
    schema = PIECES + (", ids binary" if keep_ids else "")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "row_key"))
            for doc_id, text, key in zip(*columns, strict=True):
                data = encode(text) + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    ids = data[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(ids) // 4, zlib.crc32(ids), key, ids))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k, _ in zip(columns, kinds, names, strict=False)], names
            )

    rows = documents(docs).withColumn("row_key", F.xxhash64("doc_id", "text"))
    return rows.mapInArrow(tidy_batches(cut, ("encoder", vocabulary)), schema)


# -- one group ---------------------------------------------------------------------------------


class _Bins:
    """A packing under work: sequences by their free room, with the smallest sufficient room found in one step."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.content: list[list[int]] = []
        self.free: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: some sequence has exactly r free

    def _put(self, which: int, room: int) -> None:
        self.free[which] = room
        self.by_room[room].append(which)
        self.rooms |= 1 << room

    def add(self, content: list[int]) -> None:
        self.content.append(content)
        self.free.append(0)
        self._put(len(self.content) - 1, self.capacity - sum(map(self.lengths.__getitem__, content)))

    def best_fit(self, items: list[int]) -> None:
        for i in items:
            need = self.lengths[i]
            fitting = self.rooms >> need
            if not fitting:
                self.add([i])
                continue
            room = need + (fitting & -fitting).bit_length() - 1
            waiting = self.by_room[room]
            which = waiting.pop()
            if not waiting:
                self.rooms ^= 1 << room
            self.content[which].append(i)
            self._put(which, room - need)


def _fitness(content: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then more uneven filling: well-filled ones are what crossover hands on."""
    fill = np.array([sum(map(lengths.__getitem__, c)) for c in content]) / capacity
    return -len(content), float((fill**2).sum())


def _crossover(a: list[list[int]], b: list[list[int]], lengths: list[int], capacity: int, rng: random.Random):
    """`a` with the best-filled sequences of `b`."""
    full = sorted(b, key=lambda c: sum(map(lengths.__getitem__, c)), reverse=True)
    injected = full[: max(1, int(len(full) * rng.uniform(0.3, 0.7)))]
    inside = {i for c in injected for i in c}
    bins = _Bins(lengths, capacity)
    for c in injected:
        bins.add(c[:])
    displaced = []
    for c in a:
        if inside.isdisjoint(c):
            bins.add(c[:])
        else:
            displaced += [i for i in c if i not in inside]
    displaced.sort(key=lambda i: (-lengths[i], i))
    bins.best_fit(displaced)
    return bins.content


def _shaken(order: list[int], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Best fit in an order that is only nearly decreasing: another start for the search."""
    bins = _Bins(lengths, capacity)
    noise = [lengths[i] * rng.uniform(0.9, 1.1) for i in order]
    bins.best_fit([i for _, i in sorted(zip(noise, order, strict=True), reverse=True)])
    return bins.content


def evolve(
    lengths: list[int], capacity: int, seed: int, given: list[list[list[int]]], population: int, generations: int
) -> list[list[int]]:
    """An island's best solution after some generations from the `given` solutions."""
    rng = random.Random(seed)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    decreasing = _Bins(lengths, capacity)
    decreasing.best_fit(order)
    people = [decreasing.content, *given]
    while len(people) < population:
        people.append(_shaken(order, lengths, capacity, rng))
    scored = sorted(((_fitness(p, lengths, capacity), n, p) for n, p in enumerate(people)), reverse=True)[:population]
    bound = -(-sum(lengths) // capacity)
    for generation in range(generations):
        if -scored[0][0][0] <= bound:
            break
        a, b = rng.sample(scored, 2)
        child = _crossover(min(a, b)[2], max(a, b)[2], lengths, capacity, rng)
        scored.append((_fitness(child, lengths, capacity), population + generation, child))
        scored = sorted(scored, reverse=True)[:population]
    return scored[0][2]


def _assigned(content: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for which, c in enumerate(content):
        out[c] = which
    return out


def _contents(assigned: np.ndarray) -> list[list[int]]:
    order = np.argsort(assigned, kind="stable")
    cuts = np.flatnonzero(np.diff(assigned[order])) + 1
    return [c.tolist() for c in np.split(order, cuts)] if len(order) else []


# -- all groups --------------------------------------------------------------------------------


def _group_rows(table: pa.Table) -> tuple[np.ndarray, list[int]]:
    """Order of a group's rows that depends on nothing but the rows, and their lengths in it."""
    doc = table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
    order = np.lexsort((table.column("row_key").to_numpy(), table.column("piece").to_numpy(), doc))
    return order, table.column("length").to_numpy()[order].tolist()


def place(
    cut: DataFrame,
    capacity: int,
    group_pieces: int = 8192,
    islands: int = 3,
    epochs: int = 2,
    population: int = 4,
    generations: int = 5,
) -> DataFrame:
    """The rows of `cut` (see `pieces`) with sequence_id and offset."""
    prepare(cut.sparkSession)
    groups = max(1, -(-cut.where(F.col("length") < capacity).count() // group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)).cast("int"))
    short = dealt.where(F.col("length") < capacity)
    slim = short.select("group", "doc_id", "piece", "length", "row_key")
    crowd = slim.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))

    def epoch_of(epoch: int):
        def run(key, items: pa.Table, elites: pa.Table) -> pa.Table:
            group, island = (k.as_py() for k in key)
            _, lengths = _group_rows(items)
            given = [_contents(unpack(s, np.uint32)) for s in sorted(elites.column("solution").to_pylist())]
            seed = (group * islands + island) * epochs + epoch
            best = evolve(lengths, capacity, seed, given, population, generations)
            rows = [(group, island, pack(_assigned(best, len(lengths))))]
            if epoch + 1 < epochs:  # the elite moves on to the next island
                rows.append((group, (island + 1) % islands, rows[0][2]))
            g, i, s = zip(*rows, strict=True)
            return pa.table({"group": pa.array(g, pa.int32()), "island": pa.array(i, pa.int32()), "solution": s})

        return run

    state = cut.sparkSession.createDataFrame([], STATE)
    for epoch in range(epochs):
        both = crowd.groupBy("group", "island").cogroup(state.groupBy("group", "island"))
        state = stored(both.applyInArrow(epoch_of(epoch), STATE), "islands")

    def best_of(key, items: pa.Table, found: pa.Table) -> pa.Table:
        (group,) = (k.as_py() for k in key)
        order, lengths = _group_rows(items)
        solutions = [_contents(unpack(s, np.uint32)) for s in sorted(found.column("solution").to_pylist())]
        best = max(solutions, key=lambda c: _fitness(c, lengths, capacity), default=[])
        assigned = _assigned(best, len(lengths)).astype(np.int64)
        # Within a sequence pieces stand in the group's order, without gaps.
        by_bin = np.argsort(assigned, kind="stable")
        size = np.array(lengths, np.int64)[by_bin]
        before = np.cumsum(size) - size
        first = np.concatenate([[True], np.diff(assigned[by_bin]) > 0]) if len(by_bin) else np.empty(0, bool)
        offset = np.empty(len(lengths), np.int64)
        offset[by_bin] = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(by_bin))))
        out = items.take(pa.array(order)).drop_columns(["group"])
        out = out.append_column("sequence_id", pa.array((np.int64(group) << 32) + 2 * assigned))
        return out.append_column("offset", pa.array(offset))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    packed = short.groupBy("group").cogroup(state.groupBy("group"))
    packed = packed.applyInArrow(best_of, f"{names}, sequence_id long, offset long")
    # A full piece is a sequence of its own; odd numbers keep them apart from the packed ones.
    full = dealt.where(F.col("length") == capacity)
    own = (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id")
    return packed.unionByName(full.select(*cut.columns, own, F.lit(0).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 2048, **search: int) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stored(pieces(docs, vocabulary, end_id, capacity), "pieces")
    return place(cut, capacity, **search).drop("row_key")
