"""Runs of words that repeat with a period, found by seeds on diagonals and extended once.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
`max(MIN_LENGTH, MIN_TURNS * q)` words long, that no neighbouring word extends. In the square of a document against itself
it lies on the diagonal of lag q and has at least max(24 - q, 2q) equal pairs of words there.

**Seeds.** Equal k-grams of one document are indexed for k = 16, 32, 64, ...: lags up to 16 are guaranteed an overlap of 16
equal pairs, lags of 17 to 32 one of 34, and so on, so k = 16 serves the first and each doubling of k the lags in (k/2, k].
Where the lag does not exceed k and is the smallest period, no occurrence of the k-gram lies between the two (else both
distances, and by Fine and Wilf's theorem their common divisor, would be periods). So it is enough to list each occurrence
with the *next* one: at most one pair per place and k, however often a k-gram is repeated. K-grams are numbered exactly by
doubling (a k-gram is its two halves), and a place whose half is not repeated in its document is left out at once.

**Extension.** Seeds of one lag are taken by place. A table per lag holds how far the words were compared; a seed below that
is passed over, any other is extended to both sides, in steps that double, until two words differ. Each lag's words
are thus compared at most once, and every run found has its lag as its smallest period.

The work is one `mapInArrow` over the rows: no shuffle, nothing larger than a batch of rows or one document per task.

Nulls and corner cases: a null text has no words, hence no runs and an empty collapsed text, as do texts of white space.
Null doc_ids pass through; rows are treated one by one, so repeated rows and ties need no rule. Texts of any
length are taken whole. Empty tables give empty tables. Other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table_batches

MIN_LENGTH, MIN_TURNS = 24, 3
#: Smallest overlap of a run with itself, over all lags.
SEED = 16
#: Words of the documents that are indexed together.
TOGETHER = 1 << 18

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _numbered(pairs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs at ascending `places` those that occur more than once: their places in order of pair and place, a
    number per pair, and whether the next entry holds the same pair."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = pairs[1:] == pairs[:-1]
    often = same[:-1] | same[1:]
    return places[order[often]], np.cumsum(~same[:-1])[often], same[1:][often]


def seeds(words: np.ndarray, document: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) of occurrences of repeated k-grams and their next occurrence in the same document."""
    n = len(words)
    if n == 0:
        return
    # numbers stand for a document's words, so no k-gram crosses documents
    places, numbers, again = _numbered(document * (int(words.max()) + 1) + words, np.arange(n))
    number = np.zeros(n, np.int64)
    k = 1
    while len(places):
        if k >= SEED:
            at = np.flatnonzero(again)
            lag = places[at + 1] - places[at]
            fits = (lag <= k) & ((lag > k // 2) | (k == SEED))
            yield places[at[fits]], lag[fits]
        number[:] = 0
        number[places] = numbers
        halves = np.flatnonzero((number[: max(0, n - k)] > 0) & (number[k:] > 0))
        places, numbers, again = _numbered(number[halves] * (n + 1) + number[halves + k], halves)
        k *= 2


def _equal_from(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words agree from `a` and `b` on, forwards or backwards; b > a."""
    done, size = 0, 32
    while True:
        room = min(size, len(words) - b - done if step > 0 else a + 1 - done)
        if room <= 0:
            return done
        if step > 0:
            x, y = words[a + done : a + done + room], words[b + done : b + done + room]
        else:
            x, y = words[a - done - room + 1 : a - done + 1][::-1], words[b - done - room + 1 : b - done + 1][::-1]
        differs = np.flatnonzero(x != y)
        if len(differs):
            return done + int(differs[0])
        done, size = done + room, size * 2


def runs_of(words: np.ndarray, places: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of a document's runs, by start and period, from its seeds."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    # neighbouring seeds of a lag lie in one stretch, the first of them speaks for all
    first = np.ones(len(places), bool)
    first[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    covered: dict[int, int] = {}
    found = []
    for place, lag in zip(places[first].tolist(), lags[first].tolist(), strict=True):
        if place < covered.get(lag, 0):
            continue
        start = place - _equal_from(words, place - 1, place - 1 + lag, -1)
        end = place + _equal_from(words, place, place + lag, 1)
        covered[lag] = end
        if end - start + lag >= max(MIN_LENGTH, MIN_TURNS * lag):
            found.append((start, end - start + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _document_runs(numbers: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs of each document, given its words as numbers."""
    lengths = np.array([len(x) for x in numbers])
    starts = np.cumsum(lengths) - lengths
    words = np.concatenate(numbers)
    document = np.repeat(np.arange(len(numbers)), lengths)
    parts = list(seeds(words, document))
    found: list[list[tuple[int, int, int]]] = [[] for _ in numbers]
    if parts:
        places, lags = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(document[places], kind="stable")
        places, lags = places[order], lags[order]
        owner = document[places]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)], strict=True):
            d = int(owner[a])
            found[d] = runs_of(numbers[d], places[a:b] - starts[d], lags[a:b])
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, runs (array of start, length, period), collapsed (binary, UTF-8)` of every row of `docs`."""
    prepare(docs.sparkSession)
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def work(held: list[tuple]) -> pa.RecordBatch:
        vocabulary: dict[bytes, int] = {}
        split = [(body or b"").split() for _, body in held]
        numbers = []
        for words in split:
            for w in set(words).difference(vocabulary):
                vocabulary[w] = len(vocabulary)
            numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
        found = _document_runs(numbers)
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in found]
        texts = [collapsed(words, own) for words, own in zip(split, found, strict=True)]
        return pa.record_batch(
            [
                pa.array([r[0] for r in held], pa.int64()),
                pa.array([len(w) for w in split], pa.int64()),
                pa.array(runs, pa.list_(_RUN)),
                pa.array(texts, pa.binary()),
            ],
            names,
        )

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in table_batches(batches, "doc_id", "text"):
            held.append(row)
            size += 1 + len(row[1] or b"") // 6
            if size > TOGETHER:
                yield work(held)
                held, size = [], 0
        if held:
            yield work(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(batches_of, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
