"""Language of a text by prediction by partial matching: the language whose byte model codes the text shortest.

**Model.** A text is coded as its words, each followed by one space (white space is `[\\x20\\x09-\\x0D]+`). Every language
has a tree of byte contexts of 0 to `order` bytes; a context reaches back to the space before the word at most, so the
code length of a word depends on the word alone. In a context seen T times with D kept symbols, a symbol seen c times
has probability c / (T + D); the rest, T + D minus the kept counts over T + D, is the escape to the context shorter by
one byte, where the symbols kept here are excluded. With that exclusion the probabilities of the 256 symbols add up to
one in every context, so the negative logarithms are exact code lengths. Below the empty context all 256 are alike.

**Frozen statistics.** Byte n-grams are counted over all learning texts in Spark (each task counts distinct words first and
sends n-grams). An n-gram is kept where it makes up at least `languages / nodes` of its language's coded symbols. At
most `nodes` n-grams per length remain in all languages together whatever the size of the corpus, which bounds what is
collected and broadcast: (order + 1) * nodes * languages numbers of four bytes. What is not kept stays in the escape.
Kept n-grams are closed under cutting a byte at either end. More than `MAX_LANGUAGES` different labels are refused.

**Code lengths** are integers in units of 2**-16 bits, so sums do not depend on the order of words, rows or tasks.

Nulls and corner cases: rows with a null text, or without a letter (Unicode category L), are `und` with score 0, as is
every row if nothing could be learned. Null doc_ids pass through. Repeated rows are scored alike and count as often as
they occur in learning. Ties go to the smallest language value. Learning rows with a null language or no word are
ignored. Very long texts are scored whole, in runs of words; words beyond 64 bytes are not remembered between batches.
Only `doc_id`, `text` and (in learning) `lang` are read; other columns are left behind.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, prepare, table_batches

UNIT = 1 << 16
MAX_LANGUAGES = 200
UNKNOWN = "und"
#: Distinct words a task counts before it sends their n-grams.
COUNTED = 200_000
#: Words a worker remembers the code lengths of, and the longest of them.
REMEMBERED, LONGEST = 200_000, 64


# -- n-grams -----------------------------------------------------------------------------------


def _coded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of ` word ` for all words in a row, each byte's place in its word (0: the space before it), and where the
    words begin."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)
    starts = np.cumsum(lengths) - lengths
    return data, np.arange(len(data)) - np.repeat(starts, lengths), starts


def _grams(data: np.ndarray, place: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, index of the last byte, key) of the n-grams of each length; the last byte is a coded symbol."""
    wide = data.astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for length in range(1, order + 2):
        last = np.flatnonzero(place >= max(1, length - 1))
        key[last] |= wide[last - (length - 1)] << np.uint64(8 * (length - 1))
        yield length, last, key[last] | np.uint64(length << 56)


def gram_counts(learning: DataFrame, order: int) -> DataFrame:
    """`lang, gram, n`: how often each n-gram of 1 to `order` + 1 bytes is coded in the texts of each language. A gram is
    its bytes as an integer, its length in the eighth byte."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                data, place, _ = _coded(list(words))
                weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), [len(w) + 2 for w in words])
                for _, last, keys in _grams(data, place, order):
                    distinct, at = np.unique(keys, return_inverse=True)
                    sums = np.zeros(len(distinct), np.int64)
                    np.add.at(sums, at, weight[last])
                    langs = pa.DictionaryArray.from_arrays(np.zeros(len(distinct), np.int32), [lang]).cast(pa.string())
                    yield pa.record_batch([langs, pa.array(distinct.view(np.int64)), pa.array(sums)], ["lang", "gram", "n"])
            seen.clear()

        for text, lang in table_batches(batches, "text", "lang"):
            words = text.split()
            if words:
                own = seen.setdefault(lang, Counter())
                before = len(own)
                own.update(words)
                held += len(own) - before
                if held > COUNTED:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = learning.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("text").cast("binary").alias("text"), F.col("lang").cast("string").alias("lang"))
    partial = rows.mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# -- trees -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ContextTrees:
    """All languages' trees: per n-gram length the sorted n-grams, the code length of the last byte after the others in
    every language, and what an escape from the whole n-gram as a context costs."""

    languages: tuple[str, ...]
    order: int
    grams: tuple[np.ndarray, ...]
    costs: tuple[np.ndarray, ...]
    escapes: tuple[np.ndarray, ...]
    root_escape: np.ndarray


_MASK = np.uint64((1 << 56) - 1)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _context(keys: np.ndarray, length: int) -> np.ndarray:
    """Keys of the n-grams without their last byte."""
    return ((keys & _MASK) >> np.uint64(8)) | np.uint64((length - 1) << 56)


def _suffix(keys: np.ndarray, length: int) -> np.ndarray:
    """Keys of the n-grams without their first byte."""
    return (keys & np.uint64((1 << (8 * (length - 1))) - 1)) | np.uint64((length - 1) << 56)


def _language_tree(keys: list[np.ndarray], counts: list[np.ndarray], total: int):
    """Per length: code length in bits of each n-gram's last byte; and per length from 0 the bits an escape from each
    n-gram as a context takes (0 where it is no context)."""
    bits, escapes = [], []
    lower = np.full(len(keys[0]), 1 / 256)
    at, seen = np.zeros(len(keys[0]), np.int64), np.array([total])
    for length, (own, n) in enumerate(zip(keys, counts, strict=True), 1):
        if length > 1:
            at = _find(keys[length - 2], _context(own, length))
            lower = chance[_find(keys[length - 2], _suffix(own, length))]  # noqa: F821
            seen = counts[length - 2]
        kept = np.bincount(at, minlength=len(seen))
        mass = seen + kept
        chance = n / mass[at]
        left = (mass - np.bincount(at, n, minlength=len(seen))) / mass
        shared = 1 - np.bincount(at, lower, minlength=len(seen))
        with np.errstate(divide="ignore"):
            escapes.append(np.where(kept > 0, -np.log2(left / np.maximum(shared, 1e-12)), 0.0))
        bits.append(-np.log2(chance))
    escapes.append(np.zeros(len(keys[-1])))
    return bits, escapes


def build_trees(rows: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> ContextTrees:
    """The trees of all languages from their kept n-grams and counts."""
    languages = tuple(sorted(rows))
    if not languages:
        return ContextTrees((), order, (), (), (), np.empty(0, np.int32))
    fixed = lambda bits: np.rint(bits * UNIT).astype(np.int32)
    own = []
    for lang in languages:
        keys, counts = rows[lang]
        sort = np.argsort(keys)
        keys, counts = keys[sort], counts[sort].astype(np.int64)
        ends = np.searchsorted(keys, np.array([n << 56 for n in range(1, order + 3)], np.uint64))
        parts = [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        keys, counts = [keys[p] for p in parts], [counts[p] for p in parts]
        own.append((keys, *_language_tree(keys, counts, int(counts[0].sum()))))
    grams, costs, escapes = [], [], []
    root = fixed(np.array([e[0][0] for _, _, e in own]))
    for length in range(1, order + 2):
        union = np.unique(np.concatenate([k[length - 1] for k, _, _ in own]))
        cost, escape = (np.zeros((len(union), len(own)), np.int32) for _ in range(2))
        if length > 1:
            context, suffix = _find(grams[-1], _context(union, length)), _find(grams[-1], _suffix(union, length))
        for j, (keys, bits, out) in enumerate(own):
            at = _find(keys[length - 1], union)
            below = 8 * UNIT + root[j] if length == 1 else escapes[-1][context, j] + costs[-1][suffix, j]
            cost[:, j] = np.where(at >= 0, fixed(bits[length - 1])[at], below) if len(keys[length - 1]) else below
            if len(keys[length - 1]):
                escape[:, j] = np.where(at >= 0, fixed(out[length])[at], 0)
        grams.append(union)
        costs.append(cost)
        escapes.append(escape)
    return ContextTrees(languages, order, tuple(grams), tuple(costs), tuple(escapes), root)


def learn(learning: DataFrame, order: int = 4, nodes: int = 1 << 17) -> ContextTrees:
    """The trees of the languages of `learning` (text, lang), from all its rows."""
    if not 0 <= order <= 6:
        raise ValueError("order must be 0 to 6")
    prepare(learning.sparkSession)
    counts = gram_counts(learning, order).persist()
    length = F.shiftright("gram", 56)
    try:
        totals = counts.where(length == 1).groupBy("lang").agg(F.sum("n").alias("total"))
        found = totals.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} different languages: the labels are no language codes")
        wanted = F.lit(False)
        for r in found:
            least = max(1, -(-r["total"] * len(found) // nodes))
            wanted = wanted | ((F.col("lang") == r["lang"]) & (F.col("n") >= least))
        kept = counts.where(wanted).toArrow()
    finally:
        counts.unpersist()
    langs = np.array(kept.column("lang").to_pylist(), object)
    grams = kept.column("gram").to_numpy().view(np.uint64)
    n = kept.column("n").to_numpy()
    return build_trees({r["lang"]: (grams[langs == r["lang"]], n[langs == r["lang"]]) for r in found}, order)


# -- code lengths ------------------------------------------------------------------------------


def word_costs(words: list[bytes], trees: ContextTrees) -> np.ndarray:
    """Code length of each word and the space after it, one column per language."""
    data, place, starts = _coded(words)
    total = np.full((len(data), len(trees.languages)), 8 * UNIT, np.int64) + trees.root_escape
    before = np.full(len(data), -1)
    for length, last, keys in _grams(data, place, trees.order):
        at = _find(trees.grams[length - 1], keys)
        hit, miss = at >= 0, at < 0
        if length > 1:
            context = before[last[miss] - 1]
            known = context >= 0
            total[last[miss][known]] += trees.escapes[length - 2][context[known]]
        total[last[hit]] = trees.costs[length - 1][at[hit]]
        before = np.full(len(data), -1)
        before[last] = at
        if length == 1:  # the space before a word is a context like the space that ends one
            before[starts] = _find(trees.grams[0], np.array([(1 << 56) | 32], np.uint64))[0]
    total[starts] = 0
    return np.add.reduceat(total, starts, axis=0)


class Coder:
    """Code lengths of texts; remembers those of words."""

    def __init__(self, trees: ContextTrees):
        self.trees = trees
        self.places: dict[bytes, int] = {}
        self.rows = np.empty((0, len(trees.languages)), np.int64)

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in every language, in units."""
        split = [t.split() for t in texts]
        out = np.zeros((len(texts), len(self.trees.languages)), np.int64)
        words = [w for own in split for w in own]
        if not words:
            return out
        if len(self.places) > REMEMBERED:
            self.places, self.rows = {}, self.rows[:0]
        new = [w for w in set(words) if w not in self.places]
        if new:
            self.places.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, word_costs(new, self.trees)])
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        full = np.flatnonzero(lengths)
        out[full] = np.add.reduceat(self.rows[at], (np.cumsum(lengths) - lengths)[full], axis=0)
        for w in new:
            if len(w) > LONGEST:
                del self.places[w]
        return out


def shares(costs: np.ndarray) -> np.ndarray:
    """Posterior share of each language, all alike before the text is read."""
    above = (costs - costs.min(axis=1, keepdims=True)) / UNIT
    weights = np.exp2(-np.minimum(above, 1000))
    return weights / weights.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """`doc_id, lang_pred, score, bits`: the language with the shortest code, its posterior share, and the code length in
    bits per language in the order of `trees.languages` (null for `und`)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(trees)
    key = uuid.uuid4().hex
    fields = "doc_id long, lang_pred string, score double, bits array<double>"
    names = ["doc_id", "lang_pred", "score", "bits"]

    def run(rows: list[tuple]) -> pa.RecordBatch:
        coder = held(key, lambda: Coder(shared.value))
        languages = coder.trees.languages
        coded = [i for i, r in enumerate(rows) if r[1] is not None and languages]
        label, score, bits = [UNKNOWN] * len(rows), [0.0] * len(rows), [None] * len(rows)
        if coded:
            costs = coder.texts([rows[i][1] for i in coded])
            best, share = costs.argmin(axis=1), shares(costs)
            for k, i in enumerate(coded):
                label[i], score[i], bits[i] = languages[best[k]], float(share[k, best[k]]), (costs[k] / UNIT).tolist()
        ids = pa.array([r[0] for r in rows], pa.int64())
        return pa.record_batch(
            [ids, pa.array(label, pa.string()), pa.array(score), pa.array(bits, pa.list_(pa.float64()))], names
        )

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in table_batches(batches, "doc_id", "text"):
            held.append(row)
            size += len(row[1] or b"")
            if size > 1 << 22 or len(held) >= 4096:
                yield run(held)
                held, size = [], 0
        if held:
            yield run(held)

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lettered.alias("text"))
    return rows.mapInArrow(score_batches, fields)
