"""Language-model scores by Katz backoff with Good-Turing discounts, for corpora of any size.

A text is its words `[^\\x20\\x09-\\x0D]+` in lower case (A-Z only), between a start mark, which is only ever context, and
an end, which counts as a token. Level n of the model counts n-grams of the training texts. A gram is known by
(id of its context gram, id of its word); ids are dealt densely, so grams are compared exactly and stored in a few
bytes. With n_r grams that occur r times, counts up to k are discounted by Katz's form of Good-Turing,

    d_r = (r* / r - (k+1) n_(k+1) / n_1) / (1 - (k+1) n_(k+1) / n_1),   r* = (r+1) n_(r+1) / n_r,

or by (r - 1/2) / r where the counts of counts do not give a number between 0 and 1. The score of a token is

    P(w | h) = d c(hw) / c(h)            if hw was seen,
               P(w | h')                 if h was never seen,
               a(h) P(w | h')            otherwise, with
    a(h)     = sum over r of (1 - d_r) r n_r(h) / c(h)  /  (1 - sum over seen hw of P(w | h')),

so that probabilities after every context sum to one. A context after which nothing is rarer than k+1 counts one
occurrence more, which is its mass for the unseen. Unknown words are one class with the unigrams' free mass.

Each level is one round of requests between blocks of documents and buckets of contexts, whose
result is stored as partitioned tables: the grams and counts ("model"), counts of counts, and the answers. The contexts
that have more than a quarter of a bucket's share of tokens are spread over all buckets by the next word and added up
apart; there are at most 4 per bucket. Where a context is counted changes nothing in what is counted, so scores
do not depend on the number of buckets.

Null and empty texts are one token, the end. An empty table gives an empty result; without training rows every score is
0 (one unknown class). Null doc_ids and null training flags count as held out; repeated rows are texts of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    counted, in_blocks, joined, mix, pack, pack_sorted, parted, prepare, rows_of,
    scratch, tidy, tidy_both, unpack, unpack_sorted, bucket_edges, word_hashes,
)

KEEP = 5  # counts above are taken as they are
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
ANSWER = "kind string, bucket int, block int, data binary"


@dataclass
class Discounts:
    """d_r of one level, r from 0 (unused) to KEEP."""

    d: np.ndarray

    @staticmethod
    def of(n: np.ndarray) -> Discounts:
        """From counts of counts n_1 .. n_(KEEP+1)."""
        n = np.concatenate([[0.0], n.astype(float)])
        d = np.ones(KEEP + 1)
        common = (KEEP + 1) * n[KEEP + 1] / n[1] if n[1] else 1.0
        for r in range(1, KEEP + 1):
            good = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
            d[r] = good if 0 < good < 1 else (r - 0.5) / r
        return Discounts(d)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= KEEP, self.d[np.minimum(counts, KEEP)], 1.0) * counts

    def free(self, n: np.ndarray) -> np.ndarray:
        """Mass taken from counts, given columns n_1 .. n_KEEP."""
        return n @ ((1 - self.d[1:]) * np.arange(1, KEEP + 1))


@dataclass
class Level:
    """What is known once a level is counted."""

    discounts: Discounts
    tokens: int  # N
    words: int  # V
    hot: dict[int, tuple[np.ndarray, float]]  # context -> n_1 .. n_KEEP, sum of lower-order probabilities


@dataclass
class Tokens:
    """The tokens of a block at one level: their grams' counts and ids, their contexts' counts."""

    count: np.ndarray
    ids: np.ndarray
    den: np.ndarray
    alpha: np.ndarray


def _sequences(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts with their marks, index of the token before each, training flag of each."""
    words, counts = word_hashes([text for _, text, _ in rows], lower=True)
    # Every text is preceded by a start mark and followed by an end.
    starts = np.cumsum(counts + 2) - (counts + 2)
    h = np.empty(len(words) + 2 * len(rows), np.uint64)
    solid = np.ones(len(h), bool)
    for mark, at in ((START, starts), (END, starts + counts + 1)):
        h[at], solid[at] = mark, False
    h[solid] = words
    before = np.arange(-1, len(h) - 1)
    before[starts] += 1
    return h, before, np.repeat(np.array([bool(flag) for *_, flag in rows], bool), counts + 2)


@dataclass
class Request:
    """Distinct grams of a block in the order they are asked for, and each token's place in it."""

    place: np.ndarray
    edges: np.ndarray  # of buckets
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray
    in_context: np.ndarray  # count of the context
    low_count: np.ndarray
    low_den: np.ndarray
    hot: np.ndarray


def _request(context: np.ndarray, word: np.ndarray, train: np.ndarray, in_context: np.ndarray, low: Tokens, n: int, hot_at: float) -> Request:
    contexts, c = np.unique(context, return_inverse=True)
    words, w = np.unique(word, return_inverse=True)
    _, first, place, counts = _grouped(c.astype(np.uint64) * np.uint64(max(1, len(words))) + w.astype(np.uint64), train)
    context, word, in_context = context[first], word[first], in_context[first]
    hot = in_context > hot_at
    bucket = mix(np.where(hot, mix(context) + word, context)) % np.uint64(n)
    order = np.lexsort((word, context, bucket))
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    first = first[order]
    edges = np.searchsorted(bucket[order], np.arange(n + 1).astype(np.uint64))
    return Request(
        moved[place], edges, context[order], word[order], counts[order], in_context[order], low.count[first],
        low.den[first], hot[order],
    )


def _grouped(keys: np.ndarray, train: np.ndarray):
    """Distinct keys, first place of each, group of each place, and number of training places per group."""
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, first, place, np.bincount(place, train, len(distinct)).astype(np.uint32)


class Scorer:
    """The rounds of one model over one block; goes to the tasks with what the levels before have told."""

    def __init__(self, n: int, order: int):
        self.n, self.order = n, order
        self.levels: list[Level] = []

    def tokens(self, rows: list[tuple], answers: list[list[bytes]]):
        """(word hashes, before, train, Tokens of each answered level, last request)."""
        h, before, train = _sequences(rows)
        keys, _, place, counts = _grouped(h, train)
        if not answers:
            return h, before, train, [], (keys, counts)
        got = [parted(a) for a in answers[0]]
        word_count = _gathered([g[0] for g in got], np.uint32)[place].astype(np.int64)
        word = _gathered([g[1] for g in got], np.uint64)[place]
        level = self.levels[0]
        out = [Tokens(word_count, word, np.full(len(h), max(1, level.tokens)), np.ones(len(h)))]
        for depth in range(2, len(answers) + 2):
            low, level = out[-1], self.levels[depth - 2]
            asked = _request(
                low.ids[before], word, train, low.count[before], low, self.n, self.levels[0].tokens / (4 * self.n)
            )
            if depth > len(answers):
                return h, before, train, out, asked
            out.append(self._answered(asked, answers[depth - 1], self.levels[depth - 1], before, low))
        return h, before, train, out, None

    def _answered(self, asked: Request, answers: list[bytes], level: Level, before: np.ndarray, low: Tokens) -> Tokens:
        got = [parted(a) for a in answers]
        count = _gathered([g[0] for g in got], np.uint32).astype(np.int64)
        ids = _gathered([g[1] for g in got], np.uint64)
        flag = _gathered([g[2] for g in got], np.uint8)
        if level.hot:  # whether a hot context counts one occurrence more is known from all its buckets together
            known = np.array(sorted(level.hot), np.uint64)
            none = np.array([not level.hot[int(c)][0].any() for c in known])
            at = np.minimum(np.searchsorted(known, asked.context), len(known) - 1)
            flag = np.where(asked.hot & (known[at] == asked.context), none[at], flag)
        rare = _gathered([g[3] for g in got], np.uint32).reshape(-1, KEEP).astype(float)
        sums = _gathered([g[4] for g in got], np.float64)
        alpha = np.ones(len(count))
        open_ = (count == 0) & (asked.in_context > 0)
        alpha[open_ & ~asked.hot] = _weight(level.discounts, rare, asked.in_context[open_ & ~asked.hot], sums)
        for i in np.flatnonzero(open_ & asked.hot):
            n, s = level.hot[int(asked.context[i])]
            alpha[i] = _weight(level.discounts, n[None], asked.in_context[i : i + 1], np.array([s]))[0]
        p = asked.place
        return Tokens(count[p], ids[p], (asked.in_context + flag)[p], alpha[p])

    def score(self, levels: list[Tokens]) -> np.ndarray:
        """log10 P of every token, from the shortest gram up."""
        first = self.levels[0]
        free = float(first.discounts.free(self.unigrams[None])[0]) if first.tokens else 1.0
        if first.tokens and free == 0:
            free, total = 1.0, first.tokens + 1
        else:
            total = max(1, first.tokens)
        p = np.where(levels[0].count > 0, first.discounts(levels[0].count), free) / total
        for tokens, level in zip(levels[1:], self.levels[1:], strict=True):
            seen = level.discounts(tokens.count) / np.maximum(1, tokens.den)
            p = np.where(tokens.count > 0, seen, tokens.alpha * p)
        return np.log10(p)


def _weight(discounts: Discounts, rare: np.ndarray, in_context: np.ndarray, lower: np.ndarray) -> np.ndarray:
    free = discounts.free(rare)
    free, total = np.where(free > 0, free, 1.0), np.where(free > 0, in_context, in_context + 1)
    return free / total / np.maximum(1e-12, 1 - lower)


def _gathered(parts: list[bytes], dtype: type) -> np.ndarray:
    return np.concatenate([unpack(p, dtype) for p in parts]) if parts else np.empty(0, dtype)


def _answers_of(table: pa.Table) -> list[bytes]:
    pairs = zip(table.column("bucket").to_pylist(), table.column("data").to_pylist(), strict=True)
    return [d for _, d in sorted(pairs)]


def _rows(kind_rows: list[tuple[str, int, int, bytes]]) -> pa.Table:
    k, b, o, d = zip(*kind_rows, strict=True) if kind_rows else ((), (), (), ())
    return pa.table(
        {"kind": pa.array(k, pa.string()), "bucket": pa.array(b, pa.int32()), "block": pa.array(o, pa.int32()),
         "data": pa.array(d, pa.binary())}
    )


def _of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, KEEP + 2), minlength=KEEP + 3)[1 : KEEP + 2]


def _answer_words(n: int):
    """Level 1: total count and id of every word."""

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks = table.column("block").to_pylist()
        asked = [parted(d) for d in table.column("data").to_pylist()]
        keys = [unpack_sorted(a[0]) for a in asked]
        total, sums = counted(np.concatenate(keys), np.concatenate([unpack(a[1], np.uint32) for a in asked]))
        own = (total != START) & (sums > 0)
        facts = np.concatenate([_of_counts(sums[own]), [sums[own].sum(dtype=np.int64), own.sum()]]).astype(np.int64)
        rows = [("counts", bucket, 0, facts.tobytes()), ("model", bucket, 0, joined(pack_sorted(total), pack(sums)))]
        for block, k in zip(blocks, keys, strict=True):
            at = np.searchsorted(total, k)
            ids = at.astype(np.uint64) * np.uint64(n) + np.uint64(bucket)
            rows.append(("answers", bucket, block, joined(pack(sums[at]), pack(ids))))
        return _rows(rows)

    return answer


def _answer_grams(n: int, start: int, lower: Discounts, last: bool):
    """Level n > 1: total counts, ids, and for unseen grams what their context's weight needs."""

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks = table.column("block").to_pylist()
        asked = [parted(d) for d in table.column("data").to_pylist()]
        context, word = (_sorted_gathered([a[i] for a in asked], i == 0) for i in (0, 1))
        count, in_context, low_count, low_den, hot = (
            _gathered([a[i] for a in asked], t)
            for i, t in ((2, np.uint32), (3, np.uint32), (4, np.uint32), (5, np.uint64), (6, np.uint8))
        )
        contexts, c = np.unique(context, return_inverse=True)
        words, w = np.unique(word, return_inverse=True)
        keys = c.astype(np.uint64) * np.uint64(max(1, len(words))) + w.astype(np.uint64)
        distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
        sums = np.bincount(place, count, len(distinct)).astype(np.uint32)
        group = c[first]
        own = (word[first] != start) & (sums > 0)
        q = np.where(own, lower(low_count[first].astype(np.int64)) / np.maximum(1, low_den[first]), 0.0)
        s = np.bincount(group, q, len(contexts))
        rare = np.stack(
            [np.bincount(group, own & (sums == r), len(contexts)) for r in range(1, KEEP + 1)], axis=1
        ).astype(np.uint32)
        is_hot = np.zeros(len(contexts), bool)
        is_hot[c] = hot > 0
        flag = (rare.sum(1) == 0) & ~is_hot
        rows = [("counts", bucket, 0, _of_counts(sums[own]).astype(np.int64).tobytes())]
        model = own.nonzero()[0]
        rows.append(("model", bucket, 0, joined(pack(np.diff(context[first][model], prepend=np.uint64(0))), pack(word[first][model]), pack(sums[model]))))
        for i in is_hot.nonzero()[0]:
            rows.append(("hot", bucket, 0, joined(contexts[i].tobytes(), rare[i].tobytes(), s[i].tobytes())))
        at = 0
        for block, a in zip(blocks, asked, strict=True):
            size = len(unpack(a[2], np.uint32))
            mine = slice(at, at + size)
            at += size
            p, g = place[mine], c[mine]
            open_ = (sums[p] == 0) & (in_context[mine] > 0) & ~is_hot[g]
            ids = np.empty(0, np.uint64) if last else p.astype(np.uint64) * np.uint64(n) + np.uint64(bucket)
            parts = (sums[p], ids if not last else np.zeros(size, np.uint64), flag[g].astype(np.uint8), rare[g[open_]].reshape(-1), s[g[open_]])
            rows.append(("answers", bucket, block, joined(*map(pack, parts))))
        return _rows(rows)

    return answer


def _sorted_gathered(parts: list[bytes], differences: bool) -> np.ndarray:
    one = unpack_sorted if differences else (lambda d: unpack(d, np.uint64))
    return np.concatenate([one(p) for p in parts]) if parts else np.empty(0, np.uint64)


def katz_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """Score all rows of `docs` (doc_id, text, training boolean) by the model of its training rows.

    Columns: doc_id, training, n_tokens, n_known, train_tokens, base_score, score. `base_score` is the add-one
    unigram score with one unknown class.
    """
    spark = docs.sparkSession
    n = prepare(spark)
    flagged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("training", F.lit(False)).alias("training"),
    )
    blocks = in_blocks(flagged, "training")
    scorer = Scorer(n, order)
    tables: list[DataFrame] = []

    def requested(scorer: Scorer, levels: int):
        def ask(table: pa.Table, answers: pa.Table) -> pa.Table:
            rows = rows_of(table, "training")
            if not rows:
                return _rows([]).select(["bucket", "block", "data"])
            block = table.column("block")[0].as_py()
            told = _by_level(answers, levels) if levels else []
            *_, last = scorer.tokens(rows, told)
            if not levels:
                keys, counts = last
                edges = bucket_edges(keys, n)
                parts = [(pack_sorted(keys[i:j]), pack(counts[i:j])) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            else:
                edges = last.edges
                parts = [
                    (
                        pack(np.diff(last.context[i:j], prepend=np.uint64(0))),
                        pack(last.word[i:j]),
                        pack(last.count[i:j]),
                        pack(last.in_context[i:j].astype(np.uint32)),
                        pack(last.low_count[i:j].astype(np.uint32)),
                        pack(last.low_den[i:j].astype(np.uint64)),
                        pack(last.hot[i:j].astype(np.uint8)),
                    )
                    for i, j in zip(edges[:-1], edges[1:], strict=True)
                ]
            rows = [("", b, block, joined(*p)) for b, p in enumerate(parts) if edges[b + 1] > edges[b]]
            return _rows(rows).select(["bucket", "block", "data"])

        return ask if levels else lambda table: ask(table, None)

    def told(upto: int) -> DataFrame:
        """The answers of the first levels, by block."""
        all_ = None
        for level, t in enumerate(tables[:upto]):
            own = t.where("kind = 'answers'").select("block", "bucket", F.lit(level).alias("level"), "data")
            all_ = own if all_ is None else all_.unionByName(own)
        return all_

    request = "bucket int, block int, data binary"
    for level in range(order):
        grouped = blocks.groupBy("block")
        if level:
            ask = tidy_both(requested(_frozen(scorer), level))
            asked = grouped.cogroup(told(level).groupBy("block")).applyInArrow(ask, request)
            answer = _answer_grams(n, start, scorer.levels[-1].discounts, level + 1 == order)
        else:
            asked = grouped.applyInArrow(tidy(requested(_frozen(scorer), 0)), request)
            answer = _answer_words(n)
        path = scratch(spark, f"katz-{level + 1}")
        asked.groupBy("bucket").applyInArrow(tidy(answer), ANSWER).write.partitionBy("kind").parquet(path)
        tables.append(spark.read.schema("bucket int, block int, data binary, kind string").parquet(path))
        # One row per bucket, and at most four hot contexts per bucket.
        facts = [np.frombuffer(r[0], np.int64) for r in tables[-1].where("kind = 'counts'").select("data").collect()]
        fact = sum(facts, np.zeros(KEEP + (3 if level == 0 else 1), np.int64))
        of_counts = fact[: KEEP + 1]
        hot: dict[int, tuple[np.ndarray, float]] = {}
        if level == 0:
            scorer.unigrams = of_counts[:KEEP].astype(float)
            n_tokens, n_words = int(fact[-2]), int(fact[-1])
            start = _start_id(tables[0], n)
        else:
            for (data,) in tables[-1].where("kind = 'hot'").select("data").collect():
                c, r, s = parted(data)
                key = int(np.frombuffer(c, np.uint64)[0])
                rare, lower = hot.get(key, (np.zeros(KEEP), 0.0))
                hot[key] = (rare + np.frombuffer(r, np.uint32), lower + float(np.frombuffer(s, np.float64)[0]))
        scorer.levels.append(Level(Discounts.of(of_counts), n_tokens, n_words, hot))

    final = _frozen(scorer)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows_of(table, "training")
        h, _, _, levels, _ = final.tokens(rows, _by_level(answers, order))
        real = h != START
        count = levels[0].count
        base = np.log10((count + 1) / (final.levels[0].tokens + final.levels[0].words + 1))
        owner = np.cumsum(~real) - 1
        sums = [
            np.bincount(owner, np.where(real, x, 0), len(rows)) for x in (real, count > 0, base, final.score(levels))
        ]
        ids, _, flags = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table(
            {"doc_id": pa.array(ids, pa.int64()), "training": pa.array(flags, pa.bool_()),
             "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64),
             "train_tokens": np.full(len(rows), final.levels[0].tokens, np.int64), "base_score": sums[2],
             "score": sums[3]}
        )

    return blocks.groupBy("block").cogroup(told(order).groupBy("block")).applyInArrow(
        tidy_both(finish),
        "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _frozen(scorer: Scorer) -> Scorer:
    """The scorer as it is now: tasks of a later action must not see later levels."""
    out = Scorer(scorer.n, scorer.order)
    out.levels = list(scorer.levels)
    out.unigrams = getattr(scorer, "unigrams", np.zeros(KEEP))
    return out


def _by_level(table: pa.Table, levels: int) -> list[list[bytes]]:
    level = table.column("level").to_numpy()
    return [_answers_of(table.filter(pa.array(level == i))) for i in range(levels)]


def _start_id(words: DataFrame, n: int) -> int:
    """The id of the start mark: it is in one bucket's word list."""
    bucket = int(START) * n >> 64
    row = words.where((F.col("kind") == "model") & (F.col("bucket") == bucket)).select("data").head()
    return -1 if row is None else int(np.searchsorted(unpack_sorted(parted(row[0])[0]), START)) * n + bucket
