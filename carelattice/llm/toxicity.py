"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters are lexicons and patterns that fire or do not fire on a text. The lexicons are words that are far more frequent
in toxic than in other training texts, counted over all of these, dealt round by rank, and a general list of insults; patterns are
shouting, runs of exclamation marks, and an insult near "you". The label model explains how often every combination of
voters fires over *all* documents by a hidden class with per-class firing rates; pairs of voters that are
correlated within a class share one joint table. Training labels anchor the classes: their rows count as known. EM
gives every combination a posterior. A linear classifier over distinct word forms and voters is then fitted to the
posteriors on a bounded sample, half of it labelled or else likely toxic, reweighted to the true shares.

Empty and null texts fire nothing and get the classifier's base score. Without labels the general insults alone anchor
the classes. An empty table gives an empty result. Repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare, stored, tidy_batches
from .features import adam, hash_sample, logistic

#: A general list of insults, used beside the learned lexicons.
INSULTS = (
    "idiot stupid moron loser scum trash pathetic worthless disgusting clown dumb fool jerk imbecile filthy vermin "
    "degenerate scumbag dimwit lowlife"
).split()
EDGES = b".,;:!?\"'()[]{}<>*%&$#|-_~`/\\"
SHOUT = re.compile(rb"\b[A-Z]{3,}\b(?:\W+[A-Z]{3,}\b){2}")
MARKS = re.compile(rb"!{3,}|[!?]{4,}")
CAPITALS = bytes(65 if 65 <= c <= 90 else 32 for c in range(256))
TWO_MARKS = (b"!!", b"??", b"!?", b"?!")
YOU = (b"you", b"your", b"youre", b"you're")
LEXICONS = 6
#: Voters in bit order: learned lexicons, general insults, patterns.
VOTERS = [*(f"lexicon_{i}" for i in range(LEXICONS)), "insults", "you_insult", "shouting", "marks"]
#: Bit of words that address the reader, beside those of the voters.
SAYS_YOU = 1 << 30
#: Distinct word forms a task counts before it sends them, and words a worker remembers the forms of.
COUNTED, REMEMBERED = 400_000, 150_000
#: Lengths in bytes of the beginnings of words that count as forms.
BEGINNINGS = (5, 6, 7, 8)


#: Bytes of text whose words are looked up at once.
PIECE_BYTES = 4 << 20


class _Memory(dict):
    """Raw word -> the bits of its voters, and the values of its forms."""

    def __init__(self, masks: dict[bytes, int], values: dict[bytes, int]):
        super().__init__()
        self.masks, self.values_of = masks, values

    def __missing__(self, word: bytes) -> tuple[int, tuple[int, ...]]:
        if len(self) > REMEMBERED:
            self.clear()
        own, mask = forms(word), 0
        for f in own:
            mask |= self.masks.get(f, 0)
        if own[0] in YOU:
            mask |= SAYS_YOU
        found = self[word] = mask, tuple(self.values_of[f] for f in own if f in self.values_of)
        return found


@dataclass(frozen=True)
class _Words:
    """Texts with their words in a row: where each text's begin, and what the memory holds of every word."""

    bodies: list[bytes]
    starts: np.ndarray
    masks: np.ndarray
    codes: np.ndarray
    values: list[tuple[int, ...]]

    def pairs(self, values: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, value) once each for every one of `values` values that occurs in a text, by text."""
        counts = np.fromiter(map(len, self.values), np.int64, len(self.values))
        places = np.flatnonzero(counts[self.codes] > 0)
        text = np.searchsorted(self.starts, places, "right") - 1
        code = self.codes[places]
        flat = np.fromiter((v for own in self.values for v in own), np.int64, int(counts.sum()))
        many = counts[code]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        keys = np.unique(np.repeat(text, many) * values + flat[np.repeat((np.cumsum(counts) - counts)[code], many) + within])
        return keys // max(1, values), keys % max(1, values)


def _pieces(batch: pa.RecordBatch, memory: _Memory) -> Iterator[_Words]:
    """The batch's texts, about `PIECE_BYTES` at a time; different words of a piece are looked up once."""
    text = batch.column("text")
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right")))
        part = text.slice(at, to - at)
        # Splits at the bytes that `bytes.split` splits at; an empty word may come first or last.
        split = pc.ascii_split_whitespace(part.view(pa.string()))
        coded = split.flatten().dictionary_encode()
        told = [memory[w] for w in coded.dictionary.view(pa.binary()).to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        masks = np.fromiter((m for m, _ in told), np.int64, len(told))
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        yield _Words(part.to_pylist(), np.cumsum(sizes) - sizes, masks[codes], codes, [v for _, v in told])
        at = to


def bare(word: bytes) -> bytes:
    return word.lower().strip(EDGES)


def forms(word: bytes) -> list[bytes]:
    """The bare word and its beginnings: inflected and compound insults share them."""
    word = bare(word)
    return [word, *(word[:k] + b"*" for k in BEGINNINGS if len(word) > k)]


def voter_masks(lexicon: list[bytes]) -> dict[bytes, int]:
    """Word -> bits of the lexicons that hold it."""
    masks: dict[bytes, int] = {}
    for rank, w in enumerate(lexicon):
        masks[w] = masks.get(w, 0) | 1 << rank % LEXICONS
    for w in INSULTS:
        masks[w.encode()] = masks.get(w.encode(), 0) | 1 << LEXICONS
    return masks


def votes_of(words: _Words) -> np.ndarray:
    """The voters that fire on each text, as bits."""
    told = words.masks & ((1 << len(VOTERS)) - 1)
    # Every text has one word at least, if an empty one.
    fired = np.bitwise_or.reduceat(told, words.starts) if len(told) else np.zeros(0, np.int64)
    insults, yous = np.flatnonzero(told), np.flatnonzero(words.masks & SAYS_YOU)
    if len(insults) and len(yous):
        text = np.searchsorted(words.starts, insults, "right") - 1
        before = np.searchsorted(yous, insults) - 1
        near = (before >= 0) & (yous[before] >= np.maximum(insults - 4, words.starts[text]))
        fired[text[near]] |= 1 << VOTERS.index("you_insult")
    for i, body in enumerate(words.bodies):
        # What the patterns need is looked for first: this is much faster than they are.
        if b"AAA" in body.translate(CAPITALS) and SHOUT.search(body):
            fired[i] |= 1 << VOTERS.index("shouting")
        if any(m in body for m in TWO_MARKS) and MARKS.search(body):
            fired[i] |= 1 << VOTERS.index("marks")
    return fired


# -- the label model ---------------------------------------------------------------------------


@dataclass
class LabelModel:
    """P(toxic), and per class the table of every factor (a voter, or a correlated pair of voters)."""

    prior: float
    factors: list[tuple[int, ...]]
    tables: list[np.ndarray]  # 2 x 2**len(factor)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        odds = np.full(len(patterns), math.log(self.prior / (1 - self.prior)))
        for factor, table in zip(self.factors, self.tables, strict=True):
            state = _state(patterns, factor)
            odds += np.log(table[1][state]) - np.log(table[0][state])
        return logistic(odds)


def _state(patterns: np.ndarray, factor: tuple[int, ...]) -> np.ndarray:
    return sum(((patterns >> v) & 1) << i for i, v in enumerate(factor))


def _em(patterns: np.ndarray, known: np.ndarray, free: np.ndarray, factors: list[tuple[int, ...]], rounds: int):
    """`known`: 2 x patterns, rows with labels; `free`: rows without. Posterior of the free rows starts from
    the number of lexicons that fire."""
    lexical = np.zeros(len(patterns))
    for v in range(LEXICONS + 2):
        lexical += (patterns >> v) & 1
    q = np.where(lexical > 0, 0.9, 0.02)
    for _ in range(rounds):
        mass = np.stack([known[0] + free * (1 - q), known[1] + free * q])
        prior = float(np.clip((mass[1].sum() + 1) / (mass.sum() + 2), 1e-6, 1 - 1e-6))
        tables = []
        for factor in factors:
            state, size = _state(patterns, factor), 1 << len(factor)
            # One pseudo-count a class, dealt like the whole: what never fires decides nothing.
            whole = np.bincount(state, mass.sum(0), size) + 0.5
            whole /= whole.sum()
            rows = [np.bincount(state, m, size) + whole for m in mass]
            tables.append(np.stack([r / r.sum() for r in rows]))
        model = LabelModel(prior, factors, tables)
        q = model.posterior(patterns)
    return model


def fit_label_model(counts: dict[int, int], known: dict[tuple[int, int], int], rounds: int = 40) -> LabelModel:
    """From the number of documents per combination of voters, and of labelled rows per (combination, label)."""
    patterns = np.array(sorted(counts), np.int64)
    own = np.array([[known.get((int(p), y), 0) for p in patterns] for y in (0, 1)], float)
    free = np.maximum(0, np.array([counts[int(p)] for p in patterns], float) - own.sum(0))
    voters = range(len(VOTERS))
    model = _em(patterns, own, free, [(v,) for v in voters], rounds)
    q = model.posterior(patterns)
    mass = np.stack([own[0] + free * (1 - q), own[1] + free * q])
    linked = []
    for i in voters:
        for j in range(i):
            a, b = (patterns >> i) & 1, (patterns >> j) & 1
            strength = 0.0
            for m in mass:
                total = m.sum() + 1e-9
                pa_, pb = (m * a).sum() / total, (m * b).sum() / total
                spread = math.sqrt(max(1e-12, pa_ * (1 - pa_) * pb * (1 - pb)))
                strength = max(strength, abs((m * a * b).sum() / total - pa_ * pb) / spread)
            linked.append((strength, j, i))
    factors, used = [], set()
    for strength, j, i in sorted(linked, reverse=True):
        if strength >= 0.2 and not {i, j} & used:
            factors.append((j, i))
            used |= {i, j}
    return _em(patterns, own, free, sorted(factors + [(v,) for v in voters if v not in used]), rounds)


# -- passes over the documents -----------------------------------------------------------------


@dataclass
class Classifier:
    """Weights of words, of voters, and a constant."""

    masks: dict[bytes, int]
    words: dict[bytes, int]
    word_weights: np.ndarray
    voter_weights: np.ndarray
    bias: float


def _distinct_words(docs: DataFrame, tag: str) -> DataFrame:
    """(tag, word) once per document of a bounded sample."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, words = [], []
            for value, text in zip(batch.column(tag).to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {f for w in set(text.split()) for f in forms(w)} - {b""}
                words += own
                tags += [value] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(tags, pa.int32()), pa.array(words, pa.binary())], [tag, "word"])

    rows = docs.select(F.col(tag).cast("int"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy_batches(emit), f"{tag} int, word binary")


def _telling_words(docs: DataFrame, tag: str, share: float, odds: float, both: bool) -> list[tuple[float, bytes]]:
    """Words in at least `share` of the tagged (or, with `both`, of either) texts whose odds differ by the factor `odds`."""
    totals = dict(docs.groupBy(F.col(tag).cast("int")).count().collect())
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    c1 = F.sum((F.col(tag) == 1).cast("int")).alias("c1")
    counts = _distinct_words(docs, tag).groupBy("word").agg(c1, F.count("*").alias("c"))
    frequent = (F.col("c1") >= max(3, share * n1)) | (F.lit(both) & (F.col("c") - F.col("c1") >= max(3, share * n0)))
    found = []
    # At most distinct words per text / share of them are that frequent.
    for word, a, c in counts.where(frequent).collect():
        p1, p0 = (a + 0.5) / (n1 + 1), (c - a + 0.5) / (n0 + 1)
        gap = math.log(p1 / (1 - p1)) - math.log(p0 / (1 - p0))
        if gap >= math.log(odds) or both and gap <= -math.log(odds):
            found.append((-abs(gap), bytes(word)))
    return sorted(found)


def _one_label(labels: DataFrame) -> DataFrame:
    """doc_id and toxic, once per labelled document."""
    return labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, c1, c0): in how many toxic and other texts of `docs` (text, toxic) a word form occurs, added up per task first."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[bytes, ...]] = {}
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def sums() -> pa.RecordBatch:
            words = list({**counts[0], **counts[1]})
            columns = [pa.array(words, pa.binary()), *(pa.array([c[w] for w in words], pa.int64()) for c in (counts[1], counts[0]))]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "c1", "c0"])

        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own: set[bytes] = set()
                for w in set(text.split()):
                    if w not in known:
                        known[w] = tuple(forms(w))
                    own.update(known[w])
                counts[toxic].update(own - {b""})
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield sums()
                if len(known) > REMEMBERED:
                    known.clear()
        yield sums()

    rows = docs.select(F.col("toxic").cast("int").alias("toxic"), F.col("text").cast("binary").alias("text"))
    parts = rows.mapInArrow(tidy_batches(emit), "word binary, c1 long, c0 long")
    return parts.groupBy("word").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))


#: Bits of the filter of labelled ids: at most so many, whatever the number of labels.
FILTER_BITS = 1 << 26


def _maybe_labelled(docs: DataFrame, own: DataFrame) -> DataFrame:
    """The rows of `docs` but for most whose id has no label: a bitmap of hashed ids, of bounded size, is looked up
    before texts are shuffled. The join behind it decides."""
    bits = min(FILTER_BITS, max(1 << 15, 1 << (16 * own.count()).bit_length()))
    # Bits are numbered from 0, buckets from 1.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    marked = own.select(place.alias("__place"))
    filled = marked.groupBy(F.bitmap_bucket_number("__place").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__bits")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    inside = F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1
    held = docs.withColumn("__bucket", F.bitmap_bucket_number(place)).join(F.broadcast(filled), "__bucket").where(inside)
    return held.select(*docs.columns)


def mine_lexicon(docs: DataFrame, labels: DataFrame, support: int = 3, odds: float = 30.0, surprise: float = 15.0) -> list[bytes]:
    """Words that mark toxic texts, counted over all labelled rows (doc_id, toxic), the strongest first: in at least
    `support` toxic texts, with odds `odds` times those of other texts, and not by chance (likelihood ratio of the texts that
    hold the word, `surprise`, so that the rarer toxic texts are, the fewer of them tell). Only such words go to the driver."""
    own = _one_label(labels)
    rows = _maybe_labelled(documents(docs), own).join(own, "doc_id")
    totals = dict(rows.select("doc_id", F.col("toxic").cast("int")).groupBy("toxic").count().collect())
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    c1, c0 = F.col("c1"), F.col("c0")
    logit = lambda c, n: F.log((c + 0.5) / (n + 0.5 - c))
    part = lambda c, n: F.when(c > 0, c * F.log(c * (n1 + n0) / ((c1 + c0) * n))).otherwise(0.0)
    ratio = 2 * (part(c1, n1) + part(c0, n0))
    counts = _word_counts(rows).where(c1 >= support)
    found = counts.select("word", (logit(c1, n1) - logit(c0, n0)).alias("gap"), ratio.alias("ratio"))
    found = found.where((F.col("gap") >= math.log(odds)) & (F.col("ratio") >= surprise)).select("word", "gap").collect()
    return [w for _, w in sorted((-gap, bytes(w)) for w, gap in found)]


def learn(docs: DataFrame, labels: DataFrame, bound: int = 8000) -> tuple[Classifier, LabelModel]:
    """Lexicons, label model and classifier; lexicons come from all labelled rows, the label model's counts from all
    documents, and only the linear fit looks at `bound` documents at most, half of them labelled or else likely toxic."""
    prepare(docs.sparkSession)
    masks = voter_masks(mine_lexicon(docs, labels))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(masks, {})
        for batch in batches:
            fired = [v for words in _pieces(batch, memory) for v in votes_of(words).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fired, pa.int32())], ["doc_id", "votes"])

    texts = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    voted = stored(texts.mapInArrow(tidy_batches(vote), "doc_id long, votes int"), "votes")
    counts = dict(voted.groupBy("votes").count().collect())  # at most one row per combination of voters
    own = _one_label(labels)
    known = {(v, y): n for v, y, n in voted.join(own, "doc_id").groupBy("votes", "toxic").count().collect()}
    if not counts:
        return Classifier(masks, {}, np.zeros(0), np.zeros(len(VOTERS)), 0.0), LabelModel(0.5, [], [])
    model = fit_label_model(counts, known)

    patterns = np.array(sorted(counts), np.int64)
    posterior = model.posterior(patterns)
    likely = [int(p) for p, q in zip(patterns, posterior, strict=True) if q >= 0.5]
    side = F.coalesce("toxic", F.col("votes").isin(likely).cast("int")).cast("int")
    sided = voted.join(own, "doc_id", "left").select("doc_id", "votes", side.alias("side"))
    sizes_of = dict(sided.groupBy("side").count().collect())
    sides = [(y, sided.where(F.col("side") == y)) for y in (1, 0)]
    sizes = [sizes_of.get(y, 0) for y, _ in sides]
    chosen = [
        hash_sample(rows, bound // 2, size).select("doc_id", "votes", "side")
        for (y, rows), size in zip(sides, sizes, strict=True)
    ]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]).dropDuplicates(["doc_id"]))
    sample = stored(texts.join(ids, "doc_id"), "sample")
    words = {w: i for i, (_, w) in enumerate(_telling_words(sample, "side", 0.02, 8.0, True))}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory({}, words)
        for batch in batches:
            rows: list[list[int]] = []
            for piece in _pieces(batch, memory):
                text, value = piece.pairs(len(words))
                rows += [v.tolist() for v in np.split(value, np.searchsorted(text, np.arange(1, len(piece.bodies))))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("votes"), batch.column("side"), pa.array(rows, pa.list_(pa.int32()))],
                ["votes", "side", "x"],
            )

    rows = sorted(sample.select("votes", "side", "text").mapInArrow(tidy_batches(describe), "votes int, side int, x array<int>").collect())
    x = np.zeros((len(rows), len(words) + len(VOTERS) + 1))
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, r["x"]] = 1
        x[i, len(words) : -1] = [(r["votes"] >> v) & 1 for v in range(len(VOTERS))]
    y = model.posterior(np.array([r["votes"] for r in rows], np.int64))
    side = np.array([r["side"] for r in rows])
    true = np.array([sizes[1], sizes[0]], float) / max(1, sum(sizes))
    drawn = np.array([(side == s).sum() for s in (0, 1)], float)
    weight = (true / np.maximum(drawn, 1))[side] if len(rows) else np.zeros(0)
    ridge = np.full(x.shape[1], 1e-4)
    ridge[-1] = 0
    w = adam(lambda w: x.T @ (weight * (logistic(x @ w) - y)) + ridge * w, x.shape[1], 600)
    k = len(words)
    return Classifier(masks, words, w[:k], w[k:-1], float(w[-1])), model


def score_toxicity(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`docs` (doc_id and text, as documents) with score: doc_id, score of every row."""
    prepare(docs.sparkSession)
    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy_batches(_scorer(classifier)), "doc_id long, score double")


def _scorer(c: Classifier):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(c.masks, c.words)
        for batch in batches:
            scores = [np.zeros(0)]
            for words in _pieces(batch, memory):
                patterns, own = np.unique(votes_of(words), return_inverse=True)
                voted = [sum(w for v, w in enumerate(c.voter_weights) if p >> v & 1) for p in patterns.tolist()]
                text, value = words.pairs(len(c.words))
                told = np.bincount(text, c.word_weights[value], len(words.bodies))
                scores.append(logistic(c.bias + told + np.array(voted, float)[own]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    return score


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below `threshold`, with all columns and repeated rows as they are."""
    classifier, _ = learn(docs, labels)
    names = docs.columns
    scorer = _scorer(classifier)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: deque[pa.RecordBatch] = deque()

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole.append(batch)
                text = batch.column("text").fill_null("").cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], ["doc_id", "text"])

        for scored in scorer(texts()):  # one batch of scores for each, and one memory for all
            yield whole.popleft().filter(pa.array(scored.column("score").to_numpy() < threshold))

    return docs.select(*names).mapInArrow(tidy_batches(keep), docs.schema)
