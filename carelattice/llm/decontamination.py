"""Benchmark decontamination by templates: questions are found again even with other numbers, names and units.

A text becomes a template: a number with the unit after it (or glued to it), and a run of names (capitalised words inside
a sentence), become one typed placeholder each, other words stay, in lower case and without signs around them. Windows of `window` template tokens of the
benchmark, of which at least `literal` are words, are looked up in all documents. Windows on one diagonal
(document place minus item place), and those on diagonals at most `window` away, so that inserted, lost or split words
divide nothing, make a match, and its slots must be consistent, each kind for itself: one value of the
item stands for one value of the document, and for names also the other way round. It is cut at slots that
contradict others, and the best consistent stretch is the match. A match that covers at least `coverage` of an item's
words, or `run` words, marks the document. Beside the templates, windows of the plain words (in lower case, without signs
around them, nothing replaced) are looked up whatever they hold, so that verbatim copies of lists, tables and titles are
found in any letter case. An item shorter than a window is one window of its own length: verbatim however short it is, as a
template if it has `literal` words. An item's first word is looked up as a word and, if it is capitalised, as a name.

The benchmark is a query set: it is read in blocks of `block_items`, and each block's sorted window hashes go to all
tasks. So what is sent at once is bounded however large the benchmark is; documents are never shuffled for the search.

Null and empty texts match nothing. Repeated documents are reported as often as they occur, repeated items (one item_id
and text) once. Null item_ids and doc_ids are allowed and reported. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, grams, held, prepare, tidy_batches

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
GLUED = re.compile(r"([+-]?\d[\d.,]*)([a-z]+)")
#: Units of measure (fixed values), singular and plural.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound "
    "pounds oz ounce ounces ton tons ml l liter liters litre litres meter meters metre metres kilometer kilometers "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years dollar "
    "dollars euro euros cent cents percent mph kmh degree degrees".split()
)
SIGNS = ".,;:!?\"'()[]{}<>|*_`"
ENDS = (".", "!", "?", ":")
_NUM, _NAME = (np.uint64(xxhash.xxh3_64_intdigest(x)) & ~np.uint64(15) for x in (b"\0n", b"\0p"))
_IS_NUM, _IS_UNIT, _IS_CAPITAL, _IS_END = (np.uint64(1 << i) for i in range(4))
#: Kinds of placeholders.
NUMERIC, NAME = 1, 2
REMEMBERED = 400_000

MATCHES = "row long, doc_id long, item_id long, covered int, item_tokens int, slots int, changed_slots int"


class _Codes(dict):
    """Raw word -> 60 bits of its hash and 4 flags."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        raw = word.decode("utf-8", "replace")
        core = raw.strip(SIGNS)
        low = core.lower() or raw
        number = end = False
        if not core.isalpha():
            glued = GLUED.fullmatch(low)
            number = bool(NUMBER.fullmatch(core)) or bool(glued and glued[2] in UNITS)
        if len(core) < len(raw):
            end = raw.rstrip("\"')]}").endswith(ENDS)
        flags = int(number) | (low in UNITS) << 1 | (core[:1].isupper() and core[1:].islower()) << 2 | end << 3
        found = self[word] = xxhash.xxh3_64_intdigest(low.encode()) & ~15 | flags
        return found


@dataclass
class Form:
    """Tokens of a text: their hashes, first words, numbers of words and kinds of placeholder (0 for a word)."""

    tokens: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    kinds: np.ndarray


def forms(words: list[bytes], firsts: np.ndarray, opening: bool = False) -> list[Form]:
    """The template and the plain form (every word for itself, in lower case) of texts that begin at `firsts`.
    With `opening`, a text's first word may be a name, as it is in a document after a word without end mark."""
    code = np.fromiter(map(held("codes", _Codes).__getitem__, words), np.uint64, len(words))
    plain = code & ~np.uint64(15)
    first = np.zeros(len(words), bool)
    first[firsts] = True
    number = (code & _IS_NUM) > 0
    unit = ((code & _IS_UNIT) > 0) & np.roll(number, 1) & ~first & ~number
    inside = np.where(first, opening, np.roll((code & _IS_END) == 0, 1))
    name = ((code & _IS_CAPITAL) > 0) & inside & ~number & ~unit
    out = np.where(number, _NUM, np.where(name, _NAME, plain))
    kinds = np.where(number, NUMERIC, np.where(name, NAME, 0))
    # A number with its unit, and a run of names, are one token.
    every = np.arange(len(words))
    starts = np.flatnonzero(first | ~(unit | name & np.roll(name, 1)))
    lengths = np.diff(starts, append=len(words))
    return [
        Form(out[starts], starts, lengths, kinds[starts]),
        Form(plain, every, np.ones(len(words), np.int64), np.zeros(len(words), np.int64)),
    ]


def value(words: list[bytes]) -> str:
    """What a placeholder stands for, '12km' and '12 km' alike."""
    said = " ".join(w.decode("utf-8", "replace").strip(SIGNS).lower() for w in words)
    glued = GLUED.fullmatch(said)
    return f"{glued[1]} {glued[2]}" if glued and glued[2] in UNITS else said


def consistent(places: list[int], slots: list[tuple[int, int, str, str]]) -> list[list[int]]:
    """`places` cut at the slots (place, kind, value, value in the document) that contradict others, in three ways: at slots
    that differ from the most frequent (then first) mapping of their value; anew from every contradiction to the slots
    since the last cut; and at all changed slots, as unchanged words never contradict each other."""

    def clash(maps: dict, kind: int, mine: str, theirs: str) -> bool:
        return maps.get((kind, mine), theirs) != theirs or kind == NAME and maps.get((-kind, theirs), mine) != mine

    def put(maps: dict, kind: int, mine: str, theirs: str) -> None:
        maps[kind, mine] = theirs
        maps[-kind, theirs] = mine

    main: dict = {}
    for (kind, mine, theirs), _ in Counter(s[1:] for s in slots).most_common():
        if not clash(main, kind, mine, theirs):
            put(main, kind, mine, theirs)
    rare = {p for p, *slot in slots if clash(main, *slot)}
    if not rare:
        return [places]
    since: dict = {}
    begins = set()
    for p, *slot in slots:
        if clash(since, *slot):
            begins.add(p)
            since = {}
        put(since, *slot)
    changed = {p for p, _, mine, theirs in slots if mine != theirs}
    parts: list[list[int]] = []
    for out, at in ((rare, rare), (set(), begins), (changed, changed)):
        parts.append([])
        for p in places:
            if p in at:
                parts.append([])
            if p not in out:
                parts[-1].append(p)
    return [p for p in parts if p]


def joined(diagonals: dict[int, dict[int, tuple]], reach: int) -> Iterator[dict[int, tuple]]:
    """For each diagonal its places, and those that only diagonals at most `reach` away hold, the nearest first."""
    order = sorted(diagonals)
    i = 0
    for shift in order:
        while order[i] < shift - reach:
            i += 1
        near = order[i : bisect_right(order, shift + reach)]
        pairs: dict[int, tuple] = {}
        for d in sorted(near, key=lambda d: (abs(d - shift), d)):
            for p, pair in diagonals[d].items():
                pairs.setdefault(p, pair)
        yield pairs


class Index:
    """Windows of one size, sorted by hash, each with its item's form and place in it."""

    def __init__(self, keys: np.ndarray, forms_: np.ndarray, places: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.forms, self.places = keys[order], forms_[order], places[order]
        self.mask = np.uint64((1 << max(16, len(keys).bit_length() + 4)) - 1)
        self.low = np.zeros(int(self.mask) + 1, bool)
        self.low[keys & self.mask] = True

    def hits(self, g: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in `g`, form, place in the form) of equal windows."""
        maybe = np.flatnonzero(self.low[g & self.mask])
        begin, end = (np.searchsorted(self.keys, g[maybe], side) for side in ("left", "right"))
        some = begin < end
        for at, i, j in zip(maybe[some].tolist(), begin[some].tolist(), end[some].tolist(), strict=True):
            for f, place in zip(self.forms[i:j].tolist(), self.places[i:j].tolist(), strict=True):
                yield at, f, place


class Benchmark:
    """The windows of a block of items: of their templates, of which `literal` tokens are words, and of their plain forms."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int, literal: int):
        self.window = window
        self.ids = [i for i, _ in items]
        self.words = [t.split() for _, t in items]
        self.forms: list[tuple[int, Form]] = []
        found: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}
        for at, words in enumerate(self.words):
            if not words:
                continue
            (usual, plain), (opened, _) = (forms(words, np.zeros(1, int), opening) for opening in (False, True))
            for kind, form in ((0, usual), (1, plain), *([(0, opened)] if opened.kinds[0] != usual.kinds[0] else [])):
                size = min(window, len(form.tokens))
                g = grams(form.tokens, size)
                own = np.arange(len(g))
                if kind == 0:
                    own = own[np.convolve(form.kinds == 0, np.ones(size, int), "valid") >= literal]
                if form is opened:
                    own = own[own < window]
                found.setdefault((kind, size), []).append((g[own], np.full(len(own), len(self.forms)), own))
                self.forms.append((at, form))
        self.index = {
            key: Index(*map(np.concatenate, zip(*parts, strict=True))) for key, parts in found.items() if any(len(p[0]) for p in parts)
        }

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(item, covered words, item words, slots, changed slots) of every consistent match; the best of an item."""
        return self.matches_of([words])[0]

    def matches_of(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, int, int, int]]]:
        """The matches of each text."""
        out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
        full = [i for i, t in enumerate(texts) if t]
        words = [w for i in full for w in texts[i]]
        if not words:
            return out
        firsts = np.cumsum([0, *(len(texts[i]) for i in full[:-1])])
        own = forms(words, firsts)
        texts_of = [np.searchsorted(firsts, form.starts, "right") - 1 for form in own]
        # Per text and item: diagonal -> place in the item -> (place in all words, words here, words there, kind).
        hits: dict[tuple[int, int], dict[int, dict[int, tuple[int, int, int, int]]]] = {}
        for (kind, size), index in self.index.items():
            mine = own[kind]
            if len(mine.tokens) < size:
                continue
            text = texts_of[kind]
            for at, f, place in index.hits(grams(mine.tokens, size)):
                if text[at] != text[at + size - 1]:
                    continue
                item, form = self.forms[f]
                diagonals = hits.setdefault((int(text[at]), item), {})
                for i, j in zip(range(at, at + size), range(place, place + size), strict=True):
                    q, p = int(mine.starts[i]), int(form.starts[j])
                    slot = int(form.kinds[j]) and int(mine.kinds[i])
                    pairs = diagonals.setdefault(q - p, {})
                    if slot or p not in pairs:
                        pairs[p] = (q, int(form.lengths[j]), int(mine.lengths[i]), slot)
        for (at, item), diagonals in sorted(hits.items()):
            found = (self._best(item, pairs, words) for pairs in joined(diagonals, self.window))
            out[full[at]].append(max(found, key=lambda m: (m[1], -m[4])))
        return out

    def _best(self, item: int, pairs: dict[int, tuple[int, int, int, int]], words: list[bytes]) -> tuple[int, int, int, int, int]:
        """The best stretch without contradiction."""
        mine = self.words[item]
        values = {p: (value(mine[p : p + n]), value(words[q : q + m])) for p, (q, n, m, kind) in pairs.items() if kind}
        best = (item, 0, len(mine), 0, 0)
        for part in consistent(sorted(pairs), [(p, pairs[p][3], *values[p]) for p in sorted(values)]):
            covered = {x for p in part for x in range(p, p + pairs[p][1])}
            changed = [values[p][0] != values[p][1] for p in part if p in values]
            found = (item, len(covered), len(mine), len(changed), sum(changed))
            best = max(best, found, key=lambda m: (m[1], -m[4]))
        return best


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 8,
    literal: int = 5,
    coverage: float = 0.5,
    run: int = 20,
    block_items: int = 20_000,
) -> DataFrame:
    """Marked documents: row (a hash of doc_id and text), doc_id, item_id, covered, item_tokens, slots, changed_slots."""
    prepare(docs.sparkSession)
    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    items = items.distinct().select("*", F.xxhash64("item_id", "text").alias("at"))
    blocks = max(1, -(-items.count() // block_items))
    found = None
    for b in range(blocks):
        own = items.where(F.pmod("at", F.lit(blocks)) == b).select("item_id", "text").collect()
        own = Benchmark(sorted(((i, bytes(t)) for i, t in own), key=lambda x: (x[0] is not None, x)), window, literal)
        part = rows.mapInArrow(
            tidy_batches(_search(docs.sparkSession.sparkContext.broadcast(own), coverage, run), "codes"), MATCHES
        )
        found = part if found is None else found.unionByName(part)
    return found


def _chunks(rows: Iterator[tuple], size: int = 16_000) -> Iterator[list[tuple]]:
    """Rows with the words of their texts, in lists of about `size` words."""
    some, n = [], 0
    for row, doc_id, text in rows:
        some.append((row, doc_id, text.split()))
        n += len(some[-1][2])
        if n >= size:
            yield some
            some, n = [], 0
    yield some


def _search(sent, coverage: float, run: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4
        names = [x.split()[0] for x in MATCHES.split(", ")]
        for batch in batches:
            out = []
            for rows in _chunks(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True)):
                for (row, doc_id, _), found in zip(rows, items.matches_of([r[2] for r in rows]), strict=True):
                    for item, covered, *rest in found:
                        if covered >= coverage * rest[0] or covered >= run:
                            out.append((row, doc_id, items.ids[item], covered, *rest))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return search


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of `docs` that no benchmark item marks, with all columns."""
    marked = benchmark_matches(docs, benchmark, **how).select(F.col("row").alias("__row")).distinct()
    own = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    return docs.withColumn("__row", own).join(marked, "__row", "left_anti").drop("__row")
