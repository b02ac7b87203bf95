"""Repeated passages: truncated suffix trees over groups of suffixes that share a prefix.

A passage repeats where `min_words` consecutive words occur again. Every window of that many words is a suffix's
beginning; windows are grouped by an anchor, the smallest hash among their runs of ANCHOR words, which equal windows
share. Pass one counts anchors over all documents. Windows whose anchor occurs once cannot repeat and are
dropped where they are. Pass two sends the others, as runs of windows with one anchor, to the anchor's group. The
groups' prefixes vary in length: an anchor that more than `heavy` places have would overfill its group, so its windows go
by all their words instead. Equal runs inside a block of documents are sent once.

A group builds the top of its suffix tree down to depth `min_words`: suffixes get their order by prefix doubling
(2, 4, 8, ... words), which is exact on words. Nodes of that depth with several leaves are the repeats; the first leaf by
(doc_id, start) is the original. What comes back to a block is one bit per window sent.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Null and empty texts, and texts shorter than a window, lose nothing. Nulls among
doc_ids come first; rows with one doc_id are ordered by their place in the blocks. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import (
    REPLY, REQUEST, bucket_edges, documents, grams, in_blocks, joined, key_counts, mix, pack, parted,
    prepare, replies_of, request_table, requests_of, rows_of, texts_hashes, tidy, tidy_both, total_counts, unpack,
)

ANCHOR = 8
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"


def _slid(x: np.ndarray, width: int, take) -> np.ndarray:
    """`take` (minimum or maximum) over every window of `width` values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = take(out[:-step], out[step:])
        have += step
    return out


class _Doc:
    """A document's word hashes, and the anchor of each of its windows."""

    def __init__(self, text: bytes, h: np.ndarray, size: int, span: int):
        self.text = text
        self.h = h
        self.g = grams(self.h, span)
        self.windows = max(0, len(self.h) - size + 1)
        self.anchor = _slid(self.g, size - span + 1, np.minimum) if self.windows else self.g[:0]

    def anchors(self, size: int, span: int) -> np.ndarray:
        """The anchor at every place that is the anchor of some window."""
        if not self.windows:
            return self.g[:0]
        width = size - span + 1
        wide = np.concatenate([np.zeros(width - 1, np.uint64), self.anchor, np.zeros(width - 1, np.uint64)])
        return self.g[_slid(wide, width, np.maximum) == self.g]


def _docs(rows: list[tuple], size: int, span: int) -> list[_Doc]:
    texts = [t for _, t in rows]
    return [_Doc(t, h, size, span) for t, h in zip(texts, texts_hashes(texts), strict=True)]


def _runs(doc: _Doc, counts: np.ndarray, heavy: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run that may repeat, and whether it is of a heavy anchor."""
    if not doc.windows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    may, many = counts > 1, counts > heavy
    new = np.ones(doc.windows, bool)
    new[1:] = (doc.anchor[1:] != doc.anchor[:-1]) | many[1:]
    first = np.flatnonzero(new)
    last = np.append(first[1:], doc.windows) - 1
    keep = may[first]
    return first[keep], last[keep], many[first][keep]


class _Block:
    """A block's documents and the runs it sends: equal runs once, in an order given by the rows alone."""

    def __init__(self, rows: list[tuple], counts: np.ndarray, size: int, span: int, heavy: int, n: int):
        self.docs = _docs(rows, size, span)
        keys = np.unique(np.concatenate([np.empty(0, np.uint64), *(d.anchors(size, span) for d in self.docs)]))
        seen: dict[bytes, int] = {}
        self.sent: list[tuple[int, int, int]] = []  # document, first window, last window
        self.own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per document: first, last, run sent or -1
        buckets: list[int] = []
        for at, doc in enumerate(self.docs):
            own = counts[np.searchsorted(keys, doc.anchor)] if doc.windows else np.empty(0, np.uint32)
            first, last, many = _runs(doc, own, heavy)
            which = np.empty(len(first), np.int64)
            data = doc.h.tobytes()
            goal = mix(doc.anchor[first] + np.uint64(1)) if len(first) else first
            for i, (a, b, m) in enumerate(zip(first.tolist(), last.tolist(), many.tolist(), strict=True)):
                body = xxhash.xxh3_128_digest(data[8 * a : 8 * (b + size)])
                known = seen.setdefault(body, len(self.sent))
                if known == len(self.sent):
                    self.sent.append((at, a, b))
                    key = int.from_bytes(body[:8], "little") if m else int(goal[i])
                    buckets.append(key * n >> 64)
                    which[i] = known
                else:
                    which[i] = -1
            self.own.append((first, last, which))
        bucket = np.array(buckets, np.int64)
        self.order = np.argsort(bucket, kind="stable")  # of sent runs, as they are asked for
        self.edges = np.searchsorted(bucket[self.order], np.arange(n + 1))


def _covered(windows, first, last, which, begin, flat, size: int, n_words: int) -> np.ndarray:
    """Words of a document that some later window covers. Runs that were not sent repeat an earlier one whole."""
    if not len(first):
        return np.zeros(n_words, bool)
    again = np.zeros(windows + 1, np.int64)
    whole = which < 0
    np.add.at(again, first[whole], 1)
    np.add.at(again, last[whole] + 1, -1)
    later = np.cumsum(again)[:-1] > 0
    first, length, source = first[~whole], (last - first + 1)[~whole], begin[which[~whole]]
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    later[np.repeat(first, length) + step] |= flat[np.repeat(source, length) + step] == 1
    # A word is covered if any of the last `size` windows up to its place is later.
    before = np.concatenate([[0], np.cumsum(later)])
    place = np.arange(n_words)
    return before[np.minimum(place + 1, windows)] > before[np.clip(place - size + 1, 0, windows)]


def _answer(size: int):
    """Of every window sent to this group: 1 unless it is the first of its words."""

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        asked = requests_of(table)
        parts = [(block, parted(d)) for block, d in asked]
        words = np.concatenate([unpack(p[0], np.uint64) for _, p in parts])
        lengths = [unpack(p[1], np.uint32).astype(np.int64) for _, p in parts]
        length = np.concatenate(lengths)
        doc_id = np.concatenate([unpack(p[2], np.int64) for _, p in parts])
        start = np.concatenate([unpack(p[3], np.uint32) for _, p in parts]).astype(np.int64)
        row = np.concatenate([unpack(p[4], np.uint32) for _, p in parts]).astype(np.int64)
        block = np.repeat([b for b, _ in parts], [len(x) for x in lengths])

        # Leaves: the windows of each run.
        windows = length - size + 1
        base = np.cumsum(length) - length
        run = np.repeat(np.arange(len(length)), windows)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
        node = _depth_ranks(words, size)[base[run] + inside]
        order = np.lexsort((start[run] + inside, row[run], block[run], doc_id[run], node))
        later = np.zeros(len(run), np.uint8)
        later[order[1:]] = node[order[1:]] == node[order[:-1]]
        out, at = [], 0
        for (b, _), own in zip(parts, lengths, strict=True):
            count = int((own - size + 1).sum())
            out.append((b, bucket, joined(np.packbits(later[at : at + count]).tobytes())))
            at += count
        return request_table(out, ("block", "bucket", "data"))

    return answer


def _depth_ranks(words: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first `depth` words; equal ranks are one node of the suffix tree."""

    def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a[: len(b)].astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        return np.unique(keys, return_inverse=True)[1]

    powers = {1: np.unique(words, return_inverse=True)[1]}
    have = 1
    while 2 * have <= depth:
        powers[2 * have] = pairs(powers[have], powers[have][have:])
        have *= 2
    ranks, done = powers[have], have
    for step in sorted(powers, reverse=True):
        while done + step <= depth:
            ranks = pairs(ranks, powers[step][done:])
            done += step
    return ranks


def remove_repeats(docs: DataFrame, min_words: int = 20, heavy: int = 20_000) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed, spans (removed words [start, end)), kept (text as bytes).

    A word goes if a window of `min_words` words around it also starts earlier, in a smaller doc_id or before it in the same
    document.
    """
    n = prepare(docs.sparkSession)
    size, span = min_words, min(ANCHOR, min_words)
    blocks = in_blocks(documents(docs))

    def keys_of(rows: list[tuple]) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(d.anchors(size, span) for d in _docs(rows, size, span))])

    def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows_of(table)
        if not rows:
            return request_table([])
        own = _Block(rows, total_counts(replies), size, span, heavy, n)
        block = table.column("block")[0].as_py()
        out = []
        for b, (i, j) in enumerate(zip(own.edges[:-1], own.edges[1:], strict=True)):
            if i == j:
                continue
            runs = [own.sent[k] for k in own.order[i:j].tolist()]
            words = np.concatenate([own.docs[d].h[first : last + size] for d, first, last in runs])
            lengths = np.array([last - first + size for _, first, last in runs], np.uint32)
            ids = np.array([np.iinfo(np.int64).min if rows[d][0] is None else rows[d][0] for d, _, _ in runs], np.int64)
            starts = np.array([first for _, first, _ in runs], np.uint32)
            places = np.array([d for d, _, _ in runs], np.uint32)
            out.append((b, block, joined(*map(pack, (words, lengths, ids, starts, places)))))
        return request_table(out)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows_of(table)
        level = replies.column("level").to_numpy()
        counts = total_counts(replies.filter(pa.array(level == 0)))
        own = _Block(rows, counts, size, span, heavy, n)
        windows = np.array([last - first + 1 for _, first, last in own.sent], np.int64)
        bits = [np.empty(0, np.uint8)]
        told = replies_of(replies.filter(pa.array(level == 1)))
        asked = [(i, j) for i, j in zip(own.edges[:-1], own.edges[1:], strict=True) if j > i]
        for (i, j), data in zip(asked, told, strict=True):
            count = int(windows[own.order[i:j]].sum())
            bits.append(np.unpackbits(np.frombuffer(parted(data)[0], np.uint8), count=count))
        flat = np.concatenate(bits)
        begin = np.zeros(len(own.sent), np.int64)
        begin[own.order] = np.cumsum(windows[own.order]) - windows[own.order]
        out: list[tuple] = []
        for (doc_id, _), doc, (first, last, which) in zip(rows, own.docs, own.own, strict=True):
            words = doc.text.split()
            gone = _covered(doc.windows, first, last, which, begin, flat, size, len(words))
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
            spans = [{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            kept, at = [], 0
            for a, b in zip(edge[::2], edge[1::2], strict=True):
                kept += words[at:a]
                at = b
            out.append((doc_id, len(words), int(gone.sum()), spans, b" ".join(kept + words[at:])))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        names = ["doc_id", "n_words", "n_removed", "spans", "kept"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    counts = key_counts(blocks, keys_of, n)
    asked = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(tidy_both(ask), REQUEST)
    told = asked.groupBy("bucket").applyInArrow(tidy(_answer(size)), REPLY)
    both = counts.selectExpr("*", "0 level").unionByName(told.selectExpr("*", "1 level"))
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(tidy_both(cut), RESULT)
