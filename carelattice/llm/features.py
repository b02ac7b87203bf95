"""Numbers that describe a text, and bounded samples of rows to fit on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of `text_stats`, in order.
STATS = (
    "log_words",
    "word_length",
    "distinct_words",
    "lower_share",
    "upper_share",
    "digit_share",
    "sign_share",
    "high_share",
    "line_words",
    "distinct_lines",
    "lone_signs",
    "sign_ends",
    "frequent_share",
    "longest_run",
    "repeats",
    "log_repeats",
    "log_lone_signs",
    "log_sign_ends",
    "log_shouted",
)

_CLASS = np.full(256, 3, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 sign, 4 white space, 5 not ASCII
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[128:] = 5
_PLAIN_ENDS = frozenset(b".,;:!?\"')")


def text_stats(body: bytes, words: list[bytes]) -> list[float]:
    """Shares and lengths of a text; all zero for an empty one."""
    if not words:
        return [0.0] * len(STATS)
    kinds = _CLASS[np.frombuffer(body, np.uint8)]
    lower, upper, digit, sign, space, high = np.bincount(kinds, minlength=6).tolist()
    solid = max(1, len(body) - space)
    lines = [x for x in body.split(b"\n") if x]
    n = len(words)
    distinct = len(set(words))
    ends = sum(1 for w in words if not (w[-1:].isalnum() or w[-1] in _PLAIN_ENDS or w[-1] >= 128))
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    short = sum(1 for w in words if len(w) <= 3)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    shouted = sum(1 for w in words if len(w) > 2 and w.isupper())
    breaks = np.flatnonzero(np.diff(kinds) != 0)
    run = int(np.diff(breaks, prepend=-1, append=len(kinds) - 1).max()) if len(kinds) else 0
    return [
        float(np.log1p(n)),
        solid / n,
        distinct / n,
        lower / solid,
        upper / solid,
        digit / solid,
        sign / solid,
        high / solid,
        float(np.log1p(n / max(1, len(lines)))),
        len(set(lines)) / max(1, len(lines)),
        lone / n,
        ends / n,
        short / n,
        float(np.log1p(run)),
        repeats / n,
        float(np.log1p(repeats)),
        float(np.log1p(lone)),
        float(np.log1p(ends)),
        float(np.log1p(shouted)),
    ]


def hash_sample(rows: DataFrame, bound: int, total: int | None = None) -> DataFrame:
    """About `bound` rows of `rows` (all, if there are no more), chosen by a hash of doc_id; rows without doc_id are
    not chosen. The bound limits what a fit looks at, never what is scored."""
    total = rows.count() if total is None else total
    if total <= bound:
        return rows.where(F.col("doc_id").isNotNull())
    share = int(bound / total * (1 << 31))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 31)) < share)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Minimise from zero, given the gradient at a point."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w
