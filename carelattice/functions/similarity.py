"""String similarity of many pairs at once in numpy, for use inside tasks; the same figures as the columns of `text`."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np

#: Longer texts are compared one pair at a time: positions are bits, and a window moved along must fit into 64.
LONGEST = 32
#: Pairs worked on at once, so that the arrays stay in the processor's cache.
PIECE = 16_384
#: Entries of the table of letter positions, and of a table of all pairs of values, that a task may hold.
TABLE = 4_000_000

#: Of numbers of left and of right values: the similarity of each two.
Compared = Callable[[np.ndarray, np.ndarray], np.ndarray]


def code_points(values: Sequence[str], pad: int) -> np.ndarray:
    """One row per text; texts beyond `LONGEST` characters have their first ones only."""
    width = max(1, min(LONGEST, max(map(len, values), default=0)))
    out = np.full((max(1, len(values)), width), pad, np.int32)
    for row, value in enumerate(values):
        points = np.frombuffer(value[:width].encode("utf-32-le", "surrogatepass"), np.int32)
        out[row, : len(points)] = points
    return out


def jaro_winkler_of(left: Sequence[str], right: Sequence[str]) -> Compared:
    """`text.jaro_winkler` between values of two lists of distinct texts.

    Positions of the right text are bits: per character of the left one, those of equal letters inside the window that are
    not used yet; the lowest is taken. Only where a match lies before an earlier one can letters be out of place.
    """
    a, b = code_points(left, -1), code_points(right, -2)
    n_a, n_b = (np.array([*map(len, x), 0], np.int64) for x in (left, right))
    at_right = {value: n for n, value in enumerate(right)}
    same = np.array([at_right.get(value, -1) for value in left] or [-1])
    letters = np.unique(b[b >= 0])
    coded = len(b) * (len(letters) + 1) <= TABLE
    if coded:
        of_a = np.searchsorted(letters, a).clip(max=max(0, len(letters) - 1))
        absent = len(letters)
        of_a = np.where(letters[of_a] == a, of_a, absent) if len(letters) else np.full(a.shape, absent)
        places = np.zeros((len(b), absent + 1), np.uint64)
        for k in range(b.shape[1]):
            rows = np.flatnonzero(b[:, k] >= 0)
            places[rows, np.searchsorted(letters, b[rows, k])] |= np.uint64(1 << k)
        places = places.ravel()
    one = np.uint64(1)

    def equal_letters(i: np.ndarray, j: np.ndarray, k: int) -> np.ndarray:
        if coded:
            return places[j * (absent + 1) + of_a[i, k]]
        letter, found = a[i, k], np.zeros(len(i), np.uint64)
        for p in range(b.shape[1]):
            found |= (b[j, p] == letter).astype(np.uint64) << np.uint64(p)
        return found

    def short(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n1, n2 = n_a[i], n_b[j]
        reach = np.maximum(np.maximum(n1, n2) // 2 - 1, 0).astype(np.uint64)
        window = (one << (reach + reach + one)) - one
        used, taken = np.zeros(len(i), np.uint64), np.zeros(len(i), np.uint64)
        crossed = np.zeros(len(i), bool)
        for k in range(int(n1.max(initial=0))):
            open_ = equal_letters(i, j, k) & ((window << np.uint64(k)) >> reach) & ~used
            lowest = open_ & (~open_ + one)
            hit = lowest != 0
            crossed |= hit & (lowest < used)
            used |= lowest
            taken |= hit.astype(np.uint64) << np.uint64(k)
        m = np.bitwise_count(used).astype(np.int64)
        swaps = np.zeros(len(i), np.int64)
        x = np.flatnonzero(crossed)
        u, t, out = used[x], taken[x], np.zeros(len(x), np.int64)
        while u.any():
            low_u, low_t = u & (~u + one), t & (~t + one)
            some = u != 0
            p, q = (np.where(some, np.bitwise_count(low - one), 0) for low in (low_u, low_t))
            out += some & (b[j[x], p] != a[i[x], q])
            u, t = u ^ low_u, t ^ low_t
        swaps[x] = out // 2
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m == 0, 0.0, (m / n1 + m / n2 + (m - swaps) / m) / 3)
        return jaro

    def long(i: int, j: int) -> float:
        x, y = left[i], right[j]
        reach = max(max(len(x), len(y)) // 2 - 1, 0)
        rest, matched = [*y], []
        for k, char in enumerate(x):
            at = next((p for p in range(max(0, k - reach), min(len(y), k + reach + 1)) if rest[p] == char), None)
            if at is not None:
                rest[at] = ""
                matched.append(char)
        m = len(matched)
        lost = [y[p] for p, char in enumerate(rest) if not char]
        swaps = sum(c != d for c, d in zip(matched, lost, strict=True)) // 2
        return (m / len(x) + m / len(y) + (m - swaps) / m) / 3 if m else 0.0

    def piece(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        jaro = np.zeros(len(i))
        small = (n_a[i] <= LONGEST) & (n_b[j] <= LONGEST)
        if small.all():
            jaro = short(i, j)
        else:
            jaro[small] = short(i[small], j[small])
            jaro[~small] = [long(x, y) for x, y in zip(i[~small].tolist(), j[~small].tolist(), strict=True)]
        width = min(4, a.shape[1], b.shape[1])
        shared = np.logical_and.accumulate(a[i, :width] == b[j, :width], axis=1).sum(axis=1)
        value = np.where(jaro > 0.7, jaro + shared * 0.1 * (1 - jaro), jaro)
        return np.where((n_a[i] == 0) | (n_b[j] == 0), 0.0, np.where(same[i] == j, 1.0, value))

    def compared(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i))
        for at in range(0, len(i), PIECE):
            out[at : at + PIECE] = piece(i[at : at + PIECE], j[at : at + PIECE])
        return out

    return compared


def once_each(compared: Compared, n_left: int, n_right: int) -> Compared:
    """`compared`, with pairs of values that come several times in a call worked out once."""

    def told(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        code = i * n_right + j
        if n_left * n_right <= TABLE:
            seen = np.zeros(n_left * n_right, bool)
            seen[code] = True
            distinct = np.flatnonzero(seen)
            values = np.empty(n_left * n_right)
            values[distinct] = compared(distinct // n_right, distinct % n_right)
            return values[code]
        distinct, at = np.unique(code, return_inverse=True)
        return compared(distinct // n_right, distinct % n_right)[at]

    return told


def half_up(values: np.ndarray, digits: int) -> np.ndarray:
    """Rounded as Spark's `round` does it: the shortest decimal that is the number, a five going up."""
    distinct, at = np.unique(values, return_inverse=True)
    unit = Decimal(1).scaleb(-digits)
    rounded = [float(Decimal(repr(x)).quantize(unit, ROUND_HALF_UP)) for x in distinct.tolist()]
    return np.array(rounded, float)[at]
