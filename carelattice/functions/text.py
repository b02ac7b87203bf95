"""Names, codes and string similarity as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# U+FFFF is a Unicode noncharacter: it marks used positions and never occurs in text.
USED = "￿"

DIGITS = "0123456789"


def prefix(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def strip_digits(text: Column) -> Column:
    """Remove every ASCII digit, e.g. the uniqueness suffix of generated names."""
    return F.translate(text, DIGITS, "")


def zip3(zip_code: Column) -> Column:
    """First three characters, with missing as empty text so that it can be a block key."""
    return F.coalesce(prefix(zip_code, 3), F.lit(""))


def birth_year(dob: Column) -> Column:
    """First four characters of a textual date of birth, missing as empty text."""
    return F.coalesce(prefix(dob, 4), F.lit(""))


def missing_as_text(text: Column, word: str = "nan") -> Column:
    """Missing values as a fixed word, so that two missing values compare as equal text."""
    return F.coalesce(text, F.lit(word))


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once.

    Inside higher-order functions Spark does not share common subexpressions; a lambda variable over
    a one-element array does it by hand.
    """
    return F.transform(F.array(value), body)[0]


def jaro_winkler(left: Column, right: Column) -> Column:
    """Jaro-Winkler similarity in [0, 1]; null if either side is null, 0.0 if either is empty.

    A fold over the left string: each step looks for the character inside the search window of what
    is left of the right string, and overwrites the first hit with a marker of equal length. The
    right string is padded in front by the reach of the window, so that the window of position `i`
    simply starts at `i`. The prefix boost (up to 4 characters, weight 0.1) applies above 0.7.
    """
    n_left, n_right = F.length(left), F.length(right)
    reach = F.greatest(F.floor(F.greatest(n_left, n_right) / 2).cast("int") - 1, F.lit(0))
    terms = F.struct(
        left.alias("left"),
        right.alias("right"),
        n_left.alias("n_left"),
        n_right.alias("n_right"),
        reach.alias("reach"),
        (2 * reach + 1).alias("width"),
    )
    similarity = let(let(terms, _jaro), lambda s: F.when(s > 0.7, s + _boost(left, right) * (1 - s)).otherwise(s))
    base = F.when((n_left == 0) | (n_right == 0), F.lit(0.0)).when(left == right, F.lit(1.0)).otherwise(similarity)
    return F.when(left.isNotNull() & right.isNotNull(), base)


def _jaro(t: Column) -> Column:
    # One text holds everything: padding, the right string, padding, and the characters matched so far.
    # No window reaches beyond the second padding.
    padded = F.concat(F.repeat(F.lit(USED), t["reach"]), t["right"], F.repeat(F.lit(USED), t["n_left"] + t["reach"]))

    def step(text: Column, i: Column) -> Column:
        char = F.substring(t["left"], i, F.lit(1))
        at = F.call_function("locate", char, F.substring(text, i, t["width"]))
        taken = F.concat(F.overlay(text, F.lit(USED), i + at - 1, F.lit(1)), char)
        return F.when(at > 0, taken).otherwise(text)

    def score(text: Column) -> Column:
        matched = F.substring(text, 2 * t["reach"] + t["n_left"] + t["n_right"] + 1, t["n_left"])
        # The marker stands where the right string lost a character; read those in order.
        lost = F.filter(
            F.sequence(F.lit(1), t["n_right"]),
            lambda j: F.substring(text, j + t["reach"], F.lit(1)) == USED,
        )
        return let(F.struct(matched.alias("matched"), lost.alias("lost")), ratio)

    def ratio(found: Column) -> Column:
        m = F.size(found["lost"])
        out_of_place = F.aggregate(
            F.sequence(F.lit(1), m),
            F.lit(0),
            lambda n, k: n
            + (
                F.substring(found["matched"], k, F.lit(1))
                != F.substring(t["right"], F.element_at(found["lost"], k), F.lit(1))
            ).cast("int"),
        )
        swaps = F.floor(out_of_place / 2)
        jaro = (m / t["n_left"] + m / t["n_right"] + (m - swaps) / m) / 3
        return F.when(m == 0, F.lit(0.0)).otherwise(jaro)

    return F.aggregate(F.sequence(F.lit(1), t["n_left"]), padded, step, score)


def _boost(left: Column, right: Column) -> Column:
    """0.1 for each of the first four characters shared from the start."""
    longest = F.least(F.length(left), F.length(right), F.lit(4))
    same = [(longest >= k) & (prefix(left, k) == prefix(right, k)) for k in (1, 2, 3, 4)]
    shared = F.when(same[3], 4).when(same[2], 3).when(same[1], 2).when(same[0], 1).otherwise(0)
    return shared * F.lit(0.1)


def letter_bits(text: Column) -> Column:
    """Which characters a text has, as bits; characters of one bit count as one. Null for null."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(c) % 63)
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0).cast("bigint"), lambda bits, c: bits.bitwiseOR(bit(c)))


def jaro_winkler_bound(left: Column, right: Column, left_bits: Column, right_bits: Column) -> Column:
    """At least `jaro_winkler(left, right)`, without a look at single characters; `*_bits` are `letter_bits`.

    Every character of one side that the other lacks takes away a match, so there are at most m = min(n - lacking) of
    them, and Jaro's mean is at most (m / n1 + m / n2 + 1) / 3. The boost grows with it and is known exactly.
    """
    n_left, n_right = F.length(left), F.length(right)
    lacking = lambda own, other: F.bit_count(own.bitwiseAND(F.bitwise_not(other)))
    m = F.least(n_left - lacking(left_bits, right_bits), n_right - lacking(right_bits, left_bits))
    jaro = (m / n_left + m / n_right + 1) / 3 + F.lit(1e-12)
    boosted = F.when(jaro > 0.7, jaro + _boost(left, right) * (1 - jaro)).otherwise(jaro)
    some = F.when((n_left == 0) | (n_right == 0) | (m <= 0), F.lit(0.0)).when(left == right, F.lit(1.0)).otherwise(boosted)
    return F.when(left.isNotNull() & right.isNotNull(), some)
