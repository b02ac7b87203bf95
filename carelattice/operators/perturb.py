"""A noisy copy of a person list with known truth, for scoring linkage.

All noise is drawn from md5 of the person id, so it is a narrow, repeatable column transformation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import below, digest, uniform
from ..functions.text import strip_digits
from ..schemas import SEED
from .sampling import sample_exact, sample_threshold

# Nicknames by formal first name.
NICKNAMES: dict[str, tuple[str, ...]] = {
    "robert": ("rob", "bob", "bobby", "robby"),
    "william": ("will", "bill", "billy"),
    "richard": ("rick", "rich", "dick"),
    "james": ("jim", "jimmy"),
    "elizabeth": ("liz", "beth", "eliza"),
    "margaret": ("meg", "maggie", "peggy"),
    "katherine": ("kate", "katie", "kathy"),
    "michael": ("mike", "mikey"),
    "christopher": ("chris",),
    "jennifer": ("jen", "jenny"),
}


@dataclass(frozen=True)
class NoiseRates:
    """Share of records hit by each kind of noise. Fixed values as defaults."""

    nickname: float = 0.5
    letter_swap: float = 0.4
    ssn_missing: float = 0.25
    ssn_digit: float = 0.15
    zip_cut: float = 0.2
    day_month_swap: float = 0.03


class Noise:
    """Noisy columns of one person list, drawn from its id column."""

    def __init__(self, key: Column, seed: int = SEED, rates: NoiseRates = NoiseRates()):
        self.key, self.seed, self.rates = key, seed, rates

    def _hit(self, field: str, rate: float) -> Column:
        return uniform(self.key, self.seed, field) < rate

    def _pick(self, field: str, n: Column) -> Column:
        return below(self.key, self.seed, field, n)

    def name(self, name: Column, field: str) -> Column:
        """A nickname, or two neighbouring letters swapped, or the name; always without digits."""
        plain = strip_digits(name)
        table = F.create_map(*[F.lit(x) for k, v in NICKNAMES.items() for x in (k, list(v))])
        nicks = F.try_element_at(table, F.lower(plain))
        nick = F.initcap(F.get(nicks, self._pick(f"{field}.which", F.size(nicks))))
        return (
            F.when(nicks.isNotNull() & self._hit(f"{field}.nick", self.rates.nickname), nick)
            .when((F.length(plain) > 3) & self._hit(f"{field}.swap", self.rates.letter_swap), self._swapped(plain, field))
            .otherwise(plain)
        )

    def _swapped(self, text: Column, field: str) -> Column:
        at = self._pick(f"{field}.at", F.length(text) - 1) + 1
        one = F.lit(1)
        return F.concat(
            F.substring(text, one, at - 1),
            F.substring(text, at + 1, one),
            F.substring(text, at, one),
            F.substring(text, at + 2, F.length(text)),
        )

    def ssn(self, ssn: Column) -> Column:
        """Missing, or with one digit drawn anew, or unchanged."""
        places = F.filter(F.sequence(F.lit(1), F.length(ssn)), lambda i: F.substring(ssn, i, F.lit(1)).between("0", "9"))
        at = F.get(places, self._pick("ssn.at", F.size(places)))
        digit = self._pick("ssn.to", F.lit(10)).cast("string")
        retyped = F.when(F.length(ssn) > 0, F.coalesce(F.overlay(ssn, digit, at, F.lit(1)), ssn)).otherwise(ssn)
        return (
            F.when(self._hit("ssn.missing", self.rates.ssn_missing), F.lit(None).cast("string"))
            .when(self._hit("ssn.digit", self.rates.ssn_digit), retyped)
            .otherwise(ssn)
        )

    def zip(self, zip_code: Column) -> Column:
        """Cut to four characters, or unchanged."""
        cut = (F.length(zip_code) >= 5) & self._hit("zip.cut", self.rates.zip_cut)
        return F.when(cut, F.substring(zip_code, 1, 4)).otherwise(zip_code)

    def dob(self, dob: Column) -> Column:
        """Month and day swapped where they differ; the result may be no date at all."""
        parts = F.split(dob, "-")
        swapped = F.concat_ws("-", F.get(parts, F.lit(0)), F.get(parts, F.lit(2)), F.get(parts, F.lit(1)))
        fits = (F.size(parts) == 3) & (F.get(parts, F.lit(1)) != F.get(parts, F.lit(2)))
        return F.when(fits & self._hit("dob.swap", self.rates.day_month_swap), swapped).otherwise(dob)


def second_list(
    people: DataFrame,
    fraction: float = 0.4,
    seed: int = SEED,
    rates: NoiseRates = NoiseRates(),
    exact: bool = True,
    id_digits: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """(noisy records, truth) for a share of the people, who have unique `patient_id`.

    `exact` draws round(fraction * n) people and runs small jobs to do so. Ids of fewer than 32 hex digits are
    shorter but collide sooner: with 12 digits at some ten million records.
    """
    draw = sample_exact if exact else sample_threshold
    drawn = draw(people, "patient_id", fraction, seed)
    key = F.col("patient_id")
    noise = Noise(key, seed, rates)
    made = F.concat(F.lit("B-"), F.substring(digest(key, seed, "id"), 1, id_digits)).alias("system_b_id")
    noisy = drawn.select(
        made,
        noise.name(F.col("first"), "first").alias("first"),
        noise.name(F.col("last"), "last").alias("last"),
        noise.dob(F.col("dob")).alias("dob"),
        noise.ssn(F.col("ssn")).alias("ssn"),
        noise.zip(F.col("zip")).alias("zip"),
    )
    return noisy, drawn.select(made, key.alias("true_patient_id"))
