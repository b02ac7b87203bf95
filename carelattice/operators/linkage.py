"""Linking two person lists: fixed rules, candidate pairs, best match per record.

List A has `patient_id`, list B has `system_b_id`; both have first, last, dob, zip and ssn as text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..functions.similarity import Compared, half_up, jaro_winkler_of, once_each
from ..functions.text import (
    birth_year,
    blank_to_null,
    flag,
    jaro_winkler,
    jaro_winkler_bound,
    letter_bits,
    missing_as_text,
    prefix,
    strip_digits,
    zip3,
)
from ..schemas import MATCH_THRESHOLD
from ..session import cut_lineage, importable
from .running import prefix_sums
from .skew import DEFAULT_POLICY, SkewPolicy, same_key

A_ID, B_ID = "patient_id", "system_b_id"


class Side:
    """One record of a pair: `side["first"]` is its column under a name that clashes with nothing. Remembers what was read."""

    def __init__(self, mark: str):
        self.mark = mark
        self.read: list[str] = []
        self.derived: dict[str, Callable[[Callable[[str], Column]], Column]] = {}

    def derive(self, name: str, make: Callable[[Callable[[str], Column]], Column]) -> Column:
        """A column worked out once per record, before records are paired."""
        self.derived[name] = make
        return F.col(f"{self.mark}|{name}")

    def __getitem__(self, column: str) -> Column:
        if column not in self.read:
            self.read.append(column)
        return F.col(f"{self.mark}{column}")


#: Both take a `Side`, or a struct column with the record's fields.
Feature = Callable[[Side, Side], Column]
BlockKey = Callable[[Callable[[str], Column]], Column]


# -- fixed rules -------------------------------------------------------------------------------


def _rule_keys(normalize_names: bool) -> dict[str, Column]:
    """What the weaker rule compares: whole last name, start of first name, five-character zip."""
    clean = strip_digits if normalize_names else (lambda c: c)
    return {
        "__last": F.lower(clean(F.col("last"))),
        "__first": F.lower(prefix(clean(F.col("first")), 3)),
        "__zip": prefix(F.col("zip"), 5),
    }


def rule_match(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """The rule for one pair, given column accessors of both records.

    Two numbers decide alone, either way. Otherwise last name, start of first name and zip must
    agree; missing agrees with missing.
    """
    a_ssn, b_ssn = blank_to_null(a("ssn")), blank_to_null(b("ssn"))
    weaker = (
        F.lower(a("last")).eqNullSafe(F.lower(b("last")))
        & F.lower(prefix(a("first"), 3)).eqNullSafe(F.lower(prefix(b("first"), 3)))
        & prefix(a("zip"), 5).eqNullSafe(prefix(b("zip"), 5))
    )
    return F.when(a_ssn.isNotNull() & b_ssn.isNotNull(), a_ssn == b_ssn).otherwise(weaker)


def match_by_rules(a: DataFrame, b: DataFrame, normalize_names: bool = False) -> DataFrame:
    """(system_b_id, matched_patient_id): lowest patient id of equal dob that satisfies the rule.

    The rule is a choice between two equalities, so instead of pairing everyone within a day of birth
    it becomes two lookups: by (dob, ssn) and by (dob, names, zip). List A is reduced to one row per
    lookup key beforehand, so the joins never multiply rows, however many records share a day. Missing
    days of birth never match.
    """
    dated = a.where(F.col("dob").isNotNull()).select(
        A_ID, "dob", blank_to_null(F.col("ssn")).alias("__ssn"), *[c.alias(n) for n, c in _rule_keys(normalize_names).items()]
    )
    by_ssn = dated.where(F.col("__ssn").isNotNull()).groupBy("dob", "__ssn").agg(F.min(A_ID).alias("__same_ssn"))
    weak_keys = ["dob", "__last", "__first", "__zip"]
    by_names = dated.groupBy(*weak_keys).agg(
        F.min(A_ID).alias("__any"), F.min(F.when(F.col("__ssn").isNull(), F.col(A_ID))).alias("__without_ssn")
    )
    asked = b.where(F.col("dob").isNotNull()).select(
        B_ID, "dob", blank_to_null(F.col("ssn")).alias("__ssn"), *[c.alias(n) for n, c in _rule_keys(normalize_names).items()]
    )
    first = asked.join(by_ssn, ["dob", "__ssn"], "left")
    both = first.join(by_names, same_key(first, by_names, weak_keys), "left")
    # With a number in B: the same number, or the weaker rule among those without one.
    matched = F.when(F.col("__ssn").isNotNull(), F.least("__same_ssn", "__without_ssn")).otherwise(F.col("__any"))
    return both.select(B_ID, matched.alias("matched_patient_id")).where(F.col("matched_patient_id").isNotNull())


# -- candidate pairs ---------------------------------------------------------------------------

DEFAULT_BLOCK: dict[str, BlockKey] = {
    "birth_year": lambda r: birth_year(r("dob")),
    "zip3": lambda r: zip3(r("zip")),
}


@dataclass(frozen=True)
class NameSimilarity:
    """Jaro-Winkler similarity of one column as a feature, rounded to `digits` if given, and a cheap upper bound of it."""

    column: str
    lower: bool = True
    missing: str | None = "nan"
    digits: int | None = None

    def _text(self, value: Column) -> Column:
        value = value if self.missing is None else missing_as_text(value, self.missing)
        return F.lower(value) if self.lower else value

    def __call__(self, a: Side, b: Side) -> Column:
        return self._rounded(F.coalesce(jaro_winkler(*(self._text(x[self.column]) for x in (a, b))), F.lit(0.0)))

    def _rounded(self, value: Column) -> Column:
        return value if self.digits is None else F.round(value, self.digits)

    def bound(self, a: Side, b: Side) -> Column:
        """From lengths, which letters either side has, and the shared beginning; letters are noted once per record."""
        left, right = (self._text(x[self.column]) for x in (a, b))
        name = f"letters|{self.column}|{self.lower}|{self.missing}"
        letters = [x.derive(name, lambda r: letter_bits(self._text(r(self.column)))) for x in (a, b)]
        return self._rounded(F.coalesce(jaro_winkler_bound(left, right, *letters), F.lit(0.0)))

    def value(self, record: Callable[[str], Column]) -> Column:
        return self._text(record(self.column))

    def over(self, left: Sequence[str | None], right: Sequence[str | None]) -> Compared:
        # A missing text is compared as an empty one: both give 0.0.
        compared = jaro_winkler_of(*([x or "" for x in side] for side in (left, right)))
        if self.digits is None:
            return once_each(compared, len(left), len(right))
        return once_each(lambda i, j: half_up(compared(i, j), self.digits), len(left), len(right))


@dataclass(frozen=True)
class Agreement:
    """1.0 where both records have the same value, 0.0 where not or where either has none."""

    value: Callable[[Callable[[str], Column]], Column]
    #: Few pairs of a block agree, as in a number that identifies: where pairs are counted, these are looked up by it.
    rare: bool = False

    def __call__(self, a: Side, b: Side) -> Column:
        return flag(self.value(lambda c: a[c]) == self.value(lambda c: b[c]))

    @staticmethod
    def over(left: Sequence[str | None], right: Sequence[str | None]) -> Compared:
        places = {value: n for n, value in enumerate(right) if value is not None}
        same = np.array([places.get(value, -1) for value in left] or [-1])
        return lambda i, j: (same[i] == j).astype(float)


@dataclass(frozen=True)
class BothPresent:
    """1.0 where both records have a value."""

    value: Callable[[Callable[[str], Column]], Column]

    def __call__(self, a: Side, b: Side) -> Column:
        return flag(self.value(lambda c: a[c]).isNotNull() & self.value(lambda c: b[c]).isNotNull())

    @staticmethod
    def over(left: Sequence[str | None], right: Sequence[str | None]) -> Compared:
        has_a, has_b = (np.array([value is not None for value in side] or [False]) for side in (left, right))
        return lambda i, j: (has_a[i] & has_b[j]).astype(float)


def name_similarity(
    column: str, lower: bool = True, missing: str | None = "nan", digits: int | None = None
) -> NameSimilarity:
    """Jaro-Winkler similarity of one column. Missing enters as the text `missing`, so that two
    missing values count as equal; with `missing=None` a missing value gives 0.0 instead. With `digits` it is rounded,
    where two values meet in many pairs only once for all of them."""
    return NameSimilarity(column, lower, missing, digits)


DEFAULT_FEATURES: dict[str, Feature] = {
    "first_sim": name_similarity("first"),
    "last_sim": name_similarity("last"),
    "zip_sim": name_similarity("zip", lower=False),
    # Always 1.0 inside the default blocks, which contain the year.
    "dob_year_match": Agreement(lambda r: birth_year(r("dob"))),
    "ssn_agree": Agreement(lambda r: blank_to_null(r("ssn")), rare=True),
    "ssn_both_present": BothPresent(lambda r: blank_to_null(r("ssn"))),
}


def block_columns(block: Mapping[str, BlockKey]) -> list[str]:
    """Names of the block keys inside this module; those given by the caller may clash with the records' columns."""
    return [f"__block_{i}" for i in range(len(block))]


def with_block(df: DataFrame, block: Mapping[str, BlockKey] = DEFAULT_BLOCK) -> DataFrame:
    return df.select("*", *[key(F.col).alias(n) for n, key in zip(block_columns(block), block.values(), strict=True)])


def _block_sizes(a: DataFrame, b: DataFrame, block: Mapping[str, BlockKey]) -> DataFrame:
    keys = block_columns(block)
    n_a = with_block(a, block).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_a"))
    n_b = with_block(b, block).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_b"))
    return n_a.join(n_b, keys).select(*keys, "n_a", "n_b", (F.col("n_a") * F.col("n_b")).alias("pairs"))


def block_stats(a: DataFrame, b: DataFrame, block: Mapping[str, BlockKey] = DEFAULT_BLOCK) -> DataFrame:
    """Per block present on both sides: rows of A, rows of B, pairs, and whether a key is missing."""
    keys = block_columns(block)
    missing = F.lit(False)
    for k in keys:
        missing = missing | (F.col(k) == "")
    named = [F.col(k).alias(n) for k, n in zip(keys, block, strict=True)]
    return _block_sizes(a, b, block).select(*named, "n_a", "n_b", "pairs", missing.alias("has_missing_key"))


def blocking_coverage(
    a: DataFrame, b: DataFrame, truth: DataFrame, block: Mapping[str, BlockKey] = DEFAULT_BLOCK
) -> DataFrame:
    """One row: candidate pairs, true pairs among them, share of B records whose true pair is there.

    Counted from block sizes and from the true pairs alone; no pair is formed.
    """
    keys = block_columns(block)
    totals = _block_sizes(a, b, block).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("candidate_pairs"))
    left = with_block(b, block).select(B_ID, *keys).join(truth, B_ID)
    right = with_block(a, block).select(F.col(A_ID).alias("true_patient_id"), *keys)
    found = left.join(right, ["true_patient_id", *keys]).agg(F.count(F.lit(1)).alias("true_pairs_in_block"))
    records = b.agg(F.count(F.lit(1)).alias("total_system_b_records"))
    share = F.coalesce(F.try_divide(F.col("true_pairs_in_block"), F.col("total_system_b_records")), F.lit(0.0))
    return one_row(totals, found, records).withColumn("share_in_block", F.bround(share, 4))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames side by side, as scalar subqueries of the first."""
    first, *rest = frames
    return first.select(
        "*", *[f.select(c).scalar().alias(c) for f in rest for c in f.columns]
    )


def candidate_pairs(
    a: DataFrame,
    b: DataFrame,
    truth: DataFrame | None = None,
    features: Mapping[str, Feature] = DEFAULT_FEATURES,
    block: Mapping[str, BlockKey] = DEFAULT_BLOCK,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every pair within a block: ids, `is_match` if truth is given, and one column per feature.

    Features and block keys may read any column of the lists. Tasks are cut by the number of pairs, see `tiles`.
    """
    cut = tiles(a, b, block, policy)
    if not by_value(features, cut):
        return _paired(a, b, truth, features, block, cut)
    if truth is not None:
        b = b.join(truth.select(B_ID, F.col("true_patient_id").alias("__true")), B_ID, "left")
    pairs = _tiled(a, b, features, block, cut, EveryPair.of(features), [], ["__true"] if truth is not None else [])
    label = [F.coalesce(F.col("__true") == F.col(A_ID), F.lit(False)).cast("int").alias("is_match")] if truth is not None else []
    return pairs.select(B_ID, A_ID, *label, *features)


#: Pairs that are worth a task of their own.
PAIRS_PER_TASK = 2_000
#: Pairs in a tile, so that what one call in Python returns is bounded, and pairs worked on at once in it.
PAIRS_PER_TILE, PAIRS_AT_ONCE = 500_000, 250_000
#: Pairs that leave a tile as one row, which becomes rows again all at once.
PAIRS_PER_ROW = 8_192
#: Pairs in a tile of which only sums, or only the best ones, leave it: values that recur in it are compared once.
PAIRS_PER_SUM, PAIRS_PER_BEST = 20_000_000, 5_000_000
#: Entries of a table of all pairs of a tile's values.
CODED = 16_000_000
#: With fewer pairs in all, Python workers are not worth starting.
PAIRS_BY_COLUMN = 200_000


@dataclass(frozen=True)
class Tiles:
    """Where the pairs of every block are formed. `table` has one row per block: its keys, its grid (`__rows` of A against
    `__columns` of B), its first tile, the number of tiles it takes, and the pairs of blocks before it. `count` tiles are dealt
    to `tasks` tasks."""

    tasks: int
    table: DataFrame
    count: int
    pairs: int


def tiles(
    a: DataFrame, b: DataFrame, block: Mapping[str, BlockKey], policy: SkewPolicy = DEFAULT_POLICY, per_tile: int = PAIRS_PER_TILE
) -> Tiles:
    """Cut all pairs of all blocks into tasks of equal numbers of pairs.

    The blocks' pair counts are laid end to end by a prefix sum and the line is cut at equal steps. A block shorter than
    a step goes to the tile it begins in, so a tile holds less than two steps of such blocks. A longer one becomes a grid of
    about as many cells as it has steps, each the size of a step: every row of A goes to one grid row, every row of B to
    one grid column, repeated along the other side, so each pair meets exactly once. Only block sizes are looked at
    for it: two aggregations of the key columns, and `policy.parts` sums that reach the driver. There is one tile per task, or
    more if they would have more than `per_tile` pairs.
    """
    keys = block_columns(block)
    sizes = cut_lineage(_block_sizes(a, b, block))
    laid, total = prefix_sums(sizes, keys, F.col("pairs"), "__start", policy.shares(a.sparkSession))
    tasks = max(1, min(policy.shares(a.sparkSession), math.ceil(total / PAIRS_PER_TASK)))
    count = max(tasks, math.ceil(total / per_tile))
    step = max(1.0, total / count)
    cells = F.greatest(F.lit(1), F.ceil(F.col("pairs") / step))
    rows = F.least(cells, F.col("n_a"), F.greatest(F.lit(1), F.round(F.sqrt(cells * F.col("n_a") / F.col("n_b")))))
    table = (
        laid.withColumn("__cells", cells.cast("int"))
        .withColumn("__rows", rows.cast("int"))
        .withColumn("__columns", F.ceil(F.col("__cells") / F.col("__rows")).cast("int"))
        .withColumn("__first", F.least(F.floor(F.col("__start") / step), F.lit(count - 1)).cast("int"))
    )
    return Tiles(tasks, table.select(*keys, "__cells", "__rows", "__columns", "__first", "__start"), count, total)


def _read(features: Mapping[str, Feature], block: Mapping[str, BlockKey]) -> tuple[dict[str, Column], list[str], list[str]]:
    """The feature columns over two sides, and the columns of A and of B that features and block keys read."""
    sides = Side("__a_"), Side("__b_")
    built = {name: f(*sides) for name, f in features.items()}
    seen: list[str] = []
    for key in block.values():
        key(lambda c: seen.append(c) or F.col(c))
    of_a, of_b = (list(dict.fromkeys([*side.read, *seen])) for side in sides)
    return built, of_a, of_b


def _side(
    df: DataFrame,
    mark: str,
    id_: str,
    read: Sequence[str],
    block: Mapping[str, BlockKey],
    carried: Sequence[str] = (),
    derived: Mapping[str, Callable[[Callable[[str], Column]], Column]] | None = None,
) -> DataFrame:
    """Block keys, id, the columns read and derived under marked names, and further columns as they are."""
    columns = [F.col(c).alias(f"{mark}{c}") for c in read]
    columns += [make(F.col).alias(f"{mark}|{name}") for name, make in (derived or {}).items()]
    return with_block(df, block).select(*block_columns(block), F.col(id_), *columns, *carried)


def _paired(
    a: DataFrame,
    b: DataFrame,
    truth: DataFrame | None,
    features: Mapping[str, Feature],
    block: Mapping[str, BlockKey],
    cut: Tiles,
    carried_a: Sequence[str] = (),
    carried_b: Sequence[str] = (),
    possible: Callable[[Side, Side], Column] | None = None,
) -> DataFrame:
    """The pairs with their features; with `possible`, a condition that is cheaper than these, only where it holds."""
    built, of_a, of_b = _read(features, block)
    sides = Side("__a_"), Side("__b_")
    passes = None if possible is None else possible(*sides)
    left = _side(a, "__a_", A_ID, of_a, block, carried_a, sides[0].derived)
    right = _side(b, "__b_", B_ID, of_b, block, carried_b, sides[1].derived)
    if truth is not None:
        right = right.join(truth.select(B_ID, "true_patient_id"), B_ID, "left")
    left, right = _spread(left, cut, block, A_ID, by_row=True), _spread(right, cut, block, B_ID, by_row=False)
    pairs = left.join(right, ["__tile", "__cell", *block_columns(block)])
    if passes is not None:
        pairs = pairs.where(passes)
    label = []
    if truth is not None:
        label = [F.coalesce(F.col("true_patient_id") == F.col(A_ID), F.lit(False)).cast("int").alias("is_match")]
    return pairs.select(B_ID, A_ID, *label, *[f.alias(name) for name, f in built.items()], *carried_a, *carried_b)


def _spread(side: DataFrame, cut: Tiles, block: Mapping[str, BlockKey], key: str, by_row: bool) -> DataFrame:
    """Send every record to the tiles it takes part in; records of blocks without a partner stay behind."""
    own, other = ("__rows", "__columns") if by_row else ("__columns", "__rows")
    joined = side.join(cut.table, block_columns(block))
    mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
    repeated = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("__other")
    row, column = (mine, F.col("__other")) if by_row else (F.col("__other"), mine)
    celled = joined.select("*", repeated).withColumn("__cell", row * F.col("__columns") + column)
    # A grid has at most a few cells more than the block has steps: they share tiles.
    inside = F.floor(F.col("__cell") * F.col("__cells") / (F.col("__rows") * F.col("__columns")))
    tile = F.least(F.col("__first") + inside, F.lit(cut.count - 1)).cast("int")
    task = F.floor(F.col("__tile") * F.lit(cut.tasks) / F.lit(cut.count)).cast("int")
    placed = celled.withColumn("__tile", tile).select(
        task.alias("__task"), "__tile", "__cell", F.col("__start").alias("__start"), *side.columns
    )
    return placed.repartitionById(cut.tasks, F.col("__task"))


# -- pairs by value ----------------------------------------------------------------------------


def by_value(features: Mapping[str, Feature], cut: Tiles) -> bool:
    """Whether there are many pairs, and every feature says what value of a record it compares (`value`) and how two lists
    of values compare (`over`). Values of a tile are then numbered, and its pairs are numbers until they leave it."""
    return cut.pairs > PAIRS_BY_COLUMN and all(hasattr(f, "over") for f in features.values())


@dataclass(frozen=True)
class Chunk:
    """Pairs of one tile: places of their records in `left` and `right`, and one array per feature."""

    left: pa.Table
    right: pa.Table
    i: np.ndarray
    j: np.ndarray
    values: Sequence[np.ndarray]


@dataclass(frozen=True)
class EveryPair:
    """Keep all pairs: ids, features, carried columns.

    They leave the tile as rectangles, some records of B against some of A: one row with a list per column of either side, and
    one list per feature over all pairs of the two. Ids are then not repeated for every pair before Spark does so in `apart`.
    """

    names: Sequence[str]
    #: Features that are told for each pair sooner than looked up by its values.
    plain: Sequence[bool]
    pairs_per_row: int
    coded: int

    @classmethod
    def of(cls, features: Mapping[str, Feature]) -> EveryPair:
        plain = tuple(isinstance(f, Agreement | BothPresent) for f in features.values())
        return cls(tuple(features), plain, PAIRS_PER_ROW, CODED)

    def schema(self, left: StructType, right: StructType) -> StructType:
        fields = [*right, *left, *[StructField(n, DoubleType()) for n in self.names]]
        return StructType([StructField(f"__list_{k}", ArrayType(f.dataType)) for k, f in enumerate(fields)])

    def apart(self, rectangles: DataFrame, left: StructType, right: StructType) -> DataFrame:
        """One row per pair."""
        lists = [F.col(c) for c in rectangles.columns]
        of_b, of_a, values = lists[: len(right)], lists[len(right) : -len(self.names)], lists[-len(self.names) :]
        rows = rectangles.select("*", F.posexplode(of_b[0]).alias("__j", "__b"))
        pairs = rows.select("*", F.posexplode(of_a[0]).alias("__i", "__a"))
        at = F.col("__j") * F.size(of_a[0]) + F.col("__i")
        told = [F.col("__b"), *[F.get(x, F.col("__j")) for x in of_b[1:]], F.col("__a"), *[F.get(x, F.col("__i")) for x in of_a[1:]]]
        told += [F.get(x, at) for x in values]
        return pairs.select(*[x.alias(n) for x, n in zip(told, [*right.names, *left.names, *self.names], strict=True)])

    def rectangles(
        self, left: pa.Table, right: pa.Table, features: Sequence[Callable[..., Compared]], carried: tuple[list[str], list[str]]
    ) -> list[pa.Array]:
        cells, values = list(_cells(left, right)), _values(left, right, features)
        if not cells:
            return []
        tables: list[np.ndarray | None] = []
        for v, plain in zip(values, self.plain, strict=True):
            # Two values that come together anywhere in the tile are compared once, as far as a table of them is not too large.
            if plain or v.size > self.coded:
                tables.append(None)
                continue
            v.seen = np.zeros(v.size, bool)
            for a, b in cells:
                v.seen[np.unique(v.left[a])[:, None] * v.sides[1] + np.unique(v.right[b])] = True
            at, given = v.once()
            table = np.zeros(v.size)
            table[at], v.seen = given, None
            tables.append(table)
        places: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        told: list[list[np.ndarray]] = [[] for _ in values]
        for a, b in cells:
            for from_a in range(0, len(a), self.pairs_per_row):
                some_a = a[from_a : from_a + self.pairs_per_row]
                step = max(1, self.pairs_per_row // len(some_a))
                for from_b in range(0, len(b), step):
                    some_b = b[from_b : from_b + step]
                    places[0].append(some_a)
                    places[1].append(some_b)
                    for v, plain, table, found in zip(values, self.plain, tables, told, strict=True):
                        if plain:
                            found.append(v.compared(v.left[some_a], v.right[some_b][:, None]).ravel())
                        else:
                            at = v.at(some_a, some_b[:, None]).ravel()
                            found.append(at if table is None else table.take(at))
        columns = []
        for side, names, at in ((right, carried[1], places[1]), (left, carried[0], places[0])):
            which = pa.array(np.concatenate(at))
            columns += [_lists(at, side.column(n).combine_chunks().take(which)) for n in names]
        for v, plain, table, found in zip(values, self.plain, tables, told, strict=True):
            all_pairs = np.concatenate(found)
            if not plain and table is None:
                all_pairs = v.compared(all_pairs // v.sides[1], all_pairs % v.sides[1])
            columns.append(_lists(found, pa.array(all_pairs)))
        return columns


def _lists(parts: Sequence[np.ndarray], values: pa.Array) -> pa.Array:
    """One list per part, `values` being all of them end to end."""
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


@dataclass(frozen=True)
class Prepared:
    """A feature whose value has been worked out as a column."""

    column: str
    over: Callable[[Sequence[str | None], Sequence[str | None]], Compared]

    def value(self, record: Callable[[str], Column]) -> Column:
        return record(self.column)


def _compared_only(
    df: DataFrame, features: Mapping[str, Feature], block: Mapping[str, BlockKey], leave: Sequence[str] = ()
) -> DataFrame:
    """`df` with block keys and the values that features compare, as `__key_i` and `__of_k`: of `BothPresent` only whether
    there is one, of the features to `leave` nothing. Records equal in these are alike to all other features."""
    values = []
    for k, (name, f) in enumerate(features.items()):
        value = f.value(F.col)
        if name in leave:
            value = F.lit(None).cast("string")
        elif isinstance(f, BothPresent):
            value = F.when(value.isNotNull(), F.lit("1"))
        values.append(value.alias(f"__of_{k}"))
    return df.select("*", *[key(F.col).alias(f"__key_{i}") for i, key in enumerate(block.values())], *values)


def _prepared(
    features: Mapping[str, Feature], block: Mapping[str, BlockKey]
) -> tuple[dict[str, Prepared], dict[str, BlockKey], list[str]]:
    """Features and block keys over the columns of `_compared_only`, and these columns."""
    ready = {name: Prepared(f"__of_{k}", f.over) for k, (name, f) in enumerate(features.items())}
    keys = {name: (lambda r, i=i: r(f"__key_{i}")) for i, name in enumerate(block)}
    return ready, keys, [*[f"__key_{i}" for i in range(len(block))], *[f.column for f in ready.values()]]


def _rows(c: Chunk, which: np.ndarray) -> list[pa.Array]:
    taken = [side.column(n).combine_chunks().take(pa.array(at[which])) for side, at in ((c.right, c.j), (c.left, c.i)) for n in side.column_names]
    return [*taken, *[pa.array(v[which]) for v in c.values]]


@dataclass(frozen=True)
class NearBest:
    """Keep the pairs whose score may be the best one of their B record once it is rounded, and reach the threshold."""

    names: Sequence[str]
    score: LinearScore
    threshold: float

    def schema(self, left: StructType, right: StructType) -> StructType:
        return StructType([*right, *left, *[StructField(n, DoubleType()) for n in self.names]])

    def keep(self, chunks: Iterator[Chunk]) -> Iterator[list[pa.Array]]:
        slack = 1e-9 + (2 * 10.0**-self.score.digits if self.score.digits is not None else 0.0)
        best, kept = None, []
        for c in chunks:
            z = np.full(len(c.i), float(self.score.intercept))
            for name, weight in self.score.weights.items():
                z += c.values[self.names.index(name)] * weight
            with np.errstate(over="ignore"):
                score = 1 / (1 + np.exp(-z))
            best = np.full(len(c.right), -np.inf) if best is None else best
            np.maximum.at(best, c.j, score)
            some = np.flatnonzero((score >= self.threshold - slack) & (score >= best[c.j] - slack))
            kept.append((Chunk(c.left, c.right, c.i[some], c.j[some], [v[some] for v in c.values]), score[some]))
        for c, score in kept:
            yield _rows(c, np.flatnonzero(score >= best[c.j] - slack))


@dataclass(frozen=True)
class Counted:
    """Add up the pairs of equal features and side, each with the product of its records' numbers."""

    names: Sequence[str]

    def schema(self, left: StructType, right: StructType) -> StructType:
        return StructType([right["__side"], *[StructField(n, DoubleType()) for n in self.names], StructField("n", LongType())])

    def keep(self, chunks: Iterator[Chunk]) -> Iterator[list[pa.Array]]:
        for c in chunks:
            side = c.right.column("__side").combine_chunks().dictionary_encode(null_encoding="encode")
            n_a, n_b = c.left.column("__n_a").to_numpy(), c.right.column("__n_b").to_numpy()
            key = side.indices.to_numpy(zero_copy_only=False)[c.j].astype(np.int64)
            for v in c.values:
                distinct, code = np.unique(v, return_inverse=True)
                # Keys are numbered anew before they could run over.
                if (int(key.max(initial=0)) + 1) * len(distinct) > 2**62:
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(distinct) + code
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, group, n_a[c.i] * n_b[c.j])
            yield [side.dictionary.take(side.indices.take(pa.array(c.j[first]))), *[pa.array(v[first]) for v in c.values], pa.array(total)]


def _cell_numbers(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of either side's records, numbers of the cells of blocks they are in: those that share one meet."""
    cells = []
    for t in (left, right):
        cells.append(np.stack([t.column(n).to_numpy().astype(np.int64) for n in ("__start", "__cell")]))
    _, numbers = np.unique(np.concatenate(cells, axis=1), axis=1, return_inverse=True)
    of_a, of_b = np.split(numbers.ravel(), [len(left)])
    return of_a, of_b


def _cells(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per cell of a tile, the places of its records in `left` and `right`."""
    of_a, of_b = _cell_numbers(left, right)
    shared = np.intersect1d(of_a, of_b)
    cut = []
    for of in (of_a, of_b):
        order = np.argsort(of, kind="stable")
        cut.append((order, *(np.searchsorted(of[order], shared, side).tolist() for side in ("left", "right"))))
    (order_a, from_a, to_a), (order_b, from_b, to_b) = cut
    for n in range(len(shared)):
        yield order_a[from_a[n] : to_a[n]], order_b[from_b[n] : to_b[n]]


def _places(left: pa.Table, right: pa.Table) -> Callable[[], Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Goes through the pairs of a tile, some at a time: records meet where they share a cell of a block."""
    of_a, of_b = _cell_numbers(left, right)
    order_a, order_b = np.argsort(of_a, kind="stable"), np.argsort(of_b, kind="stable")
    first = np.searchsorted(of_b[order_b], of_a[order_a], "left")
    many = np.searchsorted(of_b[order_b], of_a[order_a], "right") - first
    end = np.cumsum(many)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = 0
        while at < len(order_a):
            to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            n = many[at:to]
            i = np.repeat(order_a[at:to], n)
            j = order_b[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:to], n)]
            if len(i):
                yield i, j
            at = to

    return pairs


@dataclass
class _Values:
    """One feature of a tile: numbers of the values of its records, and how two lists of values compare."""

    left: np.ndarray
    right: np.ndarray
    sides: tuple[int, int]
    compared: Compared
    seen: np.ndarray | None = None

    @property
    def size(self) -> int:
        return self.sides[0] * self.sides[1]

    def at(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.left[i] * self.sides[1] + self.right[j]

    def once(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of values that were seen, and what each gives."""
        at = np.flatnonzero(self.seen)
        return at, self.compared(at // self.sides[1], at % self.sides[1])


def _values(left: pa.Table, right: pa.Table, features: Sequence[Callable[..., Compared]]) -> list[_Values]:
    found = []
    for k, over in enumerate(features):
        coded = [t.column(f"__value_{k}").combine_chunks().dictionary_encode(null_encoding="encode") for t in (left, right)]
        codes = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in coded]
        found.append(_Values(*codes, tuple(len(x.dictionary) for x in coded), over(*[x.dictionary.to_pylist() for x in coded])))
    return found


def _look(pairs: Callable[[], Iterator[tuple[np.ndarray, np.ndarray]]], values: Sequence[_Values]) -> None:
    """Note which pairs of values come together in the tile."""
    for v in values:
        v.seen = np.zeros(v.size, bool)
    for i, j in pairs():
        for v in values:
            v.seen[v.at(i, j)] = True


def _chunks(
    left: pa.Table, right: pa.Table, features: Sequence[Callable[..., Compared]], carried: tuple[list[str], list[str]], once: bool = False
) -> Iterator[Chunk]:
    """The pairs of a tile with what the features give, some at a time. With `once`, pairs of values that come together
    anywhere in the tile are compared once, as far as a table of them is not too large."""
    pairs, values = _places(left, right), _values(left, right, features)
    told: list[Compared] = [lambda i, j, v=v: v.compared(v.left[i], v.right[j]) for v in values]
    if once:
        _look(pairs, [v for v in values if v.size <= CODED])
        for k, v in enumerate(values):
            if v.seen is not None:
                at, given = v.once()
                table = np.zeros(v.size)
                table[at] = given
                v.seen, told[k] = None, lambda i, j, v=v, table=table: table[v.at(i, j)]
    kept_a, kept_b = left.select(carried[0]), right.select(carried[1])
    for i, j in pairs():
        yield Chunk(kept_a, kept_b, i, j, [f(i, j) for f in told])


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of `n`."""
    if (n == 1).all():
        key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[first], np.diff(np.append(first, len(key)))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


def _counted_tile(
    kept: Counted, left: pa.Table, right: pa.Table, features: Sequence[Callable[..., Compared]], carried: tuple[list[str], list[str]]
) -> Iterator[list[pa.Array]]:
    """What `Counted` gives for a whole tile: results of features are numbered, so a pair is one number."""
    pairs, values = _places(left, right), _values(left, right, features)
    if any(v.size > CODED for v in values):
        yield from kept.keep(_chunks(left, right, features, carried))
        return
    _look(pairs, values)
    given, tables = [], []
    for v in values:
        at, result = v.once()
        distinct, code = np.unique(result, return_inverse=True)
        table = np.zeros(v.size, np.int32)
        table[at] = code
        v.seen = None
        given.append(distinct)
        tables.append(table)
    side = right.column("__side").combine_chunks().dictionary_encode(null_encoding="encode")
    of_side = side.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if math.prod(map(len, given)) * max(1, len(side.dictionary)) >= 2**62:
        yield from kept.keep(_chunks(left, right, features, carried))
        return
    n_a, n_b = left.column("__n_a").to_numpy(), right.column("__n_b").to_numpy()
    keys, sums, held = [], [], 0
    for i, j in pairs():
        key = of_side[j]
        for v, table, distinct in zip(values, tables, given, strict=True):
            if len(distinct) > 1:
                key = key * len(distinct) + table[v.at(i, j)]
        n = n_a[i] * n_b[j]
        single = n == 1
        for part in (single, ~single):
            if part.any():
                added = _added(key[part], n[part])
                keys.append(added[0])
                sums.append(added[1])
                held += len(added[0])
        if held > 4_000_000:
            added = _added(np.concatenate(keys), np.concatenate(sums))
            keys, sums, held = [added[0]], [added[1]], 0
    if not keys:
        return
    key, total = _added(np.concatenate(keys), np.concatenate(sums))
    columns = []
    for distinct in reversed(given):
        key, code = (key // len(distinct), key % len(distinct)) if len(distinct) > 1 else (key, np.zeros(len(key), np.int64))
        columns.append(pa.array(distinct[code]))
    yield [side.dictionary.take(pa.array(key)), *reversed(columns), pa.array(total)]


def _tiled(
    a: DataFrame,
    b: DataFrame,
    features: Mapping[str, Feature],
    block: Mapping[str, BlockKey],
    cut: Tiles,
    kept: EveryPair | NearBest | Counted,
    carried_a: Sequence[str] = (),
    carried_b: Sequence[str] = (),
) -> DataFrame:
    """What `kept` keeps of the pairs of all blocks, formed tile by tile; features must be `by_value`."""
    importable(a.sparkSession)
    values = [f.value(F.col).alias(f"__value_{k}") for k, f in enumerate(features.values())]
    sides, carried = [], ([A_ID, *carried_a], [B_ID, *carried_b])
    for df, id_, more, by_row in ((a, A_ID, carried[0], True), (b, B_ID, carried[1], False)):
        own = with_block(df, block).select(*block_columns(block), *more, *values)
        sides.append(_spread(own, cut, block, id_, by_row).drop(*block_columns(block)))
    of_a, of_b = (StructType([df.schema[n] for n in names]) for df, names in zip((a, b), carried, strict=True))
    schema, over = kept.schema(of_a, of_b), [f.over for f in features.values()]

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return empty
        if isinstance(kept, EveryPair):
            arrays = kept.rectangles(left, right, over, carried)
            return pa.Table.from_arrays(arrays, names) if arrays else empty
        if isinstance(kept, Counted):
            told = _counted_tile(kept, left, right, over, carried)
        else:
            told = kept.keep(_chunks(left, right, over, carried, once=True))
        parts = [pa.Table.from_arrays(arrays, names) for arrays in told]
        return pa.concat_tables(parts) if parts else empty

    names = schema.names
    empty = to_arrow_schema(schema).empty_table()
    grouped = [side.groupBy("__task", "__tile") for side in sides]
    told = grouped[0].cogroup(grouped[1]).applyInArrow(pairs, schema)
    return kept.apart(told, of_a, of_b) if isinstance(kept, EveryPair) else told


def _counted_by_value(
    a: DataFrame, b: DataFrame, features: Mapping[str, Feature], block: Mapping[str, BlockKey], policy: SkewPolicy
) -> DataFrame | None:
    """(features, `__side`, n) of all pairs, as if no pair agreed in a rare feature, from records merged by what is
    compared. None where features do not say that, or where there are few pairs left."""
    if not all(hasattr(f, "over") for f in features.values()):
        return None
    ready, keys, columns = _prepared(features, block)
    rare = [name for name, f in features.items() if getattr(f, "rare", False)]
    merged = lambda df, id_, n, *more: (
        _compared_only(df, features, block, rare).groupBy(*columns, *more).agg(F.min(id_).alias(id_), F.count(F.lit(1)).alias(n))
    )
    few_a, few_b = (cut_lineage(df) for df in (merged(a, A_ID, "__n_a"), merged(b, B_ID, "__n_b", "__side")))
    cut = tiles(few_a, few_b, keys, policy, PAIRS_PER_SUM)
    if not by_value(ready, cut):
        return None
    return _tiled(few_a, few_b, ready, keys, cut, Counted(tuple(features)), ["__n_a"], ["__side", "__n_b"])


def _rare_corrections(a: DataFrame, b: DataFrame, features: Mapping[str, Feature], block: Mapping[str, BlockKey]) -> DataFrame:
    """(features, `__side`, n): every pair that agrees in a rare feature once as it is, and minus once as one that does not.
    `a` and `b` are distinct records with their numbers `__n_a` and `__n_b`."""
    built, of_a, of_b = _read(features, block)
    keys = block_columns(block)
    rare = [name for name, f in features.items() if getattr(f, "rare", False)]
    plain = [F.lit(0.0).alias(name) if name in rare else F.col(name) for name in built]
    found = []
    for k, name in enumerate(rare):
        same = lambda r, f=features[name]: f.value(r)
        left = _side(a, "__a_", A_ID, of_a, block, ["__n_a"], {"rare": same}).where(F.col("__a_|rare").isNotNull())
        right = _side(b, "__b_", B_ID, of_b, block, ["__side", "__n_b"], {"rare": same})
        pairs = left.withColumnRenamed("__a_|rare", "__rare").join(right.withColumnRenamed("__b_|rare", "__rare"), ["__rare", *keys])
        pairs = pairs.select(*[f.alias(n) for n, f in built.items()], "__side", (F.col("__n_a") * F.col("__n_b")).alias("n"))
        # Pairs that agree in an earlier one are there already.
        for earlier in rare[:k]:
            pairs = pairs.where(F.col(earlier) == 0)
        found += [pairs, pairs.select(*plain, "__side", (-F.col("n")).alias("n"))]
    none = a.sparkSession.createDataFrame([], StructType([*[StructField(n, DoubleType()) for n in built], b.select("__side").schema[0], StructField("n", LongType())]))
    return reduce(DataFrame.unionByName, found, none)


def weighted_pairs(
    a: DataFrame,
    b: DataFrame,
    truth: DataFrame,
    side: str,
    features: Mapping[str, Feature] = DEFAULT_FEATURES,
    block: Mapping[str, BlockKey] = DEFAULT_BLOCK,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The candidate pairs as a frequency table: features, `is_match`, `side`, n.

    Says the same as grouping `candidate_pairs` by these columns, for anything that treats equal pairs
    alike, such as fitting a classifier. `side` is a column of `b`, the split. Records that are equal in what is
    compared are compared once and stand for the product of their numbers: the more records of a block share names
    and the like, the fewer comparisons. A number that identifies (`Agreement.rare`) keeps none apart: pairs are counted
    as if they did not agree in it, and those that do are found by it and set right.

    Counting is signed, so no pair is looked up: every pair counts as no match where it is formed, and each true pair,
    formed from the truth alone, counts once as a match and minus once as none. Pairs leave their task added up.
    """
    built, of_a, of_b = _read(features, block)
    split = F.col(side).alias("__side")
    few_a = a.groupBy(*of_a).agg(F.min(A_ID).alias(A_ID), F.count(F.lit(1)).alias("__n_a"))
    few_b = b.groupBy(*dict.fromkeys([*of_b, side])).agg(F.min(B_ID).alias(B_ID), F.count(F.lit(1)).alias("__n_b"))
    few_b = few_b.withColumn("__side", split)
    formed = _counted_by_value(a, b.withColumn("__side", split), features, block, policy)
    if formed is not None:
        formed = formed.unionByName(_rare_corrections(few_a, few_b, features, block))
    else:
        cut = tiles(few_a, few_b, block, policy)
        formed = _paired(few_a, few_b, None, features, block, cut, ["__n_a"], ["__side", "__n_b"])
        formed = formed.withColumn("n", F.col("__n_a") * F.col("__n_b")).select(*built, "__side", "n")
    formed = formed.select(*built, "__side", F.lit(0).alias("is_match"), "n")

    left = _side(a, "__a_", A_ID, of_a, block).withColumnRenamed(A_ID, "true_patient_id")
    right = _side(b.withColumn("__side", split), "__b_", B_ID, of_b, block, ["__side"])
    true = truth.select(B_ID, "true_patient_id").join(right, B_ID).join(left, ["true_patient_id", *block_columns(block)])
    signs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("is_match"), F.lit(n).cast("long").alias("n")) for m, n in ((1, 1), (0, -1))])
    )
    matched = true.select(*[f.alias(name) for name, f in built.items()], "__side").select("*", signs.alias("__s"))
    counted = formed.unionByName(matched.select(*built, "__side", "__s.*"))
    summed = counted.groupBy(*built, "is_match", "__side").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    return summed.withColumnRenamed("__side", side).select(*built, "is_match", side, "n")


# -- scoring -----------------------------------------------------------------------------------


def logistic(weights: Mapping[str, float], intercept: float) -> Column:
    """Logistic score of named feature columns."""
    z = F.lit(float(intercept))
    for name, w in weights.items():
        z = z + F.col(name) * F.lit(float(w))
    return 1 / (1 + F.exp(-z))


@dataclass(frozen=True)
class LinearScore:
    """A logistic score of features by weights, rounded to `digits` if given."""

    weights: Mapping[str, float]
    intercept: float
    digits: int | None = None

    def column(self) -> Column:
        score = logistic(self.weights, self.intercept)
        return score if self.digits is None else F.round(score, self.digits)

    def may_reach(self, threshold: float, features: Mapping[str, Feature]) -> Callable[[Side, Side], Column]:
        """Whether a pair's score could be at least `threshold`, from bounds of its features: similarities are between 0
        and their bound, other features are taken as they are."""
        if not 0 < threshold < 1:
            return lambda a, b: F.lit(True)
        slack = 1e-6 + (10.0**-self.digits / (threshold * (1 - threshold)) if self.digits is not None else 0.0)

        def reaches(a: Side, b: Side) -> Column:
            most = F.lit(float(self.intercept))
            for name, weight in self.weights.items():
                bound = getattr(features[name], "bound", None)
                if bound is None:
                    most = most + features[name](a, b) * weight
                elif weight > 0:
                    most = most + bound(a, b) * weight
            return most >= math.log(threshold / (1 - threshold)) - slack

        return reaches


def best_per_record(scored: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    """(system_b_id, matched_patient_id, score): highest score per B record, lowest patient id among
    equals; the threshold is applied to the pick. Partial aggregation, no window."""
    best = scored.groupBy(B_ID).agg(F.min(F.struct((-F.col("score")).alias("neg"), F.col(A_ID))).alias("__best"))
    return best.select(
        B_ID, F.col(f"__best.{A_ID}").alias("matched_patient_id"), (-F.col("__best.neg")).alias("score")
    ).where(F.col("score") >= threshold)


def best_matches(
    a: DataFrame,
    b: DataFrame,
    score: Column | LinearScore,
    features: Mapping[str, Feature] = DEFAULT_FEATURES,
    block: Mapping[str, BlockKey] = DEFAULT_BLOCK,
    threshold: float = MATCH_THRESHOLD,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Best match of every B record under `score`, a function of the feature columns.

    Records that are equal in all that is compared are first reduced to one, whatever their number: equal records
    of A have equal scores, so the lowest id stands for all, and equal records of B have the same best match. A large
    group of copies is then compared once. Blocks and features may read any column. With a `LinearScore`, pairs whose
    scores cannot be a record's best, or stay below the threshold, do not leave their tile; the result is the same.
    """
    threshold_of = score if isinstance(score, LinearScore) else None
    column = score.column() if threshold_of else score
    if all(hasattr(f, "over") for f in features.values()):
        ready, keys, columns = _prepared(features, block)
        whole = _compared_only(b, features, block)
        few_a = cut_lineage(_compared_only(a, features, block).groupBy(*columns).agg(F.min(A_ID).alias(A_ID)))
        few_b = cut_lineage(whole.groupBy(*columns).agg(F.min(B_ID).alias(B_ID)))
        names = tuple(features)
        cut = tiles(few_a, few_b, keys, policy, PAIRS_PER_BEST if threshold_of else PAIRS_PER_TILE)
        if by_value(ready, cut):
            kept = NearBest(names, threshold_of, threshold) if threshold_of else EveryPair.of(features)
            compared = _tiled(few_a, few_b, ready, keys, cut, kept)
            best = best_per_record(compared.withColumn("score", column), threshold)
            told = few_b.join(best, B_ID).drop(B_ID)
            return whole.join(told, same_key(whole, told, columns)).select(whole[B_ID], "matched_patient_id", "score")
    _, of_a, of_b = _read(features, block)
    few_a = a.groupBy(*of_a).agg(F.min(A_ID).alias(A_ID))
    few_b = b.groupBy(*of_b).agg(F.min(B_ID).alias(B_ID))
    possible = threshold_of.may_reach(threshold, features) if threshold_of else None
    compared = _paired(few_a, few_b, None, features, block, tiles(few_a, few_b, block, policy), possible=possible)
    best = best_per_record(compared.withColumn("score", column), threshold)
    # Back to all records: one row per distinct content on the right.
    told = few_b.join(best, B_ID).drop(B_ID)
    return b.join(told, same_key(b, told, of_b)).select(b[B_ID], "matched_patient_id", "score")
