"""Point-in-time operators: what was known about an entity at a given instant.

All of them lay the asked-about instants ("probes") and the dated facts on one timeline per entity
and read the answer off running sums and last values. That is one shuffle by entity, however many
counts and readings are asked for, where joins would take one each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DAY_MICROS, micros, plus_days
from .running import running
from .skew import DEFAULT_POLICY, HeavyKey, SkewPolicy, dealt, same_key, split_off, weighed_keys

# Places within one microsecond, in the order they are passed.
_INCLUSIVE_FACT, _PROBE, _STRICT_FACT, _LATE_PROBE = range(4)


@dataclass(frozen=True)
class Reading:
    """A number per row, told apart by a code: `names` maps codes to output columns. Rows of other codes
    and rows without a number are no readings. `kind` is the type numbers are carried in, one for all
    readings that are asked for together; whole numbers beyond 2^53 need `bigint`."""

    code: Column
    value: Column
    names: Mapping[str, str]
    kind: str = "double"


def single_reading(name: str, value: Column, kind: str = "double") -> Reading:
    """Every row is the same reading."""
    return Reading(F.lit(name), value, {name: name}, kind)


@dataclass(frozen=True)
class Facts:
    """Dated rows of one source.

    `at`: microseconds. `counts`: name -> condition; a name may recur in several sources. `reading`: the
    number a row tells, if any (list the source twice for two). `strict`: whether a fact at
    exactly the probe's instant is unknown to it. `rank` orders readings of one instant; the highest
    wins.
    """

    rows: DataFrame
    at: Column
    counts: Mapping[str, Column] = field(default_factory=dict)
    reading: Reading | None = None
    strict: bool = True
    rank: Column | None = None


@dataclass(frozen=True)
class Probe:
    """An instant of every index row. `after_ties`: see all facts of that instant, strict or not."""

    at: Column
    after_ties: bool = False


def point_in_time(
    index: DataFrame,
    entity: str,
    probes: Mapping[str, Probe],
    facts: Sequence[Facts],
    outputs: Mapping[str, tuple[str, str]],
    key: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Index rows with `outputs`: column name -> (probe, count or reading).

    `key` tells index rows apart; only needed with more than one probe. It need not be unique: rows that
    share a key come back each with its own answers, and identical rows as often as they went in. Counts
    are 0 and readings null where nothing is known. Facts without an entity or an instant are known to nobody.

    Facts travel as (entity, place in time, bits of the counts they add to, reading number, value),
    so the width of the shuffle does not grow with the number of outputs. Facts that share a frame are
    read from it in one pass. Runs a job over the entity column to find heavy entities.
    """
    counts = list(dict.fromkeys(n for f in facts for n in f.counts))
    readings = list(dict.fromkeys(n for f in facts if f.reading for n in f.reading.names.values()))
    if len(counts) > 62:
        raise ValueError("at most 62 counts in one pass")
    names = list(probes)
    if len(names) > 1 and key is None:
        raise ValueError("several probes need a key to come back together")
    if len({f.reading.kind for f in facts if f.reading}) > 1:
        raise ValueError("readings of one pass need one kind")
    payload = [c for c in index.columns if c not in (entity, key)]

    history = reduce(DataFrame.unionByName, _histories(facts, entity, counts, readings))
    asked = _probe_rows(index, probes, payload)

    wanted_counts = {c: F.coalesce(F.getbit("__bits", F.lit(counts.index(c))).cast("bigint"), F.lit(0)) for c in counts}
    wanted_readings = {r: F.when(F.col("__slot") == readings.index(r), F.col("__value")) for r in readings}
    needed = {measure for _, measure in outputs.values()}
    sums = {c: e for c, e in wanted_counts.items() if c in needed}
    latest = {r: e for r, e in wanted_readings.items() if r in needed}

    heavy, rows = weighed_keys(_entities(index, facts, entity, len(names)), [entity], policy, F.col("__times"))
    if not heavy:
        timeline = dealt(history.unionByName(asked, allowMissingColumns=True), [entity], rows)
        state = running(timeline, [entity], "__place", sums, latest, tie=["__rank", "__value"], heavy=[])
        answered = state.where(F.col("__probe").isNotNull())
    else:
        answered = _with_heavy(history, asked, entity, sums, latest, heavy, rows)
    if len(names) == 1:
        return answered.select(*index.columns, *[F.col(m).alias(o) for o, (_, m) in outputs.items()])
    # Bring the probes of one index row together; they are co-located by entity already.
    at = lambda probe, measure: F.max(F.when(F.col("__probe") == names.index(probe), F.col(measure)))
    whole = answered.groupBy(entity, key, "__row").agg(
        *[F.max(c).alias(c) for c in payload],
        *[at(p, m).alias(o) for o, (p, m) in outputs.items()],
        F.count_if(F.col("__probe") == 0).alias("__copies"),
    )
    each = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy"))
    return each.select(*index.columns, *outputs)


def _entities(index: DataFrame, facts: Sequence[Facts], entity: str, probes: int) -> DataFrame:
    """Entity and number of timeline rows it may get, of every source row; reads no other column."""
    sources: dict[int, list] = {id(index): [index, probes]}
    for f in facts:
        sources.setdefault(id(f.rows), [f.rows, 0])[1] += 1
    counted = [df.select(F.col(entity), F.lit(n).alias("__times")) for df, n in sources.values()]
    return reduce(DataFrame.unionByName, counted)


def _histories(facts: Sequence[Facts], entity: str, counts: list[str], readings: list[str]) -> list[DataFrame]:
    """Timeline rows of all facts. Facts over one and the same frame are read in one pass."""
    by_source: dict[int, list[Facts]] = {}
    for f in facts:
        by_source.setdefault(id(f.rows), []).append(f)
    kind = next((f.reading.kind for f in facts if f.reading), "double")
    return [_fact_rows(group, entity, counts, readings, kind) for group in by_source.values()]


def _fact_rows(group: Sequence[Facts], entity: str, counts: list[str], readings: list[str], kind: str) -> DataFrame:
    rows = group[0].rows.where(F.col(entity).isNotNull())
    ranks = [f.rank for f in group if f.rank is not None]
    rank_type = rows.select(ranks[0].alias("rank")).schema["rank"].dataType if ranks else "bigint"
    marks = [_mark(f, counts, readings, rank_type, kind) for f in group]
    if len(marks) == 1:
        placed = rows.select(F.col(entity), marks[0].alias("__mark"))
    else:
        placed = rows.select(F.col(entity), F.explode(F.array(*marks)).alias("__mark"))
    told = placed.select(entity, "__mark.*")
    if not ranks:
        told = told.withColumn("__rank", F.lit(None))
    known = F.col("__slot").isNotNull() | (F.col("__bits") != 0)
    return told.where(F.col("__place").isNotNull() & known)


def _mark(f: Facts, counts: list[str], readings: list[str], rank_type, kind: str) -> Column:
    """What one fact puts on the timeline."""
    bits = F.lit(0).cast("bigint")
    for name, condition in f.counts.items():
        bits = bits.bitwiseOR(F.when(condition, F.lit(1 << counts.index(name)).cast("bigint")).otherwise(F.lit(0)))
    none = F.lit(None)
    slot = value = none
    if f.reading is not None:
        # A constant map, so that the code is worked out once per row.
        slots = F.create_map(*[F.lit(x) for c, n in f.reading.names.items() for x in (c, readings.index(n))])
        value = f.reading.value
        slot = F.when(value.isNotNull(), F.try_element_at(slots, f.reading.code))
    return F.struct(
        (f.at * 4 + (_STRICT_FACT if f.strict else _INCLUSIVE_FACT)).alias("__place"),
        (none if f.rank is None else f.rank).cast(rank_type).alias("__rank"),
        bits.alias("__bits"),
        slot.cast("int").alias("__slot"),
        value.cast(kind).alias("__value"),
    )


def _probe_rows(index: DataFrame, probes: Mapping[str, Probe], payload: list[str]) -> DataFrame:
    """One row per index row and probe; only the first probe carries the other columns. `__row` is a digest
    of the whole index row."""
    places = [
        F.struct(
            F.lit(i).alias("__probe"),
            (p.at * 4 + (_LATE_PROBE if p.after_ties else _PROBE)).alias("__place"),
        )
        for i, p in enumerate(probes.values())
    ]
    if len(places) == 1:
        return index.select("*", places[0].alias("__p")).select(*index.columns, "__p.*")
    first = F.col("__p.__probe") == 0
    kept = [F.when(first, F.col(c)).alias(c) if c in payload else F.col(c) for c in index.columns]
    # A hash passes over nulls, so where they are is hashed too.
    row = F.xxhash64(*index.columns, *[F.col(c).isNull() for c in index.columns])
    asked = index.select("*", row.alias("__row"), F.explode(F.array(*places)).alias("__p"))
    return asked.select(*kept, "__row", "__p.*")


def _with_heavy(
    history: DataFrame,
    asked: DataFrame,
    entity: str,
    sums: Mapping[str, Column],
    latest: Mapping[str, Column],
    heavy: Sequence[HeavyKey],
    rows: float,
) -> DataFrame:
    """Ordinary entities as above; heavy ones with equal facts merged and equal probes asked once.

    Merging leaves a bounded number of rows per instant, so that chunks along time stay small even if
    most of a heavy entity falls on one instant.
    """
    history_rest, history_heavy = split_off(history, [entity], heavy)
    asked_rest, asked_heavy = split_off(asked, [entity], heavy)
    rest = running(
        dealt(history_rest.unionByName(asked_rest, allowMissingColumns=True), [entity], rows),
        [entity],
        "__place",
        sums,
        latest,
        tie=["__rank", "__value"],
        heavy=[],
    ).where(F.col("__probe").isNotNull())

    merged = (
        history_heavy.groupBy(entity, "__place", "__bits", "__slot")
        .agg(F.count(F.lit(1)).alias("__times"), F.max(F.struct("__rank", "__value")).alias("__best"))
        .select(entity, "__place", "__bits", "__slot", "__times", "__best.__rank", "__best.__value")
    )
    instants = asked_heavy.select(entity, "__place").distinct().withColumn("__asked", F.lit(True))
    state = running(
        merged.unionByName(instants, allowMissingColumns=True),
        [entity],
        "__place",
        {n: c * F.coalesce(F.col("__times"), F.lit(0)) for n, c in sums.items()},
        latest,
        tie=["__rank", "__value"],
        heavy=heavy,
    ).where(F.col("__asked"))
    # One state row per (entity, instant): AQE may split the probe side freely.
    same = same_key(asked_heavy, state, [entity, "__place"])
    told = asked_heavy.join(state, same, "left").select(asked_heavy["*"], *[state[n] for n in [*sums, *latest]])
    return rest.select(*told.columns).unionByName(told)


def prior_counts(
    index: DataFrame, entity: str, at: Column, facts: Sequence[Facts], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add one column per count of `facts`: how many lie before `at`."""
    names = list(dict.fromkeys(n for f in facts for n in f.counts))
    return point_in_time(index, entity, {"at": Probe(at)}, facts, {n: ("at", n) for n in names}, policy=policy)


def as_of(
    index: DataFrame, entity: str, at: Column, facts: Sequence[Facts], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add one column per reading of `facts`: the last value at or before `at` (strictly before if
    the facts are strict)."""
    names = list(dict.fromkeys(n for f in facts if f.reading for n in f.reading.names.values()))
    return point_in_time(index, entity, {"at": Probe(at)}, facts, {n: ("at", n) for n in names}, policy=policy)


def within_days_probes(start: Column, stop: Column, days: int, day_cutoff: bool = False) -> dict[str, Probe]:
    """Probes at the end of a stay and at the end of its follow-up.

    By default the follow-up ends `days` after `stop`, inclusive. With `day_cutoff` it ends before
    the calendar day `days` after the day of `stop`.
    """
    if day_cutoff:
        end = Probe(micros(F.date_add(F.to_date(stop), days)))
    else:
        end = Probe(micros(stop) + days * DAY_MICROS, after_ties=True)
    return {"stop": Probe(micros(stop), after_ties=True), "end": end}


def restarted(by_stop: Column, by_end: Column, start: Column, stop: Column, days: int, day_cutoff: bool = False) -> Column:
    """1 if another stay starts after `stop` and within the follow-up, from counts of starts.

    `by_stop` and `by_end` count starts up to either probe. A stay whose own start lies after its stop
    (an entry error) would count itself, hence the correction.
    """
    limit = start < F.date_add(F.to_date(stop), days).cast("timestamp") if day_cutoff else start <= plus_days(stop, days)
    itself = F.coalesce(((start > stop) & limit).cast("int"), F.lit(0))
    return F.coalesce((by_end - by_stop > itself).cast("int"), F.lit(0))


def exists_within(
    stays: DataFrame,
    entity: str,
    key: str,
    start: str,
    stop: str,
    days: int = 30,
    name: str = "readmitted_30d",
    day_cutoff: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add 1 where another stay of the entity starts after this one stops and within `days`, else 0."""
    starts = Facts(stays, micros(F.col(start)), {"__starts": F.lit(True)})
    counted = point_in_time(
        stays,
        entity,
        within_days_probes(F.col(start), F.col(stop), days, day_cutoff),
        [starts],
        {"__by_stop": ("stop", "__starts"), "__by_end": ("end", "__starts")},
        key,
        policy,
    )
    label = restarted(F.col("__by_stop"), F.col("__by_end"), F.col(start), F.col(stop), days, day_cutoff)
    return counted.select(*stays.columns, label.alias(name))


def next_after(
    index: DataFrame,
    entity: str,
    at: Column,
    events: DataFrame,
    event_at: Column,
    name: str = "next_ts",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add the first event instant of the same entity strictly after `at` (microseconds), or null.

    The as-of timeline with time running backwards: the last event passed is the next one in time.
    """
    later = Facts(events, -event_at, reading=single_reading("__next", event_at, "bigint"))
    found = point_in_time(index, entity, {"at": Probe(-at)}, [later], {"__next": ("at", "__next")}, policy=policy)
    return found.select(*index.columns, F.timestamp_micros(F.col("__next")).alias(name))
