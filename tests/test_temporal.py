"""Point-in-time operators: edge rows, and brute force under hot entities and hot instants."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from carelattice.functions.dates import micros
from carelattice.operators import temporal
from carelattice.operators.skew import SkewPolicy
from carelattice.plans import readmission

POLICIES = [SkewPolicy(), SkewPolicy(floor=8, parts=5)]
DAY = timedelta(days=1)
T0 = datetime(2020, 1, 1, 10)


def stays_frame(spark, rows):
    return spark.createDataFrame(rows, "encounter_id string, patient_id string, start_ts timestamp, stop_ts timestamp")


def brute_label(rows, day_cutoff=False):
    out = {}
    for e, p, start, stop in rows:
        limit = (
            (lambda s, stop=stop: s.date() < (stop + 30 * DAY).date())
            if day_cutoff
            else (lambda s, stop=stop: s <= stop + 30 * DAY)
        )
        out[e] = int(any(q == p and f != e and s > stop and limit(s) for f, q, s, _ in rows))
    return out


def exists(spark, rows, **more):
    df = temporal.exists_within(stays_frame(spark, rows), "patient_id", "encounter_id", "start_ts", "stop_ts", **more)
    return {r["encounter_id"]: r["readmitted_30d"] for r in df.collect()}


def test_thirty_day_edges(spark):
    stop = T0 + DAY
    rows = [
        ("a1", "a", T0, stop),
        ("a2", "a", stop + 30 * DAY, stop + 30 * DAY),
        ("b1", "b", T0, stop),
        ("b2", "b", stop + 30 * DAY + timedelta(microseconds=1), stop + 31 * DAY),
        ("c1", "c", T0, stop),
        ("c2", "c", stop + 30 * DAY - timedelta(hours=2), stop + 31 * DAY),
        ("d1", "d", T0, stop),
        ("d2", "d", stop, stop + DAY),
        ("e1", "e", T0, stop + 3 * DAY),
        ("e2", "e", T0 + DAY, stop + DAY),
    ]
    got = exists(spark, rows)
    assert got == brute_label(rows)
    assert (got["a1"], got["b1"], got["c1"], got["d1"], got["e1"]) == (1, 0, 1, 0, 0)
    # By calendar day the follow-up ends before day 30 begins, whatever the hour.
    by_day = exists(spark, rows, day_cutoff=True)
    assert by_day == brute_label(rows, day_cutoff=True)
    assert (by_day["a1"], by_day["c1"]) == (0, 0)


def test_stop_before_start_does_not_count_itself(spark):
    rows = [("x1", "x", T0 + 5 * DAY, T0), ("y1", "y", T0 + 5 * DAY, T0), ("y2", "y", T0 + 5 * DAY, T0 + 6 * DAY)]
    assert exists(spark, rows) == {"x1": 0, "y1": 1, "y2": 0}


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("day_cutoff", [False, True])
def test_label_brute_force(spark, policy, day_cutoff):
    rng = random.Random(7)
    rows = []
    for i in range(250):
        patient = "hot" if rng.random() < 0.4 else f"p{rng.randint(0, 20)}"
        start = T0 + timedelta(days=rng.randint(0, 300), hours=rng.choice([0, 5, 9]))
        rows.append((f"e{i}", patient, start, start + timedelta(days=rng.randint(-2, 6))))
    assert exists(spark, rows, day_cutoff=day_cutoff, policy=policy) == brute_label(rows, day_cutoff)


@pytest.mark.parametrize("policy", POLICIES)
def test_counts_and_readings_brute_force(spark, policy):
    rng = random.Random(11)
    patient = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c"])
    # Many facts and probes of the hot patient fall on one instant.
    instant = lambda: T0 if rng.random() < 0.3 else T0 + timedelta(minutes=rng.randint(-50, 50))
    index = [(f"s{i}", patient(), instant()) for i in range(120)] + [("none", None, T0), ("when", "hot", None)]
    events = [(patient(), instant(), rng.random() < 0.5) for _ in range(200)] + [(None, T0, True), ("hot", None, True)]
    reads = [(i, patient(), instant(), rng.choice("xy"), rng.choice([None, 1.0, 2.0, 3.0])) for i in range(200)]
    probes = spark.createDataFrame(index, "id string, p string, at timestamp")
    e = spark.createDataFrame(events, "p string, ts timestamp, chronic boolean")
    r = spark.createDataFrame(reads, "rid bigint, p string, ts timestamp, code string, v double")
    facts = [
        temporal.Facts(e, micros(F.col("ts")), {"all": F.lit(True), "chronic": F.col("chronic")}),
        temporal.Facts(
            r,
            micros(F.col("ts")),
            reading=temporal.Reading(F.col("code"), F.col("v"), {"x": "x", "y": "y"}),
            strict=False,
            rank=F.col("rid"),
        ),
    ]
    outputs = {n: ("at", n) for n in ("all", "chronic", "x", "y")}
    got = temporal.point_in_time(
        probes, "p", {"at": temporal.Probe(micros(F.col("at")))}, facts, outputs, policy=policy
    ).collect()
    assert len(got) == len(index)
    for row in got:
        p, at = row["p"], row["at"]
        known = [c for q, t, c in events if at is not None and t is not None and p is not None and q == p and t < at]
        assert (row["all"], row["chronic"]) == (len(known), sum(known))
        for code in "xy":
            seen = [
                (t, i, v) for i, q, t, c, v in reads if at is not None and q == p and t <= at and c == code and v is not None
            ]
            assert row[code] == (max(seen)[2] if seen else None)


def test_as_of_exact_reading_can_be_excluded(spark):
    visits = spark.createDataFrame([("v", "p", T0)], "id string, patient_id string, start_ts timestamp")
    obs = spark.createDataFrame(
        [(1, "p", T0 - DAY, "c", "1.5"), (2, "p", T0, "c", "2.5"), (3, "p", T0, "c", "text")],
        "observation_id bigint, patient_id string, obs_date timestamp, code string, value string",
    )
    for exact, value in ((True, 2.5), (False, 1.5)):
        facts = readmission.reading_facts(obs, {"c": "reading"}, exact)
        got = temporal.as_of(visits, "patient_id", micros(F.col("start_ts")), [facts]).first()
        assert got["reading"] == value


@pytest.mark.parametrize("policy", POLICIES)
def test_next_after(spark, policy):
    rng = random.Random(2)
    events = [("hot" if rng.random() < 0.5 else "q", T0 + timedelta(hours=rng.randint(0, 40))) for _ in range(60)]
    asked = [(i, "hot" if i % 2 else "q", T0 + timedelta(hours=i)) for i in range(45)]
    e = spark.createDataFrame(events, "p string, ts timestamp")
    a = spark.createDataFrame(asked, "id int, p string, at timestamp")
    got = temporal.next_after(a, "p", micros(F.col("at")), e, micros(F.col("ts")), "next", policy).collect()
    for row in got:
        later = [t for p, t in events if p == row["p"] and t > row["at"]]
        assert row["next"] == (min(later) if later else None)


def make_tables(spark):
    enc = spark.createDataFrame(
        [
            ("e1", "p", "inpatient", T0, T0 + DAY, "10.50", "20.00"),
            ("e2", "p", "inpatient", T0 + 10 * DAY, T0 + 11 * DAY, "10.50", "20.00"),
            ("e3", "p", "inpatient", T0 + 12 * DAY, None, "1.00", "2.00"),
            ("e4", "q", "ambulatory", T0, T0 + DAY, "1.00", "2.00"),
            ("e5", "stranger", "inpatient", T0, T0 + DAY, "1.00", "2.00"),
        ],
        "encounter_id string, patient_id string, encounter_class string, start_ts timestamp, stop_ts timestamp, "
        "base_cost string, total_claim_cost string",
    )
    cond = spark.createDataFrame(
        [("p", T0.date(), "44054006"), ("p", (T0 + 10 * DAY).date(), "44054006"), ("p", (T0 - DAY).date(), "1")],
        "patient_id string, start_date date, code string",
    )
    dated = spark.createDataFrame([("p", T0), ("p", T0 + DAY)], "patient_id string, start_ts timestamp")
    obs = spark.createDataFrame(
        [(1, "p", T0, "39156-5", "30.1"), (2, "p", T0, "39156-5", "31.1"), (3, "p", T0, "4548-4", "high")],
        "observation_id bigint, patient_id string, obs_date timestamp, code string, value string",
    )
    who = spark.createDataFrame(
        [("p", datetime(1980, 1, 1).date(), "F", "x", "y")],
        "patient_id string, birth_date date, gender string, race string, ethnicity string",
    )
    names = "fact_encounter fact_condition fact_procedure fact_medication fact_observation dim_patient".split()
    return dict(zip(names, (enc, cond, dated, dated, obs, who)))


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(floor=2, parts=3)])
def test_training_frame(spark, policy):
    frame = {r["encounter_id"]: r for r in readmission.training_frame(make_tables(spark), policy=policy).collect()}
    # The open stay is not in the cohort and does not count as a readmission.
    assert set(frame) == {"e1", "e2", "e5"}
    one, two, stranger = frame["e1"], frame["e2"], frame["e5"]
    assert (one["readmitted_30d"], two["readmitted_30d"]) == (1, 0)
    # A condition of the same day is not yet known, one of the day before is.
    assert (one["prior_condition_count"], one["chronic_condition_count"]) == (1, 0)
    assert (two["prior_condition_count"], two["chronic_condition_count"]) == (2, 1)
    assert (one["prior_procedure_count"], two["prior_procedure_count"]) == (0, 2)
    assert (two["prior_encounter_count"], two["prior_inpatient_count"]) == (1, 1)
    # Tied readings: the higher id; text readings are none.
    assert (one["bmi"], one["hba1c"], one["base_cost"]) == (31.1, None, 10.5)
    assert one["age_at_encounter"] == 14610 / 365.25
    assert (stranger["gender"], stranger["age_at_encounter"], stranger["prior_encounter_count"]) == (None, None, 0)


def test_training_frame_has_one_shuffle(spark):
    tables = make_tables(spark)
    plan = readmission.training_frame(tables)._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("Exchange hashpartitioning(patient_id") <= 2  # the timeline, and the patient dimension
    assert plan.count("Window") == 1


def test_observed_until(spark):
    frame = readmission.training_frame(make_tables(spark))
    kept = readmission.observed_until(frame, "2020-02-05 00:00:00")
    assert {r["encounter_id"] for r in kept.collect()} == {"e1", "e5"}


@pytest.mark.parametrize("policy", POLICIES)
def test_rows_that_share_a_key_keep_their_own_answers(spark, policy):
    rows = [("k", "hot", T0, T0 + DAY), ("k", "hot", T0 + 60 * DAY, T0 + 61 * DAY), ("k", "hot", T0 + 80 * DAY, None)]
    rows += [("k", "hot", T0, T0 + DAY)] + [("n", None, T0, T0 + DAY)] * 2 + [(f"e{i}", "hot", T0, T0) for i in range(30)]
    df = stays_frame(spark, rows)
    got = temporal.exists_within(df, "patient_id", "encounter_id", "start_ts", "stop_ts", policy=policy).collect()
    assert len(got) == len(rows)
    shared = sorted((r["start_ts"], r["readmitted_30d"]) for r in got if r["encounter_id"] == "k")
    assert shared == [(T0, 0), (T0, 0), (T0 + 60 * DAY, 1), (T0 + 80 * DAY, 0)]


def test_next_after_is_exact_far_in_the_future(spark):
    far = datetime(9999, 12, 31, 23, 59, 59, 1)
    events = spark.createDataFrame([("a", far)], "p string, ts timestamp")
    index = spark.createDataFrame([("a", T0)], "p string, at timestamp")
    got = temporal.next_after(index, "p", micros(F.col("at")), events, micros(F.col("ts"))).select(
        micros(F.col("next_ts")).alias("next")
    )
    assert got.first()["next"] == events.select(micros(F.col("ts")).alias("next")).first()["next"]


def test_large_timelines_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    from carelattice.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = spark.range(500).selectExpr("id % 50 patient_id", "id * 1000 at", "id")
    known = temporal.Facts(index, F.col("at"), {"n": F.lit(True)})
    found = temporal.prior_counts(index, "patient_id", F.col("at"), [known])
    assert found.rdd.getNumPartitions() > parts
    assert {r["id"]: r["n"] for r in found.collect()} == {i: i // 50 for i in range(500)}
    few = skew.dealt(index, ["patient_id"], 10 * parts)
    assert few is index
