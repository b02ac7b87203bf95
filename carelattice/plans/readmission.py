"""The training frame for 30-day readmission: one row per closed inpatient stay."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DAY_MICROS, age_in_years, lenient_double, lenient_timestamp, micros
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from ..operators.temporal import (
    Facts,
    Probe,
    Reading,
    exists_within,
    point_in_time,
    restarted,
    within_days_probes,
)
from ..schemas import CHRONIC_CODES, COUNT_FEATURES, TARGET, VITAL_CODES

STAY_COLUMNS = ("encounter_id", "patient_id", "start_ts", "stop_ts", "base_cost", "total_claim_cost")


def inpatient_stays(encounters: DataFrame) -> DataFrame:
    """Closed inpatient encounters, with costs as doubles."""
    kept = encounters.where((F.col("encounter_class") == "inpatient") & F.col("stop_ts").isNotNull())
    return kept.select(
        "encounter_id",
        "patient_id",
        F.col("start_ts").cast("timestamp").alias("start_ts"),
        F.col("stop_ts").cast("timestamp").alias("stop_ts"),
        F.col("base_cost").cast("double").alias("base_cost"),
        F.col("total_claim_cost").cast("double").alias("total_claim_cost"),
    )


def label_readmissions(
    encounters: DataFrame, days: int = 30, day_cutoff: bool = False, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Stays with the label alone."""
    stays = inpatient_stays(encounters)
    return exists_within(
        stays, "patient_id", "encounter_id", "start_ts", "stop_ts", days, TARGET, day_cutoff, policy
    )


def encounter_facts(encounters: DataFrame) -> Facts:
    stay = (F.col("encounter_class") == "inpatient") & F.col("stop_ts").isNotNull()
    return Facts(
        encounters, micros(F.col("start_ts")), {"prior_encounter_count": F.lit(True), "prior_inpatient_count": stay}
    )


def condition_facts(conditions: DataFrame, chronic_codes: Sequence[str] = CHRONIC_CODES) -> Facts:
    """Conditions are dated by day: known from the next midnight on, hence the last microsecond."""
    return Facts(
        conditions,
        micros(F.col("start_date")) + DAY_MICROS - 1,
        {"prior_condition_count": F.lit(True), "chronic_condition_count": F.col("code").isin(*chronic_codes)},
    )


def dated_facts(rows: DataFrame, name: str) -> Facts:
    return Facts(rows, micros(F.col("start_ts")), {name: F.lit(True)})


def reading_facts(
    observations: DataFrame, codes: Mapping[str, str] = VITAL_CODES, allow_exact: bool = True
) -> Facts:
    """Numeric readings by code; `observation_id` decides between readings of one instant."""
    value = lenient_double(F.col("value").cast("string"))
    at = F.col("obs_date")
    if dict(observations.dtypes)["obs_date"] == "string":
        at = lenient_timestamp(at)
    return Facts(
        observations.where(F.col("code").isin(*codes)),
        micros(at),
        reading=Reading(F.col("code"), value, codes),
        strict=not allow_exact,
        rank=F.col("observation_id"),
    )


def attach_demographics(stays: DataFrame, patients: DataFrame) -> DataFrame:
    """Left join of demographics and age; stays of unknown patients are kept."""
    known = patients.select("patient_id", "birth_date", "gender", "race", "ethnicity")
    joined = stays.join(known, "patient_id", "left")
    return joined.withColumn("age_at_encounter", age_in_years(F.col("start_ts"), F.col("birth_date"))).drop(
        "birth_date"
    )


def training_frame(
    tables: Mapping[str, DataFrame],
    days: int = 30,
    day_cutoff: bool = False,
    allow_exact: bool = True,
    codes: Mapping[str, str] = VITAL_CODES,
    chronic_codes: Sequence[str] = CHRONIC_CODES,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Label, prior counts, last vitals and demographics for every stay, from the warehouse tables."""
    facts = [
        condition_facts(tables["fact_condition"], chronic_codes),
        dated_facts(tables["fact_procedure"], "prior_procedure_count"),
        dated_facts(tables["fact_medication"], "prior_medication_count"),
        reading_facts(tables["fact_observation"], codes, allow_exact),
    ]
    return assemble(tables["fact_encounter"], facts, tables["dim_patient"], days, day_cutoff, codes, policy)


def assemble(
    encounters: DataFrame,
    facts: Sequence[Facts],
    patients: DataFrame,
    days: int = 30,
    day_cutoff: bool = False,
    codes: Mapping[str, str] = VITAL_CODES,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The training frame from encounters and any facts that supply the other counts and readings.

    All counts, readings and the label come from one timeline per patient: one shuffle and one sort.
    """
    stays = inpatient_stays(encounters)
    facts = [encounter_facts(encounters), *facts]
    probes = {
        "start": Probe(micros(F.col("start_ts"))),
        **within_days_probes(F.col("start_ts"), F.col("stop_ts"), days, day_cutoff),
    }
    outputs = {c: ("start", c) for c in COUNT_FEATURES} | {v: ("start", v) for v in codes.values()}
    follow_up = {"__by_stop": ("stop", "prior_inpatient_count"), "__by_end": ("end", "prior_inpatient_count")}
    known = point_in_time(stays, "patient_id", probes, facts, outputs | follow_up, "encounter_id", policy)
    label = restarted(
        F.col("__by_stop"), F.col("__by_end"), F.col("start_ts"), F.col("stop_ts"), days, day_cutoff
    )
    labelled = known.select(*STAY_COLUMNS, label.alias(TARGET), *COUNT_FEATURES, *codes.values())
    return attach_demographics(labelled, patients)


def observed_until(frame: DataFrame, until: str, days: int = 30) -> DataFrame:
    """Leave out stays whose follow-up reaches beyond the end of observation (an instant as text)."""
    end = F.col("stop_ts") + F.make_dt_interval(days=F.lit(days))
    return frame.where(end <= F.to_timestamp(F.lit(until)))
