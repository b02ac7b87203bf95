"""The registered queries: name -> function of (session, folder of the supplied tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions import text
from carelattice.functions.dates import DAY_MICROS, micros
from carelattice.operators import linkage, metrics, perturb, quality, sampling, temporal
from carelattice.operators.running import dense_ids, describe_all, medians
from carelattice.plans import boosting, linking, load, modelling, readmission, scoring
from carelattice.session import cut_lineage, kept, shared_scratch
from carelattice.sources.prediction_log import PredictionLog
from carelattice.sources.text_tables import PERSON_EXPORT, read_exports, read_people, read_second_list, read_truth, write_csv
from carelattice.sources.warehouse import Warehouse
from carelattice.schemas import CATEGORICAL_FEATURES, CHRONIC_CODES, NUMERIC_FEATURES, PRIMARY_KEYS, RISK_REQUEST, VITAL_CODES
from carelattice.streaming import scoring as streaming

from .views import Tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of `Tables` under its own name."""
    REGISTRY[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


# -- point in time -----------------------------------------------------------------------------


def _labelled(t: Tables, day_cutoff: bool) -> DataFrame:
    return readmission.label_readmissions(t.encounter(), day_cutoff=day_cutoff).select(
        "encounter_id", "patient_id", F.to_date("start_ts").alias("start_day"), "readmitted_30d"
    )


@query
def readmitted_within_30d(t: Tables) -> DataFrame:
    return _labelled(t, False)


@query
def readmitted_day_cutoff(t: Tables) -> DataFrame:
    return _labelled(t, True)


def line_facts(t: Tables) -> list[temporal.Facts]:
    """Procedures, medications, conditions and lab readings, all read off one pass over the lines."""
    lines = t.lines()
    finished, open_ = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    dated = temporal.Facts(
        lines, micros(F.col("at")), {"prior_procedure_count": F.lit(True), "prior_medication_count": finished}
    )
    # Conditions are dated by day: known from the next midnight on.
    diagnosed = temporal.Facts(
        lines,
        micros(F.to_date("at")) + DAY_MICROS - 1,
        {
            "prior_condition_count": open_,
            "chronic_condition_count": open_ & t.line_condition().isin(*CHRONIC_CODES),
        },
    )
    number = F.when(F.col("l_discount") != 0, F.col("l_quantity"))
    measured = temporal.Facts(
        lines,
        micros(F.col("at")),
        reading=temporal.Reading(t.line_lab(), number, VITAL_CODES),
        strict=False,
        rank=t.line_reading_id(),
    )
    return [dated, diagnosed, measured]


@query
def prior_counts(t: Tables) -> DataFrame:
    stays = readmission.inpatient_stays(t.encounter())
    facts = [readmission.encounter_facts(t.encounter()), *line_facts(t)[:2]]
    counted = temporal.prior_counts(stays, "patient_id", micros(F.col("start_ts")), facts)
    return counted.select("encounter_id", *readmission.COUNT_FEATURES)


@query
def prior_counts_by_table(t: Tables) -> DataFrame:
    """The same counts from separate fact tables, as a warehouse holds them."""
    stays = readmission.inpatient_stays(t.encounter())
    facts = [
        readmission.encounter_facts(t.encounter()),
        readmission.condition_facts(t.condition()),
        readmission.dated_facts(t.procedure(), "prior_procedure_count"),
        readmission.dated_facts(t.medication(), "prior_medication_count"),
    ]
    counted = temporal.prior_counts(stays, "patient_id", micros(F.col("start_ts")), facts)
    return counted.select("encounter_id", *readmission.COUNT_FEATURES)


EVENT_KINDS = ("view", "click", "error", "signup", "purchase")


def _as_of(t: Tables, allow_exact: bool) -> DataFrame:
    kinds = {k: f"last_{k}" for k in EVENT_KINDS}
    readings = readmission.reading_facts(t.event(), kinds, allow_exact)
    found = temporal.as_of(t.visit(), "patient_id", micros(F.col("start_ts")), [readings])
    return found.select("visit_id", *kinds.values())


@query
def as_of_readings(t: Tables) -> DataFrame:
    return _as_of(t, True)


@query
def as_of_strictly_before(t: Tables) -> DataFrame:
    return _as_of(t, False)


@query
def as_of_join(t: Tables) -> DataFrame:
    """One code with the instant of the reading, against the ASOF join of the check engine."""
    events = t.event().where("code = 'view'").where(F.col("value").try_cast("double").isNotNull())
    at = micros(F.col("obs_date"))
    value = temporal.Facts(events, at, reading=temporal.single_reading("last_view", F.col("value").try_cast("double")), strict=False)
    seen = temporal.Facts(events, at, reading=temporal.single_reading("seen_us", at), strict=False)
    found = temporal.as_of(t.visit(), "patient_id", micros(F.col("start_ts")), [value, seen])
    seen_at = F.timestamp_micros(F.col("seen_us").cast("bigint")).cast("string")
    return found.select("visit_id", "last_view", seen_at.alias("seen_at"))


@query
def next_start_after_stop(t: Tables) -> DataFrame:
    stays = readmission.inpatient_stays(t.encounter())
    found = temporal.next_after(
        stays, "patient_id", micros(F.col("stop_ts")), t.encounter(), micros(F.col("start_ts")), "next_ts"
    )
    return found.select("encounter_id", F.to_date("next_ts").alias("next_day"))


@query
def demographics(t: Tables) -> DataFrame:
    joined = readmission.attach_demographics(readmission.inpatient_stays(t.encounter()), t.patient())
    return joined.select(
        "encounter_id", "gender", "race", "ethnicity", F.round("age_at_encounter", 6).alias("age_at_encounter")
    )


def frame(t: Tables) -> DataFrame:
    """The training frame over the stand-in views."""
    return readmission.assemble(t.encounter(), line_facts(t), t.patient())


def frame_by_table(t: Tables) -> DataFrame:
    """The same from separate fact tables."""
    return readmission.training_frame(
        {
            "fact_encounter": t.encounter(),
            "fact_condition": t.condition(),
            "fact_procedure": t.procedure(),
            "fact_medication": t.medication(),
            "fact_observation": t.lab(),
            "dim_patient": t.patient(),
        }
    )


@query
def training_frame(t: Tables) -> DataFrame:
    return _frame_columns(frame(t))


@query
def training_frame_by_table(t: Tables) -> DataFrame:
    return _frame_columns(frame_by_table(t))


def _frame_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "encounter_id",
        "patient_id",
        F.to_date("start_ts").alias("start_day"),
        F.to_date("stop_ts").alias("stop_day"),
        "base_cost",
        "total_claim_cost",
        "readmitted_30d",
        *readmission.COUNT_FEATURES,
        *readmission.VITAL_CODES.values(),
        "gender",
        "race",
        "ethnicity",
        F.round("age_at_encounter", 6).alias("age_at_encounter"),
    )


# -- linkage -----------------------------------------------------------------------------------


def second_list(t: Tables) -> tuple[DataFrame, DataFrame]:
    return perturb.second_list(t.person_a())


@query
def perturbed_people(t: Tables) -> DataFrame:
    return second_list(t)[0]


@query
def perturbed_truth(t: Tables) -> DataFrame:
    return second_list(t)[1]


@query
def deterministic_match(t: Tables) -> DataFrame:
    return linkage.match_by_rules(t.person_a(), second_list(t)[0])


@query
def deterministic_match_normalized(t: Tables) -> DataFrame:
    return linkage.match_by_rules(t.person_a(), second_list(t)[0], normalize_names=True)


@query
def deterministic_eval(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return metrics.linkage_metrics(linkage.match_by_rules(t.person_a(), b), truth, b)


@query
def block_stats(t: Tables) -> DataFrame:
    return linkage.block_stats(t.person_a(), second_list(t)[0])


@query
def blocking_coverage(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return linkage.blocking_coverage(t.person_a(), b, truth)


@query
def candidate_pairs(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    features = {
        name: replace(f, digits=6) if isinstance(f, linkage.NameSimilarity) else f for name, f in linkage.DEFAULT_FEATURES.items()
    }
    return linkage.candidate_pairs(t.person_a(), b, truth, features)


# A fixed scorer, so that the pick can be checked; fitted ones are in the model queries.
PAIR_WEIGHTS = {
    "first_sim": 6.0,
    "last_sim": 7.0,
    "zip_sim": 2.0,
    "dob_year_match": 0.5,
    "ssn_agree": 5.0,
    "ssn_both_present": -1.0,
}
PAIR_INTERCEPT = -12.0


def _best(t: Tables, b: DataFrame) -> DataFrame:
    # Rounded before ranking: the last digit of a sum is not the same in every engine.
    return linkage.best_matches(t.person_a(), b, linkage.LinearScore(PAIR_WEIGHTS, PAIR_INTERCEPT, digits=9))


@query
def best_match(t: Tables) -> DataFrame:
    return _best(t, second_list(t)[0]).withColumn("score", F.round("score", 6))


@query
def best_match_eval(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return metrics.end_to_end(cut_lineage(_best(t, b)), truth, b)


@query
def part_name_similarity(t: Tables) -> DataFrame:
    """Jaro-Winkler over two columns of a whole table."""
    similarity = text.jaro_winkler(F.lower("p_name"), F.lower("p_type"))
    return t.raw("part").select("p_partkey", F.round(similarity, 6).alias("similarity"))


# -- evaluation --------------------------------------------------------------------------------


@query
def binary_metrics(t: Tables) -> DataFrame:
    return metrics.binary_metrics(t.predictions(), "label", "score")


@query
def binary_metrics_by_language(t: Tables) -> DataFrame:
    return metrics.binary_metrics(t.predictions(), "label", "score", ["lang"])


@query
def precision_recall_steps(t: Tables) -> DataFrame:
    steps = metrics.precision_recall_steps(t.predictions(), "label", "score")
    return steps.withColumn("precision", F.round("precision", 6))


@query
def average_precision(t: Tables) -> DataFrame:
    return metrics.average_precision(t.predictions(), "label", "score").select(
        F.round("average_precision", 6).alias("average_precision")
    )


@query
def average_ranks(t: Tables) -> DataFrame:
    return metrics.average_ranks(t.predictions(), "label", "score")


@query
def roc_auc(t: Tables) -> DataFrame:
    return metrics.roc_auc(t.predictions(), "label", "score").select(F.round("roc_auc", 6).alias("roc_auc"))


@query
def mann_whitney_u(t: Tables) -> DataFrame:
    return metrics.mann_whitney(t.predictions(), "label", "score").select(
        "n1", "n0", "u", F.round("z", 6).alias("z"), F.round("p_value", 6).alias("p_value")
    )


@query
def rank_test_by_group(t: Tables) -> DataFrame:
    """The rank test in many groups, small ones (exact) and larger ones: do customers of one segment have more?"""
    customers = t.raw("customer").select(
        "c_nationkey",
        (F.col("c_custkey") % 40).alias("part"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label"),
        F.col("c_acctbal").alias("score"),
    )
    tested = metrics.mann_whitney(customers, "label", "score", ["c_nationkey", "part"])
    return tested.select("c_nationkey", "part", "n1", "n0", "u", F.round("z", 6).alias("z"), F.round("p_value", 6).alias("p_value"))


@query
def model_comparison_by_language(t: Tables) -> DataFrame:
    """The comparison table, with languages standing in for models."""
    return metrics.model_comparison(t.predictions(), "label", "score", "lang", digits=6)


@query
def class_weights(t: Tables) -> DataFrame:
    return metrics.class_weights(t.predictions(), "label").withColumn("weight", F.round("weight", 6))


@query
def label_rate(t: Tables) -> DataFrame:
    return metrics.label_rate(t.predictions(), "label", ["lang"]).withColumn(
        "positive_rate", F.round("positive_rate", 6)
    )


@query
def group_split(t: Tables) -> DataFrame:
    return sampling.split_groups(t.encounter(), "patient_id", 0.25, 42).select("encounter_id", "patient_id", "is_test")


@query
def group_split_exact(t: Tables) -> DataFrame:
    split = sampling.split_groups(t.encounter(), "patient_id", 0.25, 42, exact=True)
    return split.select("encounter_id", "patient_id", "is_test")


@query
def median_by_label(t: Tables) -> DataFrame:
    return medians(t.predictions(), ["n_chars", "score"], ["label"])


@query
def readmission_hypothesis(t: Tables) -> DataFrame:
    """Do readmitted patients have more prior stays? Rank test and medians on the labelled stays."""
    counted = temporal.prior_counts(
        readmission.label_readmissions(t.encounter()),
        "patient_id",
        micros(F.col("start_ts")),
        [readmission.encounter_facts(t.encounter())],
    )
    test = modelling.hypothesis_test(counted, "readmitted_30d", "prior_inpatient_count")
    return test.withColumns({c: F.round(c, 6) for c in ("roc_auc", "z", "p_value")})


@query
def describe_orders(t: Tables) -> DataFrame:
    """Summary of all columns of a table."""
    described = describe_all(t.raw("orders"))
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


# -- warehouse ---------------------------------------------------------------------------------


@query
def dim_code(t: Tables) -> DataFrame:
    return load.code_dimension(t.exports())


@query
def dim_code_with_aliases(t: Tables) -> DataFrame:
    return load.code_dimension(t.exports(), aliases={"SNOMED": "SNOMED-CT"})


@query
def dim_patient(t: Tables) -> DataFrame:
    typed = load.typed_table(t.exports(), "dim_patient")
    return typed.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})


@query
def dim_organization(t: Tables) -> DataFrame:
    return load.typed_table(t.exports(), "dim_organization")


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query
def fact_encounter(t: Tables) -> DataFrame:
    typed = load.typed_table(t.exports(), "fact_encounter")
    costs = {c: F.col(c).cast("double") for c in ("base_cost", "total_claim_cost", "payer_coverage")}
    return _as_text(typed, "start_ts", "stop_ts").withColumns(costs)


@query
def fact_condition(t: Tables) -> DataFrame:
    return load.typed_table(t.exports(), "fact_condition")


@query
def fact_procedure(t: Tables) -> DataFrame:
    typed = load.typed_table(t.exports(), "fact_procedure")
    return _as_text(typed, "start_ts", "stop_ts").withColumn("base_cost", F.col("base_cost").cast("double"))


@query
def fact_medication(t: Tables) -> DataFrame:
    typed = load.typed_table(t.exports(), "fact_medication")
    costs = {c: F.col(c).cast("double") for c in ("base_cost", "total_cost")}
    return _as_text(typed, "start_ts", "stop_ts").withColumns(costs)


@query
def fact_observation(t: Tables) -> DataFrame:
    return _as_text(load.typed_table(t.exports(), "fact_observation"), "obs_date")


@query
def loaded_encounters(t: Tables) -> DataFrame:
    """The encounters by way of files: exported as text, read back, typed, written to a warehouse in two steps, read."""
    folder = shared_scratch(t.spark, "exports")
    write_csv(t.exports()["encounters"], f"{folder}/encounters.csv")
    raw = read_exports(t.spark, folder, {"encounters": load.export_columns()["encounters"]}, single_line=["encounters"])
    typed = load.typed_table(raw, "fact_encounter")
    warehouse = Warehouse(t.spark, shared_scratch(t.spark, "warehouse"))
    first = F.crc32(F.col("encounter_id").cast("binary")) % 2 == 0
    warehouse.write("fact_encounter", typed.where(first))
    warehouse.append("fact_encounter", typed.where(~first))
    costs = {c: F.col(c).cast("double") for c in ("base_cost", "total_claim_cost", "payer_coverage")}
    return _as_text(warehouse.read("fact_encounter"), "start_ts", "stop_ts").withColumns(costs)


@query
def loaded_counts(t: Tables) -> DataFrame:
    """Rows of the eight tables of a warehouse that was loaded from text exports."""
    folder = shared_scratch(t.spark, "exports")
    exports = t.exports(kept)
    for name, df in exports.items():
        write_csv(df, f"{folder}/{name}.csv", compression="gzip", rows=1_000_000)
    warehouse = Warehouse(t.spark, shared_scratch(t.spark, "warehouse"))
    return load.load_warehouse(t.spark, folder, warehouse, single_line=list(exports))


@query
def deterministic_eval_from_files(t: Tables) -> DataFrame:
    """The fixed rules on person lists and truth that went through text files."""
    folder = shared_scratch(t.spark, "people")
    b, truth = second_list(t)
    named = {name: raw for raw, name in PERSON_EXPORT.items()}
    a = t.person_a()
    write_csv(a.select(*[F.col(c).alias(named[c]) for c in a.columns]), f"{folder}/patients.csv")
    write_csv(b, f"{folder}/second.csv")
    write_csv(truth, f"{folder}/truth.csv")
    b = read_second_list(t.spark, f"{folder}/second.csv")
    matches = linkage.match_by_rules(read_people(t.spark, f"{folder}/patients.csv"), b)
    return metrics.linkage_metrics(matches, read_truth(t.spark, f"{folder}/truth.csv"), b)


@query
def parse_report(t: Tables) -> DataFrame:
    return load.parse_report(t.exports())


@query
def surrogate_keys(t: Tables) -> DataFrame:
    """Dense ids over rows that repeat: conditions by patient, day and code."""
    return dense_ids(t.condition(), "condition_id")


@query
def surrogate_keys_events(t: Tables) -> DataFrame:
    """Dense ids over rows that differ by microseconds."""
    apart = F.make_dt_interval(secs=(F.col("event_id") % 1000).cast("decimal(18,6)") / 1000000)
    at = (F.col("ts").cast("timestamp") + apart).alias("seen")
    ids = dense_ids(t.raw("events").select("user_id", "event_type", at), "row_id")
    return ids.withColumn("seen", F.unix_micros("seen"))


@query
def orphan_check(t: Tables) -> DataFrame:
    """All declared references between the typed tables; organizations do not cover all encounters."""
    raw = t.exports()
    typed = {name: load.typed_table(raw, name) for name in PRIMARY_KEYS if name != "dim_code"}
    return quality.orphan_report(typed | {"dim_code": load.code_dimension(raw)})


# Keys of the supplied tables.
KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


@query
def key_check(t: Tables) -> DataFrame:
    """Keys of all supplied tables (line numbers repeat within an order), and two views that lack required values."""
    tables = {name: t.raw(name) for name in KEYS} | {"person_a": t.person_a(), "encounter": t.encounter()}
    keys = KEYS | {"person_a": ["patient_id"], "encounter": ["encounter_id"]}
    required = {
        "documents": ["doc_id", "text", "lang", "source"],
        "conversations": ["conv_id", "turn", "role", "text"],
        "person_a": ["first", "ssn", "zip"],
        "encounter": ["start_ts", "stop_ts"],
    }
    return quality.key_report(tables, keys, required)


@query
def table_counts(t: Tables) -> DataFrame:
    return quality.table_counts({name: t.raw(name) for name in KEYS})


# -- models and scoring ------------------------------------------------------------------------

NUMBERS, TEXTS = NUMERIC_FEATURES, CATEGORICAL_FEATURES


@query
def impute_values(t: Tables) -> DataFrame:
    """Exact medians and most frequent texts filled in, on the training frame."""
    stays = cut_lineage(frame(t).select("encounter_id", *NUMBERS, *TEXTS))
    filled = modelling.filled_columns(modelling.fit_fills(stays, NUMBERS, TEXTS))
    out = stays.select("encounter_id", *[c.alias(n) for n, c in filled.items()])
    return out.withColumn("age_at_encounter", F.round("age_at_encounter", 6))


@query
def scale_values(t: Tables) -> DataFrame:
    stays = cut_lineage(frame(t).select("encounter_id", *NUMBERS, *TEXTS))
    scaled = modelling.scaled_columns(modelling.fit_fills(stays, NUMBERS, TEXTS))
    return stays.select("encounter_id", *[F.round(c, 6).alias(n) for n, c in scaled.items()])


@query
def one_hot_values(t: Tables) -> DataFrame:
    """One row per stay and set slot of the encoded categories."""
    stays = cut_lineage(frame(t).select("encounter_id", *NUMBERS, *TEXTS))
    fills = modelling.fit_fills(stays, NUMBERS, TEXTS)
    design = dict(modelling.design_sql(fills))
    slots = [
        F.struct(F.lit(c).alias("feature"), F.lit(i).cast("long").alias("slot"), F.expr(design[f"{c}={v}"]).alias("value"))
        for c in TEXTS
        for i, v in enumerate(fills.categories[c])
    ]
    told = stays.select("encounter_id", F.explode(F.array(*slots)).alias("s")).where("s.value = 1")
    return told.select("encounter_id", "s.feature", "s.slot")


@query
def prepared_vector(t: Tables) -> DataFrame:
    """The whole input vector of the risk models for every training stay, as fitted on these."""
    stays = cut_lineage(modelling.split_by_patient(frame(t))[0].select("encounter_id", *NUMBERS, *TEXTS))
    prepared = modelling.preparation(modelling.fit_fills(stays, NUMBERS, TEXTS)).fit(stays).transform(stays)
    told = prepared.select("encounter_id", F.posexplode(vector_to_array(modelling.FEATURES)).alias("position", "value"))
    return told.withColumn("value", F.round("value", 6) + 0.0)


@query
def weighted_pairs(t: Tables) -> DataFrame:
    """The candidate pairs as a frequency table, by held-out split."""
    b, truth = second_list(t)
    b = sampling.split_groups(b, "system_b_id", 0.3, 42)
    table = linkage.weighted_pairs(t.person_a(), b, truth, "is_test")
    similar = [F.round(c, 6).alias(c) for c in ("first_sim", "last_sim", "zip_sim")]
    names = ("dob_year_match", "ssn_agree", "ssn_both_present", "is_match", "is_test")
    return table.groupBy(*similar, *names).agg(F.sum("n").alias("n"))


@query
def pair_model_metrics(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return modelling.train_lists(t.person_a(), b, truth).metrics


@query
def pair_model_weights(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return modelling.train_lists(t.person_a(), b, truth).weights


@query
def fitted_best_match(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return linking.link_by_model(t.person_a(), b, truth).matches.withColumn("score", F.round("score", 6))


@query
def fitted_best_match_eval(t: Tables) -> DataFrame:
    b, truth = second_list(t)
    return linking.link_by_model(t.person_a(), b, truth).overall


@query
def model_comparison(t: Tables) -> DataFrame:
    train, test = modelling.split_by_patient(cut_lineage(frame(t)))
    return modelling.compare_models(modelling.fit_risk_models(train), test)


@query
def boosted_splits(t: Tables) -> DataFrame:
    """The splits of the first boosted tree with eight leaves, in the order they are made."""
    train = modelling.split_by_patient(frame(t))[0].where(F.col("readmitted_30d").isNotNull())
    used = cut_lineage(train.select("readmitted_30d", *NUMBERS, *TEXTS))
    design = modelling.design_sql(modelling.fit_fills(used, NUMBERS, TEXTS))
    weight, _ = modelling.balanced_weight(used, "readmitted_30d")
    inputs = [(n, F.expr(sql)) for n, sql in design]
    fitted = boosting.fit_boosted(used, inputs, F.col("readmitted_30d"), weight, iterations=1, leaves=8, bins=32)
    rows = [
        (k, path, fitted.names[s.feature], round(s.threshold, 6), round(s.gain, 4), s.left, s.right)
        for k, (path, s) in enumerate(fitted.trees[0].splits.items() if fitted.trees else ())
    ]
    return t.spark.createDataFrame(
        rows, "step int, path string, feature string, threshold double, gain double, n_left long, n_right long"
    )


@query
def risk_scores(t: Tables) -> DataFrame:
    """Readmission score of every stay under the logistic regression."""
    stays = cut_lineage(frame(t))
    learners = {"logistic_regression": modelling.risk_learners()["logistic_regression"]}
    fitted = modelling.fit_risk_models(modelling.split_by_patient(stays)[0], learners)["logistic_regression"]
    return scoring.shown(scoring.score_risk(stays, fitted)).select("encounter_id", "score")


@query
def saved_model_scores(t: Tables) -> DataFrame:
    """The same scores by a model that was saved and loaded, of requests that arrive as JSON."""
    folder = shared_scratch(t.spark, "served")
    stays = cut_lineage(frame(t))
    learners = {"logistic_regression": modelling.risk_learners()["logistic_regression"]}
    modelling.save_models(modelling.fit_risk_models(modelling.split_by_patient(stays)[0], learners), f"{folder}/models")
    stays.select("encounter_id", *NUMBERS, *TEXTS).write.json(f"{folder}/requests")
    requests = scoring.read_requests(t.spark, f"{folder}/requests", f"encounter_id long, {RISK_REQUEST}")
    fitted = modelling.load_model(f"{folder}/models/logistic_regression")
    return scoring.shown(scoring.score_risk(requests, fitted)).select("encounter_id", "score")


def _requests(t: Tables) -> DataFrame:
    """True pairs as scoring requests."""
    b, truth = second_list(t)
    person = lambda: F.struct("first", "last", "dob", "zip", "ssn")
    left = t.person_a().select(F.col("patient_id").alias("true_patient_id"), person().alias("record_a"))
    right = b.select("system_b_id", person().alias("record_b"))
    return truth.join(left, "true_patient_id").join(right, "system_b_id")


@query
def match_scores(t: Tables) -> DataFrame:
    scored = scoring.score_pairs(_requests(t), linkage.logistic(PAIR_WEIGHTS, PAIR_INTERCEPT))
    return scored.select("system_b_id", F.round("score", 6).alias("score"), "is_match")


@query
def match_log(t: Tables) -> DataFrame:
    scored = scoring.score_pairs(_requests(t), linkage.logistic(PAIR_WEIGHTS, PAIR_INTERCEPT))
    log = scoring.as_log(scored, "match", scoring.pair_summary())
    return log.select("kind", "input_summary", F.round("score", 6).alias("score"))


@query
def streamed_match_log(t: Tables) -> DataFrame:
    """The log of requests that arrive as files and are scored as a stream."""
    folder = shared_scratch(t.spark, "stream")
    _requests(t).select("record_a", "record_b").write.json(f"{folder}/requests")
    score = linkage.logistic(PAIR_WEIGHTS, PAIR_INTERCEPT)
    stream = streaming.stream_pair_scores(t.spark, f"{folder}/requests", score, f"{folder}/log", f"{folder}/progress", once=True)
    stream.awaitTermination()
    log = PredictionLog(t.spark, f"{folder}/log")
    return log.rows().select("kind", "input_summary", F.round("score", 6).alias("score"))


@query
def risk_log(t: Tables) -> DataFrame:
    """Log rows of all stays, with the share of prior stays as a score."""
    stays = frame(t).withColumn("age_at_encounter", F.floor("age_at_encounter"))
    scored = stays.withColumn("score", F.col("prior_inpatient_count") / (F.col("prior_encounter_count") + 1))
    log = scoring.as_log(scored, "risk", scoring.risk_summary())
    return log.select("kind", "input_summary", F.round("score", 6).alias("score"))


@query
def prediction_summary(t: Tables) -> DataFrame:
    summary = scoring.log_summary(t.log())
    return summary.withColumns({c: F.round(c, 6) for c in ("avg_score", "min_score", "max_score")})


@query
def recent_predictions(t: Tables) -> DataFrame:
    recent = scoring.recent_predictions(t.log())
    return recent.select(
        "id", "kind", "input_summary", F.round("score", 6).alias("score"), F.col("created_at").cast("string")
    )


def _logged(t: Tables) -> PredictionLog:
    """The events as predictions in a new log: those of every third id first, then the others, then the first batch again."""
    log = PredictionLog(t.spark, shared_scratch(t.spark, "predictions"))
    events = t.log()
    early, late = events.where("id % 3 = 0"), events.where("id % 3 <> 0")
    for name, rows in (("early", early), ("late", late), ("early", early)):
        log.append(rows, name, order=["created_at", "id"])
    return log


@query
def logged_predictions(t: Tables) -> DataFrame:
    return _logged(t).rows().select(
        "id", "kind", "input_summary", F.round("score", 6).alias("score"), F.col("created_at").cast("string")
    )


@query
def logged_summary(t: Tables) -> DataFrame:
    return _logged(t).summary().withColumns({c: F.round(c, 6) for c in ("avg_score", "min_score", "max_score")})


@query
def logged_recent(t: Tables) -> DataFrame:
    return _logged(t).recent().select(
        "id", "kind", "input_summary", F.round("score", 6).alias("score"), F.col("created_at").cast("string")
    )


@query
def match_rejects(t: Tables) -> DataFrame:
    """The requests that cannot be scored, and why."""
    return scoring.rejected_pairs(_requests(t)).select("system_b_id", "reason")


def _in_town(b: DataFrame, truth: DataFrame, towns: DataFrame) -> DataFrame:
    """List B with the town of the true record, or another town for a tenth of the records."""
    named = b.join(truth, "system_b_id").join(towns.withColumnRenamed("patient_id", "true_patient_id"), "true_patient_id")
    moved = F.pmod(F.col("true_patient_id").cast("long"), F.lit(10)) == 0
    return named.withColumn("town", F.when(moved, F.upper("town")).otherwise(F.col("town"))).drop("true_patient_id")


@query
def best_match_by_town(t: Tables) -> DataFrame:
    """Blocks and features over columns that the lists have besides the usual ones, one named like a column."""
    towns = t.raw("customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"),
        F.concat(F.substring("c_mktsegment", 1, 4), (F.col("c_custkey") % 5).cast("string")).alias("town"),
    )
    b, truth = second_list(t)
    features = {
        "first_sim": linkage.name_similarity("first"),
        "last_sim": linkage.name_similarity("last"),
        "town_sim": linkage.name_similarity("town", lower=False),
    }
    score = linkage.LinearScore({"first_sim": 6.0, "last_sim": 7.0, "town_sim": 2.0}, -12.0, digits=9)
    matches = linkage.best_matches(
        t.person_a().join(towns, "patient_id"),
        _in_town(b, truth, towns),
        score,
        features,
        {"zip": lambda r: text.zip3(r("zip")), "town": lambda r: F.lower(r("town"))},
    )
    return matches.withColumn("score", F.round("score", 6))
