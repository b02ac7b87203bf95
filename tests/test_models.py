"""Preparation, classifiers, scoring and the stream form."""

from __future__ import annotations

import json
import math
import random
import re
import threading
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelattice.operators import linkage, perturb
from carelattice.plans import linking, modelling, network, scoring
from carelattice.plans.logit import fit_logit
from carelattice.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from carelattice.sources.prediction_log import PredictionLog
from carelattice.streaming import scoring as streaming


@pytest.fixture(scope="module")
def stays(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        x = [rng.gauss(0, 1) if rng.random() < 0.9 else None for _ in NUMERIC_FEATURES]
        risk = 1 / (1 + math.exp(-(2 * (x[1] or 0) - 1)))
        cats = [rng.choice(["u", "v", None]) for _ in CATEGORICAL_FEATURES]
        rows.append((f"e{i}", f"p{i % 290}", *x, *cats, int(rng.random() < risk)))
    ddl = ", ".join(
        ["encounter_id string", "patient_id string"]
        + [f"{c} double" for c in NUMERIC_FEATURES]
        + [f"{c} string" for c in CATEGORICAL_FEATURES]
        + ["readmitted_30d int"]
    )
    return spark.createDataFrame(rows, ddl).persist()


@pytest.fixture(scope="module")
def fitted(stays):
    train, test = modelling.split_by_patient(stays)
    return modelling.fit_risk_models(train, modelling.risk_learners(trees=10, depth=4, iterations=10)), test


def test_all_models_beat_chance(fitted):
    models, test = fitted
    table = {r["model"]: r for r in modelling.compare_models(models, test).collect()}
    assert set(table) == {"logistic_regression", "random_forest", "gradient_boosted_trees", "neural_network_mlp"}
    assert all(r["roc_auc"] > 0.6 for r in table.values()), table


def test_save_load_and_missing_fields(spark, fitted, tmp_path):
    models, test = fitted
    modelling.save_models({"logistic_regression": models["logistic_regression"]}, str(tmp_path))
    loaded = modelling.load_model(f"{tmp_path}/logistic_regression")
    key = lambda rows: sorted((r["encounter_id"], r["score"]) for r in rows)
    one = scoring.score_risk(test, models["logistic_regression"]).collect()
    assert key(one) == key(scoring.score_risk(test, loaded).collect())
    # A request without any field, and one with a category never seen.
    lines = ["{}", json.dumps({"gender": "never", "bmi": 1.5})]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text("\n".join(lines))
    requests = scoring.read_risk_requests(spark, str(tmp_path / "r"))
    assert all(0 < r["score"] < 1 for r in scoring.score_risk(requests, loaded).collect())


def labelled(rng, n=150):
    return [(float(rng.random() < 0.4), rng.gauss(0, 1), rng.gauss(1, 2)) for _ in range(n)]


def gradient(rows, weights, fitted, c=1.0):
    """Of sum(w * log-loss) + |b|^2 / 2c at the fitted coefficients, intercept first."""
    out = [0.0, *[b / c for b in fitted.weights]]
    for (y, *x), w in zip(rows, weights):
        p = 1 / (1 + math.exp(-(fitted.intercept + sum(b * v for b, v in zip(fitted.weights, x)))))
        for k, v in enumerate([1.0, *x]):
            out[k] += w * (p - y) * v
    return out


def fit(df, c=1.0, weight=None):
    return fit_logit(df, [("a", F.col("a")), ("b", F.col("b"))], F.col("y"), F.lit(1.0) if weight is None else weight, c)


def test_logistic_regression_minimises_the_summed_loss(spark):
    rows = labelled(random.Random(3))
    df = spark.createDataFrame(rows, "y double, a double, b double")
    weight, _ = modelling.balanced_weight(df, "y")
    n1 = sum(y for y, _, _ in rows)
    weights = [len(rows) / (2 * (n1 if y else len(rows) - n1)) for y, *_ in rows]
    for c in (1.0, 0.01, 1000.0):
        fitted = fit(df, c, weight)
        assert gradient(rows, weights, fitted, c) == pytest.approx([0, 0, 0], abs=1e-8)
        assert all(b <= a for a, b in zip(fitted.losses, fitted.losses[1:]))


def test_logistic_regression_does_not_depend_on_tasks_or_empty_rows(spark):
    rows = labelled(random.Random(4), 80)
    one = fit(spark.createDataFrame(rows, "y double, a double, b double").coalesce(1))
    more = [*rows, (None, 9.0, 9.0), (1.0, None, 2.0), (0.0, 3.0, None)]
    eight = fit(spark.createDataFrame(more, "y double, a double, b double").repartition(8))
    assert eight.weights == pytest.approx(one.weights, abs=1e-9)
    assert eight.intercept == pytest.approx(one.intercept, abs=1e-9)
    # Rows that stand for several give the same fit as the rows themselves.
    folded = spark.createDataFrame([(*r, 2.0) for r in rows], "y double, a double, b double, n double")
    doubled = fit(spark.createDataFrame(rows * 2, "y double, a double, b double"))
    assert fit(folded, weight=F.col("n")).weights == pytest.approx(doubled.weights, abs=1e-9)


def test_logistic_regression_of_separable_constant_or_no_rows(spark):
    far = spark.createDataFrame([(float(i > 4), 1000.0 * (i - 4.5), 1.0) for i in range(10)], "y double, a double, b double")
    fitted = fit(far, 1e6)
    assert all(b <= a + 1e-9 for a, b in zip(fitted.losses, fitted.losses[1:]))
    scores = [r["s"] for r in far.select(fitted.score().alias("s")).collect()]
    assert max(scores[:5]) < 0.5 < min(scores[5:])
    assert abs(fitted.weights[1]) < 1e-6  # a constant carries nothing beside the intercept
    nothing = fit(far.limit(0))
    assert (nothing.intercept, nothing.weights) == (0.0, (0.0, 0.0))


def test_logistic_regression_as_a_stage(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = spark.createDataFrame(labelled(random.Random(5), 60), "y double, a double, b double")
    fitted = fit(df)
    fitted.pipeline().write().save(str(tmp_path / "m"))
    scored = modelling.with_score(PipelineModel.load(str(tmp_path / "m")), df, "s").select("s", fitted.score().alias("t"))
    assert all(r["s"] == pytest.approx(r["t"], abs=1e-15) for r in scored.collect())


def test_rows_without_a_label_are_left_out(spark, stays):
    learners = {"logistic_regression": modelling.risk_learners()["logistic_regression"]}
    extra = stays.limit(50).withColumn("readmitted_30d", F.lit(None).cast("int"))
    one = modelling.fit_risk_models(stays, learners)["logistic_regression"].stages[-1].getStatement()
    two = modelling.fit_risk_models(stays.unionByName(extra), learners)["logistic_regression"].stages[-1].getStatement()
    numbers = lambda text: [float(x) for x in re.findall(r"CAST\('([^']*)'", text)]
    assert numbers(one) == pytest.approx(numbers(two), abs=1e-9)


def test_forest_does_not_depend_on_how_rows_arrive(stays):
    learners = {"random_forest": modelling.risk_learners(trees=5, depth=4)["random_forest"]}
    # Means are added up in another order, so thresholds agree but for their last digits.
    rounded = lambda text: re.sub(r"-?\d+\.\d+", lambda m: f"{float(m[0]):.7f}", text.split("\n", 1)[1])
    trees = [
        rounded(modelling.fit_risk_models(stays.repartition(n), learners)["random_forest"].stages[-1].toDebugString)
        for n in (1, 7)
    ]
    assert trees[0] == trees[1]


def forward(layers, x, kept=None):
    """Plain Python: the output of the network for one row."""
    for k, (weights, bias) in enumerate(layers):
        x = [sum(v * weights[i][j] for i, v in enumerate(x)) + bias[j] for j in range(len(bias))]
        if k < len(layers) - 1:
            x = [max(v, 0.0) * (kept[j] if kept is not None and k == 0 else 1.0) for j, v in enumerate(x)]
    return x[0]


def test_network_gradient_and_dropout():
    rng = np.random.default_rng(1)
    layers = [(w, rng.normal(size=b.shape)) for w, b in network.start((3, 5, 4, 1), 7)]
    x, y, w = rng.normal(size=(6, 3)), rng.integers(0, 2, 6).astype(float), rng.uniform(0.5, 2, 6)
    kept = network.kept_units(np.arange(6), 2, 5, 0.4)
    assert set(np.unique(kept)) <= {0.0, 1 / 0.6}
    many = network.kept_units(np.arange(20000), 0, 5, 0.4)
    assert np.abs(many.mean(axis=0) - 1).max() < 0.03 and (kept == network.kept_units(np.arange(6), 2, 5, 0.4)).all()
    assert (network.kept_units(np.arange(6), 3, 5, 0.4) != kept).any()

    def loss(flat):
        own = network._layered(flat, (3, 5, 4, 1))
        z = [forward(own, list(r), k) for r, k in zip(x, kept)]
        return sum(a * (math.log1p(math.exp(-v)) + (1 - b) * v) for a, b, v in zip(w, y, z)) / 6

    flat = network._flat(layers)
    got, gradient = network.loss_gradient(layers, x, y, w, kept)
    assert got == pytest.approx(loss(flat))
    for i, g in enumerate(network._flat(gradient)):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert (loss(up) - loss(down)) / 2e-6 == pytest.approx(g, abs=1e-6)


def test_network_does_not_depend_on_tasks(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, float(rng.random() < 0.5), rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(600)]
    rows = [(i, float((a * b > 0) != (rng.random() < 0.05)), a, b) for i, _, a, b in rows]
    schema, training = "k long, y double, a double, b double", network.Training((16, 8), rounds=25, batch=16, rate=0.01, shards=3)
    fit = lambda df: network.fit_network(df, [("a", F.col("a")), ("b", F.col("b"))], F.col("y"), F.lit(1.0), F.col("k"), training)
    one = fit(spark.createDataFrame(rows, schema).coalesce(1))
    rng.shuffle(rows)
    more = [*rows, (9000, None, 1.0, 1.0), (9001, 1.0, None, 1.0)]
    assert fit(spark.createDataFrame(more, schema).repartition(8)) == one
    assert one.losses[-1] < 0.7 * one.losses[0]
    one.stage().write().save(str(tmp_path / "n"))
    df = spark.createDataFrame(rows, schema)
    scored = modelling.with_score(modelling.load_model(str(tmp_path / "n")), df).collect()
    want = [1 / (1 + math.exp(-forward(one.layers(), [r["a"], r["b"]]))) for r in scored]
    assert [r["score"] for r in scored] == pytest.approx(want, abs=1e-9)
    assert sum((r["score"] > 0.5) == (r["y"] > 0.5) for r in scored) > 0.85 * len(scored)
    assert fit(df.limit(0)).losses == ()


def people(spark, n=300):
    names = ["Robert", "Chiara", "Omar", "Ingrid", "Svetlana", "Mateus", "Elizabeth"]
    family = ["Okafor", "Schmidt", "Rossi", "Tanaka", "Kowalski"]
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), (i % len(words) + 1).cast("int"))
    k = F.col("id")
    return spark.range(n).select(
        k.cast("string").alias("patient_id"),
        F.concat(F.lit("19"), (60 + k % 3).cast("string"), F.lit("-02-1"), (k % 9).cast("string")).alias("dob"),
        pick(names, k).alias("first"),
        pick(family, k * 3).alias("last"),
        F.lpad(k.cast("string"), 9, "7").alias("ssn"),
        F.lit("84101").alias("zip"),
    )


def test_link_by_model_and_by_rules(spark):
    a = people(spark)
    b, truth = perturb.second_list(a)
    linked = linking.link_by_model(a, b, truth)
    overall, held_out = linked.overall.first(), linked.held_out.first()
    assert overall["precision"] > 0.8 and overall["recall"] > 0.8
    assert held_out["candidate_pairs_test"] < held_out["candidate_pairs_total"]
    assert {r["feature"] for r in linked.weights.collect()} == set(linkage.DEFAULT_FEATURES)
    rules = linking.link_by_rules(a, b, truth).overall.first()
    assert 0.4 < rules["recall"] < 0.95


def pair_lines():
    person = lambda first, **more: {"first": first, "last": "Lee", "dob": "1980-01-01", "zip": "84101", **more}
    return [
        {"record_a": person("Ann", ssn="1"), "record_b": person("Anne", ssn="1")},
        {"record_a": person("Bob"), "record_b": person("Zoe")},
        {"record_a": person("Bob"), "record_b": {"first": "Bob"}},
    ]


@pytest.fixture
def pair_score(spark):
    return linkage.logistic({"first_sim": 5.0, "last_sim": 2.0, "ssn_agree": 3.0}, -6.0)


def test_pair_requests_and_log(spark, pair_score, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, pair_lines())))
    scored = scoring.score_pairs(scoring.read_pair_requests(spark, str(tmp_path / "in.json")), pair_score)
    got = {r["input_summary"]: r for r in scoring.as_log(scored, "match", scoring.pair_summary()).collect()}
    assert set(got) == {"Ann Lee <-> Anne Lee", "Bob Lee <-> Zoe Lee"}  # the incomplete pair is not scored
    assert got["Ann Lee <-> Anne Lee"]["score"] > 0.5 > got["Bob Lee <-> Zoe Lee"]["score"]

    log = PredictionLog(spark, str(tmp_path / "log"))
    rows = scoring.as_log(scored, "match", scoring.pair_summary())
    assert [log.append(rows, key) for key in ("one", "two", "one")] == [True, True, False]
    summary = log.summary().first()
    assert (summary["kind"], summary["n"]) == ("match", 4)
    assert [r["id"] for r in log.recent(3).collect()] == [4, 3, 2]


def logged(spark, n, seed, parts=3):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["match", "risk", None]), f"{seed}-{i}", rng.choice([None, rng.random()]), datetime(2024, 1, 1, seed, 0, i))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "kind string, input_summary string, score double, created_at timestamp").repartition(parts)


def test_log_is_written_once_with_increasing_ids(spark, tmp_path):
    log = PredictionLog(spark, str(tmp_path / "log"))
    assert log.rows().count() == log.recent().count() == log.summary().count() == 0
    batches = [logged(spark, n, k, parts) for k, (n, parts) in enumerate([(40, 3), (0, 1), (7, 5), (25, 2)])]
    for k, (_, df) in enumerate(batches):
        assert log.append(df, f"b{k}", order=["created_at"] if k % 2 else ())
        assert not log.append(df, f"b{k}")  # a batch that comes again
        log = PredictionLog(spark, str(tmp_path / "log"))  # a restart
    # A batch that broke off before it was entered does not count and is written anew.
    batches[2][1].selectExpr("0 AS part", "0L AS place", "*").write.parquet(str(tmp_path / "log" / "rows" / "batch=b9"))
    rows = log.rows().collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 73))
    by_id = {r["id"]: r["input_summary"] for r in rows}
    assert {by_id[i].split("-")[0] for i in range(1, 41)} == {"0"} and {by_id[i].split("-")[0] for i in range(41, 48)} == {"2"}
    assert [by_id[i] for i in range(48, 73)] == [f"3-{i}" for i in range(25)]  # in the order asked for
    assert log.append(batches[3][1], "b9") and log.rows().count() == 97
    want = scoring.log_summary(log.rows()).collect()
    got = {r["kind"]: tuple(r)[1:] for r in log.summary().collect()}
    assert {r["kind"]: pytest.approx(tuple(r)[1:]) for r in want} == got
    assert [r["id"] for r in log.recent(30).collect()] == list(range(97, 67, -1))
    assert sorted(log.recent(30).collect()) == sorted(scoring.recent_predictions(log.rows(), 30).collect())
    assert log.recent(1000).count() == 97


def test_summary_reads_no_rows_and_recent_few_files(spark, tmp_path):
    log = PredictionLog(spark, str(tmp_path / "log"))
    for k in range(6):
        log.append(logged(spark, 30, k)[1], f"b{k}")
    assert not any("/rows/" in f for f in log.summary().inputFiles())
    read = [f for f in log.recent(5).inputFiles() if "/rows/" in f]
    plan = log.recent(5)._jdf.queryExecution().executedPlan().toString()
    assert "batch#" in plan and "b0" not in plan.split("PartitionFilters: ")[1].split("]")[0] and read


def test_stream_scores_each_request_once(spark, pair_score, tmp_path):
    inbox, log, checkpoint = (str(tmp_path / n) for n in ("inbox", "log", "checkpoint"))
    (tmp_path / "inbox").mkdir()
    lines = list(map(json.dumps, pair_lines()))
    for i, line in enumerate(lines):
        (tmp_path / "inbox" / f"{i}.json").write_text(line)
        streaming.stream_pair_scores(spark, inbox, pair_score, log, checkpoint, once=True).awaitTermination(120)
    rows = PredictionLog(spark, log).rows().collect()
    assert sorted(r["id"] for r in rows) == [1, 2]
    assert sorted(r["input_summary"] for r in rows) == ["Ann Lee <-> Anne Lee", "Bob Lee <-> Zoe Lee"]


def test_stream_risk_with_a_fitted_model(spark, fitted, tmp_path):
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "a.json").write_text(json.dumps({"age_at_encounter": 63.0, "prior_inpatient_count": 2.0}))
    model, log = fitted[0]["logistic_regression"], str(tmp_path / "log")
    # Progress goes below the shared folder when no checkpoint is given.
    streaming.stream_risk_scores(spark, str(tmp_path / "inbox"), model, log, once=True).awaitTermination(120)
    row = PredictionLog(spark, log).rows().first()
    assert (row["kind"], row["input_summary"]) == ("risk", "age=63.0, prior_inpatient=2.0")


def test_rejected_pairs_name_what_is_missing(spark):
    person = "struct<first:string, last:string, dob:string, zip:string, ssn:string>"
    whole, lame = ("A", "B", "2000-01-01", "1", None), ("A", None, "2000-01-01", None, "9")
    requests = spark.createDataFrame(
        [(1, whole, whole), (2, whole, lame), (3, None, whole)], f"request int, record_a {person}, record_b {person}"
    )
    told = {r["request"]: r["reason"] for r in scoring.rejected_pairs(requests).collect()}
    assert told == {
        2: "record_b.last, record_b.zip",
        3: "record_a.first, record_a.last, record_a.dob, record_a.zip",
    }


def _stays(spark):
    numbers = [((F.col("id") * (k + 3)) % 11).cast("double").alias(c) for k, c in enumerate(NUMERIC_FEATURES)]
    texts = [F.concat(F.lit(c), F.col("id") % 3).alias(c) for c in CATEGORICAL_FEATURES]
    return spark.range(60).select(F.col("id").alias("encounter_id"), F.col("id").alias("patient_id"), *numbers, *texts)


@pytest.mark.parametrize("name", ["impute_values", "scale_values", "one_hot_values", "prepared_vector"])
def test_fitted_columns_work_the_frame_out_once(spark, monkeypatch, name):
    from catalog import queries

    seen = spark.sparkContext.accumulator(0)

    def look(_):
        seen.add(1)
        return True

    counted = _stays(spark).where(F.udf(look, "boolean")("encounter_id"))
    monkeypatch.setattr(queries, "frame", lambda t: counted)
    assert getattr(queries, name)(None).collect()
    assert 0 < seen.value <= 60  # the split may be asked first


def test_learners_that_do_not_draw_per_task_get_all_cores(spark):
    class Looks:
        def __init__(self, any_order):
            self.any_order = any_order

        def fit(self, dataset):
            tasks[self.any_order] = dataset.rdd.getNumPartitions()
            return modelling.SQLTransformer(statement="SELECT * FROM __THIS__")

    tasks = {}
    rows = _stays(spark).withColumn("readmitted_30d", (F.col("encounter_id") % 2).cast("int"))
    fitted = modelling.fit_risk_models(rows, {"a": lambda _: Looks(True), "b": lambda _: Looks(False)}, tasks=3)
    assert list(fitted) == ["a", "b"] and tasks == {True: 8, False: 3}


def test_learners_are_fitted_side_by_side(spark):
    together = threading.Barrier(2, timeout=60)

    class Waits:
        any_order = True

        def fit(self, dataset):
            together.wait()
            return modelling.SQLTransformer(statement="SELECT * FROM __THIS__")

    rows = _stays(spark).withColumn("readmitted_30d", (F.col("encounter_id") % 2).cast("int"))
    assert list(modelling.fit_risk_models(rows, {"b": lambda _: Waits(), "a": lambda _: Waits()})) == ["b", "a"]


def test_forest_keeps_the_node_of_each_row(stays):
    made = modelling.risk_learners(trees=5, depth=6)["random_forest"]
    trees = []
    for kept in (True, False):
        learner = made(0)
        assert learner.getCacheNodeIds()
        learners = {"random_forest": lambda _, f=learner.setCacheNodeIds(kept): f}
        trees.append(modelling.fit_risk_models(stays, learners)["random_forest"].stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1]
