"""Fitting and comparing the pair and risk classifiers: an exact logistic regression, leaf-wise boosted trees, a
small network (see `logit`, `boosting`, `network`), and Spark ML's forest."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import ClassVar, Protocol

from pyspark.ml import Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..operators.linkage import B_ID, one_row, weighted_pairs
from ..operators.metrics import average_rank_of, binary_metrics, model_comparison, rank_test, score_steps
from ..operators.running import medians, modes
from ..operators.sampling import split_groups
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from ..schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, PAIR_FEATURES, SEED, TARGET
from ..session import cut_lineage
from .boosting import fit_boosted
from .logit import SCORE, Logit, fit_logit
from .network import Training, fit_network

FEATURES, WEIGHT = "features", "__weight"


# -- preparation -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fills:
    """What missing values are replaced by, how numbers are scaled, and which texts become columns: one entry per column."""

    numbers: Mapping[str, float]
    texts: Mapping[str, str]
    means: Mapping[str, float]
    deviations: Mapping[str, float]
    categories: Mapping[str, Sequence[str]] = field(default_factory=dict)


def fit_fills(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> Fills:
    """Exact medians, most frequent texts, mean and population deviation after filling, and the texts after filling.

    What comes to the driver is one row per column, and the different texts of each categorical column.
    """
    numbers = {r["feature"]: r["median"] for r in medians(df, numeric, policy=policy).collect()}
    texts = {r["feature"]: r["mode"] for r in modes(df, categorical).collect()} if categorical else {}
    numbers = {c: numbers.get(c, 0.0) for c in numeric}
    texts = {c: texts.get(c, "") for c in categorical}
    filled = {c: F.expr(v) for c, v in filled_sql(numbers, texts).items()}
    moments = df.agg(
        *[F.avg(filled[c]).alias(f"mean_{c}") for c in numeric],
        *[F.stddev_pop(filled[c]).alias(f"dev_{c}") for c in numeric],
        *[F.array_sort(F.collect_set(filled[c])).alias(f"all_{c}") for c in categorical],
    ).first()
    return Fills(
        numbers,
        texts,
        {c: moments[f"mean_{c}"] or 0.0 for c in numeric},
        # A constant column is only centred.
        {c: moments[f"dev_{c}"] or 1.0 for c in numeric},
        {c: tuple(moments[f"all_{c}"]) for c in categorical},
    )


def _number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def filled_sql(numbers: Mapping[str, float], texts: Mapping[str, str]) -> dict[str, str]:
    """SQL text of the filled columns."""
    return {c: f"coalesce(CAST(`{c}` AS DOUBLE), {_number(v)})" for c, v in numbers.items()} | {
        c: f"coalesce(`{c}`, {_text(v)})" for c, v in texts.items()
    }


def design_sql(fills: Fills) -> list[tuple[str, str]]:
    """(name, SQL text) of the model inputs in order: filled numbers, centred and divided by the population deviation,
    then one 0/1 column per text of each categorical column. A text not seen in training gives zeros."""
    filled = filled_sql(fills.numbers, fills.texts)
    scaled = [(c, f"({filled[c]} - {_number(fills.means[c])}) / {_number(fills.deviations[c])}") for c in fills.numbers]
    flags = [
        (f"{c}={v}", f"CAST({filled[c]} = {_text(v)} AS DOUBLE)") for c in fills.texts for v in fills.categories[c]
    ]
    return scaled + flags


def filled_columns(fills: Fills) -> dict[str, Column]:
    return {c: F.expr(v) for c, v in filled_sql(fills.numbers, fills.texts).items()}


def scaled_columns(fills: Fills) -> dict[str, Column]:
    """The numeric inputs of the models."""
    return {c: F.expr(v) for c, v in design_sql(fills) if c in fills.numbers}


def input_names(fills: Fills) -> list[str]:
    """Column names the inputs have behind `preparation`."""
    return [f"__x{i}" for i in range(len(design_sql(fills)))]


def preparation(fills: Fills) -> Pipeline:
    """The inputs as columns and as one vector. It is SQL text, so the fitted whole can be saved."""
    names = input_names(fills)
    columns = ", ".join(f"{sql} AS `{n}`" for n, (_, sql) in zip(names, design_sql(fills), strict=True))
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol=FEATURES),
        ]
    )


# -- weights and balance -----------------------------------------------------------------------


def balanced_weight(df: DataFrame, label: str, weight: Column | None = None) -> tuple[Column, float]:
    """(weight column n / (2 * n_class), total weight). One small job."""
    rows = F.lit(1) if weight is None else weight
    counts = {r[label]: float(r["n"]) for r in df.groupBy(label).agg(F.sum(rows).alias("n")).collect()}
    n = sum(counts.values())
    of = F.when(F.col(label) == 1, F.lit(n / (2 * counts.get(1, n)))).otherwise(F.lit(n / (2 * counts.get(0, n))))
    return of * rows, n


# -- pair classifier ---------------------------------------------------------------------------


@dataclass
class PairModel:
    """`model.score()` is the fitted score over the feature columns; `model.pipeline()` can be saved."""

    model: Logit
    metrics: DataFrame
    weights: DataFrame


def train_pairs(
    pairs: DataFrame, features: Sequence[str] = PAIR_FEATURES, test_fraction: float = 0.3, seed: int = SEED
) -> PairModel:
    """Balanced logistic regression on candidate pairs; all pairs of a B record fall on one side.

    Pairs with equal features, label and side enter once, weighted by their number: the loss is the
    same sum, over far fewer rows than there are pairs.
    """
    split = split_groups(pairs, B_ID, test_fraction, seed)
    return train_weighted_pairs(
        split.groupBy(*features, "is_match", "is_test").agg(F.count(F.lit(1)).alias("n")), features
    )


def train_lists(
    a: DataFrame,
    b: DataFrame,
    truth: DataFrame,
    test_fraction: float = 0.3,
    seed: int = SEED,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> PairModel:
    """As `train_pairs` over all candidate pairs of two lists, without forming pairs of copies.

    The split covers all B records, also those without a candidate.
    """
    split = split_groups(b, B_ID, test_fraction, seed)
    return train_weighted_pairs(weighted_pairs(a, split, truth, "is_test", policy=policy))


def train_weighted_pairs(weighted: DataFrame, features: Sequence[str] = PAIR_FEATURES) -> PairModel:
    """Fit and measure on a frequency table of pairs: features, is_match, is_test, n."""
    grouped = cut_lineage(weighted)
    train = grouped.where(~F.col("is_test"))
    weight, _ = balanced_weight(train, "is_match", F.col("n"))
    fitted = fit_logit(train, [(c, F.col(c)) for c in features], F.col("is_match"), weight)
    test = grouped.where("is_test").withColumn("score", fitted.score())
    held_out = binary_metrics(test, "is_match", "score", weight=F.col("n"))
    sizes = grouped.agg(F.sum("n").alias("candidate_pairs_total"))
    measured = one_row(sizes, held_out).select(
        "candidate_pairs_total",
        F.col("n").alias("candidate_pairs_test"),
        F.col("precision").alias("test_precision"),
        F.col("recall").alias("test_recall"),
        F.col("f1").alias("test_f1"),
    )
    return PairModel(fitted, settled(measured), learned_weights(fitted, grouped))


def settled(summary: DataFrame) -> DataFrame:
    """A summary of a few rows, evaluated now: what it was computed from need not be kept."""
    return summary.sparkSession.createDataFrame(summary.collect(), summary.schema)


def learned_weights(fitted: Logit, like: DataFrame, digits: int = 3) -> DataFrame:
    """(feature, weight) rows of the fitted logistic regression."""
    rows = [(n, round(w, digits) + 0.0) for n, w in zip(fitted.names, fitted.weights, strict=True)]
    return like.sparkSession.createDataFrame(rows, "feature string, weight double")


# -- risk classifiers --------------------------------------------------------------------------


def with_score(fitted: Transformer, df: DataFrame, name: str = "score") -> DataFrame:
    """`df` with the probability of class 1 as a further column."""
    scored = fitted.transform(df)
    score = F.col(SCORE) if SCORE in scored.columns else vector_to_array("probability")[1]
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], score.alias(name))


class Fits(Protocol):
    """What learns a stage from prepared rows (`FEATURES`, label, `WEIGHT`). With `any_order = True`, how the rows are dealt
    to tasks makes no difference to it."""

    def fit(self, dataset: DataFrame) -> Transformer: ...


@dataclass(frozen=True)
class ExactLogit:
    """The logistic regression of `logit` on the prepared columns."""

    inputs: int
    label: str = TARGET
    c: float = 1.0
    any_order: ClassVar[bool] = True

    def fit(self, dataset: DataFrame) -> Transformer:
        vector = vector_to_array(FEATURES)
        columns = [(f"__x{i}", vector[i]) for i in range(self.inputs)]
        return fit_logit(dataset, columns, F.col(self.label), F.col(WEIGHT), self.c).stage()


@dataclass(frozen=True)
class LeafwiseTrees:
    """The boosted trees of `boosting` on the prepared columns."""

    inputs: int
    label: str = TARGET
    iterations: int = 100
    any_order: ClassVar[bool] = True

    def fit(self, dataset: DataFrame) -> Transformer:
        vector = vector_to_array(FEATURES)
        columns = [(f"__x{i}", vector[i]) for i in range(self.inputs)]
        return fit_boosted(dataset, columns, F.col(self.label), F.col(WEIGHT), self.iterations).stage()


@dataclass(frozen=True)
class NeuralNetwork:
    """The network of `network` on the prepared columns."""

    inputs: int
    label: str = TARGET
    key: str = "encounter_id"
    training: Training = Training()
    any_order: ClassVar[bool] = True

    def fit(self, dataset: DataFrame) -> Transformer:
        vector = vector_to_array(FEATURES)
        columns = [(f"__x{i}", vector[i]) for i in range(self.inputs)]
        return fit_network(dataset, columns, F.col(self.label), F.col(WEIGHT), F.col(self.key), self.training).stage()


#: Makes what is to be fitted on prepared rows, from the number of inputs.
Learner = Callable[[int], Fits]


def risk_learners(
    label: str = TARGET,
    seed: int = SEED,
    trees: int = 300,
    depth: int = 12,
    iterations: int = 100,
    key: str = "encounter_id",
    training: Training = Training(),
) -> dict[str, Learner]:
    """The four compared classifiers, by name; all take row weights."""
    common = {"featuresCol": FEATURES, "labelCol": label}
    return {
        "logistic_regression": lambda inputs: ExactLogit(inputs, label),
        "random_forest": lambda _: RandomForestClassifier(
            # Without the cached node ids every row walks every tree from its root in each round; the trees are the same.
            **common, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, maxMemoryInMB=1024, cacheNodeIds=True, seed=seed
        ),
        "gradient_boosted_trees": lambda inputs: LeafwiseTrees(inputs, label, iterations),
        "neural_network_mlp": lambda inputs: NeuralNetwork(inputs, label, key, training),
    }


def fit_risk_models(
    train: DataFrame,
    learners: Mapping[str, Learner] | None = None,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    label: str = TARGET,
    key: str = "encounter_id",
    policy: SkewPolicy = DEFAULT_POLICY,
    tasks: int = 4,
) -> dict[str, PipelineModel]:
    """Fit all learners on one shared preparation; each result scores raw rows and can be saved.

    Rows without a label are left out. For learners that draw per task the rows are dealt to `tasks` tasks by a hash of `key`
    and sorted in them, whatever the cluster or their number, so they give the same model everywhere; set it to what the
    cluster can run at once. The others (`any_order`) get as many tasks as there are cores.
    """
    learners = risk_learners(label, key=key) if learners is None else learners
    used = cut_lineage(train.where(F.col(label).isNotNull()).select(key, label, *numeric, *categorical))
    fills = fit_fills(used, numeric, categorical, policy)
    prepared = preparation(fills).fit(used)
    weight, _ = balanced_weight(used, label)
    ready = prepared.transform(used.withColumn(WEIGHT, weight)).select(
        key, F.col(label).cast("double").alias(label), WEIGHT, FEATURES
    )
    inputs = len(input_names(fills))
    fits = {name: make(inputs) for name, make in learners.items()}
    draws = {name for name, f in fits.items() if not getattr(f, "any_order", False)}
    cores = used.sparkSession.sparkContext.defaultParallelism
    held = {
        True: lambda: ready.repartition(tasks, key).sortWithinPartitions(key),
        False: lambda: ready.repartition(max(tasks, cores), key),
    }
    rows = {drawn: cut_lineage(held[drawn]()).persist() for drawn in {name in draws for name in fits}}
    # The learners do not wait for each other: each has rounds too small for all cores.
    pool = ThreadPool(max(1, len(fits)))
    try:
        fit = inheritable_thread_target(used.sparkSession)(lambda name: fits[name].fit(rows[name in draws]))
        stages = pool.map(fit, fits, chunksize=1)
    finally:
        pool.terminate()
        for kept in rows.values():
            kept.unpersist()
    return {name: PipelineModel([*prepared.stages, stage]) for name, stage in zip(fits, stages, strict=True)}


def compare_models(
    models: Mapping[str, Model], test: DataFrame, label: str = TARGET, digits: int = 3, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The comparison table over held-out rows, best first; evaluated at once.

    The models score side by side, so the rows are read once whatever their number.
    """
    scored = test
    for name, fitted in models.items():
        scored = with_score(fitted, scored, f"__score_{name}")
    long = scored.select(label, *[F.col(f"__score_{name}").alias(name) for name in models]).unpivot(
        [label], list(models), "model", "score"
    )
    long = cut_lineage(long)
    return settled(model_comparison(long, label, "score", digits=digits, policy=policy)).orderBy(
        F.desc("pr_auc"), "model"
    )


def split_by_patient(frame: DataFrame, test_fraction: float = 0.25, seed: int = SEED, exact: bool = False):
    """(train, test), all stays of a patient on one side."""
    split = split_groups(frame, "patient_id", test_fraction, seed, exact)
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")


def save_models(models: Mapping[str, PipelineModel], folder: str) -> None:
    for name, fitted in models.items():
        fitted.write().overwrite().save(f"{folder.rstrip('/')}/{name}")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- hypothesis --------------------------------------------------------------------------------


def hypothesis_test(
    frame: DataFrame, label: str, value: str, alpha: float = 0.05, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row: rank test of `value` being larger where label = 1, the verdict, and both medians.

    Everything is read off one table of distinct values with running counts.
    """
    steps = score_steps(frame, label, value, policy=policy)
    test = rank_test(average_rank_of(steps))
    ones, all_rows = F.col("cum_pos"), F.col("cum_n")
    totals = steps.agg(F.sum("pos").alias("ones"), F.sum(F.col("n") - F.col("pos")).alias("zeros"))

    def middle(upto: Column, total: Column) -> Column:
        reach = lambda rank: F.min(F.when(upto >= rank, F.col("score")))
        return (reach(F.floor((total + 1) / 2)) + reach(F.floor((total + 2) / 2))) / 2

    sides = steps.select(
        "*", totals.select("ones").scalar().alias("ones"), totals.select("zeros").scalar().alias("zeros")
    ).agg(
        middle(ones, F.col("ones")).alias("median_positive"),
        middle(all_rows - ones, F.col("zeros")).alias("median_negative"),
    )
    return one_row(test.withColumn("reject_h0", F.col("p_value") < alpha), sides)
