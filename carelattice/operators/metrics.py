"""Exactly defined evaluation statistics, each a plan over the scored rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..schemas import MATCH_THRESHOLD
from .linkage import B_ID, one_row
from .running import running
from .skew import DEFAULT_POLICY, SkewPolicy


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _with_prf(df: DataFrame, tp: str, predicted: str, actual: str, digits: int | None) -> DataFrame:
    """Add precision, recall and their harmonic mean."""
    raw = df.withColumns({"precision": _ratio(F.col(tp), F.col(predicted)), "recall": _ratio(F.col(tp), F.col(actual))})
    p, r = F.col("precision"), F.col("recall")
    scored = raw.withColumn("f1", _ratio(2 * p * r, p + r))
    if digits is None:
        return scored
    return scored.withColumns({c: F.bround(c, digits) for c in ("precision", "recall", "f1")})


# -- linkage -----------------------------------------------------------------------------------


def linkage_metrics(predicted: DataFrame, truth: DataFrame, b: DataFrame, digits: int = 4) -> DataFrame:
    """One row for matches (system_b_id, matched_patient_id) against the truth; `b` gives the total.

    `false_negatives_unmatched` leaves out records matched to a wrong person;
    `false_negatives_total` counts them.
    """
    joined = predicted.join(truth, B_ID, "left")
    right = F.col("matched_patient_id") == F.col("true_patient_id")
    counts = joined.agg(F.count(F.lit(1)).alias("predicted_matches"), F.count_if(right).alias("true_positives"))
    total = b.agg(F.count(F.lit(1)).alias("total_system_b_records"))
    n, tp, matched = (F.col(c) for c in ("total_system_b_records", "true_positives", "predicted_matches"))
    whole = one_row(total, counts).withColumns(
        {
            "false_positives": matched - tp,
            "false_negatives_unmatched": n - matched,
            "false_negatives_total": n - tp,
        }
    )
    return _with_prf(whole, "true_positives", "predicted_matches", "total_system_b_records", digits)


def end_to_end(matches: DataFrame, truth: DataFrame, b: DataFrame, digits: int = 4) -> DataFrame:
    """One row: records matched, matched correctly, precision, recall over all B records."""
    right = F.col("matched_patient_id") == F.col("true_patient_id")
    correct = matches.join(truth, B_ID).agg(F.count_if(right).alias("correct"))
    matched = matches.agg(F.count(F.lit(1)).alias("matched"))
    total = b.agg(F.count(F.lit(1)).alias("total_system_b_records"))
    whole = one_row(total, matched, correct)
    return _with_prf(whole, "correct", "matched", "total_system_b_records", digits).drop("f1")


# -- labels and scores -------------------------------------------------------------------------


def label_rate(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, positives and their share."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("positives"), F.avg(label).alias("positive_rate")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (2 * n_class) of each class: (label, n, weight)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(label, "n", (total / (2 * F.col("n"))).alias("weight"))


def binary_metrics(
    scored: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    threshold: float = MATCH_THRESHOLD,
    digits: int | None = 4,
    weight: Column | None = None,
) -> DataFrame:
    """Counts, precision, recall and F1 of class 1 at a threshold, per group if `by` is given.

    `weight` is the number of cases a row stands for.
    """
    called, true = F.col(score) >= threshold, F.col(label) == 1
    times = F.lit(1).cast("bigint") if weight is None else weight
    total = lambda condition: F.coalesce(F.sum(F.when(condition, times)), F.lit(0))
    counts = scored.groupBy(*by).agg(
        total(F.lit(True)).alias("n"),
        total(called & true).alias("tp"),
        total(called & ~true).alias("fp"),
        total(~called & true).alias("fn"),
        total(called).alias("predicted_positive"),
        total(true).alias("actual_positive"),
    )
    return _with_prf(counts, "tp", "predicted_positive", "actual_positive", digits)


def score_steps(
    scored: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    descending: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per distinct score: n, pos, and both summed up to it in score order.

    Ties are merged before anything is ordered, so the sort is over distinct scores only.
    """
    counts = scored.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    ordered = counts.withColumn("__at", -F.col("score") if descending else F.col("score"))
    upto = running(ordered, by, "__at", {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, policy=policy)
    return upto.drop("__at")


def precision_recall_steps(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Per distinct score as threshold: true and false positives, and precision."""
    steps = score_steps(scored, label, score, by, True, policy)
    tp, fp = F.col("cum_pos"), F.col("cum_n") - F.col("cum_pos")
    return steps.select(
        *by, "score", "n", "pos", tp.alias("tp"), fp.alias("fp"), (tp / F.col("cum_n")).alias("precision")
    )


def average_precision(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Sum over falling thresholds of recall gained times precision; not the trapezoid rule."""
    steps = precision_recall_steps(scored, label, score, by, policy)
    gained = F.sum(F.col("pos") * F.col("precision"))
    return steps.groupBy(*by).agg(_ratio(gained, F.sum("pos")).alias("average_precision"))


def average_ranks(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Per distinct score: rows, positives, and the rank its rows share (1-based, mean over ties)."""
    return average_rank_of(score_steps(scored, label, score, by, False, policy), by)


def average_rank_of(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average ranks from ascending score steps."""
    return steps.select(
        *by, "score", "n", "pos", (F.col("cum_n") - (F.col("n") - 1) / F.lit(2.0)).alias("average_rank")
    )


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal: power series near 0, continued fraction further out."""
    size = F.abs(z)
    density = F.exp(-size * size / 2) / math.sqrt(2 * math.pi)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(size.alias("term"), size.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * size * size / (2 * k + 1)).alias("term"),
            (acc["total"] + acc["term"] * size * size / (2 * k + 1)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, k: k / (size + acc))
    tail = F.when(size < 3, 0.5 - density * series).otherwise(density / (size + fraction))
    return F.when(z >= 0, tail).otherwise(1 - tail)


#: The rank test is exact up to so many rows on the smaller side, and so many pairs of rows.
EXACT_SIDE, EXACT_PAIRS = 8, 400


def exact_upper_tail(n1: Column, n0: Column, u: Column) -> Column:
    """P(U >= u) for samples of n1 and n0 rows without ties, if all orders are as likely.

    The numbers of orders with U = 0, 1, ..., n1 n0 are the coefficients of the product of (1 - q^(n + i)) / (1 - q^i)
    over i = 1..m, m the smaller and n the larger sample: a fold of m steps over an array of n1 n0 + 1 numbers, each
    a whole number below 2^53 within the bounds above.
    """
    m, n = F.least(n1, n0).cast("int"), F.greatest(n1, n0).cast("int")
    start = F.transform(F.sequence(F.lit(0), m * n), lambda k: F.when(k == 0, 1.0).otherwise(0.0))

    def divided(a: Column, i: Column) -> Column:
        terms = lambda k: F.sequence(F.lit(0), F.floor(k / i).cast("int"))
        return F.transform(a, lambda x, k: F.aggregate(terms(k), F.lit(0.0), lambda t, j: t + F.get(a, k - j * i)))

    def step(a: Column, i: Column) -> Column:
        multiplied = F.transform(a, lambda x, k: x - F.when(k >= n + i, F.get(a, k - n - i)).otherwise(0.0))
        return let(multiplied, lambda b: divided(b, i))

    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    ways = F.aggregate(F.sequence(F.lit(1), m), start, step)
    return let(ways, lambda a: total(F.filter(a, lambda x, k: k >= u)) / total(a))


def mann_whitney(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Is `score` larger where label = 1? U, ROC-AUC = U / (n1 * n0), z and one-sided p.

    Without ties and with at most `EXACT_SIDE` rows on a side (and `EXACT_PAIRS` pairs) p is exact; otherwise it is the
    normal approximation with tie and continuity correction.
    """
    return rank_test(average_ranks(scored, label, score, by, policy), by)


def rank_test(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The test of `mann_whitney` from average ranks."""
    n_double = F.col("n").cast("double")
    sums = ranks.groupBy(*by).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n1"),
        F.coalesce(F.sum(F.col("n") - F.col("pos")), F.lit(0)).alias("n0"),
        F.sum(F.col("pos") * F.col("average_rank")).alias("__ranks"),
        F.sum(n_double * n_double * n_double - n_double).alias("__ties"),
    )
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    n = n1 + n0
    spread = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.coalesce(F.try_divide(F.col("__ties"), n * (n - 1)), F.lit(0.0))))
    with_u = sums.withColumn("u", F.col("__ranks") - n1 * (n1 + 1) / 2)
    with_z = with_u.withColumn("z", F.try_divide(F.col("u") - n1 * n0 / 2 - 0.5, spread))
    small = (F.least("n1", "n0").between(1, EXACT_SIDE)) & (F.col("n1") * F.col("n0") <= EXACT_PAIRS) & (F.col("__ties") == 0)
    exact = exact_upper_tail(F.col("n1"), F.col("n0"), F.col("u"))
    return with_z.select(
        *by,
        "n1",
        "n0",
        "u",
        F.try_divide(F.col("u"), n1 * n0).alias("roc_auc"),
        "z",
        F.when(small, exact).otherwise(upper_tail(F.col("z"))).alias("p_value"),
    )


def roc_auc(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Area under the ROC curve; null if a class is absent."""
    return mann_whitney(scored, label, score, by, policy).select(*by, "roc_auc")


def model_comparison(
    scored: DataFrame,
    label: str,
    score: str,
    model: str = "model",
    digits: int = 3,
    threshold: float = MATCH_THRESHOLD,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per model: precision, recall, f1, pr_auc, roc_auc; best pr_auc first.

    Takes the scores of all models as rows. All figures come from one table of distinct scores with
    running counts, so the scored rows are grouped once.
    """
    steps = score_steps(scored, label, score, [model], True, policy)
    n, pos, cum_n = F.col("n"), F.col("pos"), F.col("cum_n")
    called = F.col("score") >= threshold
    sums = steps.groupBy(model).agg(
        F.sum(n).alias("n"),
        F.sum(pos).alias("actual_positive"),
        F.coalesce(F.sum(F.when(called, n)), F.lit(0)).alias("predicted_positive"),
        F.coalesce(F.sum(F.when(called, pos)), F.lit(0)).alias("tp"),
        F.sum(pos * F.col("cum_pos") / cum_n).alias("__ap"),
        # Rank from the top, to be turned around.
        F.sum(pos * (cum_n - (n - 1) / F.lit(2.0))).alias("__from_top"),
    )
    n1, rows = F.col("actual_positive").cast("double"), F.col("n").cast("double")
    u = n1 * (rows + 1) - F.col("__from_top") - n1 * (n1 + 1) / 2
    whole = _with_prf(sums, "tp", "predicted_positive", "actual_positive", digits)
    return whole.select(
        F.col(model).alias("model"),
        "precision",
        "recall",
        "f1",
        F.bround(_ratio(F.col("__ap"), n1), digits).alias("pr_auc"),
        F.bround(F.try_divide(u, n1 * (rows - n1)), digits).alias("roc_auc"),
    ).orderBy(F.desc("pr_auc"), "model")
