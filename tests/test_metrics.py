"""Evaluation statistics against plain Python."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from carelattice.operators import metrics
from carelattice.operators.skew import SkewPolicy
from carelattice.plans import modelling

POLICIES = [SkewPolicy(), SkewPolicy(floor=5, parts=4)]


def scored(spark, n=200, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("mn"), int(rng.random() < 0.3), round(rng.random(), 1)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "model string, y int, s double")


def plain_ap(rows):
    total = sum(y for _, y, _ in rows)
    ap = 0.0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        above = [y for _, y, s in rows if s >= t]
        here = sum(y for _, y, s in rows if s == t)
        ap += here / total * sum(above) / len(above)
    return ap


def plain_auc(rows):
    ones, zeros = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("policy", POLICIES)
def test_ap_and_auc(spark, policy):
    rows, df = scored(spark)
    ap = metrics.average_precision(df, "y", "s", policy=policy).first()[0]
    assert ap == pytest.approx(plain_ap(rows))
    assert metrics.roc_auc(df, "y", "s", policy=policy).first()[0] == pytest.approx(plain_auc(rows))


@pytest.mark.parametrize("policy", POLICIES)
def test_model_comparison_agrees_with_the_single_metrics(spark, policy):
    rows, df = scored(spark)
    table = {r["model"]: r for r in metrics.model_comparison(df, "y", "s", digits=9, policy=policy).collect()}
    single = {r["model"]: r for r in metrics.binary_metrics(df, "y", "s", ["model"], digits=9).collect()}
    for m in "mn":
        part = [r for r in rows if r[0] == m]
        assert table[m]["pr_auc"] == pytest.approx(plain_ap(part))
        assert table[m]["roc_auc"] == pytest.approx(plain_auc(part))
        assert (table[m]["precision"], table[m]["recall"]) == (single[m]["precision"], single[m]["recall"])


def test_mann_whitney_p_value(spark):
    rows, df = scored(spark)
    got = metrics.mann_whitney(df, "y", "s").first()
    n1, n0 = got["n1"], got["n0"]
    n = n1 + n0
    counts = {}
    for _, _, s in rows:
        counts[s] = counts.get(s, 0) + 1
    ties = sum(c**3 - c for c in counts.values())
    z = (got["u"] - n1 * n0 / 2 - 0.5) / math.sqrt(n1 * n0 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert got["z"] == pytest.approx(z)
    assert got["p_value"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)))


def test_small_samples_are_exact(spark):
    """Against all ways to choose the ranks of the positives."""
    rng = random.Random(11)
    rows, want = [], {}
    for k, (n1, n0) in enumerate([(1, 1), (1, 6), (3, 4), (5, 5), (6, 3), (2, 9), (8, 2), (4, 0), (0, 3), (2, 200), (201, 2), (9, 9)]):
        scores = rng.sample(range(1000), n1 + n0)
        rows += [(k, int(i < n1), float(s)) for i, s in enumerate(scores)]
        if not n1 or not n0:
            want[k] = None
            continue
        ranks = {s: r for r, s in enumerate(sorted(scores), 1)}
        u = lambda chosen: sum(chosen) - n1 * (n1 + 1) / 2
        own = u([ranks[s] for s in scores[:n1]])
        if min(n1, n0) > 8 or n1 > 200:
            continue
        few = itertools.combinations(range(1, n1 + n0 + 1), n1)
        all_u = [u(c) for c in few]
        want[k] = sum(x >= own for x in all_u) / len(all_u)
    rows += [(50, y, s) for y, s in ((1, 1.0), (0, 1.0), (1, 2.0), (0, 0.0))]  # a tie: the approximation
    got = {r["g"]: r for r in metrics.mann_whitney(spark.createDataFrame(rows, "g int, y int, s double"), "y", "s", ["g"]).collect()}
    for k, p in want.items():
        assert got[k]["p_value"] == (None if p is None else pytest.approx(p, rel=1e-12)), k
    for k in (10, 11, 50):  # too many pairs, too many rows on both sides, a tie
        assert got[k]["p_value"] == pytest.approx(0.5 * math.erfc(got[k]["z"] / math.sqrt(2)), rel=1e-9)


def test_upper_tail(spark):
    values = [-9.0, -3.0, -0.5, 0.0, 0.3, 1.0, 2.9, 3.0, 5.0, 8.0, 20.0]
    df = spark.createDataFrame([(v,) for v in values], "z double")
    for r in df.select("z", metrics.upper_tail(F.col("z")).alias("p")).collect():
        assert r["p"] == pytest.approx(0.5 * math.erfc(r["z"] / math.sqrt(2)), rel=1e-9)


def test_single_class_and_empty(spark):
    ones = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert metrics.roc_auc(ones, "y", "s").first()[0] is None
    assert metrics.average_precision(ones, "y", "s").first()[0] == 1.0
    empty = metrics.binary_metrics(ones.where("s > 1"), "y", "s").first()
    assert (empty["n"], empty["precision"], empty["f1"]) == (0, 0.0, 0.0)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(1, 0.9)] * 1 + [(0, 0.9)] * 7, "y int, s double")
    assert metrics.binary_metrics(df, "y", "s", digits=2).first()["precision"] == 0.12


@pytest.mark.parametrize("policy", POLICIES)
def test_hypothesis_medians(spark, policy):
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.4), rng.randint(0, 12)) for _ in range(151)]
    df = spark.createDataFrame(rows, "y int, v int")
    got = modelling.hypothesis_test(df, "y", "v", policy=policy).first()
    import statistics

    assert got["median_positive"] == statistics.median(v for y, v in rows if y)
    assert got["median_negative"] == statistics.median(v for y, v in rows if not y)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert {r["y"]: r["weight"] for r in metrics.class_weights(df, "y").collect()} == {1: 2.0, 0: 4 / 6}
