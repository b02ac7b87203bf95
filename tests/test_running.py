"""Running sums, dense ids, quantiles: against brute force, with and without heavy keys."""

from __future__ import annotations

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from carelattice.operators import running as running_module
from carelattice.operators.running import dense_ids, describe_all, medians, modes, quantiles, running
from carelattice.operators.skew import SkewPolicy, heavy_keys

# Everything is heavy under the second policy.
POLICIES = [SkewPolicy(), SkewPolicy(floor=10, parts=6)]


def rows_with_hot_key(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randint(0, 60), i, rng.choice([None, 1.0, 2.0, 3.5])))
    return rows


@pytest.mark.parametrize("policy", POLICIES)
def test_running_matches_brute_force(spark, policy):
    rows = rows_with_hot_key()
    df = spark.createDataFrame(rows, "k string, at bigint, id bigint, v double").repartition(7)
    out = running(
        df, ["k"], "at", {"n": F.lit(1), "s": F.coalesce("id", F.lit(0))}, {"last": F.col("v")}, ["id"], policy=policy
    )
    got = {r["id"]: (r["n"], r["s"], r["last"]) for r in out.collect()}
    assert len(got) == len(rows)
    for k, at, i, _ in rows:
        seen = sorted((a, j, v) for kk, a, j, v in rows if kk == k and (a, j) <= (at, i))
        last = [v for _, _, v in seen if v is not None]
        assert got[i] == (len(seen), sum(j for _, j, _ in seen), last[-1] if last else None)


def test_heavy_keys_are_bounded_and_found(spark):
    df = spark.createDataFrame([(r[0],) for r in rows_with_hot_key()], "k string")
    heavy = heavy_keys(df, ["k"], SkewPolicy(floor=100, parts=5))
    assert [h.key for h in heavy] == [("hot",)]
    assert 1 < heavy[0].splits <= 5
    assert heavy_keys(df, ["k"], SkewPolicy(floor=1000)) == []


def test_heavy_chunks_split_the_hot_key(spark):
    from carelattice.operators.skew import CHUNK, add_chunks

    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [("x", 1)], "k string, at bigint")
    heavy = heavy_keys(df, ["k"], SkewPolicy(floor=50, parts=10))
    sizes = {r[CHUNK]: r["count"] for r in add_chunks(df, ["k"], "at", heavy).groupBy(CHUNK).count().collect()}
    assert sizes.pop(None) == 1
    assert len(sizes) == 10 and max(sizes.values()) <= 150


@pytest.mark.parametrize("policy", POLICIES)
def test_dense_ids(spark, policy):
    rng = random.Random(5)
    rows = [(rng.choice(["p", "q", None]), rng.randint(0, 5)) for _ in range(80)] + [("copy", 1)] * 70
    df = spark.createDataFrame(rows, "a string, b int")
    one = dense_ids(df.repartition(1), "id", policy, copies_per_row=7).collect()
    many = dense_ids(df.repartition(8), "id", policy, copies_per_row=7).collect()
    assert sorted(r["id"] for r in one) == list(range(1, len(rows) + 1))
    assert Counter((r["a"], r["b"]) for r in one) == Counter(rows)
    assert sorted(one, key=lambda r: r["id"]) == sorted(many, key=lambda r: r["id"])


@pytest.mark.parametrize("policy", POLICIES)
def test_quantiles_and_medians(spark, policy):
    import pandas as pd

    rows = [(r[0] or "none", float(r[1]), r[3]) for r in rows_with_hot_key()]
    frame = pd.DataFrame(rows, columns=["k", "x", "y"])
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {
        (r["k"], r["feature"], r["fraction"]): r["value"]
        for r in quantiles(df, ["x", "y"], [0.25, 0.5, 0.9], ["k"], policy).collect()
    }
    for k, part in frame.groupby("k"):
        for c in ("x", "y"):
            for f in (0.25, 0.5, 0.9):
                assert got[k, c, f] == pytest.approx(part[c].quantile(f))
    whole = {r["feature"]: r["median"] for r in medians(df, ["x", "y"], policy=policy).collect()}
    assert whole == {"x": frame["x"].median(), "y": frame["y"].median()}


def test_modes_take_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("a", "y"), ("b", None)], "g string, h string")
    assert {r["feature"]: r["mode"] for r in modes(df, ["g", "h"]).collect()} == {"g": "a", "h": "x"}


def test_describe_all(spark):
    df = spark.createDataFrame([(1, "u", None), (2, "u", 4.0), (4, "v", 6.0)], "n int, t string, d double")
    got = {r["feature"]: r.asDict() for r in describe_all(df).collect()}
    assert got["n"]["count"] == 3 and got["n"]["q50"] == 2.0 and got["n"]["q75"] == 3.0
    assert got["d"]["count"] == 2 and got["d"]["mean"] == 5.0
    assert (got["t"]["unique"], got["t"]["top"], got["t"]["freq"]) == (2, "u", 2)


def test_ids_of_rows_apart_by_microseconds_do_not_depend_on_partitions(spark):
    rows = spark.range(600).selectExpr("timestamp_micros(1600000000000000 + id) AS seen", "id % 2 AS side")
    one, eight = (
        {(r["us"], r["side"], r["n"]) for r in dense_ids(rows.repartition(p), "n").selectExpr("unix_micros(seen) us", "side", "n").collect()}
        for p in (1, 8)
    )
    assert one == eight and sorted(n for *_, n in one) == list(range(1, 601))


def test_quantiles_shuffle_counted_values_once(spark):
    df = spark.range(500).selectExpr("id % 3 AS g", "CAST(id % 50 AS DOUBLE) AS v")
    for policy in (SkewPolicy(), SkewPolicy(floor=8, parts=5)):
        got = {r["g"]: r["median"] for r in medians(df, ["v"], ["g"], policy).collect()}
        want = {g: statistics.median([i % 50 for i in range(500) if i % 3 == g]) for g in range(3)}
        assert got == want
    plan = medians(df, ["v"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_a_value_is_held_against_fractions_near_it_only(spark):
    fractions = [0.0, *(i / 255 for i in range(1, 255)), 0.999, 1.0]
    values = [float(i * i % 997) for i in range(3000)] + [5.0] * 2000
    df = spark.createDataFrame([(v,) for v in values], "a double")
    found = {r["fraction"]: r["value"] for r in quantiles(df, ["a"], fractions).collect()}
    ordered = sorted(values)
    for f in fractions:
        place = (len(ordered) - 1) * f
        low = int(place)
        high = min(low + 1, len(ordered) - 1)
        assert found[f] == ordered[low] + (ordered[high] - ordered[low]) * (place - low)
    near = F.size(running_module._near(sorted(fractions), F.col("id"), F.col("id") + 1, F.lit(100_000)))
    assert spark.range(0, 100_000).agg(F.max(near)).first()[0] <= 8


def test_fractions_of_one_or_two_rows(spark):
    for values in ([3.0], [3.0, 5.0]):
        df = spark.createDataFrame([(v,) for v in values], "a double")
        found = {r["fraction"]: r["value"] for r in quantiles(df, ["a"], [0.0, 0.25, 0.5, 1.0]).collect()}
        assert found == {f: values[0] + (values[-1] - values[0]) * f for f in (0.0, 0.25, 0.5, 1.0)}
