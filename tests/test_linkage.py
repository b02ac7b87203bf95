"""Linkage: rules, pairs, best match, perturbation and sampling."""

from __future__ import annotations

import random
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from carelattice.functions import similarity
from carelattice.functions.text import jaro_winkler, jaro_winkler_bound, letter_bits
from carelattice.operators import linkage, metrics, perturb, sampling
from carelattice.operators.skew import SkewPolicy

PERSON = "first string, last string, dob string, ssn string, zip string"
HEAVY = SkewPolicy(floor=6, parts=7)


def people(spark, a, b):
    return (
        spark.createDataFrame(a, f"patient_id string, {PERSON}"),
        spark.createDataFrame(b, f"system_b_id string, {PERSON}"),
    )


def agree(x, y):
    """The rule for one pair, in plain Python."""
    if x["ssn"] and y["ssn"]:
        return x["ssn"] == y["ssn"]
    cut = lambda v, n: None if v is None else v[:n].lower()
    return (
        cut(x["last"], 99) == cut(y["last"], 99)
        and cut(x["first"], 3) == cut(y["first"], 3)
        and cut(x["zip"], 5) == cut(y["zip"], 5)
    )


def crowd(seed, n, prefix):
    rng = random.Random(seed)
    pick = rng.choice
    return [
        (
            f"{prefix}{i:03d}",
            pick(["Ann", "Annette", "Bob", None]),
            pick(["Lee", "LEE", "Ray", None]),
            pick(["1980-01-01", "1980-01-01", "1985-14-03", None]),
            pick(["1", "2", "", None]),
            pick(["12345", "1234", "54321", None]),
        )
        for i in range(n)
    ]


def test_rules_against_all_pairs(spark):
    rows_a, rows_b = crowd(1, 60, "a"), crowd(2, 80, "b")
    a, b = people(spark, rows_a, rows_b)
    names = ("id", "first", "last", "dob", "ssn", "zip")
    want = {}
    for y in (dict(zip(names, r)) for r in rows_b):
        ids = [
            x["id"]
            for x in (dict(zip(names, r)) for r in rows_a)
            if x["dob"] is not None and x["dob"] == y["dob"] and agree(x, y)
        ]
        if ids:
            want[y["id"]] = min(ids)
    got = {r["system_b_id"]: r["matched_patient_id"] for r in linkage.match_by_rules(a, b).collect()}
    assert got == want
    # The pairwise form of the rule says the same.
    pairs = a.alias("a").join(b.alias("b"), F.col("a.dob") == F.col("b.dob"))
    rule = linkage.rule_match(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"))
    paired = pairs.where(rule).groupBy("system_b_id").agg(F.min("patient_id").alias("m"))
    assert {r["system_b_id"]: r["m"] for r in paired.collect()} == want


def test_digits_in_names_hide_matches_unless_normalized(spark):
    a, b = people(
        spark,
        [("p", "Mila257", "Ray12", "1980-01-01", None, "12345")],
        [("b", "Mila", "Ray", "1980-01-01", None, "12345")],
    )
    assert linkage.match_by_rules(a, b).count() == 0
    assert linkage.match_by_rules(a, b, normalize_names=True).count() == 1


def test_no_match_keeps_schema_and_gives_zeros(spark):
    a, b = people(spark, [("p", "X", "Y", "1980-01-01", "1", "1")], [("b", "X", "Y", "1980-01-01", "2", "1")])
    matches = linkage.match_by_rules(a, b)
    assert matches.columns == ["system_b_id", "matched_patient_id"] and matches.count() == 0
    truth = spark.createDataFrame([("b", "p")], "system_b_id string, true_patient_id string")
    got = metrics.linkage_metrics(matches, truth, b).first()
    assert (got["precision"], got["recall"], got["f1"], got["false_negatives_total"]) == (0.0, 0.0, 0.0, 1)


@pytest.mark.parametrize("policy", [SkewPolicy(), HEAVY])
def test_candidate_pairs_are_complete_and_single(spark, policy):
    rows_a, rows_b = crowd(3, 50, "a"), crowd(4, 40, "b")
    a, b = people(spark, rows_a, rows_b)
    block = lambda r: ((r[3] or "")[:4], (r[5] or "")[:3])
    want = sorted((y[0], x[0]) for x in rows_a for y in rows_b if block(x) == block(y))
    truth = spark.createDataFrame([(r[0], f"a{i:03d}") for i, r in enumerate(rows_b)], "system_b_id string, true_patient_id string")
    pairs = linkage.candidate_pairs(a, b, truth, policy=policy).collect()
    assert sorted((r["system_b_id"], r["patient_id"]) for r in pairs) == want
    assert all(r["is_match"] == int(r["system_b_id"][1:] == r["patient_id"][1:]) for r in pairs)
    cover = linkage.blocking_coverage(a, b, truth).first()
    assert (cover["candidate_pairs"], cover["true_pairs_in_block"]) == (len(want), sum(r["is_match"] for r in pairs))


def test_best_match_is_the_same_with_heavy_blocks(spark):
    a, b = people(spark, crowd(5, 60, "a"), crowd(6, 50, "b"))
    score = F.round(linkage.logistic({"first_sim": 3.0, "last_sim": 2.0, "zip_sim": 1.0, "ssn_agree": 2.0}, -4.0), 9)
    plain = linkage.best_matches(a, b, score).collect()
    assert sorted(plain) == sorted(linkage.best_matches(a, b, score, policy=HEAVY).collect())
    # Highest score first, lowest id among equals, threshold after the pick.
    scored = linkage.candidate_pairs(a, b).withColumn("score", score).collect()
    for r in plain:
        best = min((-s["score"], s["patient_id"]) for s in scored if s["system_b_id"] == r["system_b_id"])
        assert (-r["score"], r["matched_patient_id"]) == best and r["score"] >= 0.5


def test_best_match_may_block_on_any_column(spark):
    a, b = people(spark, crowd(5, 40, "a"), crowd(6, 40, "b"))
    town = F.when(F.substring("zip", 1, 1) == "8", "x").otherwise("y").alias("town")
    a, b = a.select("*", town), b.select("*", town)
    score = (F.col("first_sim") + F.col("last_sim") + F.col("zip_sim")) / 3
    block = {"by_town": lambda c: c("town")}
    plain = linkage.best_matches(a, b, score, block=block).collect()
    assert plain and sorted(plain) == sorted(linkage.best_matches(a, b, score, block=block, policy=HEAVY).collect())


@pytest.mark.parametrize("policy", [SkewPolicy(), HEAVY])
def test_weighted_pairs_say_the_same_as_all_pairs(spark, policy):
    a, b = people(spark, crowd(7, 70, "a"), crowd(8, 60, "b"))
    truth = spark.createDataFrame([(f"b{i:03d}", f"a{i:03d}") for i in range(60)], "system_b_id string, true_patient_id string")
    b = sampling.split_groups(b, "system_b_id", 0.3, 42)
    names = [*linkage.DEFAULT_FEATURES, "is_match", "is_test"]
    pairs = linkage.candidate_pairs(a, b, truth).join(b.select("system_b_id", "is_test"), "system_b_id")
    want = pairs.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).select(*names, "n").collect()
    got = linkage.weighted_pairs(a, b, truth, "is_test", policy=policy).select(*names, "n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


SAME = {"same": lambda x, y: F.when(x["first"] == y["first"], 1.0).otherwise(0.0)}


def test_tasks_follow_pairs_not_bytes(spark):
    """One block with half of all pairs, some middling and many small ones: all tasks form about as many pairs."""
    sizes = [300, *[80] * 10, *[5] * 200]
    rows = [(f"{k}-{i}", f"n{i % 7}", str(k)) for k, n in enumerate(sizes) for i in range(n)]
    a = spark.createDataFrame(rows, "patient_id string, first string, town string")
    b = a.withColumnRenamed("patient_id", "system_b_id")
    pairs = linkage.candidate_pairs(a, b, None, SAME, {"town": lambda r: r("town")}, SkewPolicy(parts=40))
    total = sum(n * n for n in sizes)
    loads = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(loads) == total == pairs.distinct().count()
    assert len(loads) >= 36 and max(loads) < 3 * total / 40
    assert linkage.candidate_pairs(a.limit(0), b, None, SAME, {"town": lambda r: r("town")}).count() == 0


def test_equal_pairs_are_added_up_before_they_are_sent(spark):
    a, b = people(spark, crowd(7, 70, "a"), crowd(8, 60, "b"))
    truth = spark.createDataFrame([("b001", "a001")], "system_b_id string, true_patient_id string")
    table = linkage.weighted_pairs(a, b.withColumn("is_test", F.lit(False)), truth, "is_test")
    plan = table._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join" in line and "__tile" in line]
    assert len(joins) == 1  # pairs are formed once, and looked up nowhere
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, low = [], depth(plan[joins[0]])
    for line in reversed(plan[: joins[0]]):
        if depth(line) < low:
            above.append(line.lstrip(" :+-").split("(")[0].split(" ")[0])
            low = depth(line)
    assert above[:3] == ["Project", "Union", "HashAggregate"] or above[:2] == ["Project", "HashAggregate"], above
    assert "Join" not in "".join(above)


def test_blocks_and_features_over_any_column(spark):
    """Columns beside the usual ones, a block key named like a column, and a record's columns named like internal ones."""
    more = lambda df: df.select("*", F.lower("last").alias("birth_year"), F.substring("zip", 1, 1).alias("town"), F.lit(1).alias("n"))
    a, b = (more(df) for df in people(spark, crowd(15, 40, "a"), crowd(16, 30, "b")))
    block = {"birth_year": lambda r: r("birth_year"), "last": lambda r: F.upper(r("town"))}
    features = {"town_sim": linkage.name_similarity("town"), **SAME}
    rows = [[r.asDict() for r in df.collect()] for df in (a, b)]
    key = lambda r: (r["birth_year"], r["town"])
    want = sorted((y["system_b_id"], x["patient_id"]) for x in rows[0] for y in rows[1] if key(x) == key(y) and None not in key(x))
    truth = spark.createDataFrame(list(dict(want).items()), "system_b_id string, true_patient_id string")
    pairs = linkage.candidate_pairs(a, b, truth, features, block)
    assert sorted((r["system_b_id"], r["patient_id"]) for r in pairs.collect()) == want and want
    table = linkage.weighted_pairs(a, b.withColumn("held", F.col("system_b_id") < "b015"), truth, "held", features, block)
    assert table.agg(F.sum("n")).first()[0] == len(want)
    assert table.where("is_match = 1").agg(F.sum("n")).first()[0] == pairs.where("is_match = 1").count() == len(dict(want))
    best = linkage.best_matches(a, b, F.col("town_sim"), features, block).collect()
    assert {r["system_b_id"] for r in best} == {p[0] for p in want}


def test_missing_names_count_as_equal_or_as_nothing(spark):
    df = spark.createDataFrame([(("x",), (None,)), ((None,), (None,))], "a struct<first:string>, b struct<first:string>")
    equal = linkage.name_similarity("first")(F.col("a"), F.col("b"))
    nothing = linkage.name_similarity("first", missing=None)(F.col("a"), F.col("b"))
    got = df.select(equal.alias("e"), nothing.alias("n")).collect()
    assert [(r["e"], r["n"]) for r in got] == [(0.0, 0.0), (1.0, 0.0)]


def test_similarity_bound_is_never_below(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdeé\u0161 Z") for _ in range(rng.randint(0, 9)))
    rows = [(word(), word()) for _ in range(1500)] + [("martha", "marhta"), ("", ""), ("a", ""), (None, "x"), ("same", "same")]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    bound = jaro_winkler_bound(a, b, letter_bits(a), letter_bits(b))
    got = df.select("a", "b", jaro_winkler(a, b).alias("s"), bound.alias("most")).collect()
    assert all((r["s"] is None) == (r["most"] is None) for r in got)
    assert all(r["s"] <= r["most"] <= 1 + 1e-9 for r in got if r["s"] is not None)
    assert sum(r["most"] < 0.7 for r in got if r["s"] is not None) > 0.3 * len(got)


def test_pairs_that_cannot_reach_the_threshold_are_not_compared(spark):
    rng = random.Random(13)
    names = ["Robert", "Chiara", "Omar", "Ingrid", "Svetlana", "Mateus", "Elizabeth", "Bo", None]
    family = ["Okafor", "Schmidt", "Rossi", "Tanaka", "Kowalski", "Wu", "Fitzgerald"]
    rows = [(str(i), rng.choice(names), rng.choice(family) + rng.choice(["", "x"]), "1980-01-01", rng.choice(["1", None]), "12345") for i in range(160)]
    a, b = people(spark, rows[:80], rows[80:])
    weights = {"first_sim": 6.0, "last_sim": 7.0, "zip_sim": -0.5, "ssn_agree": 1.0}
    score = linkage.LinearScore(weights, -10.0, digits=9)
    plain = sorted(linkage.best_matches(a, b, score.column()).collect())
    assert plain == sorted(linkage.best_matches(a, b, score).collect()) and len(plain) > 20
    block, features = linkage.DEFAULT_BLOCK, linkage.DEFAULT_FEATURES
    cut = linkage.tiles(a, b, block)
    left = linkage._paired(a, b, None, features, block, cut, possible=score.may_reach(0.5, features))
    every = linkage._paired(a, b, None, features, block, cut).withColumn("score", score.column())
    assert left.count() <= every.count() / 2
    assert every.where("score >= 0.5").join(left, ["patient_id", "system_b_id"], "left_anti").isEmpty()
    # The bound comes first: similarities are worked out above the filter only.
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("first_sim") < plan.index("bit_count")


def test_jaro_winkler_equals_the_check_engine(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 9)))
    rows = [("martha", "marhta"), ("dixon", "dicksonx"), ("ab", "ac"), ("", ""), ("a", ""), (None, "x"), ("nan", "nan")]
    rows += [(word(), word()) for _ in range(1500)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", jaro_winkler(F.col("a"), F.col("b")).alias("s"), jaro_winkler(F.col("a"), F.col("a")).alias("one")).collect()
    con = duckdb.connect()
    for r in got:
        want = con.execute("SELECT jaro_winkler_similarity(?::VARCHAR, ?::VARCHAR)", [r["a"], r["b"]]).fetchone()[0]
        assert (r["s"] is None) == (want is None)
        assert r["s"] is None or (abs(r["s"] - want) < 1e-9 and 0.0 <= r["s"] <= 1.0)
        assert r["one"] == (None if r["a"] is None else float(r["a"] != ""))


def test_jaro_winkler_counts_characters_not_bytes(spark):
    df = spark.createDataFrame([("josé", "jose"), ("éa", "aé"), ("ñandú", "ñandú")], "a string, b string")
    got = [r["s"] for r in df.select(jaro_winkler(F.col("a"), F.col("b")).alias("s")).collect()]
    jaro = (3 / 4 + 3 / 4 + 1) / 3
    assert got == pytest.approx([jaro + 0.3 * (1 - jaro), 0.0, 1.0])


def source(spark, n=500):
    return spark.range(n).select(
        F.col("id").cast("string").alias("patient_id"),
        F.lit("Robert12").alias("first"),
        F.concat(F.lit("Kowalski"), F.col("id").cast("string")).alias("last"),
        F.lit("1980-02-17").alias("dob"),
        F.lit("123-45-6789").alias("ssn"),
        F.lit("84101").alias("zip"),
    )


def test_perturbation_is_repeatable_and_near_its_rates(spark):
    noisy, truth = perturb.second_list(source(spark).repartition(1), 1.0)
    again, _ = perturb.second_list(source(spark).repartition(8), 1.0)
    assert sorted(noisy.collect()) == sorted(again.collect())
    rows = noisy.collect()
    assert len({r["system_b_id"] for r in rows}) == len(rows) == 500
    share = lambda test: sum(map(test, rows)) / len(rows)
    nicknames = {n.capitalize() for n in perturb.NICKNAMES["robert"]}
    assert share(lambda r: r["first"] in nicknames) == pytest.approx(0.5, abs=0.08)
    assert share(lambda r: r["ssn"] is None) == pytest.approx(0.25, abs=0.07)
    assert share(lambda r: r["zip"] == "8410") == pytest.approx(0.2, abs=0.07)
    assert share(lambda r: r["dob"] == "1980-17-02") == pytest.approx(0.03, abs=0.03)
    assert all(not any(c.isdigit() for c in r["first"] + r["last"]) for r in rows)
    assert all(sorted(r["last"].lower()) == sorted("kowalski") for r in rows)
    assert truth.count() == 500


@pytest.mark.parametrize("fraction", [0.0, 0.4, 1.0])
def test_exact_sample(spark, fraction):
    df = source(spark, 333)
    got = sampling.sample_exact(df, "patient_id", fraction, 42)
    assert got.count() == round(fraction * 333)


def test_splits_keep_groups_whole(spark):
    df = spark.range(2000).select((F.col("id") % 97).alias("g"), "id")
    for exact in (False, True):
        split = sampling.split_groups(df, "g", 0.3, 42, exact)
        sides = split.groupBy("g").agg(F.count_distinct("is_test").alias("n"), F.max("is_test").alias("t")).collect()
        assert all(r["n"] == 1 for r in sides)
        tests = sum(r["t"] for r in sides)
        assert tests == 30 if exact else 0 < tests < 97


def test_similarity_by_values_is_the_column_to_the_last_bit(spark):
    rng = random.Random(5)
    words = ["", "é𝄞ab", "Łódź", "nan", "ab" * 20, "ba" * 20, "x" * 33] + [
        "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 36 if n % 5 == 0 else 12))) for n in range(80)
    ]
    words = [*dict.fromkeys(words)]
    df = spark.createDataFrame([(n, w) for n, w in enumerate(words)], "n int, w string")
    pairs = df.alias("x").crossJoin(df.alias("y")).select(
        F.col("x.n").alias("i"), F.col("y.n").alias("j"), jaro_winkler(F.col("x.w"), F.col("y.w")).alias("s")
    ).collect()
    i, j = (np.array([r[c] for r in pairs]) for c in "ij")
    got = similarity.jaro_winkler_of(words, words)
    assert got(i, j).tolist() == [r["s"] for r in pairs]
    assert similarity.once_each(got, len(words), len(words))(i, j).tolist() == [r["s"] for r in pairs]
    most, similarity.TABLE = similarity.TABLE, 10
    try:
        small = similarity.once_each(similarity.jaro_winkler_of(words, words), len(words), len(words))
        assert small(i, j).tolist() == [r["s"] for r in pairs]
    finally:
        similarity.TABLE = most


@pytest.mark.parametrize("sizes", [(500_000, 250_000), (7, 3)])
def test_pairs_by_value_are_those_by_column(spark, sizes, monkeypatch):
    monkeypatch.setattr(linkage, "PAIRS_PER_TILE", sizes[0])
    monkeypatch.setattr(linkage, "PAIRS_AT_ONCE", sizes[1])
    monkeypatch.setattr(linkage, "PAIRS_BY_COLUMN", 0)
    a, b = people(spark, crowd(3, 90, "p"), crowd(4, 70, "b"))
    truth = b.select("system_b_id", F.concat(F.lit("p"), F.substring("system_b_id", 2, 9)).alias("true_patient_id"))
    b = b.withColumn("is_test", F.when(F.crc32("system_b_id") % 3 == 0, F.lit("yes")))
    score = linkage.LinearScore({"first_sim": 6.0, "last_sim": 7.0, "zip_sim": 2.0, "ssn_agree": -1.0}, -8.0, digits=1)
    ask = lambda: [
        sorted(linkage.candidate_pairs(a, b, truth).collect()),
        sorted(linkage.candidate_pairs(a, b).collect()),
        sorted(linkage.weighted_pairs(a, b, truth, "is_test").collect(), key=str),
        sorted(linkage.best_matches(a, b, score).collect()),
    ]
    by_value = ask()
    plan = linkage.candidate_pairs(a, b)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert not linkage.candidate_pairs(a.limit(0), b).count()
    # Pairs are added up in the task that forms them: no exchange between the two.
    plan = linkage.weighted_pairs(a, b, truth, "is_test")._jdf.queryExecution().executedPlan().toString().splitlines()
    formed = next(n for n, line in enumerate(plan) if "FlatMapCoGroupsInArrow" in line)
    above = [line for line in plan[:formed] if "Exchange" in line or "HashAggregate" in line]
    assert "HashAggregate" in above[-1]
    monkeypatch.setattr(linkage, "PAIRS_BY_COLUMN", 10**9)
    assert by_value == ask() and all(by_value)


def test_pairs_are_compared_once_per_values_whatever_number_identifies_them(spark, monkeypatch):
    """600 x 600 records of one block that differ in their numbers only, but for a few names: few pairs are compared, and the
    table says the same as all pairs do."""
    names = ["ann", "anne", None, "bob"]
    row = lambda i, mark: (f"{mark}{i}", f"1950-01-{i % 28 + 1:02d}", names[i % 4], "Lee", f"{i:09d}" if i % 5 else "", "12345")
    columns = "dob string, first string, last string, ssn string, zip string"
    a = spark.createDataFrame([row(i, "p") for i in range(600)], f"patient_id string, {columns}")
    b = spark.createDataFrame([row(i, "b") for i in range(300, 900)], f"system_b_id string, {columns}").withColumn("part", F.expr("system_b_id < 'b6'"))
    truth = spark.createDataFrame([(f"b{i}", f"p{i}") for i in range(300, 600)], "system_b_id string, true_patient_id string")
    monkeypatch.setattr(linkage, "PAIRS_BY_COLUMN", 0)
    formed, cut = [], linkage.tiles
    monkeypatch.setattr(linkage, "tiles", lambda *args: formed.append(cut(*args)) or formed[-1])
    table = linkage.weighted_pairs(a, b, truth, "part")
    assert [t.pairs for t in formed] == [8 * 16]  # of A: names and whether there is a number; of B also the part
    of = [*linkage.DEFAULT_FEATURES, "is_match", "part"]
    pairs = linkage.candidate_pairs(a, b, truth).join(b.select("system_b_id", "part"), "system_b_id")
    want = pairs.groupBy(*of).count().collect()
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, want)) and sum(r["count"] for r in want) == 360_000

    # Best matches of records that differ in nothing compared are looked for once.
    formed.clear()
    score = linkage.LinearScore({"first_sim": 6.0, "last_sim": 7.0}, -12.0, digits=9)
    features = {"first_sim": linkage.name_similarity("first"), "last_sim": linkage.name_similarity("last")}
    best = {r[0]: tuple(r)[1:] for r in linkage.best_matches(a, b, score, features).collect()}
    assert [t.pairs for t in formed] == [4 * 4] and len(best) == 600
    lowest = {n: min(f"p{i}" for i in range(600) if i % 4 == n) for n in range(4)}
    assert all(best[f"b{i}"][0] == lowest[i % 4] for i in range(300, 900))


def test_pairs_are_counted_alike_by_tile_and_by_column(spark, monkeypatch):
    people = [(str(i), f"19{50 + i % 3}-01-01", f"na{i % 7}me{i % 11}", f"x{i % 13}", None if i % 3 else f"{i // 2:09d}", "12345") for i in range(200)]
    columns = "dob string, first string, last string, ssn string, zip string"
    a = spark.createDataFrame(people, f"patient_id string, {columns}")
    b = spark.createDataFrame(people[::-1], f"system_b_id string, {columns}").withColumn("part", F.lit(None).cast("string"))
    truth = b.selectExpr("system_b_id", "system_b_id true_patient_id")
    seen = []
    for most in (0, 10**9):
        monkeypatch.setattr(linkage, "PAIRS_BY_COLUMN", most)
        seen.append(sorted(map(str, linkage.weighted_pairs(a, b, truth, "part").collect())))
    assert seen[0] == seen[1]


@pytest.mark.parametrize("sizes", [(8_192, 16_000_000), (7, 10), (3, 16_000_000)])
def test_candidate_pairs_leave_their_task_as_rectangles(spark, sizes, monkeypatch):
    """Ids of a pair are not sent once per pair: a row stands for some records against some others. Copies, records without
    an id, blocks of one record and rounded features give what pairs made one by one give."""
    row = lambda i, mark: (None if i % 50 == 7 else f"{mark}{i // 2}", f"na{i % 7}m\u00e9"[: i % 6], f"x{i % 13}y" if i % 5 else None, f"19{50 + i % 3}-01-01" if i != 11 else "1999-09-09", None if i % 3 else f"{i // 4}", "12345"[: i % 5 + 1])
    a, b = people(spark, [row(i, "p") for i in range(200)], [row(i, "b") for i in range(150)])
    truth = spark.createDataFrame([(f"b{i}", f"p{i}") for i in (1, 2, 3, 3, 4)] + [("b5", None)], "system_b_id string, true_patient_id string")
    features = {n: replace(f, digits=2) if isinstance(f, linkage.NameSimilarity) else f for n, f in linkage.DEFAULT_FEATURES.items()}
    score = sum(map(F.col, features), F.lit(0.0)) / 6
    want = sorted(map(str, linkage.candidate_pairs(a, b, truth, features).collect()))
    best = sorted(map(str, linkage.best_matches(a, b, score, features).collect()))
    monkeypatch.setattr(linkage, "PAIRS_BY_COLUMN", 0)
    monkeypatch.setattr(linkage, "PAIRS_PER_ROW", sizes[0])
    monkeypatch.setattr(linkage, "CODED", sizes[1])
    seen, apart = [], linkage.EveryPair.apart
    monkeypatch.setattr(linkage.EveryPair, "apart", lambda self, rows, *more: seen.append(rows) or apart(self, rows, *more))
    pairs = linkage.candidate_pairs(a, b, truth, features)
    assert sorted(map(str, pairs.collect())) == want and len(want) > 2_000
    assert sorted(map(str, linkage.best_matches(a, b, score, features).collect())) == best
    held = seen[0].select(F.size("__list_0") * F.size("__list_2")).toPandas().iloc[:, 0]
    assert held.sum() == len(want) and held.max() <= sizes[0]
    if sizes[0] > 7:
        assert len(held) < len(want) / 20


def test_numbers_are_rounded_as_spark_does(spark):
    values = [x / 128 for x in range(129)] + [(m / p + m / q + 1) / 3 for p in range(1, 9) for q in range(1, 9) for m in range(9)]
    frame = spark.createDataFrame([(x,) for x in values], "x double")
    for digits in (0, 2, 6):
        assert similarity.half_up(np.array(values), digits).tolist() == [r[0] for r in frame.select(F.round("x", digits)).collect()]
