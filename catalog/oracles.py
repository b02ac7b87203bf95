"""SQL that each registered query must agree with, over the supplied tables."""

from __future__ import annotations

import re

from carelattice.operators.perturb import NICKNAMES
from carelattice.schemas import CATEGORICAL_FEATURES, CHRONIC_CODES, NUMERIC_FEATURES

from .views import LAB_BY_LINE, _sql_case, sql_views


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by the views it needs, directly or through other views."""
    views = {**sql_views(), **(extra or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in views:
            if re.search(rf"\b{name}\b", sql) and name not in needed:
                visit(views[name])
                needed.append(name)

    visit(body)
    # What a recursive fit reads in every step is computed once.
    kept = lambda name: "MATERIALIZED " if name.startswith("v_fit_") else ""
    head = ",\n".join(f"{name} AS {kept(name)}({views[name]})" for name in needed)
    return (f"WITH {head}\n" if head else "") + body.strip()


def cohort_views() -> dict[str, str]:
    """Label and prior counts of every stay. The first start after a stop decides the label: if that one lies
    outside the follow-up, all later ones do. No supplied stay stops before it starts, so none follows itself."""
    chronic = ", ".join(f"'{c}'" for c in CHRONIC_CODES)
    kinds = {
        "encounter": "SELECT patient_id, start_ts, encounter_class FROM v_encounter",
        "inpatient": "SELECT patient_id, start_ts, NULL FROM v_stay",
        "procedure": "SELECT patient_id, start_ts, NULL FROM v_procedure",
        "medication": "SELECT patient_id, start_ts, NULL FROM v_medication",
        # A day is over when the next one begins.
        "condition": "SELECT patient_id, start_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND, code FROM v_condition",
    }
    past = " UNION ALL ".join(f"SELECT '{k}' AS kind, * FROM ({sql}) t(patient_id, known_at, code)" for k, sql in kinds.items())
    number = lambda kind, more="": f"count(*) FILTER (WHERE kind = '{kind}'{more})"
    return {
        "v_start": "SELECT patient_id, start_ts AS next_start FROM v_stay GROUP BY ALL",
        "v_label": """
            SELECT s.encounter_id, s.patient_id, CAST(s.start_ts AS DATE) AS start_day,
              CAST(coalesce(next_start - s.stop_ts <= INTERVAL 30 DAYS, false) AS INTEGER) AS readmitted_30d,
              CAST(coalesce(date_diff('day', s.stop_ts, next_start) < 30, false) AS INTEGER) AS readmitted_by_day
            FROM v_stay s ASOF LEFT JOIN v_start n ON s.patient_id = n.patient_id AND s.stop_ts < n.next_start""",
        "v_past": past,
        "v_prior": f"""
            SELECT encounter_id, {number("encounter")} AS prior_encounter_count,
              {number("inpatient")} AS prior_inpatient_count, {number("condition")} AS prior_condition_count,
              {number("condition", f" AND code IN ({chronic})")} AS chronic_condition_count,
              {number("procedure")} AS prior_procedure_count, {number("medication")} AS prior_medication_count
            FROM v_stay LEFT JOIN v_past ON v_past.patient_id = v_stay.patient_id AND known_at < start_ts
            GROUP BY encounter_id""",
    }


def temporal() -> dict[str, str]:
    def last_reading(source: str, code: str, name: str, op: str = "<=") -> str:
        return f"""(SELECT arg_max(r.v, (r.obs_date, r.observation_id)) FROM
            (SELECT *, TRY_CAST(value AS DOUBLE) AS v FROM {source} WHERE code = '{code}') r
          WHERE r.v IS NOT NULL AND r.patient_id = s.patient_id AND r.obs_date {op} s.start_ts) AS {name}"""

    kinds = ("view", "click", "error", "signup", "purchase")
    vitals = {
        "39156-5": "bmi",
        "8480-6": "systolic_bp",
        "8462-4": "diastolic_bp",
        "8867-4": "heart_rate",
        "2339-0": "glucose",
        "4548-4": "hba1c",
    }
    readings = ", ".join(last_reading("v_lab", c, n) for c, n in vitals.items())
    queries = {
        "readmitted_within_30d": "SELECT encounter_id, patient_id, start_day, readmitted_30d FROM v_label",
        "readmitted_day_cutoff": "SELECT encounter_id, patient_id, start_day, readmitted_by_day AS readmitted_30d FROM v_label",
        "prior_counts": "SELECT * FROM v_prior",
        "as_of_readings": "SELECT s.visit_id, "
        + ", ".join(last_reading("v_event", k, f"last_{k}") for k in kinds)
        + " FROM v_visit s",
        "as_of_strictly_before": "SELECT s.visit_id, "
        + ", ".join(last_reading("v_event", k, f"last_{k}", "<") for k in kinds)
        + " FROM v_visit s",
        "as_of_join": """
            SELECT s.visit_id, r.v AS last_view, CAST(r.obs_date AS VARCHAR) AS seen_at
            FROM v_visit s ASOF LEFT JOIN
              (SELECT patient_id, obs_date, TRY_CAST(value AS DOUBLE) AS v FROM v_event
               WHERE code = 'view' AND TRY_CAST(value AS DOUBLE) IS NOT NULL) r
              ON r.patient_id = s.patient_id AND r.obs_date <= s.start_ts""",
        "next_start_after_stop": """
            SELECT s.encounter_id, CAST(min(n.start_ts) AS DATE) AS next_day
            FROM v_stay s LEFT JOIN v_encounter n
              ON n.patient_id = s.patient_id AND n.start_ts > s.stop_ts
            GROUP BY s.encounter_id""",
        "demographics": """
            SELECT encounter_id, gender, race, ethnicity,
              round(date_diff('day', birth_date, CAST(start_ts AS DATE)) / 365.25, 6) AS age_at_encounter
            FROM v_stay LEFT JOIN v_patient USING (patient_id)""",
        "training_frame": f"""
            SELECT s.encounter_id, s.patient_id, CAST(s.start_ts AS DATE) AS start_day,
              CAST(s.stop_ts AS DATE) AS stop_day, s.base_cost, s.total_claim_cost,
              readmitted_30d, v_prior.* EXCLUDE (encounter_id),
              {readings}, p.gender, p.race, p.ethnicity,
              round(date_diff('day', p.birth_date, CAST(s.start_ts AS DATE)) / 365.25, 6) AS age_at_encounter
            FROM v_stay s JOIN v_label ON v_label.encounter_id = s.encounter_id
              JOIN v_prior ON v_prior.encounter_id = s.encounter_id
              LEFT JOIN v_patient p ON p.patient_id = s.patient_id""",
    }
    return queries | {f"{name}_by_table": queries[name] for name in ("prior_counts", "training_frame")}


# -- the noisy second list, restated -----------------------------------------------------------


def _bits(field: str, key: str = "patient_id") -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {key}, '42', '{field}')), 1, 8) AS BIGINT)"


def _hit(field: str, rate: float) -> str:
    return f"{_bits(field)} / 4294967296.0::DOUBLE < {rate}"


def _noisy_name(column: str) -> str:
    plain = f"translate({column}, '0123456789', '')"
    nicks = (
        f"CASE lower({plain})" + "".join(f" WHEN '{k}' THEN {list(v)}" for k, v in NICKNAMES.items()) + " END"
    )
    nick = f"(({nicks})[{_bits(column + '.which')} % len({nicks}) + 1])"
    at = f"({_bits(column + '.at')} % (length({plain}) - 1) + 1)"
    return f"""CASE
        WHEN {nicks} IS NOT NULL AND {_hit(column + '.nick', 0.5)} THEN upper({nick}[1]) || substr({nick}, 2)
        WHEN length({plain}) > 3 AND {_hit(column + '.swap', 0.4)}
          THEN substr({plain}, 1, {at} - 1) || substr({plain}, {at} + 1, 1) || substr({plain}, {at}, 1)
            || substr({plain}, {at} + 2)
        ELSE {plain} END"""


def linkage_views() -> dict[str, str]:
    places = "list_filter(range(1, length(ssn) + 1), lambda i: substr(ssn, i, 1) BETWEEN '0' AND '9')"
    at = f"({places})[{_bits('ssn.at')} % len({places}) + 1]"
    parts = "string_split(dob, '-')"
    return {
        "v_drawn": """
            SELECT * FROM (SELECT *, count(*) OVER () AS n,
                row_number() OVER (ORDER BY md5(concat_ws('|', patient_id, '42', 'sample'))) AS rn
              FROM v_person_a) WHERE rn <= round(0.4 * n)""",
        "v_noisy": f"""
            SELECT 'B-' || md5(concat_ws('|', patient_id, '42', 'id')) AS system_b_id,
              patient_id AS true_patient_id,
              {_noisy_name("first")} AS first,
              {_noisy_name("last")} AS last,
              CASE WHEN len({parts}) = 3 AND ({parts})[2] <> ({parts})[3] AND {_hit("dob.swap", 0.03)}
                THEN concat_ws('-', ({parts})[1], ({parts})[3], ({parts})[2]) ELSE dob END AS dob,
              CASE WHEN {_hit("ssn.missing", 0.25)} THEN NULL
                WHEN {_hit("ssn.digit", 0.15)} AND length(ssn) > 0
                  THEN substr(ssn, 1, {at} - 1) || CAST({_bits("ssn.to")} % 10 AS VARCHAR) || substr(ssn, {at} + 1)
                ELSE ssn END AS ssn,
              CASE WHEN length(zip) >= 5 AND {_hit("zip.cut", 0.2)} THEN substr(zip, 1, 4) ELSE zip END AS zip
            FROM v_drawn""",
        "v_b": "SELECT system_b_id, first, last, dob, ssn, zip FROM v_noisy",
        "v_truth": "SELECT system_b_id, true_patient_id FROM v_noisy",
        "v_rule": _rule_sql("lower({})"),
        "v_blocks_a": """
            SELECT *, coalesce(substr(dob, 1, 4), '') AS birth_year, coalesce(substr(zip, 1, 3), '') AS zip3
            FROM v_person_a""",
        "v_blocks_b": """
            SELECT *, coalesce(substr(dob, 1, 4), '') AS birth_year, coalesce(substr(zip, 1, 3), '') AS zip3
            FROM v_b""",
        "v_pair": """
            SELECT b.system_b_id, a.patient_id,
              CAST(coalesce(t.true_patient_id = a.patient_id, false) AS INTEGER) AS is_match,
              jaro_winkler_similarity(lower(coalesce(a.first, 'nan')), lower(coalesce(b.first, 'nan'))) AS first_sim,
              jaro_winkler_similarity(lower(coalesce(a.last, 'nan')), lower(coalesce(b.last, 'nan'))) AS last_sim,
              jaro_winkler_similarity(coalesce(a.zip, 'nan'), coalesce(b.zip, 'nan')) AS zip_sim,
              1.0::DOUBLE AS dob_year_match,
              CASE WHEN a.ssn <> '' AND b.ssn <> '' AND a.ssn = b.ssn THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ssn_agree,
              CASE WHEN a.ssn <> '' AND b.ssn <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ssn_both_present
            FROM v_blocks_b b JOIN v_blocks_a a ON a.birth_year = b.birth_year AND a.zip3 = b.zip3
              LEFT JOIN v_truth t ON t.system_b_id = b.system_b_id""",
        "v_scored": """
            SELECT *, round(1 / (1 + exp(-(-12.0 + first_sim * 6.0 + last_sim * 7.0 + zip_sim * 2.0
              + dob_year_match * 0.5 + ssn_agree * 5.0 + ssn_both_present * -1.0)::DOUBLE)), 9) AS score
            FROM v_pair""",
        "v_best": """
            SELECT system_b_id, patient_id AS matched_patient_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY system_b_id ORDER BY score DESC, patient_id) AS rn
              FROM v_scored) WHERE rn = 1 AND score >= 0.5""",
    }


def _rule_sql(clean: str) -> str:
    last = f"{clean.format('a.last')} IS NOT DISTINCT FROM {clean.format('b.last')}"
    first = f"substr({clean.format('a.first')}, 1, 3) IS NOT DISTINCT FROM substr({clean.format('b.first')}, 1, 3)"
    return f"""
        SELECT b.system_b_id, min(a.patient_id) AS matched_patient_id
        FROM v_b b JOIN v_person_a a ON a.dob = b.dob AND
          CASE WHEN a.ssn <> '' AND b.ssn <> '' THEN a.ssn = b.ssn
            ELSE {last} AND {first}
              AND substr(a.zip, 1, 5) IS NOT DISTINCT FROM substr(b.zip, 1, 5) END
        GROUP BY b.system_b_id"""


def linking() -> dict[str, str]:
    prf = """round_even(p, 4)::DOUBLE AS precision, round_even(r, 4)::DOUBLE AS recall,
        round_even(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4)::DOUBLE AS f1"""
    return {
        "perturbed_people": "SELECT * FROM v_b",
        "perturbed_truth": "SELECT * FROM v_truth",
        "deterministic_match": "SELECT * FROM v_rule",
        "deterministic_match_normalized": _rule_sql("lower(translate({}, '0123456789', ''))"),
        "deterministic_eval": f"""
            SELECT n AS total_system_b_records, m AS predicted_matches, tp AS true_positives,
              m - tp AS false_positives, n - m AS false_negatives_unmatched, n - tp AS false_negatives_total, {prf}
            FROM (SELECT *, coalesce(tp / m::DOUBLE, 0) AS p, coalesce(tp / n::DOUBLE, 0) AS r FROM
              (SELECT (SELECT count(*) FROM v_b) AS n, count(*) AS m,
                count(*) FILTER (WHERE matched_patient_id = true_patient_id) AS tp
               FROM v_rule LEFT JOIN v_truth USING (system_b_id)))""",
        "block_stats": """
            SELECT birth_year, zip3, n_a, n_b, n_a * n_b AS pairs, birth_year = '' OR zip3 = '' AS has_missing_key
            FROM (SELECT birth_year, zip3, count(*) AS n_a FROM v_blocks_a GROUP BY ALL)
            JOIN (SELECT birth_year, zip3, count(*) AS n_b FROM v_blocks_b GROUP BY ALL) USING (birth_year, zip3)""",
        "blocking_coverage": """
            SELECT count(*) AS candidate_pairs, CAST(sum(is_match) AS BIGINT) AS true_pairs_in_block,
              (SELECT count(*) FROM v_b) AS total_system_b_records,
              round_even(sum(is_match) / (SELECT count(*) FROM v_b)::DOUBLE, 4)::DOUBLE AS share_in_block
            FROM v_pair""",
        "candidate_pairs": """
            SELECT system_b_id, patient_id, is_match, round(first_sim, 6) AS first_sim, round(last_sim, 6) AS last_sim,
              round(zip_sim, 6) AS zip_sim, dob_year_match, ssn_agree, ssn_both_present
            FROM v_pair""",
        "weighted_pairs": f"""
            SELECT round(first_sim, 6) AS first_sim, round(last_sim, 6) AS last_sim, round(zip_sim, 6) AS zip_sim,
              dob_year_match, ssn_agree, ssn_both_present, is_match,
              {_bits("split", "system_b_id")} / 4294967296.0::DOUBLE < 0.3 AS is_test, count(*) AS n
            FROM v_pair GROUP BY ALL""",
        "best_match": "SELECT system_b_id, matched_patient_id, round(score, 6) AS score FROM v_best",
        "best_match_eval": """
            SELECT n AS total_system_b_records, m AS matched, c AS correct,
              round_even(c / m::DOUBLE, 4)::DOUBLE AS precision, round_even(c / n::DOUBLE, 4)::DOUBLE AS recall
            FROM (SELECT (SELECT count(*) FROM v_b) AS n, count(*) AS m,
                count(*) FILTER (WHERE matched_patient_id = true_patient_id) AS c
              FROM v_best JOIN v_truth USING (system_b_id))""",
        "part_name_similarity": """
            SELECT p_partkey, round(jaro_winkler_similarity(lower(p_name), lower(p_type)), 6) AS similarity
            FROM part""",
    }


# -- evaluation --------------------------------------------------------------------------------


def _tail(z: str) -> str:
    """P(Z > z) by the series phi(z) * sum z^(2k+1) / (2k+1)!!, good for |z| < 6."""
    series = (
        f"list_sum(list_transform(range(0, 120), lambda k: exp((2 * k + 1) * ln(abs({z}) + 1e-300)"
        " + (k + 1) * ln(2) + lgamma(k + 2) - lgamma(2 * k + 3))))"
    )
    half = f"exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {series}"
    return f"CASE WHEN {z} > 6 THEN 0 WHEN {z} < -6 THEN 1 ELSE 0.5 - sign({z}) * {half} END"


def _u_test(source: str, label: str, score: str, by: str = "") -> str:
    """n1, n0, u, z per group of `by` (a column list ending in a comma, or nothing)."""
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""
        SELECT {by} n1, n0, u, (u - n1 * n0 / 2 - 0.5)
            / sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))) AS z
        FROM (SELECT {by} n1, n0, ties, ranks - n1 * (n1 + 1) / 2 AS u FROM
          (SELECT {by} sum(pos)::DOUBLE AS n1, sum(n - pos)::DOUBLE AS n0, sum(pos * avg_rank) AS ranks,
             sum(n::DOUBLE * n * n - n) AS ties
           FROM (SELECT {by} score, n, pos,
               sum(n) OVER ({part} ORDER BY score) - (n - 1) / 2.0::DOUBLE AS avg_rank
             FROM (SELECT {by} {score} AS score, count(*) AS n, sum({label}) AS pos FROM {source}
               GROUP BY {by} {score}))
           {group}))"""


def _ap(by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""
        SELECT {by} sum(pos * precision) / sum(pos) AS ap FROM
          (SELECT {by} score, n, pos, tp, cum - tp AS fp, tp / cum::DOUBLE AS precision FROM
            (SELECT {by} score, n, pos, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS cum
             FROM (SELECT {by} score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM v_pred GROUP BY {by} score)
             WINDOW w AS ({part} ORDER BY score DESC)))
        {group}"""


def _binary(by: str = "", digits: int = 4) -> str:
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""
        SELECT {by} n, tp, fp, fn, tp + fp AS predicted_positive, tp + fn AS actual_positive,
          round_even(p, {digits})::DOUBLE AS precision, round_even(r, {digits})::DOUBLE AS recall,
          round_even(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, {digits})::DOUBLE AS f1
        FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS p,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS r
          FROM (SELECT {by} count(*) AS n, count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
              count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
              count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn
            FROM v_pred {group}))"""


def evaluation() -> dict[str, str]:
    split = "CAST('0x' || substr(md5(concat_ws('|', patient_id, '42', 'split')), 1, 8) AS BIGINT)"
    numbers = ("o_orderkey", "o_custkey", "o_totalprice")
    texts = ("o_orderstatus", "o_orderpriority", "o_orderdate")
    described = [
        f"""SELECT '{c}' AS feature, count({c}) AS count, CAST(NULL AS BIGINT) AS "unique", NULL AS top,
            CAST(NULL AS BIGINT) AS freq, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
            round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
            round(max({c})::DOUBLE, 4) AS max FROM orders"""
        for c in numbers
    ] + [
        f"""SELECT '{c}', sum(n)::BIGINT, count(*), arg_min(v, (-n, v)), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL
            FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in texts
    ]
    return {
        "binary_metrics": _binary(),
        "binary_metrics_by_language": _binary("lang,"),
        "precision_recall_steps": """
            SELECT score, n, pos, tp, cum - tp AS fp, round(tp / cum::DOUBLE, 6) AS precision
            FROM (SELECT score, n, pos, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS cum
              FROM (SELECT score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM v_pred GROUP BY score)
              WINDOW w AS (ORDER BY score DESC))""",
        "average_precision": f"SELECT round(ap, 6) AS average_precision FROM ({_ap()})",
        "average_ranks": """
            SELECT score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos, avg(rn) AS average_rank
            FROM (SELECT score, label, row_number() OVER (ORDER BY score) AS rn FROM v_pred) GROUP BY score""",
        "roc_auc": f"SELECT round(u / (n1 * n0), 6) AS roc_auc FROM ({_u_test('v_pred', 'label', 'score')})",
        "mann_whitney_u": f"""
            SELECT n1::BIGINT AS n1, n0::BIGINT AS n0, u, round(z, 6) AS z, round({_tail("z")}, 6) AS p_value
            FROM ({_u_test('v_pred', 'label', 'score')})""",
        "rank_test_by_group": f"""
            SELECT t.c_nationkey, t.part, t.n1::BIGINT AS n1, t.n0::BIGINT AS n0, t.u,
              CASE WHEN t.n1 * t.n0 > 0 THEN round(t.z, 6) END AS z,
              round(CASE WHEN t.n1 * t.n0 = 0 THEN NULL WHEN least(t.n1, t.n0) BETWEEN 1 AND 8 AND t.n1 * t.n0 <= 400 AND ties = 0 THEN (
                  SELECT sum(ways) FILTER (r - j * (j + 1) / 2 >= t.u) / sum(ways) FROM v_orders
                  WHERE k = t.n1 + t.n0 AND j = least(t.n1, t.n0)) ELSE {_tail("t.z")} END, 6) AS p_value
            FROM ({_u_test('v_segments', 'label', 'score', 'c_nationkey, part,').replace("SELECT c_nationkey, part, n1, n0, u,", "SELECT c_nationkey, part, n1, n0, u, ties,", 1)}) t""",
        "model_comparison_by_language": f"""
            SELECT b.lang AS model, b.precision, b.recall, b.f1, round_even(a.ap, 6)::DOUBLE AS pr_auc,
              round_even(u.u / (u.n1 * u.n0), 6)::DOUBLE AS roc_auc
            FROM ({_binary('lang,', 6)}) b JOIN ({_ap('lang,')}) a ON a.lang = b.lang
              JOIN ({_u_test('v_pred', 'label', 'score', 'lang,')}) u ON u.lang = b.lang""",
        "class_weights": """
            SELECT label, count(*) AS n, round((SELECT count(*) FROM v_pred) / (2.0::DOUBLE * count(*)), 6) AS weight
            FROM v_pred GROUP BY label""",
        "label_rate": """
            SELECT lang, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS positive_rate
            FROM v_pred GROUP BY lang""",
        "group_split": f"""
            SELECT encounter_id, patient_id, {split} / 4294967296.0::DOUBLE < 0.25 AS is_test FROM v_encounter""",
        "group_split_exact": """
            SELECT encounter_id, patient_id, rn <= ceil(0.25 * n) AS is_test
            FROM v_encounter JOIN (SELECT patient_id, count(*) OVER () AS n,
                row_number() OVER (ORDER BY md5(concat_ws('|', patient_id, '42', 'split'))) AS rn
              FROM (SELECT DISTINCT patient_id FROM v_encounter)) USING (patient_id)""",
        "median_by_label": """
            SELECT label, 'n_chars' AS feature, count(*) AS n, median(n_chars)::DOUBLE AS median FROM v_pred GROUP BY label
            UNION ALL
            SELECT label, 'score', count(*), median(score) FROM v_pred GROUP BY label""",
        "readmission_hypothesis": f"""
            SELECT n1::BIGINT AS n1, n0::BIGINT AS n0, u, round(u / (n1 * n0), 6) AS roc_auc, round(z, 6) AS z,
              round({_tail("z")}, 6) AS p_value, {_tail("z")} < 0.05 AS reject_h0,
              (SELECT median(v)::DOUBLE FROM v_tested WHERE label = 1) AS median_positive,
              (SELECT median(v)::DOUBLE FROM v_tested WHERE label = 0) AS median_negative
            FROM ({_u_test('v_tested', 'label', 'v')})""",
        "describe_orders": " UNION ALL ".join(described),
    }


def evaluation_views() -> dict[str, str]:
    return {
        "v_segments": """
            SELECT c_nationkey, c_custkey % 40 AS part, (c_mktsegment = 'BUILDING')::INTEGER AS label, c_acctbal AS score
            FROM customer""",
        # In how many ways j of k ranks add up to r.
        "v_orders": """
            WITH RECURSIVE o AS (
              SELECT 0 AS k, 0 AS j, 0 AS r, 1.0::DOUBLE AS ways
              UNION ALL SELECT k + 1, j + taken, r + taken * (k + 1) AS sum_of_ranks, sum(ways)
              FROM o, (VALUES (0), (1)) t(taken) WHERE k < 60 AND j + taken <= 8 GROUP BY k, j, taken, r)
            SELECT k, j, r, sum(ways) AS ways FROM o GROUP BY k, j, r""",
        "v_tested": """
            SELECT readmitted_30d AS label, prior_inpatient_count AS v FROM v_label JOIN v_prior USING (encounter_id)"""
    }


# -- warehouse ---------------------------------------------------------------------------------


def warehouse() -> dict[str, str]:
    lines = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
    lab = _sql_case(LAB_BY_LINE, "l_linenumber")
    first = "arg_min(coalesce(description, ''), (rank, description))"
    orphans = [
        ("fact_encounter", "patient_id", "dim_patient", "orders", "o_custkey", "SELECT c_custkey FROM customer"),
        ("fact_encounter", "organization_id", "dim_organization", "orders", "o_custkey", "SELECT s_suppkey FROM supplier"),
        (
            "fact_encounter",
            "code_system,code",
            "dim_code",
            "orders",
            "o_orderpriority[1]",
            "SELECT code FROM v_raw_code WHERE code_system = 'SNOMED-CT'",
        ),
    ]
    by_fact = {
        "fact_condition": "WHERE l_linestatus = 'O'",
        "fact_procedure": "",
        "fact_medication": "WHERE l_linestatus = 'F'",
        "fact_observation": "",
    }
    for fact, where in by_fact.items():
        code = lab if fact == "fact_observation" else "CAST(l_partkey AS VARCHAR)"
        source = f"(SELECT * FROM {lines} {where})"
        orphans += [
            (fact, "patient_id", "dim_patient", source, "o_custkey", "SELECT c_custkey FROM customer"),
            (fact, "encounter_id", "fact_encounter", source, "l_orderkey", "SELECT o_orderkey FROM orders"),
            (fact, "code_system,code", "dim_code", source, code, "SELECT code FROM v_raw_code"),
        ]
    keys = {
        "region": "r_regionkey",
        "nation": "n_nationkey",
        "customer": "c_custkey",
        "supplier": "s_suppkey",
        "part": "p_partkey",
        "orders": "o_orderkey",
        "lineitem": "l_orderkey, l_linenumber",
        "events": "event_id",
        "documents": "doc_id",
        "embeddings": "vec_id",
        "pages": "page_id",
        "benchmark": "item_id",
        "labels": "doc_id",
        "conversations": "conv_id, turn",
    }
    missing = {
        "documents": "text IS NULL OR lang IS NULL OR source IS NULL",
        "conversations": "role IS NULL OR text IS NULL",
        "v_person_a": "first IS NULL OR ssn IS NULL OR zip IS NULL",
        "v_encounter": "stop_ts IS NULL",
    }
    checked = keys | {"v_person_a": "patient_id", "v_encounter": "encounter_id"}
    brands = ", ".join(f"'Brand#{i}'" for i in range(1, 6))
    system = f"CASE WHEN p_brand IN ({brands}) THEN 'SNOMED' ELSE 'SNOMED-CT' END"
    line = "CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_orderkey AS VARCHAR) AS encounter_id"
    typed = [
        ("dim_patient", "customer", {"birth_date": 0, "death_date": 0, "lat": 0, "lon": 0}),
        (
            "fact_encounter",
            "orders",
            {"start_ts": 0, "stop_ts": 0, "base_cost": 0, "total_claim_cost": 0, "payer_coverage": "count(*)"},
        ),
        ("fact_condition", "lineitem WHERE l_linestatus = 'O'", {"start_date": 0, "stop_date": 0}),
        ("fact_procedure", "lineitem", {"start_ts": 0, "stop_ts": 0, "base_cost": 0}),
        (
            "fact_medication",
            "lineitem WHERE l_linestatus = 'F'",
            {"start_ts": 0, "stop_ts": 0, "base_cost": 0, "dispenses": 0, "total_cost": 0},
        ),
        ("fact_observation", "lineitem", {"obs_date": 0}),
    ]
    return {
        "loaded_counts": """
            SELECT 'dim_code' AS "table", count(DISTINCT (code_system, code)) AS rows FROM v_raw_code
            UNION ALL SELECT 'dim_patient', count(*) FROM customer
            UNION ALL SELECT 'dim_organization', count(*) FROM supplier
            UNION ALL SELECT 'fact_encounter', count(*) FROM orders
            UNION ALL SELECT 'fact_condition', count(*) FROM lineitem WHERE l_linestatus = 'O'
            UNION ALL SELECT 'fact_medication', count(*) FROM lineitem WHERE l_linestatus = 'F'
            UNION ALL SELECT 'fact_procedure', count(*) FROM lineitem
            UNION ALL SELECT 'fact_observation', count(*) FROM lineitem""",
        "dim_code": f"SELECT code_system, code, {first} AS description FROM v_raw_code GROUP BY code_system, code",
        "dim_code_with_aliases": f"""
            SELECT code_system, code, {first} AS description
            FROM (SELECT * REPLACE (replace(code_system, 'SNOMED-CT', 'SNOMED') AS code_system) FROM v_raw_code)
            GROUP BY code_system, code""".replace(
            "SELECT code_system, code,", "SELECT replace(code_system, 'SNOMED', 'SNOMED-CT') AS code_system, code,", 1
        ),
        "dim_patient": """
            SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
              DATE '1930-01-01' + CAST((c_custkey * 37) % 22000 AS INTEGER) AS birth_date, CAST(NULL AS DATE) AS death_date,
              CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, lower(c_mktsegment) AS race,
              CAST(NULL AS VARCHAR) AS ethnicity, CAST(NULL AS VARCHAR) AS marital_status, n_name AS city, n_name AS state, n_name AS county,
              lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
              CASE WHEN abs(c_acctbal) < 1000 THEN c_acctbal END AS lat, CAST(NULL AS DOUBLE) AS lon
            FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
        "dim_organization": """
            SELECT CAST(s_suppkey AS VARCHAR) AS organization_id, s_name AS name, CAST(NULL AS VARCHAR) AS city,
              CAST(s_nationkey AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip FROM supplier""",
        "fact_encounter": """
            SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id,
              CAST(o_custkey AS VARCHAR) AS organization_id, CAST(o_orderdate AS VARCHAR) AS start_ts,
              CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) END AS stop_ts,
              lower(o_orderpriority) AS encounter_class, 'SNOMED-CT' AS code_system, o_orderpriority[1] AS code,
              o_totalprice AS base_cost, o_totalprice AS total_claim_cost, CAST(NULL AS DOUBLE) AS payer_coverage
            FROM orders""",
        "fact_condition": f"""
            SELECT {line}, CAST(l_shipdate AS DATE) AS start_date, CAST(NULL AS DATE) AS stop_date,
              {system} AS code_system, CAST(l_partkey AS VARCHAR) AS code
            FROM {lines} WHERE l_linestatus = 'O'""",
        "fact_procedure": f"""
            SELECT {line}, CAST(l_shipdate AS VARCHAR) AS start_ts, CAST(NULL AS VARCHAR) AS stop_ts,
              {system} AS code_system, CAST(l_partkey AS VARCHAR) AS code, l_extendedprice AS base_cost
            FROM {lines}""",
        "fact_medication": f"""
            SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_orderkey AS VARCHAR) AS encounter_id,
              CAST(l_shipdate AS VARCHAR) AS start_ts, CAST(NULL AS VARCHAR) AS stop_ts, 'RxNorm' AS code_system,
              CAST(l_partkey AS VARCHAR) AS code, l_extendedprice AS base_cost, CAST(l_quantity AS INTEGER) AS dispenses,
              l_extendedprice AS total_cost
            FROM {lines} WHERE l_linestatus = 'F'""",
        "fact_observation": f"""
            SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_orderkey AS VARCHAR) AS encounter_id,
              CAST(l_shipdate AS VARCHAR) AS obs_date, p_type AS category, 'LOINC' AS code_system, {lab} AS code,
              CASE WHEN l_discount = 0 THEN 'coded' ELSE CAST(l_quantity AS VARCHAR) END AS value,
              lower(l_returnflag) AS units
            FROM {lines}""",
        "parse_report": " UNION ALL ".join(
            f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, "
            + (
                "count(*) FILTER (WHERE abs(c_acctbal) >= 1000)"
                if (table, c) == ("dim_patient", "lat")
                else f"CAST({bad} AS BIGINT)"
            )
            + f" AS unparsed FROM {source}"
            for table, source, columns in typed
            for c, bad in columns.items()
        ),
        "surrogate_keys": f"""
            SELECT patient_id, start_date, code, row_number() OVER (ORDER BY substr(h, 1, 15), h) AS condition_id
            FROM (SELECT *, md5('{{"patient_id":' || patient_id || ',"start_date":"' || start_date || '","code":"' || code
                || '"}}') AS h FROM v_condition)""",
        "surrogate_keys_events": """
            SELECT user_id, event_type, epoch_us(seen) AS seen, row_number() OVER (ORDER BY substr(h, 1, 15), h) AS row_id
            FROM (SELECT *, md5('{"user_id":' || user_id || ',"event_type":"' || event_type || '","seen":"'
                || strftime(seen, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}') AS h
              FROM (SELECT user_id, event_type, ts + to_microseconds(event_id % 1000) AS seen FROM events))""",
        "orphan_check": " UNION ALL ".join(
            f"""SELECT '{fact}' AS "table", '{columns}' AS columns, '{target}' AS target, count(*) AS orphan_rows,
                count(DISTINCT {key}) AS orphan_keys FROM {source} WHERE {key} NOT IN ({known})"""
            for fact, columns, target, source, key, known in orphans
        ),
        "key_check": " UNION ALL ".join(
            f"""SELECT '{t.removeprefix("v_")}' AS "table", sum(n)::BIGINT AS rows,
                count(*) FILTER (WHERE n > 1) AS duplicate_keys,
                coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_rows, sum(m)::BIGINT AS rows_missing_required
                FROM (SELECT {k}, count(*) AS n, count(*) FILTER (WHERE {missing.get(t, "false")}) AS m FROM {t} GROUP BY {k})"""
            for t, k in checked.items()
        ),
        "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in keys),
    }


# -- logistic regression by Newton's method ----------------------------------------------------


def newton(source: str, inputs: list[str], label: str, weight: str, steps: int = 30) -> str:
    """One row with the list `b` (intercept first) that minimises sum(w * log-loss) + |b without intercept|^2 / 2.

    Each recursion adds up the gradient and the weighted Gram matrix over `source` and solves for the step by
    elimination, one nested query per pivot (the matrix is positive definite).
    """
    d = len(inputs)
    x = ["1.0::DOUBLE", *inputs]
    z = " + ".join(f"b[{i + 1}] * {c}" for i, c in enumerate(x))
    columns = ", ".join(f"{c} AS x{i}" for i, c in enumerate(x))
    sums = [f"sum(w * (y - p) * x{i}) AS g{i}" for i in range(d + 1)]
    sums += [f"sum(w * p * (1 - p) * x{i} * x{j}) AS h{i}_{j}" for i in range(d + 1) for j in range(i, d + 1)]
    ridge = lambda i, j: " + 1" if i == j and i else ""
    rows = ", ".join(
        "["
        + ", ".join(f"h{min(i, j)}_{max(i, j)}{ridge(i, j)}" for j in range(d + 1))
        + f", g{i}{f' - b[{i + 1}]' if i else ''}]"
        for i in range(d + 1)
    )
    solved = f"""SELECT k, b, [{rows}] AS m FROM (
        SELECT k, b, {", ".join(sums)} FROM (
          SELECT k, b, {columns}, ({label})::DOUBLE AS y, {weight} AS w, 1 / (1 + exp(-({z}))) AS p
          FROM newton, {source} WHERE k < {steps}) GROUP BY k, b)"""
    for p in range(1, d + 2):
        solved = f"""SELECT k, b, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
            CASE WHEN i = {p} THEN v / m[{p}][{p}] ELSE v - r[{p}] * m[{p}][j] / m[{p}][{p}] END)) AS m FROM ({solved})"""
    return f"""WITH RECURSIVE newton AS (
        SELECT 0 AS k, {[0.0] * (d + 1)}::DOUBLE[] AS b
        UNION ALL SELECT k + 1, list_transform(b, lambda v, i: v + m[i][{d + 2}]) FROM ({solved}))
      SELECT b FROM newton WHERE k = {steps}"""


PAIR_INPUTS = ["first_sim", "last_sim", "zip_sim", "dob_year_match", "ssn_agree", "ssn_both_present"]


def _logistic(names: list[str]) -> str:
    return "1 / (1 + exp(-(b[1]" + "".join(f" + b[{i}] * {n}" for i, n in enumerate(names, 2)) + ")))"


def risk_inputs() -> list[tuple[str, str, str]]:
    """(name, kind or text, expression over v_fit_frame) of the inputs of the risk models, in order. The categories are those
    of the supplied customers, who all have them."""
    numbers = [(c, "", f"(({c}) - m_{c}) / s_{c}") for c in NUMERIC_FEATURES]
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    texts = {"gender": ["F", "M"], "race": segments, "ethnicity": ["hispanic", "nonhispanic"]}
    return numbers + [(c, v, f"({c} = '{v}')::INTEGER::DOUBLE") for c in CATEGORICAL_FEATURES for v in texts[c]]


def boosted_steps(leaves: int = 8, bins: int = 32) -> dict[str, str]:
    """Views that grow one tree on v_fit_training, best gain first: per step the gains of all cuts of all leaves, the best
    of them, and the rows' leaves after it. At the base score every probability is a half."""
    inputs = range(len(risk_inputs()))
    fractions = [i / bins for i in range(1, bins)]
    long = " UNION ALL ".join(f"SELECT encounter_id, {i} AS feature, i{i} AS x FROM v_fit_training" for i in inputs)
    views = {
        "v_fit_long": long,
        "v_fit_edges": f"""
            SELECT feature, unnest(list_distinct(quantile_cont(x, {fractions}))) AS edge FROM v_fit_long GROUP BY feature""",
        "v_fit_bins": """
            SELECT l.encounter_id, l.feature, count(e.edge) AS bin
            FROM v_fit_long l LEFT JOIN v_fit_edges e ON e.feature = l.feature AND e.edge < l.x GROUP BY ALL""",
        "v_fit_cuts": """
            SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS bin FROM v_fit_edges""",
        "v_fit_leaf_0": "SELECT encounter_id, w * (0.5 - readmitted_30d) AS g, w / 4 AS h, '' AS leaf FROM v_fit_training",
    }
    for k in range(leaves - 1):
        views[f"v_fit_best_{k}"] = f"""
            SELECT * FROM (
              SELECT leaf, feature, bin, nl, n - nl AS nr,
                gl * gl / hl + (g - gl) * (g - gl) / (h - hl) - g * g / h AS gain, hl, h - hl AS hr
              FROM (SELECT leaf, feature, bin, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(n) OVER u AS nl,
                  sum(g) OVER a AS g, sum(h) OVER a AS h, sum(n) OVER a AS n
                FROM (SELECT leaf, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n
                  FROM v_fit_leaf_{k} JOIN v_fit_bins USING (encounter_id) GROUP BY ALL)
                WINDOW u AS (PARTITION BY leaf, feature ORDER BY bin), a AS (PARTITION BY leaf, feature))
              WHERE n > nl)
            WHERE nl >= 20 AND nr >= 20 AND hl >= 0.001 AND hr >= 0.001 AND gain > 1e-9
            ORDER BY round(gain, 7) DESC, leaf, feature, bin LIMIT 1"""
        views[f"v_fit_leaf_{k + 1}"] = f"""
            SELECT l.encounter_id, l.g, l.h,
              CASE WHEN l.leaf = b.leaf THEN l.leaf || CASE WHEN x.bin <= b.bin THEN '0' ELSE '1' END ELSE l.leaf END AS leaf
            FROM v_fit_leaf_{k} l CROSS JOIN v_fit_best_{k} b
              JOIN v_fit_bins x ON x.encounter_id = l.encounter_id AND x.feature = b.feature"""
    return views


def model_views() -> dict[str, str]:
    is_test = f"{_bits('split', '{}')} / 4294967296.0::DOUBLE < {{}}"
    by_features = ", ".join(PAIR_INPUTS)
    weight = "n * total / (2.0::DOUBLE * sum(n) OVER (PARTITION BY is_match))"
    training = is_test.format("patient_id", 0.25)
    number = lambda c: f"coalesce({c}::DOUBLE, median({c}::DOUBLE) FILTER (NOT is_test) OVER ())"
    text = lambda c: f"coalesce({c}, mode({c}) FILTER (NOT is_test) OVER ())"
    moments = ", ".join(
        f"avg({c}) FILTER (NOT is_test) OVER () AS m_{c}, stddev_pop({c}) FILTER (NOT is_test) OVER () AS s_{c}"
        for c in NUMERIC_FEATURES
    )
    return {
        "v_fit_counts": f"""
            SELECT {by_features}, is_match, {is_test.format("system_b_id", 0.3)} AS is_test, count(*) AS n
            FROM v_pair GROUP BY ALL""",
        "v_fit_pairs": f"""
            SELECT *, {weight} AS w FROM (SELECT *, sum(n) OVER () AS total FROM v_fit_counts WHERE NOT is_test)""",
        "v_fit_pair_model": newton("v_fit_pairs", PAIR_INPUTS, "is_match", "w"),
        "v_fit_pair_test": f"SELECT *, {_logistic(PAIR_INPUTS)} AS score FROM v_fit_counts, v_fit_pair_model WHERE is_test",
        "v_fit_best": f"""
            SELECT system_b_id, patient_id AS matched_patient_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY system_b_id ORDER BY score DESC, patient_id) AS rn
              FROM (SELECT *, {_logistic(PAIR_INPUTS)} AS score FROM v_pair, v_fit_pair_model))
            WHERE rn = 1 AND score >= 0.5""",
        "v_fit_frame": f"""
            SELECT *, CASE WHEN NOT is_test THEN count(*) FILTER (NOT is_test) OVER ()
                / (2.0::DOUBLE * count(*) FILTER (NOT is_test) OVER (PARTITION BY readmitted_30d)) END AS w, {moments}
            FROM (SELECT encounter_id, readmitted_30d, is_test, {", ".join(f"{number(c)} AS {c}" for c in NUMERIC_FEATURES)},
                {", ".join(f"{text(c)} AS {c}" for c in CATEGORICAL_FEATURES)}
              FROM (SELECT *, {training} AS is_test FROM v_frame))""",
        "v_fit_inputs": "SELECT encounter_id, readmitted_30d, is_test, w, "
        + ", ".join(f"{e} AS i{i}" for i, (_, _, e) in enumerate(risk_inputs()))
        + " FROM v_fit_frame",
        "v_fit_training": "SELECT * FROM v_fit_inputs WHERE NOT is_test",
        "v_fit_risk_model": newton("v_fit_training", [f"i{i}" for i in range(len(risk_inputs()))], "readmitted_30d", "w"),
    }


# -- models and scoring ------------------------------------------------------------------------


def scoring() -> dict[str, str]:
    numbers, texts = NUMERIC_FEATURES, CATEGORICAL_FEATURES
    filled_number = {c: f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM v_frame))" for c in numbers}
    filled_text = {
        c: f"coalesce({c}, (SELECT arg_min({c}, (-n, {c})) FROM (SELECT {c}, count(*) AS n FROM v_frame "
        f"WHERE {c} IS NOT NULL GROUP BY {c})))"
        for c in texts
    }
    scaled = ", ".join(
        f"round(({e} - (SELECT avg({e}) FROM v_frame)) / (SELECT stddev_pop({e}) FROM v_frame), 6) AS {c}"
        for c, e in filled_number.items()
    )
    one_hot = " UNION ALL ".join(
        f"""SELECT encounter_id, '{c}' AS feature, slot FROM (SELECT encounter_id, {e} AS v FROM v_frame)
            JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT DISTINCT {e} AS v FROM v_frame))
            USING (v)"""
        for c, e in filled_text.items()
    )
    inputs = risk_inputs()
    return {
        "pair_model_weights": f"""
            SELECT unnest({PAIR_INPUTS}) AS feature, unnest(list_transform(b[2:], lambda v: round(v, 3) + 0.0)) AS weight
            FROM v_fit_pair_model""",
        "pair_model_metrics": """
            SELECT CAST((SELECT sum(n) FROM v_fit_counts) AS BIGINT) AS candidate_pairs_total,
              CAST(c AS BIGINT) AS candidate_pairs_test, round_even(tp / m, 4)::DOUBLE AS test_precision,
              round_even(tp / t, 4)::DOUBLE AS test_recall, round_even(2 * tp / (m + t), 4)::DOUBLE AS test_f1
            FROM (SELECT sum(n) AS c, sum(n) FILTER (score >= 0.5 AND is_match = 1)::DOUBLE AS tp,
                sum(n) FILTER (score >= 0.5)::DOUBLE AS m, sum(n) FILTER (is_match = 1)::DOUBLE AS t FROM v_fit_pair_test)""",
        "fitted_best_match": "SELECT system_b_id, matched_patient_id, round(score, 6) AS score FROM v_fit_best",
        "fitted_best_match_eval": linking()["best_match_eval"].replace("v_best", "v_fit_best"),
        "risk_scores": f"""
            SELECT encounter_id, round_even({_logistic([f"i{i}" for i in range(len(inputs))])}, 4)::DOUBLE AS score
            FROM v_fit_inputs, v_fit_risk_model""",
        "boosted_splits": " UNION ALL ".join(
            f"""SELECT {k} AS step, leaf AS path, {[c + (f"={v}" if v else "") for c, v, _ in inputs]}[b.feature + 1] AS feature,
              round(edge, 6) AS threshold, round(gain, 4) AS gain, nl::BIGINT AS n_left, nr::BIGINT AS n_right
            FROM v_fit_best_{k} b JOIN v_fit_cuts c ON c.feature = b.feature AND c.bin = b.bin"""
            for k in range(7)
        ),
        "prepared_vector": " UNION ALL ".join(
            f"SELECT encounter_id, {i} AS position, round(i{i}, 6) + 0.0 AS value FROM v_fit_inputs WHERE NOT is_test"
            for i in range(len(inputs))
        ),
        "impute_values": "SELECT encounter_id, "
        + ", ".join(
            f"round({e}, 6) AS {c}" if c == "age_at_encounter" else f"{e} AS {c}"
            for c, e in (filled_number | filled_text).items()
        )
        + " FROM v_frame",
        "scale_values": f"SELECT encounter_id, {scaled} FROM v_frame",
        "one_hot_values": one_hot,
        "match_scores": "SELECT system_b_id, round(score, 6) AS score, score >= 0.5 AS is_match FROM v_request",
        "match_log": """
            SELECT 'match' AS kind, a_name || ' <-> ' || b_name AS input_summary, round(score, 6) AS score
            FROM v_request""",
        "risk_log": """
            SELECT 'risk' AS kind, concat('age=', coalesce(CAST(CAST(floor(age_at_encounter) AS BIGINT) AS VARCHAR), 'None'),
                ', prior_inpatient=', prior_inpatient_count) AS input_summary,
              round(prior_inpatient_count / (prior_encounter_count + 1)::DOUBLE, 6) AS score
            FROM v_frame""",
        "prediction_summary": """
            SELECT kind, count(*) AS n, round(avg(score), 6) AS avg_score, round(min(score), 6) AS min_score,
              round(max(score), 6) AS max_score
            FROM v_log GROUP BY kind""",
        "recent_predictions": """
            SELECT id, kind, input_summary, round(score, 6) AS score, CAST(created_at AS VARCHAR) AS created_at
            FROM v_log ORDER BY id DESC LIMIT 25""",
        "logged_predictions": "SELECT id, kind, input_summary, round(score, 6) AS score, CAST(created_at AS VARCHAR) AS created_at FROM v_logged",
        "logged_summary": """
            SELECT kind, count(*) AS n, round(avg(score), 6) AS avg_score, round(min(score), 6) AS min_score,
              round(max(score), 6) AS max_score
            FROM v_log GROUP BY kind""",
        "logged_recent": """
            SELECT id, kind, input_summary, round(score, 6) AS score, CAST(created_at AS VARCHAR) AS created_at
            FROM v_logged ORDER BY id DESC LIMIT 25""",
        "match_rejects": "SELECT * FROM (SELECT system_b_id, concat_ws(', ', "
        + ", ".join(
            f"CASE WHEN {side}.{c} IS NULL THEN 'record_{side}.{c}' END" for side in "ab" for c in ("first", "last", "dob", "zip")
        )
        + """) AS reason FROM v_truth JOIN v_person_a a ON a.patient_id = true_patient_id JOIN v_b b USING (system_b_id))
            WHERE reason <> ''""",
        "best_match_by_town": """
            SELECT system_b_id, matched_patient_id, round(score, 6) AS score
            FROM (SELECT *, row_number() OVER (PARTITION BY system_b_id ORDER BY score DESC, matched_patient_id) AS rn
              FROM (SELECT system_b_id, a.patient_id AS matched_patient_id,
                  round(1 / (1 + exp(-(-12.0
                    + jaro_winkler_similarity(lower(coalesce(a.first, 'nan')), lower(coalesce(b.first, 'nan'))) * 6.0
                    + jaro_winkler_similarity(lower(coalesce(a.last, 'nan')), lower(coalesce(b.last, 'nan'))) * 7.0
                    + jaro_winkler_similarity(town_a, town_b) * 2.0)::DOUBLE)), 9) AS score
                FROM (SELECT *, CASE WHEN true_patient_id::BIGINT % 10 = 0 THEN upper(town) ELSE town END AS town_b
                    FROM v_b JOIN v_truth USING (system_b_id) JOIN v_town ON v_town.patient_id = true_patient_id) b
                  JOIN (SELECT v_person_a.*, town AS town_a FROM v_person_a JOIN v_town USING (patient_id)) a
                    ON lower(town_a) = lower(town_b) AND substr(coalesce(a.zip, ''), 1, 3) = substr(coalesce(b.zip, ''), 1, 3)))
            WHERE rn = 1 AND score >= 0.5""",
    }


def scoring_views() -> dict[str, str]:
    return {
        "v_town": """
            SELECT CAST(c_custkey AS VARCHAR) AS patient_id, substr(c_mktsegment, 1, 4) || (c_custkey % 5) AS town
            FROM customer""",
        "v_logged": """
            SELECT row_number() OVER (ORDER BY id % 3 <> 0, created_at, v_log.id) AS id, kind, input_summary, score, created_at
            FROM v_log""",
        "v_frame": temporal()["training_frame"].replace("round(date_diff", "(date_diff").replace("/ 365.25, 6)", "/ 365.25)"),
        "v_request": """
            SELECT p.system_b_id, score, concat_ws(' ', a.first, a.last) AS a_name, concat_ws(' ', b.first, b.last) AS b_name
            FROM (SELECT *, 1 / (1 + exp(-(-12.0 + first_sim * 6.0 + last_sim * 7.0 + zip_sim * 2.0
                + dob_year_match * 0.5 + ssn_agree * 5.0 + ssn_both_present * -1.0)::DOUBLE)) AS score
              FROM (SELECT b.system_b_id, a.patient_id,
                  jaro_winkler_similarity(lower(a.first), lower(b.first)) AS first_sim,
                  jaro_winkler_similarity(lower(a.last), lower(b.last)) AS last_sim,
                  jaro_winkler_similarity(a.zip, b.zip) AS zip_sim,
                  CASE WHEN substr(a.dob, 1, 4) = substr(b.dob, 1, 4) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dob_year_match,
                  CASE WHEN a.ssn <> '' AND b.ssn <> '' AND a.ssn = b.ssn THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ssn_agree,
                  CASE WHEN a.ssn <> '' AND b.ssn <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ssn_both_present
                FROM v_truth t JOIN v_person_a a ON a.patient_id = t.true_patient_id
                  JOIN v_b b ON b.system_b_id = t.system_b_id
                WHERE a.first IS NOT NULL AND a.last IS NOT NULL AND a.dob IS NOT NULL AND a.zip IS NOT NULL
                  AND b.first IS NOT NULL AND b.last IS NOT NULL AND b.dob IS NOT NULL AND b.zip IS NOT NULL)) p
              JOIN v_person_a a ON a.patient_id = p.patient_id JOIN v_b b ON b.system_b_id = p.system_b_id""",
    }


def all_sql() -> dict[str, str]:
    same = {
        "loaded_encounters": "fact_encounter",
        "deterministic_eval_from_files": "deterministic_eval",
        "saved_model_scores": "risk_scores",
        "streamed_match_log": "match_log",
    }
    extra = {**cohort_views(), **linkage_views(), **evaluation_views(), **scoring_views(), **model_views(), **boosted_steps()}
    groups = (temporal(), linking(), evaluation(), warehouse(), scoring())
    bodies = {name: sql for group in groups for name, sql in group.items()}
    # What went through files, a saved model or a stream must come out as it would directly.
    bodies |= {name: bodies[other] for name, other in same.items()}
    return {name: with_views(sql, extra) for name, sql in bodies.items()}
