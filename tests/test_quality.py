from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from histlake.functions.rules import Rule, present, tax_return_rules
from histlake.operators.quality import apply_rules, latest_quality, score

from .helpers import frame, returns


def flags(spark, rule: str, changes: list[dict]) -> list[bool]:
    df = apply_rules(frame(spark, returns(*changes))).orderBy("row_pos")
    (column,) = [c for c in df.columns if c.startswith(f"dq_{rule}_")]
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "rule, column, good, bad",
    [
        ("rule1", "nric", ["T7654321K", "whatever"], [None, "", "\t  "]),
        (
            "rule2",
            "nric",
            ["T7654321K", "S0000007Q", "F2468013B", " G1357924Z "],
            ["UNKNOWN", "T76543210", "T765432K", "7654321TK", "t7654321K", "", None, "aT7654321K"],
        ),
        (
            "rule3",
            "postal_code",
            ["520123", "000001", "999999"],
            ["52O123", "postal", "52012", "5201234", "", None],
        ),
        (
            "rule4",
            "filing_date",
            ["2024-03-11", "2024-7-9"],
            ["2024-00-10", "2025-02-29", "soon", "", None, "2022-12-31", "2024/03/11"],
        ),
        ("rule4", "assessment_year", ["2023", "2023.5"], ["2024", "year", None]),
        ("rule5", "chargeable_income_sgd", ["52500", "52500.0"], ["51500", "?", None]),
        ("rule5", "total_reliefs_sgd", ["11800"], ["", None, "1_1800"]),
        ("rule6", "cpf_contributions_sgd", ["9100", "0.25"], ["0", "-3", None, "none"]),
    ],
)
def test_rules(spark, rule, column, good, bad):
    outcome = flags(spark, rule, [{column: v} for v in good + bad])
    assert outcome == [True] * len(good) + [False] * len(bad)


def test_only_the_exact_status_owes_contributions(spark):
    states = ["Non-Resident", None, "Resident ", "Resident"]
    rows = [{"residential_status": s, "cpf_contributions_sgd": "0"} for s in states]
    assert flags(spark, "rule6", rows) == [True, True, True, False]


def test_blank_number_fails_two_domains(spark):
    row = apply_rules(frame(spark, returns({"nric": " "}))).first()
    assert (row.dq_completeness_pass, row.dq_validity_pass, row.dq_accuracy_pass) == (False, False, True)


def test_input_is_kept_and_flags_are_never_null(spark):
    df = frame(spark, returns({}, {c: None for c in ["nric", "filing_date", "assessment_year"]}))
    flagged = apply_rules(df)
    assert flagged.columns[: len(df.columns)] == df.columns
    assert flagged.count() == 2
    assert len(flagged.columns) == len(df.columns) + 9
    assert all(v is not None for r in flagged.collect() for v in r[len(df.columns) :])


def test_scores(spark):
    df = apply_rules(frame(spark, returns({}, {}, {}, {"postal_code": "52O123"})))
    got = {r.domain: (r.score, r.passing_count, r.total_count) for r in score(df).collect()}
    assert got == {
        "completeness": (100.0, 4, 4),
        "validity": (75.0, 3, 4),
        "accuracy": (100.0, 4, 4),
    }


def test_empty_input_scores_zero(spark):
    got = score(apply_rules(frame(spark, []))).collect()
    assert [(r.score, r.passing_count, r.total_count) for r in got] == [(0.0, 0, 0)] * 3


def test_score_ties_round_to_even(spark):
    rows = returns(*[{"postal_code": "520123" if i < 1 else "x"} for i in range(32)])
    got = score(apply_rules(frame(spark, rows)), domains=["validity"]).first()
    assert got.score == round(1 / 32 * 100, 2) == 3.12


def test_own_rules_and_domain_subset(spark):
    rules = [
        Rule("named", "completeness", lambda: present("full_name")),
        Rule("rich", "wealth", lambda: F.col("annual_income_sgd").try_cast("double") > 1e6),
    ]
    df = apply_rules(frame(spark, returns({}, {"annual_income_sgd": "x"})), rules)
    assert "dq_validity_pass" not in df.columns
    assert {r.domain for r in score(df).collect()} == {"completeness"}
    assert score(df, ["wealth", "accuracy"]).first().passing_count == 0


def test_patterns_are_parameters(spark):
    rules = tax_return_rules(postal_pattern="^[A-Z]+$", cpf_required_status="Visitor")
    df = apply_rules(
        frame(spark, returns({"postal_code": "ABC", "cpf_contributions_sgd": "0"})), rules
    )
    assert df.first().dq_rule3_postal_code_pass and df.first().dq_rule6_cpf_resident_pass


def test_latest_quality_breaks_ties_by_batch(spark):
    metrics = spark.createDataFrame(
        [("day1", "validity", 1.0, 1, 1, 5), ("day2", "validity", 2.0, 1, 1, 5), ("day9", "accuracy", 3.0, 1, 1, 1)],
        "batch string, domain string, score double, passing_count int, total_count int, computed_at int",
    )
    assert [(r.domain, r.batch) for r in latest_quality(metrics).collect()] == [
        ("accuracy", "day9"),
        ("validity", "day2"),
    ]
