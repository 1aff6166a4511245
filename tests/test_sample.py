"""Known totals of a sample of three batches and thirty reference records."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from histlake.operators.quality import apply_rules, score
from histlake.plans import serving
from histlake.plans.warehouse import Warehouse
from histlake.sources.batches import list_batches, read_log
from histlake.sources.employers import count_issues, parse_employers, read_json_array

FOLDER = os.environ.get("HISTLAKE_SAMPLE_DIR", "")
pytestmark = pytest.mark.skipif(not FOLDER, reason="HISTLAKE_SAMPLE_DIR not set")


def test_totals(spark, tmp_path):
    employers = parse_employers(read_json_array(spark, f"{FOLDER}/employer/employers.json"))
    assert tuple(count_issues(employers).first()) == (30, 4)
    log = read_log(spark, list_batches(spark, f"{FOLDER}/individual"))
    passing = {
        (r.batch, r.domain): (r.passing_count, r.score) for r in score(apply_rules(log), by=["batch"]).collect()
    }
    assert passing == {
        ("day1", "completeness"): (126, 88.11),
        ("day1", "validity"): (102, 71.33),
        ("day1", "accuracy"): (112, 78.32),
        ("day2", "completeness"): (17, 94.44),
        ("day2", "validity"): (16, 88.89),
        ("day2", "accuracy"): (18, 100.0),
        ("day3", "completeness"): (10, 100.0),
        ("day3", "validity"): (10, 100.0),
        ("day3", "accuracy"): (10, 100.0),
    }
    w = Warehouse(spark, str(tmp_path))
    w.load_employers(employers)
    w.backfill(f"{FOLDER}/individual")
    counts = {r.table_name: r.num_rows for r in serving.table_counts(w.tables()).collect()}
    assert counts == {
        "dim_taxpayer": 166,
        "dim_employer": 31,
        "fact_tax_returns": 161,
        "agg_data_quality_metrics": 9,
        "fact_corrections": 3,
    }
    facts = w.table("fact_tax_returns").agg(
        F.count_if("is_corrected"),
        F.count_if(F.col("employer_id") == "UNKNOWN"),
        F.count_if(F.col("filing_date").isNull()),
        F.sum("tax_payable_sgd"),
    )
    assert tuple(facts.first()) == (5, 29, 31, 1145050.0)
    assert [tuple(r) for r in w.summary("residential_status").collect()] == [
        ("Resident", 157, 1014190.0, 72248.41),
        ("Non-Resident", 4, 130860.0, 169000.0),
    ]
    assert [tuple(r) for r in w.summary("occupation", 3).collect()] == [
        ("Director", 15, 123240.0, 90866.67),
        ("Manager", 17, 120300.0, 82647.06),
        ("Consultant", 16, 114005.0, 79937.5),
    ]
