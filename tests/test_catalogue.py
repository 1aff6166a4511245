"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

from catalog import compare, oracle, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, con, name):
    outcome, _ = compare.compare(spark, FOLDER, name, con)
    assert outcome.startswith("ok"), outcome


def test_batch_files_derive_the_log_once(spark, tmp_path, monkeypatch):
    """Each batch file is written from the derived log's own split; the log is not
    derived again for every batch."""
    from pyspark.sql import functions as F

    from histlake.schema import CANONICAL_COLUMNS

    derived = spark.sparkContext.accumulator(0)

    def counted(value):
        derived.add(1)
        return value

    tag = F.udf(counted, "string")

    def log(spark, sf, months=6):
        rows = spark.range(40).selectExpr(
            *[f"CAST(id AS STRING) AS {c}" for c in CANONICAL_COLUMNS if c != "batch"],
            "concat('day', id % 4 + 1) AS batch", "CAST(id % 4 + 1 AS INT) AS batch_seq", "id AS row_pos",
        )
        return rows.withColumn("taxpayer_id", tag("taxpayer_id"))

    monkeypatch.setattr(queries, "returns_log", log)
    folder = str(tmp_path / "in")
    queries.write_batches(spark, "unused", folder, 6)
    assert derived.value == 40
    day3 = spark.read.csv(f"{folder}/individual_tax_returns_day3.csv", header=True)
    assert sorted(int(r.taxpayer_id) for r in day3.collect()) == list(range(2, 40, 4))
    assert day3.columns == [*reversed(CANONICAL_COLUMNS), "batch"]
