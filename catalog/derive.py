"""Batch logs and reference records derived from the driver tables.

The driver tables hold no tax returns, so every order becomes one messy return of its
customer and every supplier one irregular employer record. `returns_log` here and
`LOG` in `oracle.py` are the same derivation in two dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.dedupe import last_per_key

FIRST_MONTH = 1995 * 12


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def returns_log(spark: SparkSession, sf: str, months: int = 6) -> DataFrame:
    """One text row per order, in batches of `months` months, with `row_pos`."""
    first = FIRST_MONTH // months
    base = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "CAST(floor(o_totalprice) AS BIGINT) AS p",
        "CAST(o_orderdate AS DATE) AS d",
        "o_orderstatus AS st",
        "o_orderpriority AS pr",
        f"CAST((year(o_orderdate) * 12 + month(o_orderdate) - 1) DIV {months} AS INT)"
        f" - {first} + 1 AS batch_seq",
    )
    numbers = base.selectExpr(
        "*",
        "CASE WHEN k % 31 = 0 THEN NULL WHEN k % 37 = 0 THEN concat(p, '.5') ELSE concat(p, '.0') END AS annual",
        "p % 20000 AS reliefs",
        "date_add(d, CAST(k % 400 AS INT)) AS filed",
    )
    return numbers.selectExpr(
        "CASE WHEN k % 211 = 0 THEN NULL ELSE concat('T', c) END AS taxpayer_id",
        "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'INVALID_NRIC'"
        " WHEN k % 53 = 0 THEN '  S0000001A  '"
        " ELSE concat('S', lpad(CAST(c % 10000000 AS STRING), 7, '0'), 'A') END AS nric",
        "concat('Customer ', c, CASE WHEN k % 3 = 0 THEN ' Jr' ELSE '' END) AS full_name",
        "CASE WHEN c % 2 = 0 THEN 'Single' ELSE 'Married' END AS filing_status",
        "CASE WHEN k % 101 = 0 THEN 'unknown'"
        " WHEN k % 97 = 0 THEN concat(year(d), '.0')"
        " WHEN k % 10 = 5 THEN CAST(year(d) - 1 AS STRING)"
        " ELSE CAST(year(d) AS STRING) END AS assessment_year",
        "CASE WHEN k % 17 = 0 THEN 'invalid-date' WHEN k % 19 = 0 THEN '2024-02-30'"
        " WHEN k % 23 = 0 THEN date_format(filed, 'yyyy/MM/dd')"
        " WHEN k % 29 = 0 THEN concat(' ', date_format(filed, 'yyyy-MM-dd'), ' ')"
        " ELSE date_format(filed, 'yyyy-MM-dd') END AS filing_date",
        "annual AS annual_income_sgd",
        "CAST(p - reliefs + CASE WHEN k % 7 = 0 THEN 1000 ELSE 0 END AS STRING)"
        " AS chargeable_income_sgd",
        "CAST(p DIV 10 AS STRING) AS tax_payable_sgd",
        "CASE WHEN k % 43 = 0 THEN 'n/a' ELSE CAST(p DIV 11 AS STRING) END AS tax_paid_sgd",
        "CAST(reliefs AS STRING) AS total_reliefs_sgd",
        "CAST(c % 4 AS STRING) AS number_of_dependents",
        "pr AS occupation",
        "CASE WHEN k % 5 = 0 THEN 'Non-Resident' ELSE 'Resident' END AS residential_status",
        "CASE WHEN c % 47 = 0 THEN 'BADPOST' ELSE lpad(CAST(c % 1000000 AS STRING), 6, '0') END"
        " AS postal_code",
        "CASE st WHEN 'F' THEN 'HDB 4-room' WHEN 'O' THEN 'Private Condo'"
        " ELSE 'Landed Property' END AS housing_type",
        "CASE WHEN k % 23 = 1 THEN '0' ELSE CAST(p DIV 5 AS STRING) END AS cpf_contributions_sgd",
        "CASE WHEN k % 59 = 0 THEN '1e3' ELSE '0' END AS foreign_income_sgd",
        "CASE WHEN k % 9 = 0 THEN NULL ELSE concat('EMP', p % 130) END AS employer_id",
        f"CASE WHEN batch_seq = 1 THEN NULL ELSE date_format(add_months(DATE'1995-01-01',"
        f" batch_seq * {months}), 'yyyy-MM-dd') END AS batch_date",
        "CASE WHEN batch_seq = 1 THEN 'new' WHEN k % 10 IN (0, 1, 2) THEN 'update' WHEN k % 10 IN (3, 4) THEN 'correction'"
        " WHEN k % 10 = 5 THEN 'late_arrival' ELSE 'new' END AS record_type",
        "concat('day', batch_seq) AS batch",
        "batch_seq",
        "k AS row_pos",
    )


def employer_records(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON record per supplier as `(pos, record)`, with every irregularity."""
    text = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS pos",
        """concat('{',
          CASE WHEN s_suppkey % 31 = 30 THEN ''
               WHEN s_suppkey % 37 = 36 THEN '"employer_id": "", '
               ELSE concat('"employer_id": "EMP', s_suppkey, '", ') END,
          '"company_name": "', s_name, '", ',
          CASE WHEN s_suppkey % 7 = 0 THEN '"uen": null, '
               WHEN s_suppkey % 11 = 0 THEN '"uen": "", '
               ELSE concat('"uen": "U', s_suppkey, '", ') END,
          '"industry": "N', s_nationkey, '", ',
          CASE WHEN s_suppkey % 3 = 1 THEN '"global_hq": "X", "subsidiary_of": {"a": 1}, ' ELSE '' END,
          CASE WHEN s_suppkey % 13 = 0 THEN '"employee_count": "many", '
               WHEN s_suppkey % 17 = 0 THEN '"employee_count": true, '
               WHEN s_suppkey % 19 = 0 THEN '"employee_count": null, '
               WHEN s_suppkey % 23 = 0 THEN ''
               WHEN s_suppkey % 29 = 0 THEN '"employee_count": 12.5, '
               WHEN s_suppkey % 5 = 0 THEN concat('"employee_count": " ', s_suppkey * 3, '", ')
               ELSE concat('"employee_count": ', s_suppkey * 3, ', ') END,
          '"address": "', s_nationkey, ' Road"}') AS text""",
    )
    return text.select("pos", F.parse_json("text").alias("record"))


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Last event of each user and day, with the day as batch."""
    events = table(spark, sf, "events").selectExpr(
        "user_id",
        "event_id",
        "ts",
        "CAST(ts AS DATE) AS d",
        "event_type",
        "value",
        "CAST(floor(value / 10) AS INT) AS attr",
        "CASE event_type WHEN 'error' THEN 'correction' WHEN 'signup' THEN 'late_arrival'"
        " ELSE 'update' END AS record_type",
        "datediff(CAST(ts AS DATE), DATE'2024-01-01') + 1 AS batch_seq",
    )
    return last_per_key(events, ["user_id", "batch_seq"], ["ts", "event_id"])
