from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from histlake.functions import (
    clean_text,
    lenient_date,
    load_double,
    load_int,
    round_half_away,
    round_half_even,
    rule_number,
    strict_date,
)

DATES = [
    "2024-03-11", "2024-3-5", "2024/03/15", "2024/3/5", " 2024-03-11 ", "2024-03-11 10:00:00",
    "2024-03-11T10:00:00", "2024-03-11abc", "2024-03-11 abc", "2024", "2024-03", "20240315",
    "2024 03 15", "2024\\03\\15", "2024-03/15", "202-01-01", "24-01-01", "2024-02-30",
    "2024-13-45", "invalid-date", "", "2024-003-05", "+2024-03-11", "2024-03-11 25:00",
    "9999-12-31", "1600-01-01", "2262-04-11", "2262-04-12", "1677-09-21", "1677-09-22",
    "2024-03-11\n", "\t2024-03-11", "2024-03-11Z", "0001-01-01", "2024-03-11 10",
    "2024-03-11 10:00:00+08", "2024-03-11 01:00:00+08", "2024-03-11 23:59:59.123456",
]
NUMBERS = [
    "12", "12.5", "12d", "12f", "12L", "1e3", "1E3", "1_000", "1__0", "_1", "1_", "1,000", " 12 ",
    "\t12", "12\n", "inf", "-inf", "+inf", "Infinity", "INF", "nan", "NaN", "", ".5", "5.", "+5",
    "--5", "1e", "1e400", "-1e400", "True", "-0", "1e-400", "infinit", "$5", "1_0.5", "  ", "+ 5",
    "1.0.0", "00012", "12 3", "-.5", "+.5e+2", ".", "-", "e5",
]
INTEGERS = NUMBERS + [
    "2023.0", "2023.5", "2022.5", "2023.6", "-2022.5", "-0.5", "0.5", "2147483647",
    "2147483647.4", "2147483647.5", "2147483648", "-2147483648", "-2147483648.5", "1e9", "1e10",
    "2.0225e3", "2023.49999999999999", "1e-3", "2023e-1", "20_23", "25e-1", "12345e-2",
]


def evaluate(spark, values, cast):
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", cast(F.col("v")).alias("r"))
    return {row.v: row.r for row in df.collect()}


def try_cast(value, target):
    return duckdb.execute(f"SELECT try_cast(? AS {target})", [value]).fetchone()[0]


def same(a, b):
    return str(a) == str(b) if a is not None and b is not None else a is b


def test_strict_date_follows_the_rule_parser(spark):
    for value, ours in evaluate(spark, DATES, strict_date).items():
        parsed = pd.to_datetime(pd.Series([value], dtype=object), format="%Y-%m-%d", errors="coerce")[0]
        assert ours == (None if pd.isna(parsed) else parsed.date()), repr(value)


def test_lenient_date_follows_the_loader(spark):
    for value, ours in evaluate(spark, DATES, lenient_date).items():
        assert ours == try_cast(value, "DATE"), repr(value)


def test_rule_number_follows_the_rule_parser(spark):
    for value, ours in evaluate(spark, NUMBERS, rule_number).items():
        parsed = pd.to_numeric(pd.Series([value], dtype=object), errors="coerce")[0]
        assert ours == (None if pd.isna(parsed) else float(parsed)), repr(value)


def test_load_double_follows_the_loader(spark):
    for value, ours in evaluate(spark, NUMBERS, load_double).items():
        assert same(ours, try_cast(value, "DOUBLE")), repr(value)


def test_load_int_follows_the_loader(spark):
    for value, ours in evaluate(spark, INTEGERS, load_int).items():
        assert ours == try_cast(value, "INTEGER"), repr(value)


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    casts = [strict_date, lenient_date, rule_number, load_double, load_int]
    assert list(df.select(*[c(F.col("v")) for c in casts]).first()) == [None] * 5


@pytest.mark.parametrize("value", [None, "", " ab ", "　x ", "\x1c\tx y\n", "   "])
def test_clean_text_strips_like_python(spark, value):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(clean_text(F.col("v"))).first()[0] == (value or "").strip()


def test_rounding_conventions(spark):
    values = [i / 1000 for i in range(0, 20000, 5)] + [i * 3.125 for i in range(33)] + [1.005, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", round_half_even(F.col("v")).alias("e"), round_half_away(F.col("v")).alias("a"))
    for r in rows.collect():
        assert r.e == round(r.v, 2)
        assert r.a == duckdb.execute("SELECT round(?::DOUBLE, 2)", [r.v]).fetchone()[0]
