"""Queries over the finished warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_away
from ..operators.facts import version_totals
from ..schema import KEY, PERIOD, SUMMARY_DIMENSIONS

MAX_LIMIT = 500

# Columns of the published reports.
PROFILE = [
    "taxpayer_id",
    "nric",
    "full_name",
    "occupation",
    "residential_status",
    "postal_code",
    "housing_type",
]
RETURNS = [
    "assessment_year",
    "filing_date",
    "annual_income_sgd",
    "chargeable_income_sgd",
    "tax_payable_sgd",
    "tax_paid_sgd",
    "employer_id",
    "is_corrected",
]


def grouped_totals(
    facts: DataFrame,
    dim: DataFrame,
    on: Column | list[str],
    fact_key: Sequence[str],
    by: str,
    total: Column,
    average: Column,
) -> DataFrame:
    """`(group_value, n, total, avg_sum, avg_n)` of facts by a dimension attribute.

    Facts are summed per foreign key before the join. The sums shuffle by the key the
    join needs anyway, map-side partial sums dissolve hot keys, and the join handles
    one row per key instead of every fact.
    """
    per_key = facts.groupBy(*fact_key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(total).alias("_total"),
        F.sum(average).alias("_avg_sum"),
        F.count(average).alias("_avg_n"),
    )
    return _by_group(per_key.join(dim, on), by)


def _by_group(per_key: DataFrame, by: str) -> DataFrame:
    return per_key.groupBy(F.col(by).alias("group_value")).agg(
        F.sum("_n").alias("n"),
        F.sum("_total").alias("total"),
        F.sum("_avg_sum").alias("avg_sum"),
        F.sum("_avg_n").alias("avg_n"),
    )


def page(df: DataFrame, order: Sequence[Column], limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of a sorted result; Spark keeps `limit + offset` rows per task."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return df.orderBy(*order).offset(offset).limit(limit)


def summary(
    facts: DataFrame,
    dim: DataFrame,
    by: str,
    limit: int | None = 50,
    offset: int = 0,
    link: Sequence[str] = ("taxpayer_sk",),
) -> DataFrame:
    """Returns, total payable and average income per group, highest total first.

    The group value breaks ties so that pages do not overlap; without `limit` all
    groups are returned. Money is summed as decimals, so no order of rows changes a
    cent. `link` names the columns that tie a fact to its version.
    """
    return summary_of_totals(version_totals(facts, link), dim, by, limit, offset, link)


def summary_of_totals(
    totals: DataFrame,
    dim: DataFrame,
    by: str,
    limit: int | None = 50,
    offset: int = 0,
    link: Sequence[str] = (KEY, "taxpayer_sk"),
) -> DataFrame:
    """`summary` from the totals per version (`version_totals`): one row per version is
    read instead of every fact."""
    if by not in SUMMARY_DIMENSIONS:
        raise ValueError(f"group by one of {SUMMARY_DIMENSIONS}, not {by!r}")
    per_version = totals.select(
        *link,
        F.col("num_returns").alias("_n"),
        F.when(F.col("num_taxes") > 0, F.col("tax_payable")).alias("_total"),
        F.col("annual_income").alias("_avg_sum"),
        F.col("num_incomes").alias("_avg_n"),
    )
    totals = _by_group(per_version.join(dim.select(*link, by), list(link)), by)
    report = totals.select(
        "group_value",
        F.col("n").alias("num_returns"),
        round_half_away(F.col("total").cast("double")).alias("total_tax_payable"),
        round_half_away(F.try_divide(F.col("avg_sum").cast("double"), F.col("avg_n"))).alias("avg_annual_income"),
    )
    order = [F.col("total_tax_payable").desc_nulls_last(), F.col("group_value").asc_nulls_last()]
    if limit is None:
        return report.orderBy(*order)
    return page(report, order, limit, offset)


def profiles(dim: DataFrame, ids: DataFrame) -> DataFrame:
    """Current profile of every id in `ids`; unknown ids are absent."""
    return (
        dim.where("is_current")
        .join(ids.select(KEY).distinct(), KEY, "left_semi")
        .select(*PROFILE)
    )


def profile(dim: DataFrame, taxpayer_id: str) -> DataFrame:
    """Current profile of one taxpayer: one row, or none for an unknown id."""
    return dim.where((F.col(KEY) == taxpayer_id) & F.col("is_current")).select(*PROFILE)


def require_profile(dim: DataFrame, taxpayer_id: str):
    """The profile row; an unknown id is an error."""
    row = profile(dim, taxpayer_id).first()
    if row is None:
        raise KeyError(f"taxpayer {taxpayer_id} not found")
    return row


def returns_of(facts: DataFrame, taxpayer_id: str) -> DataFrame:
    return facts.where(F.col(KEY) == taxpayer_id).select(*RETURNS).orderBy(PERIOD)


def history_of(dim: DataFrame, taxpayer_id: str) -> DataFrame:
    return (
        dim.where(F.col(KEY) == taxpayer_id)
        .select("taxpayer_sk", "occupation", "postal_code", "valid_from", "valid_to", "is_current")
        .orderBy("valid_from", "taxpayer_sk")
    )


def fact_sample(facts: DataFrame, limit: int = 5) -> DataFrame:
    return (
        facts.select(KEY, PERIOD, "employer_id", "tax_payable_sgd", "is_corrected")
        .orderBy(KEY, PERIOD)
        .limit(limit)
    )


def metric_listing(metrics: DataFrame) -> DataFrame:
    return metrics.select("batch", "domain", "score", "passing_count", "total_count").orderBy(
        "batch", "domain"
    )


def audit_listing(corrections: DataFrame) -> DataFrame:
    return corrections.select(KEY, PERIOD, "old_tax_payable_sgd")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table: `(table_name, num_rows)`."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result
