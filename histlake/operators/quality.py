"""Rule flags, domain scores and the latest score per domain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import round_half_even
from ..functions.rules import Rule, domain_flag_column, tax_return_rules
from ..schema import DOMAINS


def apply_rules(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Append one boolean per rule and one per domain that has rules.

    A row passes a domain when it passes every rule of the domain. Rows are only
    flagged, never filtered or repaired.
    """
    rules = tax_return_rules() if rules is None else rules
    flagged = df.select(
        "*", *[F.coalesce(r.predicate(), F.lit(False)).alias(r.flag_column) for r in rules]
    )
    by_domain: dict[str, list[Column]] = {}
    for r in rules:
        by_domain.setdefault(r.domain, []).append(F.col(r.flag_column))
    return flagged.select(
        "*",
        *[
            reduce(lambda a, b: a & b, flags).alias(domain_flag_column(domain))
            for domain, flags in by_domain.items()
        ],
    )


def pass_counts(columns: Sequence[str], domains: Sequence[str] | None = None) -> list[Column]:
    """Aggregates: rows passing each domain that has a flag among `columns`, named like it.

    With the number of rows they are all a score needs, and they add up over parts of
    the data, so they can be taken while rows are written.
    """
    scored = [d for d in (DOMAINS if domains is None else domains) if domain_flag_column(d) in columns]
    return [F.coalesce(F.sum(F.col(domain_flag_column(d)).cast("bigint")), F.lit(0)).alias(d) for d in scored]


def score(
    validated: DataFrame, domains: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Percentage of rows passing each domain: `(by..., domain, score, passing_count,
    total_count)`.

    One aggregation serves all domains and groups; map-side partial sums leave one
    row per group and task to shuffle. Domains without a flag column are left out.
    Without `by`, an empty input scores 0.0.
    """
    counts = pass_counts(validated.columns, domains)
    totals = validated.groupBy(*by).agg(F.count(F.lit(1)).alias("total_count"), *counts)
    return scores_of_counts(totals, [d for d in totals.columns if d not in (*by, "total_count")], by)


def scores_of_counts(totals: DataFrame, domains: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`score` from counts: a column per domain and `total_count`, one row per group."""
    long = totals.select(
        *by,
        "total_count",
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("domain"), F.coalesce(F.col(d), F.lit(0)).alias("n")) for d in domains])
        ).alias("s"),
    )
    return long.select(*by, F.col("s.domain").alias("domain"), *_scored(F.col("s.n"), F.col("total_count")))


def _scored(passing: Column, total: Column) -> list[Column]:
    percent = passing.cast("double") / total * F.lit(100.0)
    value = F.when(total == 0, F.lit(0.0)).otherwise(round_half_even(percent))
    return [value.alias("score"), passing.alias("passing_count"), total.alias("total_count")]


def merged_scores(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score over all batches (or per group) from the counts that their loads stored,
    without reading any row of them."""
    sums = metrics.groupBy(*by, "domain").agg(F.sum("passing_count").alias("_passing"), F.sum("total_count").alias("_total"))
    return sums.select(*by, "domain", *_scored(F.col("_passing"), F.col("_total")))


def latest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group under `order`. The rank filter lets Spark drop all but
    one candidate per group and task before the shuffle, so a hot group is harmless.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_quality(metrics: DataFrame) -> DataFrame:
    """Most recent score of every domain; of equal times that of the batch loaded last.
    Without load numbers (`batch_seq`) the batch name decides."""
    order = "batch_seq" if "batch_seq" in metrics.columns else "batch"
    newest = latest_per_group(metrics, ["domain"], [F.desc("computed_at"), F.desc(order)])
    return newest.select(
        "domain", "score", "passing_count", "total_count", "batch", "computed_at"
    ).orderBy("domain")
