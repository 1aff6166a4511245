"""Fact rows, replacement by key, lookups with an unknown member, corrections audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casting import lenient_date, load_double, load_int
from ..schema import (
    AUDITED,
    CORRECTION,
    EMPLOYER_COLUMNS,
    KEY,
    MEASURES,
    PERIOD,
    UNKNOWN_MEMBER,
    UNKNOWN_MEMBER_NAME,
)
from .dedupe import last_per_key
from .history import differs


def typed_returns(rows: DataFrame, batch_date: Column | None = None) -> DataFrame:
    """Canonical text rows to stored types; a bad value becomes null."""
    batch_date = lenient_date(F.col("batch_date")) if batch_date is None else batch_date
    year = F.col(PERIOD) if dict(rows.dtypes)[PERIOD] == "int" else load_int(F.col(PERIOD))
    return rows.select(
        KEY,
        year.alias(PERIOD),
        "employer_id",
        lenient_date(F.col("filing_date")).alias("filing_date"),
        batch_date.alias("batch_date"),
        "record_type",
        *[load_double(F.col(m)).alias(m) for m in MEASURES],
        F.coalesce(F.col("record_type") == CORRECTION, F.lit(False)).alias("is_corrected"),
        "batch_seq",
    )


def lookup_or_unknown(
    df: DataFrame, members: DataFrame, key: str, unknown: str = UNKNOWN_MEMBER
) -> DataFrame:
    """Replace keys without a member by the unknown member.

    `members` has unique keys, and only the keys travel. Given a stored table, Spark
    knows its size: a small one is broadcast; otherwise both sides are shuffled and
    adaptive execution splits the partition of a hot (or null) key of `df`. No other
    step sits between the shuffles and the join, which would rule that out.
    """
    known = members.select(F.col(key).alias("_member"))
    joined = df.join(known, F.col(key) == F.col("_member"), "left")
    return joined.select(
        *[
            F.coalesce("_member", F.lit(unknown)).alias(c) if c == key else F.col(c)
            for c in df.columns
        ]
    )


def with_unknown_member(employers: DataFrame) -> DataFrame:
    """The employer dimension: six stored columns plus the row for "no employer".

    Identifiers come out unique. Of several records with one identifier the last by
    `pos` is kept (without that column, the smallest), and the row for "no employer"
    comes before any record that claims its identifier. `superseded_members` lists the
    others.
    """
    return _ranked_members(employers).where("_place = 1").select(*EMPLOYER_COLUMNS)


def superseded_members(employers: DataFrame) -> DataFrame:
    """Records that `with_unknown_member` leaves out because of a repeated identifier."""
    return _ranked_members(employers).where("_place > 1").select(*EMPLOYER_COLUMNS)


def _ranked_members(employers: DataFrame) -> DataFrame:
    key, *others = EMPLOYER_COLUMNS
    order = [F.desc("pos")] if "pos" in employers.columns else []
    stored = employers.select(
        F.lit(1).alias("_rank"),
        *[c for c in EMPLOYER_COLUMNS if c != "employee_count"],
        F.col("employee_count").try_cast("int").alias("employee_count"),
        *(["pos"] if order else []),
    )
    sentinel = employers.sparkSession.range(1).select(
        F.lit(0).alias("_rank"),
        F.lit(UNKNOWN_MEMBER).alias(key),
        F.lit(UNKNOWN_MEMBER_NAME).alias("company_name"),
        *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns[3:]],
    )
    place = Window.partitionBy(key).orderBy("_rank", *order, *others)
    return stored.unionByName(sentinel).withColumn("_place", F.row_number().over(place))


def replace_by_key(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], seq: str | None = None
) -> DataFrame:
    """Delete the target rows whose key is in `rows`, then add `rows`.

    With `seq`, a target row from a later batch stays and the incoming row is dropped.
    """
    if seq:
        newer = target.select(*keys, F.col(seq).alias("_newer"))
        batch = rows.select(*keys, seq)
        stale = newer.join(batch, list(keys)).where(F.col("_newer") > F.col(seq)).select(*keys)
        rows = rows.join(stale, list(keys), "left_anti").select(*rows.columns)
    kept = target.join(rows.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(rows.select(*target.columns))


def latest_facts(
    returns: DataFrame, keys: Sequence[str] = (KEY, PERIOD), seq: str = "batch_seq"
) -> DataFrame:
    """State after replacing by key batch after batch: the last row of each key."""
    return last_per_key(returns, keys, [seq])


def version_totals(facts: DataFrame, link: Sequence[str] = (KEY, "taxpayer_sk")) -> DataFrame:
    """Facts counted and summed per version (`link`).

    Money is summed as decimals, so sums can be added up and taken back in any order.
    """
    tax, income = (F.col(c).try_cast("decimal(28,6)") for c in ("tax_payable_sgd", "annual_income_sgd"))
    return facts.groupBy(*link).agg(
        F.count(F.lit(1)).alias("num_returns"),
        F.sum(tax).alias("tax_payable"),
        F.count(tax).alias("num_taxes"),
        F.sum(income).alias("annual_income"),
        F.count(income).alias("num_incomes"),
    )


SUMS = ("num_returns", "tax_payable", "num_taxes", "annual_income", "num_incomes")


def add_totals(totals: DataFrame, link: Sequence[str] = (KEY, "taxpayer_sk")) -> DataFrame:
    """Totals of equal versions added up; versions that have lost all their facts go."""
    kinds = dict(totals.dtypes)
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in SUMS]
    return totals.groupBy(*link).agg(*sums).where("num_returns <> 0")


def totals_change(replaced: DataFrame, written: DataFrame) -> DataFrame:
    """What a load changes in the totals: facts it replaces are taken back, those it
    writes are added. Only those rows are read."""
    back, added = version_totals(replaced), version_totals(written)
    back = back.select(KEY, "taxpayer_sk", *[(-F.col(c)).cast(back.schema[c].dataType).alias(c) for c in SUMS])
    both = back.unionByName(added).groupBy(KEY, "taxpayer_sk").agg(*[F.sum(c).cast(added.schema[c].dataType).alias(c) for c in SUMS])
    return both.where(" OR ".join(f"coalesce({c}, 0) <> 0" for c in SUMS))


def audit_build(
    returns: DataFrame,
    keys: Sequence[str] = (KEY, PERIOD),
    measures: Sequence[str] = AUDITED,
    seq: str = "batch_seq",
    record_type: str = "record_type",
    corrected_at: str = "batch_date",
    seeds: DataFrame | None = None,
    logged: DataFrame | None = None,
) -> DataFrame:
    """Values overwritten by corrections, from the whole batch log in one pass.

    `returns` holds one typed row per (key, seq). The fact a correction overwrites is
    the row before it; it is logged if a measure differs, once per key and set of
    old values. Both windows partition by the key, so there is one shuffle, over at
    most one row per key and batch.

    `seeds` are stored facts, older than the log and at most one per key, that the log's
    first row of a key overwrites; what `logged` holds already isn't returned.
    """
    by_key = Window.partitionBy(*keys).orderBy(seq)
    old = [f"old_{m}" for m in measures]
    rows = returns.select(*keys, seq, record_type, corrected_at, *measures)
    if seeds is not None:
        none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (record_type, corrected_at)]
        rows = rows.unionByName(seeds.select(*keys, seq, *none, *measures))
    overwritten = (
        rows.withColumn("_old", F.lag(F.struct(*measures)).over(by_key))
        .where(
            (F.col(record_type) == CORRECTION)
            & F.col("_old").isNotNull()
            & differs([(F.col(m), F.col(f"_old.{m}")) for m in measures])
        )
        .select(
            *keys,
            F.col(corrected_at).alias("corrected_at"),
            *[F.col(f"_old.{m}").alias(o) for m, o in zip(measures, old)],
            seq,
        )
    )
    once = Window.partitionBy(*keys, *old).orderBy(seq)
    found = overwritten.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    return _not_logged(found, logged, keys, old) if logged is not None else found


def _not_logged(found: DataFrame, logged: DataFrame, keys: Sequence[str], old: Sequence[str]) -> DataFrame:
    """Rows whose key and old values the log doesn't hold. Of a long log, only the
    entries of the keys at hand take part."""
    known = logged.join(found.select(*keys), list(keys), "left_semi").select(
        *[F.col(c).alias(f"_{c}") for c in [*keys, *old]]
    )
    return found.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, *old]], "left_anti")


def audit_apply(
    facts: DataFrame,
    rows: DataFrame,
    logged: DataFrame,
    keys: Sequence[str] = (KEY, PERIOD),
    measures: Sequence[str] = AUDITED,
    record_type: str = "record_type",
    corrected_at: str = "batch_date",
) -> DataFrame:
    """Values the corrections among `rows` are about to overwrite in `facts` and that
    are not logged yet."""
    old = [f"old_{m}" for m in measures]
    corrections = rows.where(F.col(record_type) == CORRECTION).select(
        *keys, F.col(corrected_at).alias("corrected_at"), *measures
    )
    before = facts.select(*keys, *[F.col(m).alias(o) for m, o in zip(measures, old)])
    overwritten = (
        before.join(corrections, list(keys))
        .where(differs([(F.col(m), F.col(o)) for m, o in zip(measures, old)]))
        .select(*keys, "corrected_at", *old)
    )
    # Of a long log, only the entries of the corrected keys take part.
    known = logged.join(corrections.select(*keys), list(keys), "left_semi").select(
        *[F.col(c).alias(f"_{c}") for c in [*keys, *old]]
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, *old]]
    return overwritten.join(known, same, "left_anti")
