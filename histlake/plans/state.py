"""The warehouse as DataFrames: built from the whole log, or advanced by one batch."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casting import lenient_date
from ..operators.dedupe import batch_entities, batch_returns
from ..operators.facts import (
    audit_apply,
    audit_build,
    latest_facts,
    lookup_or_unknown,
    replace_by_key,
    totals_change,
    typed_returns,
    with_unknown_member,
)
from ..operators.history import asof_link, scd2_apply, scd2_build, scd2_extend
from ..operators.numbering import number_and_count
from ..schema import (
    AUDITED,
    DIM_EMPLOYER,
    DIM_TAXPAYER,
    FACT_CORRECTIONS,
    FACT_TAX_RETURNS,
    KEY,
    PERIOD,
    column_names,
)
from ..session import cut_lineage


@dataclass(frozen=True)
class State:
    """Tables of the warehouse. The taxpayer dimension is kept as two parts, because
    loading a batch rewrites current versions and only ever adds closed ones."""

    current: DataFrame
    closed: DataFrame
    employers: DataFrame
    facts: DataFrame
    corrections: DataFrame
    last_taxpayer_sk: int = 0
    last_correction_id: int = 0

    @property
    def versions(self) -> DataFrame:
        return self.current.unionByName(self.closed)


@dataclass(frozen=True)
class Step:
    """Result of one batch: the next state; the current versions and facts it wrote, of
    which each replaces the row of its key; and the versions it closed and values it
    logged, or None if there are none."""

    state: State
    versions: DataFrame
    facts: DataFrame
    totals: DataFrame
    closed: DataFrame | None
    corrections: DataFrame | None


def empty_state(spark: SparkSession, employers: DataFrame | None = None) -> State:
    def empty(ddl: str) -> DataFrame:
        return spark.createDataFrame([], ddl)

    return State(
        empty(DIM_TAXPAYER),
        empty(DIM_TAXPAYER),
        empty(DIM_EMPLOYER) if employers is None else with_unknown_member(employers),
        empty(FACT_TAX_RETURNS),
        empty(FACT_CORRECTIONS),
    )


def _facts(returns: DataFrame, versions: DataFrame, employers: DataFrame) -> DataFrame:
    # A key can hold any number of periods, hence `many_per_key`.
    linked = asof_link(returns, versions, "filing_date", "batch_seq", many_per_key=True)
    return lookup_or_unknown(linked, employers, "employer_id").select(
        *column_names(FACT_TAX_RETURNS)
    )


def rebuild(log: DataFrame, employers: DataFrame, order: str = "row_pos") -> State:
    """All tables from the whole batch log in one pass.

    `log` has the canonical columns, `batch_seq`, and `order`, the position within
    the batch. No batch loop: history and audit are windows over one row per key and
    batch, and a fact is the last row of its key.
    """
    dim, last_sk = number_and_count(build_versions(log, order), ["opened_seq", KEY], "taxpayer_sk")
    dim = dim.select(*column_names(DIM_TAXPAYER))
    returns = cut_lineage(typed_returns(batch_returns(log, order)))
    members = cut_lineage(with_unknown_member(employers))
    logged, last_id = number_and_count(audit_build(returns), ["batch_seq", KEY, PERIOD], "correction_id")
    return State(
        dim.where("is_current"),
        dim.where("NOT is_current"),
        members,
        _facts(latest_facts(returns), dim, members),
        logged.select(*column_names(FACT_CORRECTIONS)),
        last_sk,
        last_id,
    )


def build_versions(log: DataFrame, order: str = "row_pos") -> DataFrame:
    return scd2_build(batch_entities(log, order), order=order)


def build_facts(
    log: DataFrame, versions: DataFrame, employers: DataFrame, order: str = "row_pos"
) -> DataFrame:
    """The fact table with version numbers in place of surrogate keys.

    (key, version) identifies a version as well as its surrogate key does, and needs
    no numbering step.
    """
    numbered = versions.withColumn("taxpayer_sk", F.col("version").cast("bigint"))
    returns = typed_returns(batch_returns(log, order))
    members = cut_lineage(with_unknown_member(employers))
    return _facts(latest_facts(returns), numbered, members)


def build_corrections(log: DataFrame, order: str = "row_pos") -> DataFrame:
    return audit_build(typed_returns(batch_returns(log, order)))


def apply_batch(
    state: State,
    batch: DataFrame,
    batch_seq: int,
    batch_date: Column | str | None = None,
    order: str = "row_pos",
) -> Step:
    """Advance the state by one batch: history, then audit, then facts.

    `batch` holds canonical rows plus `order`. The result is a plan over `state`;
    the small per-batch parts are written out, so the plan does not grow with the
    number of rows already stored.
    """
    day = (
        lenient_date(F.lit(batch_date).cast("string"))
        if batch_date is None or isinstance(batch_date, str)
        else batch_date
    )
    rows = batch.withColumn("batch_seq", F.lit(batch_seq))
    history = scd2_apply(
        state.current, batch_entities(rows, order), batch_seq, day, state.last_taxpayer_sk, order=order
    )
    returns = cut_lineage(typed_returns(batch_returns(rows, order), day))
    keys = [KEY, PERIOD]
    # The stored facts are read once, for the keys of the batch.
    met = cut_lineage(state.facts.join(returns.select(*keys), keys, "left_semi").select(*keys, "taxpayer_sk", "batch_seq", *AUDITED))
    newer = met.where(F.col("batch_seq") > F.lit(batch_seq)).select(*keys)
    fresh = returns.join(newer, keys, "left_anti").select(*returns.columns)
    logged, corrected = number_and_count(
        audit_apply(met, fresh, state.corrections),
        keys,
        "correction_id",
        state.last_correction_id,
    )
    logged = logged.select(*column_names(FACT_CORRECTIONS))

    # A fact can only link to versions of its own key: the few this batch met or
    # opened, and older closed ones. The current versions are not read again.
    earlier = state.closed.join(returns.select(KEY).distinct(), KEY, "left_semi")
    versions = history.of_batch.unionByName(earlier.select(*history.of_batch.columns))
    linked = cut_lineage(_facts(fresh, versions, state.employers))
    replaced = met.where(F.col("batch_seq") <= F.lit(batch_seq))

    next_state = replace(
        state,
        current=history.current,
        closed=state.closed.unionByName(history.closed),
        facts=replace_by_key(state.facts, linked, keys),
        corrections=state.corrections.unionByName(logged),
        last_taxpayer_sk=state.last_taxpayer_sk + history.opened,
        last_correction_id=state.last_correction_id + corrected,
    )
    return Step(
        next_state,
        history.written,
        linked,
        totals_change(replaced, linked),
        history.closed if history.changed else None,
        logged if corrected else None,
    )


def apply_batches(state: State, log: DataFrame, first_seq: int, order: str = "row_pos") -> Step:
    """Advance the state by all batches of `log` in one step.

    `log` holds canonical rows plus `order` and `batch_seq`; its batches are newer than
    all that is stored and numbered from `first_seq` on, and `batch_date` is the date of
    the batch in every row. The result equals that of `apply_batch` for one batch after
    another, but the number of jobs doesn't depend on the number of batches.
    """
    history = scd2_extend(state.current, batch_entities(log, order), first_seq, state.last_taxpayer_sk, order=order)
    returns = cut_lineage(typed_returns(batch_returns(log, order)))
    keys = [KEY, PERIOD]
    met = cut_lineage(state.facts.join(returns.select(*keys), keys, "left_semi").select(*keys, "taxpayer_sk", "batch_seq", *AUDITED))
    logged, corrected = number_and_count(
        audit_build(returns, seeds=met, logged=state.corrections),
        ["batch_seq", *keys],
        "correction_id",
        state.last_correction_id,
    )
    logged = logged.select(*column_names(FACT_CORRECTIONS))
    earlier = state.closed.join(returns.select(KEY).distinct(), KEY, "left_semi")
    versions = history.of_batch.unionByName(earlier.select(*history.of_batch.columns))
    linked = cut_lineage(_facts(latest_facts(returns), versions, state.employers))
    next_state = replace(
        state,
        current=history.current,
        closed=state.closed.unionByName(history.closed),
        facts=replace_by_key(state.facts, linked, keys),
        corrections=state.corrections.unionByName(logged),
        last_taxpayer_sk=state.last_taxpayer_sk + history.opened,
        last_correction_id=state.last_correction_id + corrected,
    )
    return Step(
        next_state,
        history.written,
        linked,
        totals_change(met, linked),
        history.closed if history.changed else None,
        logged if corrected else None,
    )
