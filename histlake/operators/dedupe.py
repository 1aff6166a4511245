"""One row per key and batch, with everything else accounted for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import load_int
from ..schema import CORRECTION, KEY, PERIOD, UPDATE
from .quality import latest_per_group


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key under `order` (ascending)."""
    return latest_per_group(df, keys, [F.desc(c) for c in order])


def loadable(key: str = KEY, period: str = PERIOD) -> Column:
    """Rows a fact can be made from: a key and a readable period."""
    return F.col(key).isNotNull() & load_int(F.col(period)).isNotNull()


def batch_returns(
    log: DataFrame, order: str, seq: str = "batch_seq", key: str = KEY, period: str = PERIOD
) -> DataFrame:
    """Fact candidates: the last row by file order per (batch, key, period)."""
    typed = log.where(loadable(key, period)).withColumn(period, load_int(F.col(period)))
    return last_per_key(typed, [seq, key, period], [order])


def batch_entities(
    log: DataFrame,
    order: str,
    seq: str = "batch_seq",
    key: str = KEY,
    period: str = PERIOD,
    record_type: str = "record_type",
) -> DataFrame:
    """Dimension candidates: per (batch, key) the last correction, the last update and
    the last row of any other type, as far as there are any.

    A batch can deliver several periods of one key, and each acting type acts by itself:
    corrections first, then updates (`scd2_build`).
    """
    ranked = log.where(loadable(key, period)).withColumn("_kind", kind_of(F.col(record_type)))
    return last_per_key(ranked, [seq, key, "_kind"], [order]).drop("_kind")


def kind_of(record_type: Column) -> Column:
    """Order in which the rows of one batch act: 1 correction, 2 update; 0 acts only on
    a key not seen before."""
    return F.when(record_type == CORRECTION, 1).when(record_type == UPDATE, 2).otherwise(0)


def rejects(
    log: DataFrame, order: str, seq: str = "batch_seq", key: str = KEY, period: str = PERIOD
) -> DataFrame:
    """Rows that do not become facts, with the reason.

    The survivors are recognised by their file position, which is unique within a
    batch, so a key with very many copies spreads over all tasks of the join.
    """
    unusable = log.where(~loadable(key, period)).withColumn(
        "reason",
        F.when(F.col(key).isNull(), F.lit("missing key")).otherwise(F.lit("unreadable period")),
    )
    kept = batch_returns(log, order, seq, key, period).select(seq, order)
    superseded = (
        log.where(loadable(key, period))
        .join(kept, [seq, order], "left_anti")
        .select(*log.columns)
        .withColumn("reason", F.lit("superseded in batch"))
    )
    return unusable.unionByName(superseded)
