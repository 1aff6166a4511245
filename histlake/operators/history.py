"""Slowly changing dimension history, built in one pass or applied batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casting import lenient_date
from ..schema import CORRECTION, IDENTITY, KEY, OPEN_END, TRACKED, UPDATE
from ..session import cut_lineage
from .dedupe import kind_of
from .numbering import number_and_count


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Null-safe: true when any pair is distinct."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in pairs])


def scd2_build(
    entities: DataFrame,
    key: str = KEY,
    tracked: Sequence[str] = TRACKED,
    identity: Sequence[str] = IDENTITY,
    starts: Column | None = None,
    batch_date: Column | None = None,
    seq: str = "batch_seq",
    record_type: str = "record_type",
    order: str | None = None,
    seeds: DataFrame | None = None,
    sk: str = "taxpayer_sk",
) -> DataFrame:
    """Every version of every key from the whole batch log.

    `entities` holds at most one row per (key, seq) and type; `order` is the position
    within the batch and may be left out if there is one row per (key, seq). Rules:

    * in the first batch of a key its last update or correction, else its last row,
      opens version 1 from `starts`; nothing else of that batch acts;
    * in later batches a correction acts before an update;
    * an `update` that changes a tracked attribute closes the version on its batch
      date and opens the next one;
    * a `correction` overwrites tracked and identity attributes in place;
    * other rows of a known key change nothing.

    After any acting row the open version carries that row's tracked attributes, so
    "changed" means "differs from the previous acting row". All windows share one
    partitioning, hence one shuffle; a partition holds at most three rows per batch,
    however hot the key is.

    `seeds` are stored current versions, opened before any batch of the log, at most one
    per key: each is the first row of its key, which so goes on from it. The result then
    has the surrogate key `sk`, null for versions that the log opens.
    """
    starts = lenient_date(F.col("filing_date")) if starts is None else starts
    batch_date = lenient_date(F.col("batch_date")) if batch_date is None else batch_date
    by_key = Window.partitionBy(key).orderBy(seq, "_kind")
    acts = F.col("_kind") > 0
    in_batch = Window.partitionBy(key, seq).orderBy(acts.desc(), *([F.desc(order)] if order else []))
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    acting = (
        entities.select(
            key,
            *tracked,
            *identity,
            F.col(seq).alias("_seq"),
            F.col(record_type).alias("_type"),
            kind_of(F.col(record_type)).alias("_kind"),
            starts.alias("_starts"),
            batch_date.alias("_batch_date"),
            seq,
            *([order] if order else []),
            *([F.lit(None).cast(seeds.schema[sk].dataType).alias("_sk"), F.col(seq).alias("_touched")] if seeds is not None else []),
        )
        .transform(lambda log: log.unionByName(_as_first_rows(seeds, log, key, tracked, identity, seq, sk)) if seeds is not None else log)
        .withColumn("_opener", F.row_number().over(in_batch) == 1)
        .withColumn("_first", F.col(seq) == F.min(seq).over(Window.partitionBy(key)))
        .where(F.when(F.col("_first"), F.col("_opener")).otherwise(acts))
    )
    previous = F.lag(F.struct(*tracked)).over(by_key)
    marked = acting.withColumn("_previous", previous).withColumn(
        "_opens",
        F.col("_first")
        | (
            (F.col("_type") == UPDATE)
            & differs([(F.col(c), F.col(f"_previous.{c}")) for c in tracked])
        ),
    )
    fixes = F.col("_opens") | (F.col("_type") == CORRECTION)
    start_date = F.when(F.col("_first"), F.col("_starts")).otherwise(F.col("_batch_date"))
    running = marked.select(
        "*",
        F.sum(F.col("_opens").cast("int")).over(so_far).cast("int").alias("version"),
        F.last(F.when(F.col("_opens"), F.struct(start_date.alias("d"), F.col("_seq").alias("s"), *(["_sk"] if seeds is not None else []))), True)
        .over(so_far)
        .alias("_opening"),
        F.last(F.when(fixes, F.struct(*identity, F.col("_touched" if seeds is not None else "_seq").alias("s"))), True)
        .over(so_far)
        .alias("_fixed"),
        F.lead(F.struct("_opens", "_batch_date")).over(by_key).alias("_next"),
    )
    closing = running.where(F.col("_next").isNull() | F.col("_next._opens"))
    return closing.select(
        key,
        "version",
        *[F.col(f"_fixed.{c}").alias(c) for c in identity],
        *tracked,
        F.col("_opening.d").alias("valid_from"),
        F.when(F.col("_next").isNull(), open_end()).otherwise(F.col("_next._batch_date")).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        F.col("_opening.s").alias("opened_seq"),
        F.col("_fixed.s").alias("touched_seq"),
        *([F.col("_opening._sk").alias(sk)] if seeds is not None else []),
    )


def _as_first_rows(
    seeds: DataFrame, log: DataFrame, key: str, tracked: Sequence[str], identity: Sequence[str], seq: str, sk: str
) -> DataFrame:
    """Stored versions in the shape of acting rows."""
    values = {c: F.col(c) for c in (key, *tracked, *identity)} | {
        "_seq": F.col("opened_seq"),
        seq: F.col("opened_seq"),
        "_kind": F.lit(0),
        "_starts": F.col("valid_from"),
        "_sk": F.col(sk),
        "_touched": F.col("touched_seq"),
    }
    return seeds.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in log.schema])


@dataclass(frozen=True)
class HistoryStep:
    """Outcome of one batch: all current versions, those of them that it opened or
    corrected, those it closed, the versions of the batch's keys with their dates, how
    many versions it opened, and whether it closed any."""

    current: DataFrame
    written: DataFrame
    closed: DataFrame
    of_batch: DataFrame
    opened: int
    changed: bool


def scd2_apply(
    current: DataFrame,
    entities: DataFrame,
    batch_seq: int,
    batch_date: Column,
    last_sk: int = 0,
    key: str = KEY,
    sk: str = "taxpayer_sk",
    tracked: Sequence[str] = TRACKED,
    identity: Sequence[str] = IDENTITY,
    starts: Column | None = None,
    record_type: str = "record_type",
    order: str | None = None,
) -> HistoryStep:
    """Apply one batch to the current versions; closed versions are never read.

    Every known key has exactly one current version, so an unmatched key is new.

    The matched rows are at most as many as the batch and are written out once; the
    large side is only probed and filtered, so a small batch is broadcast and the
    dimension is not shuffled. A batch older than the last change of a version
    leaves that version alone, and a batch with a correction and an update finds its own
    result in place, which makes replays harmless.
    """
    starts = lenient_date(F.col("filing_date")) if starts is None else starts
    attributes = [*identity, *tracked]
    row = F.struct(starts.alias("starts"), *attributes)
    kind = kind_of(F.col(record_type))
    place = F.struct((kind > 0).alias("acts"), F.col(order) if order else F.lit(0).alias("at"))
    # At most three rows per key, so these are small.
    incoming = entities.groupBy(key).agg(
        F.max(F.when(kind == 1, row)).alias("_fix"),
        F.max(F.when(kind == 2, row)).alias("_new"),
        F.max_by(row, place).alias("_opener"),
    )
    matched = cut_lineage(
        current.join(incoming, key).select(
            F.struct(*[F.col(c) for c in current.columns]).alias("_old"), key, "_fix", "_new", "_opener"
        )
    )
    in_order = F.col("_old.touched_seq") <= F.lit(batch_seq)
    both = F.col("_fix").isNotNull() & F.col("_new").isNotNull()
    done = both & (F.col("_old.opened_seq") == F.lit(batch_seq))
    fixes = in_order & F.col("_fix").isNotNull() & ~done
    as_opened = done & ~differs([(F.col(f"_old.{c}"), F.col(f"_opener.{c}")) for c in tracked])

    def fixed_value(c: str) -> Column:
        return F.when(fixes, F.col(f"_fix.{c}")).otherwise(F.col(f"_old.{c}"))

    changes = (
        in_order
        & F.col("_new").isNotNull()
        & ~as_opened
        & differs([(fixed_value(c), F.col(f"_new.{c}")) for c in tracked])
    )
    corrected = matched.where(fixes & ~changes)
    changed = matched.where(changes)

    def version(row: DataFrame, values: dict[str, Column]) -> DataFrame:
        return row.select(*[values[c].cast(current.schema[c].dataType).alias(c) for c in current.columns])

    old = {c: F.col(f"_old.{c}") for c in current.columns}
    base = {**old, **{c: fixed_value(c) for c in attributes}}
    base["touched_seq"] = F.when(fixes, F.lit(batch_seq)).otherwise(F.col("_old.touched_seq"))
    new = {c: F.col(f"_new.{c}") for c in attributes}
    opening = {
        **new,
        key: F.col(key),
        "valid_to": open_end(),
        "is_current": F.lit(True),
        "opened_seq": F.lit(batch_seq),
        "touched_seq": F.lit(batch_seq),
    }
    first_seen = incoming.join(matched.select(key), key, "left_anti")
    to_open = (
        first_seen.select(key, F.col("_opener").alias("_new"), F.col("_opener.starts").alias("_from"))
        .unionByName(changed.select(key, "_new", batch_date.alias("_from")))
    )
    numbered, count = number_and_count(to_open, [key], "_sk", last_sk)
    opened = version(numbered, {**opening, sk: F.col("_sk"), "valid_from": F.col("_from")})
    closed = version(changed, {**base, "valid_to": batch_date, "is_current": F.lit(False)})
    fixed = version(corrected, base)
    replaced = corrected.select(key).unionByName(changed.select(key))
    kept = current.join(replaced, key, "left_anti").select(*current.columns)
    untouched = matched.join(changed.select(key), key, "left_anti")
    written = fixed.unionByName(opened)
    return HistoryStep(
        kept.unionByName(written),
        written,
        closed,
        version(untouched, old).unionByName(closed).unionByName(opened),
        count,
        not changed.isEmpty(),
    )


def scd2_extend(
    current: DataFrame,
    entities: DataFrame,
    first_seq: int,
    last_sk: int = 0,
    key: str = KEY,
    sk: str = "taxpayer_sk",
    **options,
) -> HistoryStep:
    """Apply several batches, all newer than what is stored, in one step.

    The stored current versions of the keys that the batches bring are the first rows of
    `scd2_build` over the batches' log, so the work doesn't grow with their number: one
    probe of the stored versions and one shuffle of the log. `entities` has `batch_seq`
    from `first_seq` on; `options` are those of `scd2_build`. Surrogate keys come out as
    if the batches had been applied one after another.
    """
    entities = cut_lineage(entities)
    met = cut_lineage(current.join(entities.select(key), key, "left_semi"))
    built = cut_lineage(scd2_build(entities, key=key, sk=sk, seeds=met, **options))
    numbered, count = number_and_count(built.where(F.col(sk).isNull()).drop(sk), ["opened_seq", key], sk, last_sk)
    known = built.where(F.col(sk).isNotNull())
    columns = [F.col(c).cast(current.schema[c].dataType).alias(c) for c in current.columns]
    versions = known.select(*columns).unionByName(numbered.select(*columns))
    closed = versions.where("NOT is_current")
    written = versions.where(F.col("is_current") & (F.col("touched_seq") >= first_seq))
    ended = known.where(~F.col("is_current") | (F.col("touched_seq") >= first_seq)).select(key)
    kept = current.join(ended, key, "left_anti").select(*current.columns)
    return HistoryStep(kept.unionByName(written), written, closed, versions, count, not closed.isEmpty())


HOT_FACTS = 1_000_000  # facts of one key that a task takes when `many_per_key` is set
NO_KEY_PARTS = 4096  # facts without key link to nothing and are spread


def asof_link(
    facts: DataFrame,
    versions: DataFrame,
    at: str,
    seq: str,
    key: str = KEY,
    sk: str = "taxpayer_sk",
    found: str | None = None,
    many_per_key: bool = False,
) -> DataFrame:
    """Add the surrogate key of the version valid at `at`, else the current one.

    A version counts if its half-open interval `[valid_from, valid_to)` holds the
    date. Only versions opened by the fact's own batch or an earlier one are seen,
    and the last of those is open-ended and "current": a fact is linked when it is
    loaded and a later version does not move it. Of several valid ones the last counts.
    `found` optionally names a boolean column that tells an as-of match from the fallback.

    Facts and versions are merged: both come sorted by batch, then by date, and each fact
    takes the last version before it. So a fact costs the same however many versions its
    key has, none of them are gathered in a row, and there is one shuffle. The intervals
    of a key follow each other unless batches came with earlier dates than their
    predecessors; each such step back begins a new run of intervals, in which a fact of
    the key looks once more.

    Set `many_per_key` if a key can hold a large share of `facts`. They are then written
    out and counted by key, and a key with more than HOT_FACTS of them is dealt to
    several tasks, each with a copy of the key's versions.
    """
    number = F.monotonically_increasing_id()
    day = facts.schema[at].dataType
    if many_per_key:
        facts = cut_lineage(facts)
        counts = facts.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        # At most one row per HOT_FACTS facts.
        hot = cut_lineage(counts.where(F.col("_key").isNotNull() & (F.col("_n") > HOT_FACTS)))
        hot = hot.select("_key", F.ceil(F.col("_n") / HOT_FACTS).cast("int").alias("_parts"))
    right = _interval_runs(versions, key, sk).select(
        F.col(key).alias("_key"), F.lit(0).alias("_kind"), F.col("_version.seq").alias("_seq"),
        F.col("_version.lo").cast(day).alias("_day"), "_version", "_run",
    )
    left = facts.select(
        F.col(key).alias("_key"), F.lit(1).alias("_kind"), F.col(seq).alias("_seq"), F.col(at).alias("_day"),
        *[F.col(c).alias(f"_fact{i}") for i, c in enumerate(facts.columns)], number.alias("_id"),
    )
    part = F.when(F.col("_key").isNull(), F.pmod("_id", F.lit(NO_KEY_PARTS))).otherwise(F.lit(0)).cast("int")
    if many_per_key:
        left = left.join(hot, "_key", "left").withColumn("_part", F.coalesce(F.pmod("_id", "_parts").cast("int"), part)).drop("_parts")
        every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        right = right.join(hot, "_key", "left").withColumn("_part", F.explode(every)).drop("_parts")
    else:
        left, right = left.withColumn("_part", part), right.withColumn("_part", F.lit(0))
    place = ["_key", "_part"]
    by_seq = Window.partitionBy(*place).orderBy("_seq", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = (
        left.unionByName(right, allowMissingColumns=True)
        .withColumn("_last", F.last("_version", True).over(by_seq))
        .withColumn("_runs", F.max("_run").over(by_seq))
    )
    is_fact = F.col("_kind") == 1
    # The versions that a fact sees are those before it; it looks into each of their runs.
    spread = merged.withColumn(
        "_run", F.explode(F.when(is_fact, F.sequence(F.lit(0), F.coalesce("_runs", F.lit(0)))).otherwise(F.array("_run")))
    )
    in_run = Window.partitionBy(*place, "_run").orderBy("_day", "_kind", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    proper = F.when(F.col("_version.lo") < F.col("_version.hi"), F.col("_version"))
    looked = spread.withColumn("_match", F.last(proper, True).over(in_run)).where(is_fact)
    earlier = (F.col("_match.seq") < F.col("_last.seq")) & (F.col("_match.lo") <= F.col("_day")) & (F.col("_day") < F.col("_match.hi"))
    own = F.when(F.col("_last.lo") <= F.col("_day"), F.struct("_last.seq", "_last.sk")).when(earlier, F.struct("_match.seq", "_match.sk"))
    several = F.col("_runs") > 0
    # The copies of a fact meet in its first run.
    copies = Window.partitionBy(*place, F.when(several, F.col("_id"))).orderBy(F.desc("_run"))
    so_far = copies.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = (
        looked.withColumn("_own", own)
        .withColumn("_best", F.when(several, F.max("_own").over(so_far)).otherwise(F.col("_own")))
        .where("_run = 0")
    )
    extra = [F.col("_best").isNotNull().alias(found)] if found else []
    return linked.select(
        *[F.col(f"_fact{i}").alias(c) for i, c in enumerate(facts.columns)], F.coalesce("_best.sk", "_last.sk").alias(sk), *extra
    )


def _interval_runs(versions: DataFrame, key: str, sk: str) -> DataFrame:
    """(key, _version, _run): versions, numbered by runs of intervals that follow each
    other without overlap. Intervals that hold no date don't interrupt a run."""
    before = Window.partitionBy(key).orderBy("opened_seq").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(key).orderBy("opened_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    proper = F.col("_version.lo") < F.col("_version.hi")
    rows = versions.where(F.col(key).isNotNull()).select(
        key,
        "opened_seq",
        F.struct(
            F.col("opened_seq").alias("seq"), F.col(sk).alias("sk"), F.col("valid_from").alias("lo"), F.col("valid_to").alias("hi")
        ).alias("_version"),
    )
    reached = F.last(F.when(proper, F.col("_version.hi")), True).over(before)
    back = F.coalesce(proper & (F.col("_version.lo") < reached), F.lit(False))
    return rows.withColumn("_back", back).select(key, "_version", F.sum(F.col("_back").cast("int")).over(so_far).cast("int").alias("_run"))
