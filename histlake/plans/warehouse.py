"""The stored warehouse: load batches, replay them, read tables."""

from __future__ import annotations

import copy
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casting import lenient_date, load_int
from ..functions.rules import Rule, domain_flag_column
from ..operators.checks import on_keys, violations
from ..operators.dedupe import loadable, rejects
from ..operators.facts import add_totals, superseded_members, version_totals, with_unknown_member
from ..operators.quality import apply_rules, latest_per_group, latest_quality, merged_scores, pass_counts, scores_of_counts
from ..schema import BATCH_LOG, CANONICAL_COLUMNS, DOMAINS, KEY, PERIOD, REJECTS, TABLES, VERSION_TOTALS, column_names, public_columns
from ..session import cut_lineage, work_tables
from ..sources.batches import BatchFile, drift, first_date, list_batches, read_batch, read_headers, read_log, select_batches
from ..sources.snapshots import Snapshots, with_parts
from . import serving
from .state import State, Step, apply_batch, apply_batches, rebuild

FIRST_YEAR, LAST_YEAR = 1900, 2100


MAX_BUCKETS = 10_000
LAYOUT = "_layout"  # entry of the version list: the number of buckets
ROWS = "_rows"  # entry of the version list: rows of base and deltas of each area


@dataclass(frozen=True)
class Area:
    """Rows of a table that are stored as a base, partitioned by an integer column, and
    deltas. With `keys`, the newest row of a key counts; without, rows only are added, and
    with `sums` they are totals to add up."""

    table: str
    name: str
    column: str
    keys: tuple[str, ...] = ()
    sums: bool = False

    @property
    def base(self) -> str:
        return f"{self.name}/base"

    @property
    def deltas(self) -> str:
        return f"{self.name}/delta"


CURRENT = Area("dim_taxpayer", "current", "bucket", (KEY,))
CLOSED = Area("dim_taxpayer", "closed", "bucket")
FACTS = Area("fact_tax_returns", "facts", "part", (KEY, PERIOD))
AUDIT = Area("fact_corrections", "audit", "part")
TOTALS = Area("agg_version_totals", "totals", "bucket", sums=True)
AREAS = (CURRENT, CLOSED, FACTS, AUDIT, TOTALS)
LAYOUTS = TABLES | {TOTALS.table: VERSION_TOTALS}
LOAD = "_load"  # column of a delta with keys: version that wrote the row


@dataclass(frozen=True)
class LoadReport:
    """What a load did: number of the batch, drift of its header, score by domain."""

    batch: str
    batch_seq: int
    rows: int
    scores: dict[str, float]
    added: tuple[str, ...] = ()
    unexpected: tuple[str, ...] = ()


class Warehouse:
    """Five tables plus a batch log and a list of rejected rows under one folder.

    Taxpayer versions are split into `buckets` by a hash of the key, facts and logged
    corrections by year and bucket. A load reads the partitions its rows fall into and
    appends what it changed as a delta, so it writes in proportion to its batch; readers
    take the newest row of a key. Once the deltas of a table exceed the share
    `compact_share` of its base (and `compact_rows`), they are folded into a new base;
    more than `max_deltas` small ones are merged into one.

    Choose `buckets` so that one bucket of current versions is a few files; the number is
    stored with the data, and a store that has one keeps it whatever is asked for. Batches
    are numbered in order of their first load; a replay keeps its number and cannot
    overwrite what later batches did.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: Sequence[Rule] | None = None,
        buckets: int = 8,
        compact_share: float = 0.25,
        compact_rows: int = 1_000_000,
        max_deltas: int = 24,
    ):
        self.spark = spark
        self.store = Snapshots(spark, root)
        if not 1 <= buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
        self.rules = rules
        self.buckets = buckets
        self.compact_share, self.compact_rows, self.max_deltas = compact_share, compact_rows, max_deltas
        self._adopt(self.store.latest()[1])

    # ---- reading ------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        """A published table without control columns."""
        return self._stored(name).select(*public_columns(name))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def rejected(self) -> DataFrame:
        _, listing = self.store.latest()
        return self.store.read(listing, "rejects", REJECTS)

    def batch_log(self) -> DataFrame:
        _, listing = self.store.latest()
        return self.store.read(listing, "batch_log", BATCH_LOG)

    def _stored(self, name: str) -> DataFrame:
        _, listing = self.store.latest()
        areas = [a for a in AREAS if a.table == name]
        if not areas:
            return self.store.read(listing, name, TABLES[name])
        return reduce(DataFrame.unionByName, [self._rows(listing, a) for a in areas])

    def current(self) -> DataFrame:
        """Current taxpayer versions, without touching closed ones."""
        _, listing = self.store.latest()
        return self._rows(listing, CURRENT).select(*public_columns("dim_taxpayer"))

    def quality(self) -> DataFrame:
        """Current score of every domain: that of the batch loaded last."""
        return latest_quality(self._stored("agg_data_quality_metrics"))

    def overall_quality(self) -> DataFrame:
        """Score of every domain over all batches, from the counts their loads stored."""
        return merged_scores(self.table("agg_data_quality_metrics"))

    def summary(self, by: str, limit: int | None = 50, offset: int = 0, recompute: bool = False) -> DataFrame:
        """Totals per group from the totals per version, which every load keeps up to
        date, or with `recompute` from all facts."""
        _, listing = self.store.latest()
        dim = self.table("dim_taxpayer")
        if recompute or TOTALS.table not in listing:
            return serving.summary(self.table("fact_tax_returns"), dim, by, limit, offset)
        return serving.summary_of_totals(self._rows(listing, TOTALS), dim, by, limit, offset)

    def check_touched(self, rows: DataFrame) -> DataFrame:
        """What the integrity checks find among the taxpayers and facts of `rows`, those of a
        batch, as (check, value, n). Only the storage partitions they fall into are read.

        A link counts as dangling if its version isn't one of these taxpayers.
        """
        touched = rows.where(loadable()).select(KEY, load_int(F.col(PERIOD)).alias(PERIOD)).distinct()
        # Sets bounded by the layout.
        seen = touched.agg(F.collect_set(self._bucket()).alias("buckets"), F.collect_set(self._fact_part(F.col(PERIOD))).alias("parts")).first()
        _, listing = self.store.latest()
        dim = self._rows(listing, CURRENT, seen.buckets).unionByName(self._rows(listing, CLOSED, seen.buckets))
        facts = on_keys(self._rows(listing, FACTS, seen.parts), touched, [KEY, PERIOD])
        return violations(on_keys(dim, touched, [KEY]), facts, self.table("dim_employer"))

    # ---- writing ------------------------------------------------------------

    def load_employers(self, employers: DataFrame) -> DataFrame:
        """Replace the employer dimension; returns the records that a later one with the
        same identifier supersedes."""
        version, listing = self._open()
        new = self.store.write("dim_employer", with_unknown_member(employers), "all")
        with_parts(listing, "dim_employer", ["all"], new)
        self._publish(version + 1, listing)
        return superseded_members(employers)

    def load_file(self, path: str, batch: str, computed_at: datetime | None = None) -> LoadReport:
        aligned = read_batch(self.spark, path)
        report = self.load_batch(aligned.rows, batch, computed_at)
        return replace(report, added=tuple(aligned.added), unexpected=tuple(aligned.unexpected))

    def load_batch(
        self, rows: DataFrame, batch: str, computed_at: datetime | None = None
    ) -> LoadReport:
        """Validate, score and load one batch of canonical rows with `row_pos`."""
        with work_tables(self.spark):
            return self._load_batch(rows, batch, computed_at or datetime.now(timezone.utc))

    def load_files(self, files: Sequence[BatchFile], computed_at: datetime | None = None) -> list[LoadReport]:
        """Load batches in the given order: those stored before are replayed one by one,
        the new ones are read, scored and merged in one step."""
        stored = {r.batch for r in self.batch_log().select("batch").collect()}  # one row per batch
        new = [f for f in files if f.batch not in stored]
        if len(new) < 2:
            return [self.load_file(f.path, f.batch, computed_at) for f in files]
        reports = {f.batch: self.load_file(f.path, f.batch, computed_at) for f in files if f.batch in stored}
        headers = read_headers(self.spark, new)
        log = read_log(self.spark, new, headers=headers)
        for f, header, report in zip(new, headers, self.load_batches(log, [f.batch for f in new], computed_at)):
            added, unexpected = drift(header.names)
            reports[f.batch] = replace(report, added=tuple(added), unexpected=tuple(unexpected))
        return [reports[f.batch] for f in files]

    def load_batches(
        self, log: DataFrame, names: Sequence[str], computed_at: datetime | None = None
    ) -> list[LoadReport]:
        """Validate, score and load several batches that are not stored yet in one step.

        `log` holds canonical rows with `batch_seq` (1, 2, ... as in `names`), `row_pos`,
        and the date of the batch in every row. All batches become visible at once.
        """
        with work_tables(self.spark):
            return self._load_batches(log, list(names), computed_at or datetime.now(timezone.utc))

    def _load_batches(self, log: DataFrame, names: list[str], computed_at: datetime) -> list[LoadReport]:
        version, listing = self._open()
        before = copy.deepcopy(listing)
        history = self.store.read(listing, "batch_log", BATCH_LOG).collect()  # one row per batch
        repeated = set(names) & {r.batch for r in history}
        if repeated or len(set(names)) < len(names):
            raise ValueError(f"batches must be new and different: {sorted(repeated) or names}")
        last = max([r.batch_seq for r in history], default=0)
        numbered = log.select(*CANONICAL_COLUMNS, "row_pos", (F.col("batch_seq") + F.lit(last)).cast("int").alias("batch_seq"))
        validated = cut_lineage(apply_rules(numbered, self.rules))
        # One row per batch; the partitions are sets bounded by the layout.
        measures = self._measures(validated.columns)
        facts = {r.batch_seq: r.asDict() for r in validated.groupBy("batch_seq").agg(*measures).collect()}
        parts = sorted({p for r in facts.values() for p in r["parts"]})
        buckets = sorted({b for r in facts.values() for b in r["buckets"]})
        step = apply_batches(self._state(before, buckets, parts, history), validated, last + 1)

        seqs = {last + i: name for i, name in enumerate(names, 1)}
        scores = self._scores({k: facts.get(k, {}) for k in seqs}, validated.columns)
        metrics = self.spark.createDataFrame(
            [(seqs[k], *row, computed_at, k) for k, rows in scores.items() for row in rows], TABLES["agg_data_quality_metrics"]
        ).withColumn("part", F.col("batch_seq"))
        of = self.spark.createDataFrame(list(seqs.items()), "part int, batch string")
        refused = rejects(validated, "row_pos").join(F.broadcast(of), F.col("batch_seq") == F.col("part"))
        refused = refused.select("batch", "reason", _place(), *CANONICAL_COLUMNS, "part")
        entries = [tuple(r) for r in history]
        for k, name in seqs.items():
            r = facts.get(k, {})
            entries.append((name, k, r.get("day"), r.get("n", 0), step.state.last_taxpayer_sk, step.state.last_correction_id))
        by_seq = {str(k): name for k, name in seqs.items()}
        self._store_step(
            listing,
            step,
            version + 1,
            sum(r["n"] for r in facts.values()),
            [
                self._split("agg_data_quality_metrics", metrics, "part", "", [], by_seq),
                self._split("rejects", refused, "part", "", [], by_seq),
                self._whole(
                    "batch_log", self.spark.createDataFrame(entries, BATCH_LOG).coalesce(1), "all", replace=True
                ),
            ],
        )
        return [LoadReport(name, k, facts.get(k, {}).get("n", 0), {s[0]: s[1] for s in scores[k]}) for k, name in seqs.items()]

    def _measures(self, columns: Sequence[str]) -> list[Column]:
        """Aggregates of validated rows: their number, the date of the batch, the storage
        partitions they fall into (sets bounded by the layout), rows passing each domain."""
        usable = loadable()
        return [
            F.count(F.lit(1)).alias("n"),
            lenient_date(first_date()).alias("day"),
            F.collect_set(F.when(usable, self._fact_part(load_int(F.col(PERIOD))))).alias("parts"),
            F.collect_set(F.when(usable, self._bucket())).alias("buckets"),
            *pass_counts(columns),
        ]

    def _scores(self, measured: Mapping[int, Mapping], columns: Sequence[str]) -> dict[int, list[tuple]]:
        """(domain, score, passing, total) by batch, from what was measured of each."""
        domains = [d for d in DOMAINS if domain_flag_column(d) in columns]
        rows = [(k, m.get("n", 0), *[m.get(d) or 0 for d in domains]) for k, m in measured.items()]
        counts = self.spark.createDataFrame(rows, "k int, total_count bigint, " + ", ".join(f"{d} bigint" for d in domains))
        found: dict[int, list[tuple]] = {k: [] for k in measured}
        for r in scores_of_counts(counts, domains, ["k"]).collect():
            found[r.k].append((r.domain, r.score, r.passing_count, r.total_count))
        return found

    def _state(self, listing: dict, buckets: Sequence[int], parts: Sequence[int], history: Sequence) -> State:
        """What a load can meet: the stored partitions its rows fall into."""
        return State(
            self._rows(listing, CURRENT, buckets),
            self._rows(listing, CLOSED, buckets),
            self.store.read(listing, "dim_employer", TABLES["dim_employer"]),
            self._rows(listing, FACTS, parts),
            self._rows(listing, AUDIT, parts),
            max([r.last_taxpayer_sk for r in history], default=0),
            max([r.last_correction_id for r in history], default=0),
        )

    def _store_step(self, listing: dict, step: Step, version: int, rows: int, more: Sequence[Write]) -> None:
        """Write what a step changed as deltas, and the rest, and publish."""
        writes = [self._delta(CURRENT, step.versions, version), self._delta(FACTS, step.facts, version), *more]
        if TOTALS.table in listing or FACTS.table not in listing:  # else a store from before there were totals
            writes.append(self._delta(TOTALS, step.totals, version))
        if step.closed:
            writes.append(self._delta(CLOSED, step.closed, version))
        if step.corrections:
            writes.append(self._delta(AUDIT, step.corrections, version))
        self._write(listing, writes)
        for area in AREAS:
            # The rows loaded bound those of each delta.
            _add_rows(listing, f"{area.table}/{area.deltas}", rows)
        self._compact(listing)
        self._publish(version, listing)

    def _load_batch(self, rows: DataFrame, batch: str, computed_at: datetime) -> LoadReport:
        version, listing = self._open()
        before = copy.deepcopy(listing)
        checked, seen = apply_rules(rows, self.rules), Observation()
        validated = cut_lineage(checked, *self._measures(checked.columns), into=seen)
        facts = seen.get

        log = self.store.read(listing, "batch_log", BATCH_LOG)
        history = {r.batch: r for r in log.collect()}  # one row per batch
        known = history.get(batch)
        seq = known.batch_seq if known else 1 + max([r.batch_seq for r in history.values()], default=0)
        state = self._state(before, facts["buckets"], facts["parts"], list(history.values()))
        day = F.lit(facts["day"]).cast("date")
        step = apply_batch(state, validated, seq, day)

        # A replay replaces the batch's own scores and rejects. One row per domain.
        scores = self._scores({seq: facts}, validated.columns)[seq]
        metrics = self.spark.createDataFrame(
            [(batch, *row, computed_at, seq) for row in scores], TABLES["agg_data_quality_metrics"]
        ).coalesce(1)
        refused = rejects(validated.withColumn("batch_seq", F.lit(seq)), "row_pos").select(
            F.lit(batch).alias("batch"), "reason", _place(), *CANONICAL_COLUMNS
        )
        entry = (
            batch,
            seq,
            facts["day"],
            facts["n"],
            step.state.last_taxpayer_sk,
            step.state.last_correction_id,
        )
        entries = [tuple(r) for r in history.values() if r.batch != batch] + [entry]
        more = [
            self._whole("agg_data_quality_metrics", metrics, batch, replace=True),
            self._whole("rejects", refused, batch, replace=True),
            self._whole(
                "batch_log", self.spark.createDataFrame(entries, BATCH_LOG).coalesce(1), "all", replace=True
            ),
        ]
        self._store_step(listing, step, version + 1, facts["n"], more)
        return LoadReport(batch, seq, facts["n"], {s[0]: s[1] for s in scores})

    def backfill(
        self, folder: str, wanted: str = "all", computed_at: datetime | None = None
    ) -> list[LoadReport]:
        """Load the batch files of a folder, in natural name order; see `load_files`."""
        return self.load_files(select_batches(list_batches(self.spark, folder), wanted), computed_at)

    def compact(self) -> None:
        """Fold all deltas into new bases now."""
        version, listing = self._open()
        self._compact(listing, always=True)
        self._publish(version + 1, listing)

    def vacuum(self) -> int:
        """Remove what no reader of the newest version needs; how many folders went."""
        return self.store.vacuum()

    def rebuild(
        self, log: DataFrame, employers: DataFrame, computed_at: datetime | None = None
    ) -> None:
        """Replace all tables by a one-pass build of the whole log.

        `log` holds canonical rows with `batch`, `batch_seq` and `row_pos`.
        """
        with work_tables(self.spark):
            self._rebuild(log, employers, computed_at or datetime.now(timezone.utc))

    def _rebuild(self, log: DataFrame, employers: DataFrame, computed_at: datetime) -> None:
        version, _ = self._open()
        validated = cut_lineage(apply_rules(log, self.rules))
        state = rebuild(validated, employers)
        # One row per batch. Scores and rejects are stored by batch, so that a later
        # replay of one batch replaces only its own.
        measured = {
            r.batch_seq: r.asDict()
            for r in validated.groupBy("batch", "batch_seq")
            .agg(F.count(F.lit(1)).alias("n"), lenient_date(first_date()).alias("day"), *pass_counts(validated.columns))
            .collect()
        }
        batches = self.spark.createDataFrame(
            [(m["batch"], k, m["day"], m["n"], state.last_taxpayer_sk, state.last_correction_id) for k, m in measured.items()], BATCH_LOG
        ).coalesce(1)
        scores = self._scores(measured, validated.columns)
        metrics = self.spark.createDataFrame(
            [(measured[k]["batch"], *row, computed_at, k) for k, rows in scores.items() for row in rows], TABLES["agg_data_quality_metrics"]
        ).withColumn("part", F.col("batch_seq"))
        refused = rejects(validated, "row_pos").select(
            "batch", "reason", _place(), *CANONICAL_COLUMNS, F.col("batch_seq").alias("part")
        )
        names = {str(k): m["batch"] for k, m in measured.items()}
        listing: dict = {}
        bases = [
            self._base(CURRENT, state.current),
            self._base(CLOSED, state.closed),
            self._base(FACTS, state.facts),
            self._base(AUDIT, state.corrections),
        ]
        self._write(
            listing,
            [
                self._whole("dim_employer", state.employers, "all"),
                *bases,
                self._whole("batch_log", batches, "all"),
                self._split("agg_data_quality_metrics", metrics, "part", "", [], names),
                self._split("rejects", refused, "part", "", [], names),
            ],
        )
        # Facts are read back as stored, so they aren't linked a second time.
        bases.append(self._base(TOTALS, version_totals(self._rows(listing, FACTS))))
        self._write(listing, bases[-1:])
        _count_bases(listing, bases)
        self._publish(version + 1, listing)

    # ---- helpers ------------------------------------------------------------

    def _open(self) -> tuple[int, dict]:
        version, listing = self.store.latest()
        self._adopt(listing)
        return version, listing

    def _adopt(self, listing: Mapping) -> None:
        """Take over the number of buckets that the stored tables were split by."""
        for stored in listing.get(LAYOUT, ()):
            self.buckets = int(stored)

    def _publish(self, version: int, listing: dict) -> None:
        listing[LAYOUT] = {str(self.buckets): [""]}
        self.store.publish(version, listing)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int")

    def _fact_part(self, year: Column) -> Column:
        """Year and bucket in one number; years out of the ordinary share year 0, so
        that garbage years cannot create partitions without end."""
        usual = F.when(year.between(FIRST_YEAR, LAST_YEAR), year).otherwise(F.lit(0))
        return (usual * MAX_BUCKETS + self._bucket()).cast("int")

    def _rows(self, listing: dict, area: Area, values: Sequence[int] | None = None) -> DataFrame:
        """Valid rows of an area. `values` leaves out partitions of the base; the deltas,
        a bounded share, are read whole. The base is probed with the keys of the deltas
        and not shuffled as long as those are small."""
        base = self.store.read_split(listing, area.table, LAYOUTS[area.table], area.base, area.column, values)
        if not listing.get(area.table, {}).get(area.deltas):
            return base
        newest = self._deltas(listing, area).select(*base.columns)
        if area.keys:
            base = base.join(newest.select(*area.keys), list(area.keys), "left_anti").select(*base.columns)
        rows = base.unionByName(newest)
        return add_totals(rows) if area.sums else rows

    def _deltas(self, listing: dict, area: Area) -> DataFrame:
        ddl = LAYOUTS[area.table] + (f", {LOAD} int" if area.keys else "")
        rows = self.store.read(listing, area.table, ddl, lambda p: p == area.deltas)
        if area.sums:
            return add_totals(rows)
        return latest_per_group(rows, area.keys, [F.desc(LOAD)]) if area.keys else rows

    def _delta(self, area: Area, rows: DataFrame, version: int) -> Write:
        if area.keys:
            rows = rows.withColumn(LOAD, F.lit(version))
        return self._whole(area.table, rows, area.deltas)

    def _base(self, area: Area, rows: DataFrame) -> Write:
        """A new base, which replaces the former one and all deltas."""
        value = self._bucket() if area.column == "bucket" else self._fact_part(F.col(PERIOD))
        split, counted = rows.withColumn(area.column, value), Observation()
        return Write(
            area.table,
            [area.base, area.deltas],
            lambda: self.store.write(area.table, split, area.base, area.column, counted),
            area,
            counted,
        )

    def _compact(self, listing: dict, always: bool = False) -> None:
        """Fold or merge the deltas of areas that are due."""
        folded, merged = [], []
        for area in AREAS:
            deltas = listing.get(area.table, {}).get(area.deltas, [])
            counts = listing.get(ROWS, {})
            rows, base = (int(counts.get(f"{area.table}/{p}", ["0"])[0]) for p in (area.deltas, area.base))
            if deltas and (always or rows > max(self.compact_rows, self.compact_share * base)):
                folded.append(area)
            elif len(deltas) > self.max_deltas:
                merged.append(area)
        old = copy.deepcopy(listing)
        writes = [self._base(a, self._rows(old, a)) for a in folded]
        for a in merged:
            rows = self._deltas(old, a).hint("rebalance")
            writes.append(Write(a.table, [a.deltas], lambda a=a, rows=rows: self.store.write(a.table, rows, a.deltas)))
        if writes:
            self._write(listing, writes)
            _count_bases(listing, writes)

    def _whole(self, table: str, df: DataFrame, part: str, replace: bool = False) -> Write:
        return Write(table, [part] if replace else [], lambda: self.store.write(table, df, part))

    def _split(
        self,
        table: str,
        df: DataFrame,
        column: str,
        prefix: str,
        replaced: Sequence[int],
        names: Mapping[str, str] | None = None,
    ) -> Write:
        def run() -> Mapping[str, list[str]]:
            new = self.store.write_split(table, df, column, prefix)
            if not names:
                return new
            by_name: dict[str, list[str]] = {}
            for k, folders in new.items():
                by_name.setdefault(names[k], []).extend(folders)
            return by_name

        return Write(table, [f"{prefix}{v}" for v in replaced], run)

    def _write(self, listing: dict, writes: Sequence[Write]) -> None:
        """Run independent writes side by side, then enter them in the listing."""
        with ThreadPoolExecutor(len(writes)) as pool:
            for w, new in zip(writes, pool.map(lambda w: w.run(), writes)):
                with_parts(listing, w.table, w.replaced, new)


def _add_rows(listing: dict, place: str, n: int) -> None:
    counts = listing.setdefault(ROWS, {})
    counts[place] = [str(int(counts.get(place, ["0"])[0]) + n)]


def _count_bases(listing: dict, writes: Sequence[Write]) -> None:
    """Note the rows of new bases, counted while they were written."""
    for w in writes:
        if w.counted:
            counts = listing.setdefault(ROWS, {})
            counts[f"{w.table}/{w.area.base}"], counts[f"{w.table}/{w.area.deltas}"] = [str(w.counted.get["n"])], ["0"]


def _place() -> Column:
    """Position in the batch as text, whatever its type."""
    return F.to_json(F.struct("row_pos")).alias("row_pos")


@dataclass(frozen=True)
class Write:
    """A pending write: the stored partitions it replaces and how to run it."""

    table: str
    replaced: list[str]
    run: Callable[[], Mapping[str, list[str]]]
    area: Area | None = None
    counted: Observation | None = None
