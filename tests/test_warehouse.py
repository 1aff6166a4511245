"""The stored warehouse end to end on a small story in three batch files."""

from __future__ import annotations

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F

from histlake.operators import checks
from histlake.plans import serving
from histlake.plans.warehouse import Warehouse
from histlake.schema import BASE_COLUMNS, CANONICAL_COLUMNS, KEY, PERIOD
from histlake.sources.batches import list_batches, read_log
from histlake.streaming.folder import load_new_files

from .helpers import CLEAN, frame, random_batches
from .test_history import employer_frame
from .test_sources import write_csv

AT = datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)
D2, D3 = "2024-04-15", "2024-04-16"


def person(n, **changes):
    return {**CLEAN, "taxpayer_id": f"P{n}", **changes}


BATCHES = {
    1: [
        person(1),
        person(2, postal_code="BADPOST", filing_date="2024-02-30"),
        person(3, employer_id=""),
        person(4, filing_date=D2),
        person(5),
    ],
    2: [
        person(1, occupation="Senior Baker", batch_date=D2, record_type="update"),
        person(3, tax_payable_sgd="9000", batch_date=D2, record_type="correction"),
        person(4, occupation="Nurse", filing_date=D2, batch_date=D2, record_type="update"),
        person(5, batch_date=D2, record_type="update"),
        person(6, employer_id="E9", batch_date=D2, record_type="new"),
    ],
    3: [
        person(2, postal_code="310456", filing_date="2024-03-01", batch_date=D3, record_type="correction"),
        person(7, filing_date="2024-04-10", batch_date=D3, record_type="late_arrival"),
        person(5, assessment_year="x", batch_date=D3, record_type="new"),
        person(1, occupation="Ignored", filing_date="2024-04-15", batch_date=D3, record_type="late_arrival"),
    ],
}


def write_batch(folder, n):
    columns = BASE_COLUMNS if n == 1 else CANONICAL_COLUMNS
    write_csv(folder / f"individual_tax_returns_day{n}.csv", columns, BATCHES[n])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("in")
    for n in BATCHES:
        write_batch(path, n)
    return path


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), buckets=3)
    w.load_employers(employer_frame(spark))
    w.backfill(str(folder), computed_at=AT)
    return w


def contents(w):
    return {n: sorted(map(str, map(tuple, t.collect()))) for n, t in w.tables().items()}


def comparable(w):
    """Contents with dates of the linked version in place of surrogate keys."""
    t = w.tables()
    dim = t["dim_taxpayer"]
    links = dim.select("taxpayer_sk", "occupation", "valid_from", "valid_to")
    frames = {
        "dim": dim.drop("taxpayer_sk"),
        "fact": t["fact_tax_returns"].join(links, "taxpayer_sk").drop("taxpayer_sk"),
        "audit": t["fact_corrections"].drop("correction_id"),
        "metrics": t["agg_data_quality_metrics"],
        "rejects": w.rejected().drop("row_pos"),
    }
    return {n: sorted(map(str, map(tuple, f.select(*sorted(f.columns)).collect()))) for n, f in frames.items()}


def history(w, key):
    df = serving.history_of(w.table("dim_taxpayer"), key)
    return [(r.occupation, r.postal_code, str(r.valid_from), str(r.valid_to), r.is_current) for r in df.collect()]


def fact(w, key):
    (row,) = w.table("fact_tax_returns").where(F.col(KEY) == key).collect()
    return row


def test_counts(loaded):
    got = {r.table_name: r.num_rows for r in serving.table_counts(loaded.tables()).collect()}
    assert got == {
        "dim_taxpayer": 9,
        "dim_employer": 3,
        "fact_tax_returns": 7,
        "agg_data_quality_metrics": 9,
        "fact_corrections": 1,
    }


def test_update_opens_a_version_and_late_filing_of_a_known_taxpayer_does_not(loaded):
    assert history(loaded, "P1") == [
        ("Baker", "520123", "2024-03-11", D2, False),
        ("Senior Baker", "520123", D2, "9999-12-31", True),
    ]
    assert fact(loaded, "P1").record_type == "late_arrival"
    newest = serving.history_of(loaded.table("dim_taxpayer"), "P1").collect()[-1]
    assert fact(loaded, "P1").taxpayer_sk == newest.taxpayer_sk


def test_correction_fixes_in_place(loaded):
    assert history(loaded, "P2") == [("Baker", "310456", "None", "9999-12-31", True)]
    row = fact(loaded, "P2")
    assert row.is_corrected and str(row.filing_date) == "2024-03-01" and row.taxpayer_sk is not None


def test_correction_of_money_is_audited(loaded):
    (row,) = loaded.table("fact_corrections").collect()
    assert (row.taxpayer_id, str(row.corrected_at), row.old_tax_payable_sgd) == ("P3", D2, 4310.0)
    assert fact(loaded, "P3").tax_payable_sgd == 9000.0


def test_same_day_update_leaves_an_empty_version(loaded):
    assert [h[2:4] for h in history(loaded, "P4")] == [(D2, D2), (D2, "9999-12-31")]
    newest = serving.history_of(loaded.table("dim_taxpayer"), "P4").collect()[-1]
    assert fact(loaded, "P4").taxpayer_sk == newest.taxpayer_sk


def test_unchanged_update_and_rejected_row(loaded):
    assert len(history(loaded, "P5")) == 1
    assert fact(loaded, "P5").record_type == "update"
    (row,) = loaded.rejected().collect()
    assert (row.batch, row.reason, row.taxpayer_id, row.assessment_year) == ("day3", "unreadable period", "P5", "x")
    assert (row.full_name, row.record_type) == ("Pat Example", "new") and "day3" in row.row_pos


def test_unknown_employers(loaded):
    assert tuple(checks.unknown_links(loaded.table("fact_tax_returns")).first()) == (7, 1)


def test_integrity(loaded):
    t = loaded.tables()
    dim, facts = t["dim_taxpayer"], t["fact_tax_returns"]
    assert checks.several_current(dim).isEmpty()
    assert checks.repeated_grain(facts).isEmpty()
    assert checks.dangling_links(facts, dim, t["dim_employer"]).isEmpty()
    assert checks.gaps_between_versions(dim, order="taxpayer_sk").isEmpty()
    assert not checks.gaps_between_versions(
        dim.withColumn("valid_to", F.lit("2020-01-01").cast("date")), order="taxpayer_sk"
    ).isEmpty()
    assert checks.content_difference(facts, facts).isEmpty()
    assert checks.content_difference(facts, facts.limit(6)).count() == 1


def test_checks_of_touched_keys_find_what_full_checks_find(loaded):
    t = loaded.tables()
    dim, facts, employers = t["dim_taxpayer"], t["fact_tax_returns"], t["dim_employer"]
    batch = loaded.spark.createDataFrame([("P1", "2023"), ("P3", "2023"), ("P5", "x"), (None, "2023")], f"{KEY} string, {PERIOD} string")
    assert loaded.check_touched(batch).isEmpty()
    broken = dim.withColumn("valid_to", F.lit("2020-01-01").cast("date")).withColumn("is_current", F.lit(True))
    twice = facts.unionByName(facts.where(F.col(KEY).isin("P1", "P2")))
    some = employers.where("employer_id = 'UNKNOWN'")
    full = checks.violations(broken, twice, some).collect()
    touched = checks.violations(checks.on_keys(broken, batch, [KEY]), checks.on_keys(twice, batch, [KEY]), some).collect()
    by_key = {(r.check, r.value, r.n) for r in full if r.value[:2] in ("P1", "P3")}
    assert by_key and by_key == {(r.check, r.value, r.n) for r in touched if r.check != "dangling link"}
    assert [(r.value, r.n) for r in touched if r.check == "dangling link"] == [("employer_id=E1", 4)]  # P1 twice, P3, P5


def test_checks_of_touched_keys_read_their_partitions_only(spark, folder, tmp_path):
    w = Warehouse(spark, str(tmp_path), buckets=3)
    w.load_employers(employer_frame(spark))
    w.backfill(str(folder), computed_at=AT)
    w.compact()
    batch = spark.createDataFrame([("P1", "2023")], f"{KEY} string, {PERIOD} string")
    found = w.check_touched(batch)
    assert found.isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[isnotnull\((bucket|part)#\d+\), \((?:bucket|part)#\d+ = \d+\)", plan)
    assert {"bucket", "part"} == set(pruned)


def test_content_by_sums(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "a"), (2, "a", None), (3, "x", "y")] + [(k, str(k), None) for k in range(10, 400)]
    before = spark.createDataFrame(rows, "k int, a string, b string").withColumn("s", F.struct("a", "b")).repartition(5)
    after = spark.createDataFrame([(1, "a", None), (2, "a", None), (2, "a", None), *rows[4:]][::-1], "k int, a string, b string").withColumn("s", F.struct("a", "b"))
    for parts in (1, 3, 64):
        found = checks.content_difference_by_sums(before, after, parts).collect()
        assert sorted(map(str, found)) == sorted(map(str, checks.content_difference(before, after).collect()))
        assert sorted((r.k, r.a, r.b, r.side) for r in found if r.a) == [(1, "a", None, "before"), (2, "a", None, "after")]
        assert checks.content_difference_by_sums(before, before.repartition(3), parts).isEmpty()
    assert checks.content_difference_by_sums(before.limit(0), after.limit(0)).isEmpty()
    assert checks.content_difference_by_sums(before.limit(0), after).count() == after.count()
    whole = checks.content_sums(after, 7)
    halves = checks.merged_sums(checks.content_sums(after.where("k < 50"), 7), checks.content_sums(after.where("k >= 50"), 7))
    assert sorted(whole.collect()) == sorted(halves.collect())


def test_metrics_and_latest(loaded):
    metrics = loaded.table("agg_data_quality_metrics")
    day1 = {r.domain: r.score for r in metrics.where("batch = 'day1'").collect()}
    assert day1 == {"completeness": 100.0, "validity": 80.0, "accuracy": 100.0}
    assert [r.batch for r in serving.metric_listing(metrics).collect()][::3] == ["day1", "day2", "day3"]


def test_serving(loaded):
    dim, facts = loaded.table("dim_taxpayer"), loaded.table("fact_tax_returns")
    top = loaded.summary("occupation").collect()
    assert [(r.group_value, r.num_returns, r.total_tax_payable) for r in top] == [
        ("Baker", 5, 26240.0),
        ("Nurse", 1, 4310.0),
        ("Senior Baker", 1, 4310.0),
    ]
    assert [r.group_value for r in loaded.summary("occupation", 1, 1).collect()] == ["Nurse"]
    for bad in ({"by": "banana"}, {"by": "occupation", "limit": 0}, {"by": "occupation", "limit": 501},
                {"by": "occupation", "offset": -1}):
        with pytest.raises(ValueError):
            loaded.summary(**bad)
    assert serving.require_profile(dim, "P2").postal_code == "310456"
    with pytest.raises(KeyError):
        serving.require_profile(dim, "nobody")
    assert loaded.current().count() == 7
    assert serving.returns_of(facts, "P3").first().tax_payable_sgd == 9000.0
    assert serving.fact_sample(facts, 2).count() == 2
    assert serving.audit_listing(loaded.table("fact_corrections")).count() == 1


def test_replays_change_nothing(loaded, folder):
    before = contents(loaded)
    loaded.backfill(str(folder), "day2", computed_at=AT)
    loaded.backfill(str(folder), "day1", computed_at=AT)
    assert contents(loaded) == before


def test_rebuild_gives_the_same_tables(spark, loaded, folder, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.rebuild(read_log(spark, list_batches(spark, str(folder))), employer_frame(spark), AT)
    assert comparable(w) == comparable(loaded)
    before = contents(w)
    w.backfill(str(folder), "day3", computed_at=AT)
    assert contents(w) == before


def test_stream_loads_new_files_once_and_resumes(spark, loaded, folder, tmp_path):
    inbox, progress = tmp_path / "in", tmp_path / "progress"
    inbox.mkdir()
    w = Warehouse(spark, str(tmp_path / "wh"))
    w.load_employers(employer_frame(spark))

    def run():
        load_new_files(w, str(inbox), str(progress), computed_at=AT).awaitTermination()

    # Arrival order differs from name order within the first run.
    write_batch(inbox, 2)
    write_batch(inbox, 1)
    os.utime(inbox / "individual_tax_returns_day1.csv", (2e9, 2e9))
    run()
    assert [r.batch for r in w.batch_log().orderBy("batch_seq").collect()] == ["day1", "day2"]
    version, _ = w.store.latest()
    run()
    assert w.store.latest()[0] == version
    write_batch(inbox, 3)
    os.utime(inbox / "individual_tax_returns_day3.csv", (2.1e9, 2.1e9))
    run()
    assert comparable(w) == comparable(loaded)


def test_a_version_is_published_once(spark, loaded):
    version, listing = loaded.store.latest()
    with pytest.raises(Exception):
        loaded.store.publish(version, listing)


def test_stored_bucket_count_wins(spark, loaded, folder):
    other = Warehouse(spark, loaded.store.root, buckets=7)
    assert other.buckets == 3
    before = contents(loaded)
    other.backfill(str(folder), "day2", computed_at=AT)
    assert contents(other) == before


def test_interrupted_publish_is_passed_over(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.load_employers(employer_frame(spark))
    (tmp_path / "versions" / "v=2" / "_temporary").mkdir(parents=True)
    w.load_employers(employer_frame(spark))
    assert w.store.latest()[0] == 3 and w.table("dim_employer").count() == 3


def test_second_writer_of_a_version_fails(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.load_employers(employer_frame(spark))
    version, listing = w.store.latest()
    with pytest.raises(RuntimeError):
        w.store.publish(version, listing)


def test_vacuum_keeps_the_newest_version(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for _ in range(3):
        w.load_employers(employer_frame(spark))
    before = contents(w)
    assert w.vacuum() == 4 and w.vacuum() == 0
    assert contents(w) == before


def test_partitions_that_could_not_be_found_are_refused(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for bad in (-1, None):
        with pytest.raises(ValueError):
            w.store.write_split("t", spark.createDataFrame([(1, bad)], "a int, part int"), "part")


@pytest.mark.parametrize("when", [{"compact_rows": 0, "compact_share": 0.0}, {"max_deltas": 1}])
def test_folded_and_merged_deltas_give_the_same_tables(spark, loaded, folder, tmp_path, when):
    w = Warehouse(spark, str(tmp_path), buckets=3, **when)
    w.load_employers(employer_frame(spark))
    w.backfill(str(folder), computed_at=AT)
    facts = w.store.latest()[1]["fact_tax_returns"]
    assert {part: len(folders) for part, folders in facts.items()} == (
        {"facts/delta": 1} if "max_deltas" in when else {"facts/base": 1}
    )
    assert comparable(w) == comparable(loaded)


def test_a_load_writes_in_proportion_to_its_batch(spark, tmp_path):
    def log(rows):
        return frame(spark, rows).drop("batch", "batch_seq")

    w = Warehouse(spark, str(tmp_path), buckets=4)
    w.load_employers(employer_frame(spark))
    w.load_batch(log([person(i) for i in range(400)]), "day1", AT)
    w.compact()
    old = w.store.latest()[1]
    changes = [person(7, occupation="Nurse", record_type="update"), person(8, tax_paid_sgd="1", record_type="correction")]
    w.load_batch(log(changes), "day2", AT)
    new = w.store.latest()[1]
    for name in ("dim_taxpayer", "fact_tax_returns", "fact_corrections"):
        added = {f for parts in new[name].values() for f in parts} - {f for parts in old.get(name, {}).values() for f in parts}
        assert all(f in new[name][part] for part, folders in old.get(name, {}).items() for f in folders)
        assert sum(spark.read.parquet(f"{tmp_path}/{f}").count() for f in added) <= 3
    assert w.table("dim_taxpayer").count() == 401 and w.current().count() == 400
    assert w.table("fact_tax_returns").count() == 400 and w.table("fact_corrections").count() == 1
    before = contents(w)
    w.compact()
    assert contents(w) == before
    assert not any(part.endswith("/delta") for part in w.store.latest()[1]["fact_tax_returns"])


def test_report_of_a_load(spark, tmp_path):
    path = tmp_path / "individual_tax_returns_day1.csv"
    write_csv(path, [*BASE_COLUMNS, "surprise"], [{**person(1), "surprise": "x"}, {**person(2, postal_code="BAD"), "surprise": "y"}])
    w = Warehouse(spark, str(tmp_path / "wh"))
    w.load_employers(employer_frame(spark))
    (report,) = w.backfill(str(tmp_path))
    assert (report.batch, report.batch_seq, report.rows) == ("day1", 1, 2)
    assert report.added == ("batch_date", "record_type") and report.unexpected == ("surprise",)
    assert report.scores == {"completeness": 100.0, "validity": 50.0, "accuracy": 100.0}
    assert [r.batch for r in w.quality().collect()] == ["day1"] * 3
    assert w.summary("occupation", limit=None).count() == 1


def test_first_batch_date_in_file_order_counts(spark, tmp_path):
    rows = [person(1), person(1, occupation="Nurse", record_type="update")]
    w = Warehouse(spark, str(tmp_path))
    w.load_employers(employer_frame(spark))
    for batch, dates in (("day1", [None, None]), ("day2", ["2024-04-15", "15/04/2024"])):
        log = frame(spark, [{**rows[batch == "day2"], "batch_date": d, "taxpayer_id": f"P{i}"} for i, d in enumerate(dates)])
        w.load_batch(log.drop("batch", "batch_seq"), batch, AT)
    assert history(w, "P1")[0][3] == "2024-04-15"


def test_summary_is_kept_up_to_date(spark, tmp_path):
    """After every load, from totals alone, what a full recomputation gives."""
    batches = random_batches(6, keys=30, batches=4)
    for _, rows in batches:
        for i, r in enumerate(rows):
            r["tax_payable_sgd"] = ["12.5", "n/a", "7.25", None][i % 4]
    w = Warehouse(spark, str(tmp_path), buckets=3)
    w.load_employers(employer_frame(spark))

    def check(*dimensions):
        for by in dimensions:
            assert w.summary(by).collect() == w.summary(by, recompute=True).collect()

    for n, (_, rows) in enumerate(batches[:2], 1):
        w.load_batch(frame(spark, rows).drop("batch", "batch_seq"), f"day{n}", AT)
    check("occupation")
    log = [{**r, "batch_seq": n, "row_pos": i} for n, (_, rows) in enumerate(batches[2:], 1) for i, r in enumerate(rows)]
    w.load_batches(frame(spark, log), ["day3", "day4"], AT)
    check("occupation", "residential_status", "housing_type")
    w.load_batch(frame(spark, batches[1][1]).drop("batch", "batch_seq"), "day2", AT)  # a replay
    check("occupation")
    plan = w.summary("occupation")._jdf.queryExecution().optimizedPlan().toString()
    assert "assessment_year" not in plan and "filing_date" not in plan
    before = w.summary("occupation").collect()
    w.compact()
    assert w.summary("occupation").collect() == before


def test_summary_of_a_rebuilt_store(spark, folder, loaded, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.rebuild(read_log(spark, list_batches(spark, str(folder))), employer_frame(spark), AT)
    assert w.summary("occupation").collect() == loaded.summary("occupation").collect() == w.summary("occupation", recompute=True).collect()


def test_several_new_batches_are_refused_if_one_is_stored(spark, loaded):
    log = frame(spark, [person(1)]).drop("batch")
    with pytest.raises(ValueError):
        loaded.load_batches(log, ["day1"], AT)
    with pytest.raises(ValueError):
        loaded.load_batches(log, ["a", "a"], AT)


def test_empty_batches_among_several(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.load_employers(employer_frame(spark))
    reports = w.load_batches(frame(spark, [{**person(1), "batch_seq": 2}]).drop("batch"), ["day1", "day2", "day3"], AT)
    assert [(r.batch, r.batch_seq, r.rows) for r in reports] == [("day1", 1, 0), ("day2", 2, 1), ("day3", 3, 0)]
    assert set(reports[0].scores.values()) == {0.0} and len(reports[0].scores) == 3
    assert [(r.batch, r.total_rows) for r in w.batch_log().orderBy("batch_seq").collect()] == [("day1", 0), ("day2", 1), ("day3", 0)]
