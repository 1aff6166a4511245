"""One-pass build, batch-by-batch load and replay against a row-by-row loader."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from histlake.operators.dedupe import rejects
from histlake.operators import history
from histlake.operators.history import asof_link
from histlake.plans.state import (
    apply_batch,
    apply_batches,
    build_corrections,
    build_facts,
    build_versions,
    empty_state,
    rebuild,
)
from histlake.schema import AUDITED, EMPLOYER_COLUMNS, IDENTITY, KEY, MEASURES, PERIOD, TRACKED
from histlake.session import cut_lineage

from .helpers import RowByRow, frame, random_batches, returns

FACTS = [KEY, PERIOD, "version", "employer_id", "filing_date", "record_type", *MEASURES]
VERSIONS = [KEY, "version", *TRACKED, *IDENTITY, "valid_from", "valid_to", "is_current"]
AUDIT = [KEY, PERIOD, "corrected_at", *[f"old_{m}" for m in AUDITED]]


def rows(df, columns):
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


def as_text(expected):
    return sorted(map(str, expected))


def employer_frame(spark, ids=("E1", "E2")):
    ddl = ", ".join(f"{c} string" for c in EMPLOYER_COLUMNS[:5]) + ", employee_count int"
    return spark.createDataFrame([(i, "name", None, None, None, 1) for i in ids], ddl)


def log_of(spark, batches):
    flat = [
        {**r, "batch": f"day{b}", "batch_seq": b, "row_pos": i}
        for b, (_, batch) in enumerate(batches, 1)
        for i, r in enumerate(batch)
    ]
    return frame(spark, flat)


def with_version_numbers(state):
    """Versions and facts of a state with the version number next to the key."""
    order = F.struct("opened_seq", "taxpayer_sk")
    dim = state.versions
    ranked = dim.groupBy(KEY).agg(F.array_sort(F.collect_list(order)).alias("_all"))
    numbered = dim.join(ranked, KEY).withColumn(
        "version", F.expr("array_position(_all.taxpayer_sk, taxpayer_sk)").cast("int")
    )
    facts = state.facts.join(numbered.select("taxpayer_sk", "version"), "taxpayer_sk", "left")
    return numbered, facts


def saved(state):
    from dataclasses import replace

    names = ["current", "closed", "employers", "facts", "corrections"]
    return replace(state, **{n: cut_lineage(getattr(state, n)) for n in names})


@pytest.fixture(scope="module", params=[1, 2])
def scenario(request):
    batches = random_batches(request.param)
    expected = RowByRow({"E1", "E2"})
    for day, batch in batches:
        expected.load(batch, day)
    return batches, expected


def test_one_pass_build(spark, scenario):
    batches, expected = scenario
    log = cut_lineage(log_of(spark, batches))
    versions = build_versions(log)
    assert rows(versions, VERSIONS) == as_text(expected.version_rows())
    facts = build_facts(log, versions, employer_frame(spark))
    linked = facts.withColumn("version", F.col("taxpayer_sk").cast("int"))
    assert rows(linked, FACTS) == as_text(expected.fact_rows())
    assert rows(build_corrections(log), AUDIT) == as_text(expected.audit_rows())
    assert len(expected.audit) > 5 and len(expected.version_rows()) > 50


def test_one_pass_build_with_surrogate_keys(spark, scenario):
    batches, expected = scenario
    state = rebuild(cut_lineage(log_of(spark, batches)), employer_frame(spark))
    versions, facts = with_version_numbers(state)
    assert rows(versions, VERSIONS) == as_text(expected.version_rows())
    assert rows(facts, FACTS) == as_text(expected.fact_rows())
    assert rows(state.corrections, AUDIT) == as_text(expected.audit_rows())
    n = len(expected.version_rows())
    assert sorted(r[0] for r in versions.select("taxpayer_sk").collect()) == list(range(1, n + 1))


def test_batch_by_batch_and_replay(spark):
    batches = random_batches(3, keys=60, batches=4)
    expected = RowByRow({"E1", "E2"})
    for day, batch in batches:
        expected.load(batch, day)
    state = empty_state(spark, employer_frame(spark))
    frames = [cut_lineage(frame(spark, batch)) for _, batch in batches]
    for seq, ((day, _), df) in enumerate(zip(batches, frames), 1):
        state = saved(apply_batch(state, df, seq, day).state)

    def check(state):
        versions, facts = with_version_numbers(state)
        assert rows(versions, VERSIONS) == as_text(expected.version_rows())
        assert rows(facts, FACTS) == as_text(expected.fact_rows())
        assert rows(state.corrections, AUDIT) == as_text(expected.audit_rows())

    check(state)
    # Replays of an old and of the newest batch change nothing.
    for seq in (2, 4):
        state = saved(apply_batch(state, frames[seq - 1], seq, batches[seq - 1][0]).state)
    check(state)


@pytest.mark.parametrize("seed, alone", [(3, 0), (4, 1), (5, 2), (8, 3)])
def test_several_batches_in_one_step(spark, seed, alone):
    """The first batches one by one, then all others in one step: tables and keys are
    those of loading every batch by itself."""
    batches = random_batches(seed, keys=40, batches=6)
    expected = RowByRow({"E1", "E2"})
    for day, batch in batches:
        expected.load(batch, day)
    state = empty_state(spark, employer_frame(spark))
    for seq, (day, batch) in enumerate(batches[:alone], 1):
        state = saved(apply_batch(state, frame(spark, batch), seq, day).state)
    log = log_of(spark, batches).where(F.col("batch_seq") > alone)
    step = apply_batches(state, cut_lineage(log), alone + 1)
    state = saved(step.state)
    versions, facts = with_version_numbers(state)
    assert rows(versions, VERSIONS) == as_text(expected.version_rows())
    assert rows(facts, FACTS) == as_text(expected.fact_rows())
    assert rows(state.corrections, AUDIT) == as_text(expected.audit_rows())
    n, logged = len(expected.version_rows()), len(expected.audit_rows())
    assert sorted(r[0] for r in versions.select("taxpayer_sk").collect()) == list(range(1, n + 1))
    assert sorted(r[0] for r in state.corrections.select("correction_id").collect()) == list(range(1, logged + 1))
    assert (state.last_taxpayer_sk, state.last_correction_id) == (n, logged)
    ahead = rebuild(log_of(spark, batches), employer_frame(spark)).versions
    keys = ["taxpayer_sk", "taxpayer_id", "opened_seq", "touched_seq"]
    assert rows(versions, keys) == rows(ahead, keys)


def test_every_row_is_loaded_or_rejected(spark, scenario):
    batches, _ = scenario
    log = log_of(spark, batches)
    refused = rejects(log, "row_pos")
    total = sum(len(b) for _, b in batches)
    kept = {
        (b, r["taxpayer_id"], r["assessment_year"])
        for b, (_, batch) in enumerate(batches)
        for r in batch
        if r["taxpayer_id"] and r["assessment_year"].isdigit()
    }
    assert refused.count() == total - len(kept)
    assert {r.reason for r in refused.select("reason").distinct().collect()} == {
        "missing key",
        "unreadable period",
        "superseded in batch",
    }


def test_asof_boundaries(spark):
    """Start is inside, end is outside, empty intervals match nothing, unknown starts
    and missing dates fall back to the current version."""
    d = datetime.date.fromisoformat
    end = d("9999-12-31")
    versions = spark.createDataFrame(
        [
            ("a", 1, 11, d("2024-01-01"), d("2024-02-01")),
            ("a", 2, 12, d("2024-02-01"), d("2024-02-01")),
            ("a", 3, 13, d("2024-02-01"), end),
            ("b", 1, 21, None, d("2024-03-01")),
            ("b", 2, 22, d("2024-03-01"), end),
        ],
        "k string, opened_seq int, sk int, valid_from date, valid_to date",
    )
    cases = [
        ("a", "2024-01-01", 9, 11, True),
        ("a", "2024-01-31", 9, 11, True),
        ("a", "2024-02-01", 9, 13, True),
        ("a", "2023-12-31", 9, 13, False),
        ("a", None, 9, 13, False),
        ("a", "2024-05-01", 1, 11, True),  # loaded before the later versions existed
        ("a", None, 1, 11, False),
        ("b", "2024-02-01", 9, 22, False),
        ("b", "2024-03-01", 9, 22, True),
        ("c", "2024-03-01", 9, None, False),
    ]
    facts = spark.createDataFrame(
        [(k, t and d(t), s, i) for i, (k, t, s, _, _) in enumerate(cases)],
        "k string, day date, seq int, i int",
    )
    for many in (False, True):
        got = asof_link(facts, versions, "day", "seq", "k", "sk", "as_of", many).orderBy("i").collect()
        assert [(r.sk, r.as_of) for r in got] == [(c[3], c[4]) for c in cases]


def plain_link(versions, day, seq):
    """(sk, found) by the definition; `versions` are (seq, sk, lo, hi) in order."""
    seen = [v for v in versions if v[0] <= seq]
    if not seen:
        return None, False
    last = seen[-1]
    for s, sk, lo, hi in reversed(seen):
        hi = datetime.date(9999, 12, 31) if s == last[0] else hi
        if day and lo and hi and lo <= day < hi:
            return sk, True
    return last[1], False


@pytest.mark.parametrize("many, hot", [(False, 10**6), (True, 10**6), (True, 7)])
def test_asof_link_equals_the_definition(spark, monkeypatch, many, hot):
    """Dates that go back, are missing or empty, versions not seen yet, repeated facts."""
    monkeypatch.setattr(history, "HOT_FACTS", hot)
    rng = random.Random(hot)
    d = datetime.date(2024, 1, 1)

    def some_day():
        return rng.choice([None, *[d + datetime.timedelta(days=rng.randint(0, 40)) for _ in range(6)]])

    versions, facts = [], []
    for k in range(40):
        seqs = sorted(rng.sample(range(1, 40), rng.randint(1, 12)))
        starts = [some_day() for _ in seqs]
        if k % 2:
            starts = sorted((x for x in starts if x), key=str) + [None] * starts.count(None)
        for i, (s, lo) in enumerate(zip(seqs, starts)):
            versions.append((f"k{k}", s, 100 * k + i, lo, starts[i + 1] if i + 1 < len(seqs) else datetime.date(9999, 12, 31)))
    for i in range(1500):
        facts.append((rng.choice([None, "nobody", "k0", "k1", *(f"k{k}" for k in range(40))]), some_day(), rng.randint(0, 41), i // 2 if i % 100 == 0 else i))
    facts += facts[:20]
    vf = spark.createDataFrame(versions, "k string, opened_seq int, sk int, valid_from date, valid_to date").repartition(3)
    ff = spark.createDataFrame(facts, "k string, day date, seq int, _id int").repartition(4)
    got = sorted(map(str, (tuple(r) for r in asof_link(ff, vf, "day", "seq", "k", "sk", "hit", many).collect())))
    of = {}
    for k, *v in versions:
        of.setdefault(k, []).append(tuple(v))
    assert got == sorted(str((*f, *plain_link(of.get(f[0], []), f[1], f[2]))) for f in facts)


def test_correction_and_update_of_one_batch_both_act(spark):
    first = frame(spark, returns({"occupation": "Baker"}))
    second = frame(
        spark,
        returns(
            {"occupation": "Nurse", "record_type": "update", "batch_date": "2024-04-15"},
            {"occupation": "Clerk", "assessment_year": "2022", "record_type": "correction", "batch_date": "2024-04-15"},
        ),
        "day2",
        2,
    )
    got = [tuple(r) for r in build_versions(first.unionByName(second)).orderBy("version").select("occupation", "is_current").collect()]
    assert got == [("Clerk", False), ("Nurse", True)]
