"""Removal of repeated byte strings against a plain table of all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from histlake.llm import suffix_repeats
from histlake.llm.queries import op12_suffix_repeats

LENGTH = 100


def plain_removal(rows):
    """By (id, text): n_bytes, n_removed, n_spans and digest; rows of one id by text hash."""
    tagged = sorted({(2**63 - 1 if k is None else k, t) for k, t in rows}, key=lambda r: (r[0], r[1] is None, r[1] or ""))
    shared = {}
    for k, _ in rows:
        shared[k] = shared.get(k, 0) + 1
    def tag(k, t):
        h = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42
        return h - 2**64 if h >= 2**63 else h

    tagged.sort(key=lambda r: (r[0], tag(*r)))
    seen, out = set(), {}
    for k, t in tagged:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - LENGTH + 1):
            window = data[s : s + LENGTH]
            if window in seen:
                gone[s : s + LENGTH] = True
            seen.add(window)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[None if k == 2**63 - 1 else k, t] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def check(spark, rows, df=None):
    want = plain_removal(rows)
    df = frame(spark, rows) if df is None else df
    found = suffix_repeats.remove(df.withColumn("doc_id", F.col("doc_id"))).collect()
    texts = {}
    for k, t in rows:
        texts.setdefault(k, []).append(t)
    assert len(found) == len(rows)
    for k in texts:
        mine = sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found if r.doc_id == k)
        assert mine == sorted(want[k, t] for t in texts[k]), k
    return found


def corpus(seed, alphabet="abcdefgh é", n=60):
    rng = random.Random(seed)

    def junk(n):
        return "".join(rng.choices(alphabet, k=n))

    passages = [junk(rng.choice([40, 90, 99, 100, 101, 130, 250, 700])) for _ in range(8)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            parts += [junk(rng.randint(0, 60)), p if rng.random() < 0.6 else p[rng.randint(0, 30) : len(p) - rng.randint(0, 30)]]
        text = "".join(parts) + junk(rng.randint(0, 150))
        if rng.random() < 0.2 and rows:  # a near copy
            text = rng.choice(rows)[1]
            at = rng.randint(0, len(text))
            text = text[:at] + "#" + text[at:]
        rows.append((k, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,alphabet,stretch,hot", [(1, "abcdefgh é", 1 << 20, 4), (2, "ab", 700, 4), (3, "abc", 3000, 200), (4, "a", 1 << 20, 4), (5, "xyz中", 400, 500)])
def test_removal_equals_brute_force(spark, monkeypatch, seed, alphabet, stretch, hot):
    monkeypatch.setattr(suffix_repeats, "STRETCH_BYTES", stretch)
    monkeypatch.setattr(suffix_repeats, "HOT_SHARE", hot)
    monkeypatch.setattr(suffix_repeats, "HOT_SAMPLE", 1)
    check(spark, corpus(seed, alphabet))


def test_all_anchors_split(spark, monkeypatch):
    every = lambda rows: np.unique(np.array([r.bucket for r in suffix_repeats.runs(rows, np.zeros(0, np.uint64)).collect()], np.int64)).view(np.uint64)
    monkeypatch.setattr(suffix_repeats, "hot_anchors", every)
    check(spark, corpus(6, n=25))


def test_nothing_settled_by_content(spark, monkeypatch):
    """Every bucket with two runs goes through the suffix arrays."""
    real = suffix_repeats.Runs.__init__

    def apart(self, docs, tags, offsets, pieces, hot):
        real(self, docs, tags, offsets, pieces, hot)
        self.content = self.content + self.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.start.astype(np.uint64)

    class Apart(suffix_repeats.Runs):
        __init__ = apart

    monkeypatch.setattr(suffix_repeats, "Runs", Apart)
    check(spark, corpus(7))


def test_texts_of_one_id_and_repeated_rows(spark):
    rng = random.Random(8)
    p, q = ("".join(rng.choices("abcd ", k=300)) for _ in range(2))
    rows = [(7, p), (7, p), (7, q + p), (7, None), (3, q), (None, p), (None, q + "x" + q), (None, p), (9, ""), (9, ""), (-4, p[100:])]
    check(spark, rows)


def test_maximal_repeats_equal_all_pairs():
    rng = random.Random(9)
    for _ in range(40):
        center = "".join(rng.choices("ab", k=32)).encode()
        rows = []
        for k in range(rng.randint(2, 14)):
            left = b"".join(rng.choices([b"a", b"b"], weights=[9, 1], k=rng.randint(0, 68)))
            right = b"".join(rng.choices([b"a", b"b"], weights=[9, 1], k=rng.randint(max(0, 68 - len(left)), 68)))
            rows.append((center + right, left, (k, 0, 1000 * k)))
        rows.sort()
        gone = {}
        for before, depth, found in suffix_repeats.maximal_repeats(*map(list, zip(*rows))):
            assert len(found) > 1 and before + depth >= LENGTH
            for doc, _, _ in set(found) - {min(found)}:
                gone.setdefault(doc, set()).update(range(-before, depth))
        want = {}
        for r, l, (k, *_) in rows:
            for r2, l2, (k2, *_) in rows:
                lam, rho = suffix_repeats.common_prefix(l[::-1], l2[::-1]), suffix_repeats.common_prefix(r, r2)
                if k2 < k and lam + rho >= LENGTH:
                    want.setdefault(k, set()).update(range(-lam, rho))
        assert gone == want


def test_intervals_of_a_small_array():
    assert list(suffix_repeats.intervals([2, 4, 4, 1, 3], 1)) == [(1, 3, 4, 2), (0, 3, 2, 1), (4, 5, 3, 1), (0, 5, 1, 0)]
    assert list(suffix_repeats.intervals([2, 4, 4, 1, 3], 3)) == [(1, 3, 4, 2), (4, 5, 3, 2)]
    assert list(suffix_repeats.intervals([], 0)) == []


def test_common_prefix():
    assert [suffix_repeats.common_prefix(a, b) for a, b in ((b"", b"a"), (b"ab", b"abc"), (b"xbc", b"abc"), (b"abd", b"abc"), (b"\0a", b"\0b"))] == [0, 2, 0, 2, 1]


def test_awkward_rows_text_ids_and_empty_tables(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    clash = awkward.withColumns({c: F.lit(1) for c in ("doc", "tag", "shared", "count", "bucket", "place", "kept", "n_bytes")})
    short = [(k, t if len(t or "") < 5000 else None) for k, t in rows]
    check(spark, short)
    found = {r.n_bytes: r for r in suffix_repeats.remove(clash).collect() if r.doc_id in (6, 7)}
    assert len(found) == 1 and next(iter(found.values())).n_bytes > 200_000
    assert suffix_repeats.remove(nothing).count() == 0
    with pytest.raises(TypeError):
        suffix_repeats.remove(awkward, id_col="lang")


def test_query_over_the_driver_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = plain_removal(rows)
    found = op12_suffix_repeats(spark, folder).collect()
    by_id = dict(rows)
    assert len(found) == len(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, by_id[r.doc_id]] for r in found)
