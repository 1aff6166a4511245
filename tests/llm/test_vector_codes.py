"""Product codes of vectors against a plain version with Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histlake.llm import vector_codes
from histlake.llm.queries import op13_vector_codes


def plain_codes(rows, entries=64, rounds=2, parts=16):
    """{(id, vector): (code, error, label error)} and the digest, by the definition."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    size = len(kept[0][1]) // parts if kept else 0

    def cut(v, p):
        return v[p * size : (p + 1) * size]

    def nearest(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return min(range(len(book)), key=lambda k: (far[k], k)), min(far)

    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(cut(v, p), books[p])[0], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out, by_label = [], {}
    for i, v, lab in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        error = sum(f for _, f in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, lab, "".join(f"{k:02x}" for k, _ in found), error))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, c, e, by_label[lab]) for i, lab, c, e in out), digest


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(9)]
    rows = [(k, [x + rng.gauss(0, 0.2) for x in rng.choice(centers)], rng.choice([None, 1, 2, 2, 2])) for k in range(n)]
    return rows + [(n, rows[0][1], 1), (n + 1, rows[0][1], None), (n + 2, [0.0] * dims, 3), (n + 3, [-0.001] * dims, 3)]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


@pytest.mark.parametrize("n,dims,spread", [(500, 64, 1.0), (300, 16, 0.01), (20, 32, 1.0), (200, 48, 3e4), (60, 16, 1e5)])
def test_codes_equal_the_plain_version(spark, monkeypatch, n, dims, spread):
    monkeypatch.setattr(vector_codes, "CHUNK_BYTES", 8 * dims * 100)
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 8)
    rows = vectors(n, dims, n, spread)
    rng = random.Random(4)
    rng.shuffle(rows)
    want, digest = plain_codes(rows)
    found, books = vector_codes.compress(frame(spark, rows))
    assert vector_codes.books_sha256(books) == digest
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()) == want


def test_unusable_and_repeated_vectors(spark):
    rows = vectors(90, 16, 2)
    bad = [(-1, None, 1), (-2, [None] + [0.0] * 15, 1), (-3, [float("nan")] * 16, 1), (-4, [float("inf")] + [0.0] * 15, 2), (None, None, None)]
    short = [(500, [0.5] * 15, 1), (501, [], 1), (502, [0.5] * 32, 1)]
    repeated = [rows[3], rows[3], (7, rows[9][1], 2)]
    found, books = vector_codes.compress(frame(spark, rows + bad + short + repeated))
    want, digest = plain_codes(rows + bad + repeated)
    assert vector_codes.books_sha256(books) == digest
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()) == want


def test_empty_table_extra_columns_and_null_ids(spark):
    rows = vectors(30, 16, 3)
    plain = frame(spark, rows, "float")
    for df in (plain.where("false"), frame(spark, [(1, None, None)])):
        found, books = vector_codes.compress(df)
        assert found.count() == 0 and found.columns == ["vec_id", "label", "code", "error", "label_error"] and books.size == 0
    clash = plain.select("*", *[F.lit(9).alias(c) for c in ("id", "vector", "code", "error", "label_error", "of", "total", "n", "flat")])
    with_null = clash.unionByName(clash.limit(1).withColumn("vec_id", F.lit(None).cast("long")))
    found = vector_codes.compress(with_null)[0].collect()
    assert len(found) == len(rows) + 1 and sum(r.vec_id is None for r in found) == 1


def test_huge_components_neither_overflow_nor_fail(spark):
    rows = [(k, [10.0 ** (k * 4)] * 16, None) for k in range(60)] + [(90, [1e308] * 16, 4)]
    found = {r.vec_id: r for r in vector_codes.compress(frame(spark, rows))[0].collect()}
    assert len(found) == 61 and found[0].error == 0 and all(0 <= r.error <= r.label_error < 2**63 for r in found.values())


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(6)
    rows = rng.integers(-300, 300, (20_000, 4))
    rows = rows[vector_codes.hilbert_order(rows)]
    entries = rng.integers(-300, 300, (64, 4))
    blocks = vector_codes.Blocks(rows)
    lists = blocks.shortlists(entries)
    best = ((rows[:, None] - entries) ** 2).sum(-1).argmin(1)
    assert all(lists[k // vector_codes.BLOCK_ROWS, e] for k, e in enumerate(best))
    assert lists.mean() < 0.8


def test_hilbert_neighbours_are_near():
    grid = np.stack(np.meshgrid(np.arange(32), np.arange(32)), -1).reshape(-1, 2)
    path = grid[vector_codes.hilbert_order(grid)]
    assert (abs(np.diff(path, axis=0)).sum(1) == 1).mean() > 0.95
    assert len(vector_codes.hilbert_order(np.arange(800).reshape(10, 80))) == 10


def test_query_over_the_driver_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, digest = plain_codes(rows)
    found = op13_vector_codes(spark, folder).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in found) == want
    assert {r.codebooks_sha256 for r in found} == {digest}
