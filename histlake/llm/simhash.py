"""Near-duplicate groups by SimHash with covering-code anchors.

Anchors are the words of the perfect Hamming code of length 31, whose covering radius
is 1. Two fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of
one of their 32-bit halves, so in at most 1 bit of its lower 31. One of the two lies
within radius 1 of its anchor, the other then within 1 + 1 = 2 of the same anchor.
Every distinct fingerprint is therefore copied, for each half, to all anchors within
distance 2 (16, or 1 if it is an anchor itself), and compared per anchor over all 64
bits. No pair is lost and no list of candidates is cut.

Inside an anchor the links found are reduced to a spanning forest before they leave the
task, so a group of n fingerprints gives at most n - 1 rows. An anchor that very many
fingerprints share is split by the bytes of the other half: of its four bytes one at
least is equal in any linked pair.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, connected_components, map_batches, map_slices, unused, utf8, work_table

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
HOT_ROWS = 20_000  # of an anchor: beyond, it is split
HOT_SAMPLE = 16  # one of so many fingerprints is looked at to find such anchors
BUFFER_ROWS = 400_000  # handled at once in a task
CELL_ROWS = 128  # up to here all pairs of an anchor are compared at once
PAIRS = 2_000_000  # compared at once

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
# Columns of the parity check matrix: position p of 1..31 is the number p itself.
CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)) for j in range(5)]
LOW31 = np.uint64(0x7FFFFFFF)


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of the word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    stops = ends[len(words) - n :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        slices = map(slice, starts[at : at + 65536], stops[at : at + 65536])
        count = min(65536, n - at)
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, slices), repeat(SEED)), np.uint64, count)
        octets = h.view(np.uint8).reshape(count, 8)
        if count < 200:
            votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for k in range(8):
                votes[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ BITS
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; a null text has no words."""

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = np.array([fingerprint(t) for t in utf8(batch.column(2))], np.uint64).view(np.int64)
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(fp)], ["id", "text_hash", "fp"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, text_hash long, fp long")


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor key and whether the anchor is within radius 1, for each copy."""
    rows, keys, homes = [], [], []
    every = np.arange(len(fp))
    for half in (0, 1):
        x = (fp >> np.uint64(32 * half)) & LOW31
        syndrome = np.zeros(len(fp), np.uint64)
        for j, mask in enumerate(CHECKS):
            syndrome |= (np.bitwise_count(x & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(j)
        tag = np.uint64(half << 32)
        flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, np.uint64(1)) - np.uint64(1)), np.uint64(0))
        rows.append(every)
        keys.append((x ^ flip) | tag)
        homes.append(np.ones(len(fp), bool))
        for i in range(1, 32):
            other = syndrome ^ np.uint64(i)
            there = np.flatnonzero((syndrome > 0) & (other > i))
            two = np.uint64(1 << (i - 1)) | (np.uint64(1) << (other[there] - np.uint64(1)))
            rows.append(there)
            keys.append((x[there] ^ two) | tag)
            homes.append(np.zeros(len(there), bool))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def copies(distinct: DataFrame) -> DataFrame:
    """(key, fp, home): every fingerprint at every anchor within distance 2 of a half."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(start, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                rows, keys, homes = anchors_of(fp)
                yield pa.record_batch(
                    [pa.array(keys.view(np.int64)), pa.array(fp[rows].view(np.int64)), pa.array(homes)], ["key", "fp", "home"]
                )

    return map_batches(distinct, run, "key long, fp long, home boolean")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest linked row of each of n rows under the links a - b."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def explore(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest of a large cell: each visited row takes what is near it out of the rest."""
    a, b = [], []
    rest = np.unique(fp)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= MAX_DISTANCE
            if near.any():
                found = rest[near]
                rest = rest[~near]
                a.append(np.full(len(found), x, np.uint64))
                b.append(found)
                front.extend(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def link_cells(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by key, as a forest per key."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts = np.r_[0, cuts]
    sizes = np.diff(np.r_[starts, len(key)])
    outs = [explore(fp[s : s + m]) for s, m in zip(starts[sizes > CELL_ROWS], sizes[sizes > CELL_ROWS])]
    cell = np.repeat(np.arange(len(starts)), sizes)
    left = np.flatnonzero(home & (sizes[cell] > 1) & (sizes[cell] <= CELL_ROWS))
    many = sizes[cell[left]]
    upto = np.cumsum(many)
    at, pairs = 0, [(np.zeros(0, np.int64),) * 2]
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS)))
        m = many[at:to]
        a = np.repeat(left[at:to], m)
        b = np.repeat(starts[cell[left[at:to]]] - (np.cumsum(m) - m), m) + np.arange(len(a))
        d = fp[a] ^ fp[b]
        near = (np.bitwise_count(d) <= MAX_DISTANCE) & (d != 0)
        pairs.append((a[near], b[near]))
        at = to
    a, b = (np.concatenate(x) for x in zip(*pairs))
    if len(a):
        rows, flat = np.unique(np.r_[a, b], return_inverse=True)
        low = forest(flat[: len(a)], flat[len(a) :], len(rows))
        child = low != np.arange(len(rows))
        outs.append((fp[rows[child]], fp[rows[low[child]]]))
    none = (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(none, *outs))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (column fp) of each group."""
    spread = copies(distinct)
    sampled = copies(distinct.where(F.pmod(F.hash("fp"), F.lit(HOT_SAMPLE)) == 0))
    hot = work_table(sampled.groupBy("key").count().where(F.col("count") > HOT_ROWS // HOT_SAMPLE).select("key"))
    if not hot.isEmpty():
        half = F.col("key").bitwiseAND(1 << 32) == 0
        rest = F.when(half, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
        octets = [F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(rest, 8 * k).bitwiseAND(255).alias("v")) for k in range(4)]
        plain = F.array(F.struct(F.lit(-1).alias("k"), F.lit(0).cast("long").alias("v")))
        marked = spread.join(hot.withColumn("hot", F.lit(True)), "key", "left")
        cells = marked.withColumn("o", F.explode(F.when(F.col("hot"), F.array(*octets)).otherwise(plain)))
        # Where an anchor is split, all its fingerprints are compared with each other.
        spread = cells.select(
            F.when(F.col("o.k") < 0, F.col("key")).otherwise(F.xxhash64("key", "o.k", "o.v")).alias("key"),
            "fp",
            (F.col("home") | (F.col("o.k") >= 0)).alias("home"),
        )

    def run(batches: Batches) -> Batches:
        held: list[tuple] = []

        def out(rows: tuple) -> pa.RecordBatch:
            a, b = link_cells(*rows)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            key, fp, home = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            held.append((key, fp.view(np.uint64), home))
            if sum(len(h[0]) for h in held) >= BUFFER_ROWS:
                rows = tuple(np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on
                held = [tuple(x[cut:] for x in rows)]
                if cut:
                    yield out(tuple(x[:cut] for x in rows))
        if held:
            yield out(tuple(np.concatenate(x) for x in zip(*held)))

    return map_batches(spread.repartition("key").sortWithinPartitions("key"), run, "a long, b long")


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp, group, component_id) of every row.

    `component_id` is the smallest id reachable by links, `group` the smallest
    fingerprint (signed) reachable. Exact copies share a fingerprint and are compared
    once. Null texts and texts without words have fingerprint 0; null ids don't count
    as smallest and give null only where a group has no other. Repeated rows each stay.
    """
    fps = work_table(fingerprints(df, id_col=id_col, text_col=text_col))
    distinct = work_table(fps.groupBy("fp").agg(F.min("id").alias("low")))
    joined = connected_components(links(distinct.select("fp")))
    label = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("group")
    )
    smallest = label.groupBy("group").agg(F.min("low").alias("component_id"))
    label = work_table(label.select("fp", "group").join(smallest, "group"))
    return fps.join(label, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "group", "component_id")


def one_per_group(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, unchanged: of each group that with the smallest id, once.

    A group without any id keeps the row with the smallest text hash; of repeated rows
    one stays. Columns may have any names.
    """
    found = work_table(near_duplicates(df, id_col=id_col, text_col=text_col))
    mine = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    # Several texts under the smallest id: one of them stays.
    keep = mine.groupBy("group").agg(F.min(F.struct("text_hash")).alias("first"), F.count("*").alias("rows"))
    stay = mine.join(keep, "group").where("text_hash = first.text_hash")
    own, stay_id, stay_hash, stay_rows = unused(df, "hash", "stay_id", "stay_hash", "stay_rows")
    stay = work_table(stay.groupBy(F.col(id_col).alias(stay_id), F.col("text_hash").alias(stay_hash)).agg(F.max("rows").alias(stay_rows)))
    rows = df.withColumn(own, F.xxhash64(text_col)).join(
        stay, F.col(id_col).eqNullSafe(F.col(stay_id)) & (F.col(own) == F.col(stay_hash))
    )
    if stay.where(F.col(stay_rows) > 1).isEmpty():
        return rows.select(*df.columns)
    alone = rows.where(F.col(stay_rows) == 1)
    repeated = rows.where(F.col(stay_rows) > 1).dropDuplicates([stay_id, stay_hash])
    return alone.unionByName(repeated).select(*df.columns)
