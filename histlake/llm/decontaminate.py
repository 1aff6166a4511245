"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a stretch of the documents a task reads, bounded in words. Its words are
numbered by the benchmark's vocabulary. A word that no test phrase has cannot lie inside
an occurrence, so such words only separate runs, and runs shorter than the shortest
phrase are left out; what remains is indexed: suffix array by prefix doubling,
Burrows-Wheeler transform in a wavelet matrix with rank counts, and suffix positions
sampled. All phrases are searched backward at once, occurrences are located by walking
to a sampled position, and their word spans are merged per document.

No document is shuffled. The benchmark reaches the tasks in blocks of at most
`BLOCK_BYTES` of text, each of which passes over all shards.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, map_batches, map_slices, unused, utf8, work_table

WINDOW = 13
SHARD_WORDS = 400_000
BLOCK_BYTES = 2 << 20
SAMPLE = 8  # one of so many positions is kept
CONTAMINATED = 20  # hit words times this reach the number of words
# Lower-cases A-Z; what is neither digit, letter nor beyond ASCII separates words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def pieces(text: bytes, limit: int) -> list[bytes]:
    """The text, or if it is longer, pieces of about `limit` bytes with the same windows."""
    words = words_of(text) if len(text) > limit else []
    if len(words) <= WINDOW:
        return [text]
    out, start = [], 0
    while True:
        stop, held = start, 0
        while stop < len(words) and (stop - start < WINDOW or held + len(words[stop]) < limit):
            held += len(words[stop]) + 1
            stop += 1
        out.append(b" ".join(words[start:stop]))
        if stop == len(words):
            return out
        start = stop - WINDOW + 1


class Phrases:
    """Distinct windows of a block of items over the block's vocabulary (from 1 on)."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for k in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                windows.setdefault(tuple(ids[k : k + WINDOW]), set()).add(item)
        self.items = [sorted(x) for x in windows.values()]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        # Last word first: column t is the word met at step t of a backward search.
        self.turned = np.zeros((len(windows), WINDOW), np.int64)
        for row, w in zip(self.turned, windows):
            row[: len(w)] = w[::-1]


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector with block counts per symbol bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        n = len(symbols)
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))]
            self.levels.append((level, words, counts, n - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def ones(words: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return counts[at >> 6] + np.bitwise_count(inside)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        start = np.zeros_like(at)
        for level, words, counts, zeros in self.levels:
            bit = (symbol >> level & 1).astype(bool)
            a, b = self.ones(words, counts, start), self.ones(words, counts, at)
            start, at = np.where(bit, zeros + a, start - a), np.where(bit, zeros + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for level, words, counts, zeros in self.levels:
            bit = words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            before = self.ones(words, counts, at)
            symbol |= bit.astype(np.int64) << level
            at = np.where(bit > 0, zeros + before, at - before)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order. 0 separates: each is different, earlier ones are smaller."""
    gaps = text == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, int(gaps.sum()) + text)
    step = 1
    while True:
        after = np.zeros(len(text), np.int64)
        after[:-step] = rank[step:] + 1
        key = rank << 32 | after
        order = np.argsort(key, kind="stable")
        new = np.empty(len(text), np.int64)
        new[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        if new[order[-1]] == len(text) - 1 or step >= len(text):
            return order
        rank, step = new, 2 * step


class FMIndex:
    """Index of a text of symbols; phrases don't contain 0, which separates runs."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.r_[0, text, 0]  # every run has a separator before and after it
        order = suffix_array(text)
        last = text[order - 1]  # before the first comes the last, also a separator
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols + 1))]
        self.size = len(text)
        self.last = WaveletMatrix(last, max(1, int(symbols).bit_length()))
        kept = (order % SAMPLE == 0) | (last == 0)
        self.kept, self.where = kept, np.where(kept, np.cumsum(kept) - 1, -1)
        self.positions = order[kept]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high): rows of the suffixes that begin with each phrase found."""
        alive = np.arange(len(phrases.lengths))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.size)
        for t in range(WINDOW):
            going = t < phrases.lengths[alive]
            symbol = phrases.turned[alive, t]
            base = self.first[symbol]
            low = np.where(going, base + self.last.rank(symbol, low), low)
            high = np.where(going, base + self.last.rank(symbol, high), high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking left to a sampled position."""
        out, left, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(rows):
            done = self.kept[rows]
            out[left[done]] = self.positions[self.where[rows[done]]] + steps
            rows, left, steps = rows[~done], left[~done], steps + 1
            symbol = self.last.access(rows)
            rows = self.first[symbol] + self.last.rank(symbol, rows)
        return out - 1  # without the separator put in front


def shard_hits(found: list[list[int]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Merged word spans and items of each document of a shard, given as word numbers."""
    sizes = np.array([len(f) for f in found])
    out = [([], set()) for _ in found]
    if not len(phrases.lengths) or not sizes.sum():
        return out
    # A separator after each document; place[k] is the word's number in the shard.
    text = np.fromiter((x for f in found for x in (*f, 0)), np.int64, int(sizes.sum()) + len(found))
    known = text > 0
    edges = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= phrases.lengths.min()
    starts, stops = starts[long], stops[long]
    if not len(starts):
        return out
    runs = stops - starts + 1  # each with the separator after it
    place = np.repeat(starts - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    index = FMIndex(text[place], len(phrases.vocabulary))
    which, low, high = index.search(phrases)
    counts = high - low
    rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    phrase = np.repeat(which, counts)
    begin = place[index.locate(rows)]
    end = begin + phrases.lengths[phrase]
    offsets = np.r_[0, np.cumsum(sizes + 1)]
    doc = np.searchsorted(offsets, begin, side="right") - 1
    for d, p in set(zip(doc.tolist(), phrase.tolist())):
        out[d][1].update(phrases.items[p])
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, end, -1)
    hit = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        d = int(np.searchsorted(offsets, a, side="right")) - 1
        out[d][0].append((a - int(offsets[d]), b - int(offsets[d])))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
NAMES = ["id", "text_hash", "n_words", "spans", "items"]


def hits(rows: DataFrame, block: Broadcast) -> DataFrame:
    """Spans and items of one block of the benchmark for every row (id, text_hash, text)."""

    def run(batches: Batches) -> Batches:
        phrases = Phrases(block.value)
        number = phrases.vocabulary.get

        def out(ids: list, hashes: list, found: list[list[int]]) -> pa.RecordBatch:
            hit = shard_hits(found, phrases)
            return pa.record_batch(
                [
                    pa.concat_arrays(ids),
                    pa.concat_arrays(hashes),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in s] for s, _ in hit], SPANS),
                    pa.array([sorted(i) for _, i in hit], pa.list_(pa.string())),
                ],
                NAMES,
            )

        ids, hashes, found, held = [], [], [], 0
        for batch in batches:
            done = 0
            for k, text in enumerate(utf8(batch.column(2))):
                found.append([number(w, 0) for w in words_of(text)])
                held += len(found[-1]) + 1
                if held >= SHARD_WORDS:
                    part = batch.slice(done, k + 1 - done)
                    yield out([*ids, part.column(0)], [*hashes, part.column(1)], found)
                    ids, hashes, found, held, done = [], [], [], 0, k + 1
            ids.append(batch.column(0).slice(done))
            hashes.append(batch.column(1).slice(done))
        if found:
            yield out(ids, hashes, found)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash long, n_words long, spans array<struct<start:int,stop:int>>, items array<string>"
    return map_batches(rows, run, schema)


def contamination(
    df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(id, text_hash, n_words, spans, items, n_hit, contaminated) of every row of `df`.

    `spans` are the merged word spans hit, `items` the items with an occurring window, in
    text order. Null texts have no words; items without words have no window; a null item
    id is the empty text, items of one id are one item. Repeated rows each stay.
    """
    spark = df.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 32)).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_BYTES) if size > BLOCK_BYTES else 1)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    if blocks > 1:
        limit = BLOCK_BYTES // 4

        def split(batches: Batches) -> Batches:
            for batch in batches:
                for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    found = pieces(text, limit)
                    yield pa.record_batch([pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary()).cast(pa.string())], ["item", "text"])

        items = work_table(map_batches(items, split, "item string, text string"))
    parts = []
    for k in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        block = [(r.item, r.text.encode("utf-8")) for r in mine.collect()]
        sent = spark.sparkContext.broadcast(block)
        part = hits(rows, sent)
        if blocks > 1:  # one block at a time is on the driver and in the tasks
            part = work_table(part)
            sent.unpersist(blocking=True)
        parts.append(part)
    if blocks > 1:
        every = reduce(DataFrame.unionByName, parts)
        joined = every.groupBy("id", "text_hash").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / blocks).cast("int").alias("copies"),
        )
        found = map_slices(joined.select(*NAMES, "copies"), merge_spans, joined.select(*NAMES, "copies").schema)
        found = found.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")
    else:
        found = parts[0]
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    found = found.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr(f"n_hit > 0 and {CONTAMINATED} * n_hit >= n_words"))
    return found.withColumnRenamed("id", id_col)


def merge_spans():
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for spans in batch.column(3).to_pylist():
            merged: list[dict] = []
            for s in sorted(spans, key=lambda s: s["start"]):
                if merged and s["start"] <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
                else:
                    merged.append(dict(s))
            out.append(merged)
        return batch.set_column(3, "spans", pa.array(out, SPANS))

    return work


def clean_rows(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that are not contaminated, unchanged, whatever their columns' names.

    Repeated rows go or stay together; rows without id are told apart by their text.
    """
    found = contamination(df, benchmark, id_col=id_col, text_col=text_col)
    bad_id, bad_hash = unused(df, "bad_id", "bad_hash")
    bad = work_table(found.where("contaminated").select(F.col(id_col).alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct())
    same = df[id_col].eqNullSafe(F.col(bad_id)) & (F.xxhash64(df[text_col]) == F.col(bad_hash))
    return df.join(bad, same, "left_anti")
