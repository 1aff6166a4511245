"""Removal of long repeated passages, by compaction of a de Bruijn graph over words.

Windows of `WINDOW` words are the edges that must not repeat. Walking along a text,
consecutive windows share their smallest k-mer of `K` words (by hash); such a stretch
is a path that the text takes through the graph around that k-mer, and is one row: the
k-mer, the source coordinates and the hashes of the path's windows. Equal windows have
equal smallest k-mers, so they always meet.

Rows are joined on the k-mer by one shuffle, sorted by source coordinates. Where the
path doesn't branch, all its windows repeat or none does, and it is settled as a whole;
where texts branch off, it is settled window by window. A window goes if the same window
(same k-mer and offset, equal hash: 64 + 56 bits of the words) has an earlier coordinate.

Repeats within the stretch of documents that a task handles at once are settled there
and never shuffled, so a passage that very many documents share arrives as few rows. A
k-mer that would still fill a good part of a task is split by offset and window hash;
such k-mers are found on a sample, which decides on speed only.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from histlake.llm.common import NO_ID, Batches, map_batches, map_slices, mix, utf8, work_table
from histlake.operators.numbering import number_rows

WINDOW = 20
K = 8
STRETCH_BYTES = 3 << 20  # text handled at once in a task
HOT_SAMPLE = 16  # one of so many documents is looked at for very frequent k-mers
HOT_SHARE = 4  # a k-mer is split if it fills more than one such part of a task
HASH_BYTES = 7  # of a window's hash: all that tells continuations of one k-mer apart
STOP_BYTES = 4  # of what is settled, instead of windows; no multiple of HASH_BYTES
TAG_BITS = 23  # of the number that tells texts with one id apart
SPACES = b" \t\n\r\x0b\x0c"


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, whether they are spaces, and powers for places in a word."""
    values = np.random.Generator(np.random.Philox(key=11)).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    spaces = np.zeros(256, bool)
    spaces[list(SPACES)] = True
    values[spaces] = 0
    powers = np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    return values, spaces, np.cumprod(powers)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a text."""
    values, spaces, powers = tables()
    octets = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[True, spaces[octets], True].astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    place = np.arange(len(octets))
    place[starts[0] :] -= np.repeat(starts, np.diff(np.r_[starts, len(octets)]))
    if (stops - starts).max() >= len(powers):  # a giant word: powers repeat, mixed with the round
        powers = np.concatenate([mix(powers + np.uint64(r)) for r in range(int((stops - starts).max()) // len(powers) + 1)])
    found = np.add.reduceat(values[octets] * powers[np.minimum(place, len(powers) - 1)], starts)
    return mix(found + np.uint64(0x51ED270B) * (stops - starts).astype(np.uint64)), starts


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(out)]
    return mix(out)


def paths(docs: np.ndarray, tags: np.ndarray, found: list[bytes], hot: np.ndarray) -> tuple[list, list]:
    """Rows to shuffle (key, doc, place, windows) and stretches settled (doc, tag, start, stop)."""
    nothing = ([np.zeros(0, np.int64)] * 3 + [[]], [np.zeros(0, np.int64)] * 4)
    words, starts = word_hashes(b"\n".join(found))
    if len(words) < WINDOW:
        return nothing
    begins = np.cumsum([0, *(len(t) + 1 for t in found)])[: len(found)]
    firsts = np.searchsorted(starts, begins)  # first word of each document
    owner = np.repeat(np.arange(len(found)), np.diff(np.r_[firsts, len(words)]))
    kmers, windows = grams(words, K), grams(words, WINDOW)
    valid = owner[: len(windows)] == owner[WINDOW - 1 :]
    anchor = np.arange(len(windows)) + sliding_window_view(kmers, WINDOW - K + 1).argmin(axis=1)
    at = np.flatnonzero(valid)
    if not len(at):
        return nothing
    new = np.r_[True, (anchor[at[1:]] != anchor[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])]
    run = np.flatnonzero(new)
    low, high = at[run], at[np.r_[run[1:] - 1, len(at) - 1]]
    key = kmers[anchor[low]]
    # Split very frequent k-mers: each window is a path of its own under its own key.
    if len(hot):
        split = np.isin(key, hot)
        if split.any():
            many = high[split] - low[split] + 1
            single = np.repeat(low[split] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            own = np.repeat(key[split], many)
            own = mix(own + windows[single] * np.uint64(3) + (anchor[single] - single).astype(np.uint64))
            low, high = np.r_[low[~split], single], np.r_[high[~split], single]
            key = np.r_[key[~split], own]
    sums = np.r_[np.uint64(0), np.cumsum(mix(windows))]
    path = mix(sums[high + 1] - sums[low] + windows[low] * np.uint64(5) + (anchor[low] - low).astype(np.uint64))
    doc, start = docs[owner[low]], low - firsts[owner[low]]
    tag = tags[owner[low]]
    order = np.lexsort((tag, start, doc, path, key))
    fresh = np.r_[True, (key[order[1:]] != key[order[:-1]]) | (path[order[1:]] != path[order[:-1]])]
    leader = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    later = (doc[order] != doc[leader]) | (start[order] != start[leader])
    gone = np.sort(order[later])
    # Texts of one id can have the same path at the same place; each has its row.
    kept = order[fresh | ~later & np.r_[True, tag[order[1:]] != tag[order[:-1]]]]
    settled = [doc[gone], tag[gone], start[gone], start[gone] + high[gone] - low[gone] + WINDOW]
    place = (low[kept] - firsts[owner[low[kept]]]) << 31 | (anchor[low[kept]] - low[kept]) << 27 | (high[kept] - low[kept]) << 23
    place |= tag[kept]
    raw = windows.view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :].tobytes()
    held = [raw[a:b] for a, b in zip((low[kept] * HASH_BYTES).tolist(), ((high[kept] + 1) * HASH_BYTES).tolist())]
    return [key[kept].view(np.int64), doc[kept], place, held], settled


def spread(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """Paths of all documents, and what is settled already (its stop instead of windows), by key."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes = batch.column(2).cast(pa.binary()).to_pylist()
            start, held = 0, 0
            for k, text in enumerate(sizes):
                held += len(text or b"") + 1
                if held >= STRETCH_BYTES or k + 1 == len(sizes):
                    yield step(batch, sizes, start, k + 1)
                    start, held = k + 1, 0

    def step(batch: pa.RecordBatch, found: list[bytes | None], a: int, b: int) -> pa.RecordBatch:
        docs, tags = (batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False) for c in (0, 1))
        (key, doc, place, windows), (doc2, tag2, start, stop) = paths(docs, tags.astype(np.int64), [t or b"" for t in found[a:b]], hot)
        # Neighbouring stretches of a document are one row.
        new = np.r_[True, (doc2[1:] != doc2[:-1]) | (tag2[1:] != tag2[:-1]) | (start[1:] > stop[:-1]) | (start[1:] < start[:-1])][: len(doc2)]
        cut = np.flatnonzero(new)
        ends = np.maximum.reduceat(stop, cut) if len(cut) else stop
        doc2, place2 = doc2[cut], start[cut] << 31 | tag2[cut]
        return pa.record_batch(
            [
                pa.array(np.r_[key, mix(doc2.view(np.uint64)).view(np.int64)]),
                pa.array(np.r_[doc, doc2]),
                pa.array(np.r_[place, place2]),
                pa.array([*windows, *(e.to_bytes(STOP_BYTES, "little") for e in ends.tolist())], pa.binary()),
            ],
            ["key", "doc", "place", "windows"],
        )

    return map_batches(rows, run, "key long, doc long, place long, windows binary")


def settle(sorted_paths: DataFrame) -> DataFrame:
    """(doc, tag, start, stop): stretches of windows that have an earlier equal."""
    mask = (1 << TAG_BITS) - 1

    def run(batches: Batches) -> Batches:
        now, whole, single = None, {}, {}  # of the key in hand
        for batch in batches:
            key, doc, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            windows = batch.column(3)
            done = pc.binary_length(windows).to_numpy(zero_copy_only=False) == STOP_BYTES
            stop = windows.filter(pa.array(done)).to_pylist()
            out = [(d, p & mask, p >> 31, int.from_bytes(s, "little")) for d, p, s in zip(doc[done].tolist(), place[done].tolist(), stop)]
            same = np.r_[False, key[1:] == key[:-1]]
            several = same | np.r_[same[1:], True]  # the last key may go on
            several[0] |= key[0] == now if now is not None else False
            rows = np.flatnonzero(several & ~done)
            for k, d, p, w in zip(key[rows].tolist(), doc[rows].tolist(), place[rows].tolist(), windows.take(pa.array(rows)).to_pylist()):
                if k != now:
                    now, whole, single = k, {}, {}
                start, offset, many, tag = p >> 31, p >> 27 & 15, (p >> 23 & 15) + 1, p & mask
                own = (d, start)
                first = whole.setdefault((offset, w), own)
                if first < own:
                    out.append((d, tag, start, start + many - 1 + WINDOW))
                    continue
                if first == own and (d, start, w, tag) in single:
                    continue
                single[d, start, w, tag] = own
                for n in range(many):
                    at, here = (offset - n, w[HASH_BYTES * n : HASH_BYTES * n + HASH_BYTES]), (d, start + n, tag)
                    was = single.setdefault(at, here)
                    if was[0] < d or was[1] < here[1]:
                        out.append((d, tag, here[1], here[1] + WINDOW))
                    elif was[1] > here[1]:  # of another text with this id, whose row began earlier
                        out += [(d, t, was[1], was[1] + WINDOW) for t in was[2:]]
                        single[at] = here
                    elif tag not in was[2:]:
                        single[at] = (*was, tag)
            if len(key) and not several[-1]:
                now = None
            columns = list(zip(*out)) if out else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc", "tag", "start", "stop"])

    return map_batches(sorted_paths, run, "doc long, tag long, start int, stop int")


def numbered_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as (id, doc, tag, text). `tag` is 0, or for ids that several rows share the
    number of the text among the id's different texts (told apart by 64-bit hashes).

    Only ids are shuffled, and of shared ids the hashes. Beyond 2^23 different texts of
    one id there is an error; rows without id then begin another id, still after all others.
    """
    if not isinstance(df.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = df.select(F.col(id_col).alias("id"), doc.alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    shared = work_table(rows.groupBy("doc").count().where("count > 1").select("doc"))
    if shared.isEmpty():
        return rows.select("id", "doc", F.lit(0).cast("long").alias("tag"), "text")
    several = number_rows(rows.select("doc", "hash").join(shared, "doc", "left_semi").distinct(), ["doc", "hash"], "number")
    first = several.groupBy("doc").agg(F.min("number").alias("first"))
    numbers = several.join(first, "doc").select("doc", "hash", (F.col("number") - F.col("first")).alias("place"))
    within = F.col("place").bitwiseAND((1 << TAG_BITS) - 1)
    group = F.shiftright("place", TAG_BITS)
    too_many = F.raise_error(F.lit(f"more than 2^{TAG_BITS} different texts of one id"))
    moved = F.when(group == 0, F.col("doc")).when(F.col("doc") == NO_ID, F.col("doc") - group).otherwise(too_many.cast("long"))
    numbers = work_table(numbers.select(F.col("doc").alias("of"), F.col("hash").alias("h"), moved.alias("moved"), within.alias("tag")))
    found = rows.join(numbers, (F.col("doc") == F.col("of")) & (F.col("hash") == F.col("h")), "left")
    return found.select("id", F.coalesce("moved", "doc").alias("doc"), F.coalesce("tag", F.lit(0).cast("long")).alias("tag"), "text")


def repeated(rows: DataFrame) -> DataFrame:
    """(doc, tag, spans): word spans of every document that has any repeated earlier.

    `rows` come from `numbered_texts`. Order is by integer id, then place; null ids come
    last. A window at the same id and place isn't earlier.
    """
    none = np.zeros(0, np.uint64)
    sampled = spread(rows.select("doc", "tag", "text").where(F.pmod(F.hash("doc"), F.lit(HOT_SAMPLE)) == 0), none).where(F.octet_length("windows") > STOP_BYTES)
    counts = work_table(sampled.groupBy("key").count().where("count > 8"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most HOT_SHARE * tasks keys can hold so large a share of what was counted.
    most = counts.where(F.col("count") > total / (HOT_SHARE * tasks)).select("key").limit(HOT_SHARE * tasks).collect()
    hot = np.array([r.key for r in most], np.int64).view(np.uint64)
    ordered = spread(rows.select("doc", "tag", "text"), hot).repartition("key").sortWithinPartitions("key", "doc", "place")
    spans = settle(ordered).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return spans


def remove(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) of every row; `kept` is the rest, joined by one space.

    Null texts have no words. Repeated rows each stay and lose the same words. Texts of
    one id are told apart whatever they are; ids must be integers (TypeError otherwise).
    """
    rows = numbered_texts(df, id_col, text_col)
    found = repeated(rows)
    joined = rows.join(found, ["doc", "tag"], "left").select("id", "text", "spans")

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, gone, kept = [], [], []
            for text, spans in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                n.append(len(words))
                out, at = [], 0
                for s in sorted(spans or (), key=lambda s: s["start"]):
                    if s["start"] > at:
                        out += words[at : s["start"]]
                    at = max(at, s["stop"])
                out += words[at:]
                gone.append(len(words) - len(out))
                kept.append(b" ".join(out))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            return pa.record_batch(columns, ["id", "n_words", "n_removed", "kept"])

        return work

    kind = joined.schema["id"].dataType.simpleString()
    return map_slices(joined, step, f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
