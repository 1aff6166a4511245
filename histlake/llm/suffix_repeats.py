"""Removal of long repeated byte strings with common-prefix interval trees.

Every string of LENGTH bytes has an anchor: the first of those of its K-byte substrings
whose hash is smallest. Equal strings have equal anchors at equal offsets, so a suffix
array over anchors only, some three of a hundred positions, sees every repeat. A run is a
stretch of consecutive strings with one anchor. Suffixes with the same first K bytes form
a bucket, one subtree of the interval tree, and buckets are spread over all tasks.

1. Runs are sorted by bucket and content (hashes of 64 bits each). Runs of equal content
   repeat as a whole; all but the earliest are settled. A bucket with one content needs no
   more. Runs that repeat within the stretch of text that a task holds are settled there.
2. Of buckets with several contents, one run each is cut out of its text, as the bytes
   before and from the anchor on. Spark sorts the bytes from the anchor on: that is the
   enhanced suffix array. A scan with a stack over the common prefixes of neighbours gives
   the intervals. Within an interval the bytes before the anchor are tested for diversity
   by the same scan, backwards: each interval of it is a maximal repeat with all its
   occurrences, which can be extended neither to the right nor to the left. All its
   occurrences but the earliest lose its bytes.

An anchor whose bucket would fill a good part of a task is split into the strings around
it, each a run and bucket of its own; such anchors are found on a sample, which decides on
speed only. Texts of any length are read in pieces that overlap by LENGTH - 1 bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, map_batches, map_slices, mix, tell_apart, utf8, work_table

LENGTH = 100
K = 32
WIDTH = LENGTH - K + 1  # places of an anchor within a string
STRETCH_BYTES = 1 << 20  # text handled at once in a task
HOT_SAMPLE = 16  # one of so many documents is looked at for very frequent anchors
HOT_SHARE = 4  # an anchor is split if it fills more than one such part of a task
PLACE_BITS = 24
# A run in one number: start in the text, bytes before the anchor, number of strings.
OFFSET_BITS, MANY_BITS = 7, 7


@functools.lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=12)).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all substrings of K and of 2 K bytes, by doubling."""
    h, n, factor = byte_values()[octets], 1, 0x9E3779B97F4A7C15
    while n < 2 * K:
        if n == K:
            short = h
        h = h[:-n] * np.uint64(factor) + h[n:]
        n, factor = 2 * n, factor * factor % (1 << 64)
    return mix(short), mix(h)


def first_smallest(hashes: np.ndarray) -> np.ndarray:
    """Place of the smallest of each WIDTH neighbouring hashes, the first of equals."""
    place = np.uint64((1 << PLACE_BITS) - 1)
    least, n = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * n <= WIDTH:
        least, n = np.minimum(least[:-n], least[n:]), 2 * n
    if n < WIDTH:
        least = np.minimum(least[: len(least) - (WIDTH - n)], least[WIDTH - n :])
    return (least & place).astype(np.int64)


class Runs:
    """Runs of some pieces of texts: bucket, content, text, start, offset, number of strings."""

    def __init__(self, docs: np.ndarray, tags: np.ndarray, offsets: np.ndarray, pieces: list[bytes], hot: np.ndarray):
        joined = b"".join(pieces)
        octets = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        begins = ends - [len(p) for p in pieces]
        short, long = gram_hashes(octets)
        anchor = first_smallest(short)
        of = np.repeat(np.arange(len(pieces)), ends - begins)[: len(anchor)]
        at = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends[of])  # strings within one piece
        new = np.flatnonzero(np.r_[True, (anchor[at[1:]] != anchor[at[:-1]]) | (of[at[1:]] != of[at[:-1]])])
        low, high = at[new], at[np.r_[new[1:], len(at)] - 1]
        bucket, place = short[anchor[low]], anchor[low]
        own = np.zeros(len(low), bool)
        if len(hot) and (split := np.isin(bucket, hot)).any():
            single = np.concatenate([np.arange(a, b + 1) for a, b in zip(low[split], high[split])])
            low, high, place = np.r_[low[~split], single], np.r_[high[~split], single], np.r_[place[~split], anchor[single]]
            bucket, own = short[place], np.r_[own[~split], np.ones(len(single), bool)]
        text = of[low]
        self.doc, self.tag, self.start = docs[text], tags[text], low - begins[text] + offsets[text]
        self.offset, self.many = place - low, high - low + 1
        shape = (self.offset << MANY_BITS | self.many).astype(np.uint64)
        content = long[low] * np.uint64(3) + mix(long[low + LENGTH - 2 * K] + shape)
        content = mix(content + mix(long[high] + np.uint64(5)) * np.uint64(7) + mix(long[high + LENGTH - 2 * K] + np.uint64(9)))
        self.bucket, self.content = np.where(own, mix(bucket + content), bucket), content

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs to go on with, and runs whose content is in an earlier one."""
        order = np.lexsort((self.start, self.tag, self.doc, self.content, self.bucket))
        b, c, *where = (x[order] for x in (self.bucket, self.content, self.doc, self.tag, self.start))
        new = np.r_[True, (b[1:] != b[:-1]) | (c[1:] != c[:-1])]
        leader = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = functools.reduce(np.logical_or, [x != x[leader] for x in where])
        return order[new], order[later]


def pieces_of(batches: Batches, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Stretches of (docs, tags, offsets, pieces), of about `most` bytes each."""
    held, size = [], 0
    for batch in batches:
        for doc, tag, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = data.as_buffer().to_pybytes() if data.is_valid else b""
            for offset in range(0, len(data) - LENGTH + 1, most):
                piece = data[offset : offset + most + LENGTH - 1]
                held.append((doc, tag, offset, piece))
                size += len(piece)
                if size >= most:
                    yield *(np.array(x, np.int64) for x in list(zip(*held))[:3]), [x[3] for x in held]
                    held, size = [], 0
    if held:
        yield *(np.array(x, np.int64) for x in list(zip(*held))[:3]), [x[3] for x in held]


def runs(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """Runs of all texts; and what is settled within a stretch, its stop as content and
    its start as place."""

    def run(batches: Batches) -> Batches:
        for docs, tags, offsets, pieces in pieces_of(batches, STRETCH_BYTES):
            found = Runs(docs, tags, offsets, pieces, hot)
            kept, gone = found.settle()
            gone = gone[np.lexsort((found.start[gone], found.tag[gone], found.doc[gone]))]
            doc, tag, start, stop = merged(found.doc[gone], found.tag[gone], found.start[gone], found.start[gone] + found.many[gone] + LENGTH - 1)
            place = found.start[kept] << (OFFSET_BITS + MANY_BITS) | found.offset[kept] << MANY_BITS | found.many[kept]
            yield pa.record_batch(
                [
                    pa.array(np.r_[found.bucket[kept], mix(doc.astype(np.uint64))].view(np.int64)),
                    pa.array(np.r_[found.content[kept].view(np.int64), stop]),
                    pa.array(np.r_[found.doc[kept], doc]),
                    pa.array(np.r_[found.tag[kept], tag]),
                    pa.array(np.r_[place, start]),
                    pa.array(np.r_[np.zeros(len(kept), bool), np.ones(len(doc), bool)]),
                ],
                ["bucket", "content", "doc", "tag", "place", "settled"],
            )

    return map_batches(rows.select("doc", "tag", "text"), run, "bucket long, content long, doc long, tag long, place long, settled boolean")


def merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans sorted by text and start, with those that touch joined."""
    if not len(doc):
        return doc, tag, start, stop
    texts = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
    reach = np.maximum.accumulate(stop + (texts << 40)) - (texts << 40)
    cut = np.flatnonzero(np.r_[True, (texts[1:] != texts[:-1]) | (start[1:] > reach[:-1])])
    return doc[cut], tag[cut], start[cut], reach[np.r_[cut[1:], len(doc)] - 1]


def compare_contents(sorted_runs: DataFrame) -> DataFrame:
    """Spans that repeat (place is their start), and one run per content of buckets that
    have several (with their bucket). Runs come sorted by bucket, content and place."""

    def run(batches: Batches) -> Batches:
        last, known = None, False  # the leader in hand; has its bucket several contents?
        for batch in batches:
            settled = batch.column(5).to_numpy(zero_copy_only=False)
            bucket, content, doc, tag, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            done = [x[settled] for x in (doc, tag, place, content)]
            b, c, d, t, p = (x[~settled] for x in (bucket, content, doc, tag, place))
            if last:
                b, c, d, t, p = (np.r_[first, x] for first, x in zip(last, (b, c, d, t, p)))
            if not len(b):
                yield table(done, [b, d, t, p])
                continue
            new_bucket = np.r_[True, b[1:] != b[:-1]]
            leads = new_bucket | np.r_[True, c[1:] != c[:-1]]
            leader = np.flatnonzero(leads)[np.cumsum(leads) - 1]
            later = (d != d[leader]) | (t != t[leader]) | (p != p[leader])
            start, many = p >> (OFFSET_BITS + MANY_BITS), p & ((1 << MANY_BITS) - 1)
            done = [np.r_[x, y[later]] for x, y in zip(done, (d, t, start, start + many + LENGTH - 1))]
            of = np.cumsum(new_bucket) - 1
            several = np.bincount(of, leads) > 1
            several[0] |= known
            passed = leads & several[of]
            passed[0] &= not known  # the leader in hand has been passed on already
            yield table(done, [x[passed] for x in (b, d, t, p)])
            k = leader[-1]
            last, known = [x[k : k + 1] for x in (b, c, d, t, p)], bool(several[-1])

    def table(done: list, passed: list) -> pa.RecordBatch:
        n, m = len(done[0]), len(passed[0])
        whole = np.r_[np.ones(n, bool), np.zeros(m, bool)]
        columns = [pa.array(np.r_[x, y]) for x, y in zip(done, passed[1:])]
        stop = pa.array(np.r_[done[3], np.zeros(m, np.int64)], mask=~whole)
        bucket = pa.array(np.r_[np.zeros(n, np.int64), passed[0]], mask=whole)
        return pa.record_batch([*columns, stop, bucket], ["doc", "tag", "place", "stop", "bucket"])

    return map_batches(sorted_runs, run, "doc long, tag long, place long, stop long, bucket long")


def cut_out(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(bucket, right, left, doc, tag, at): the bytes from each wanted run's anchor on,
    those before it, and the place of the anchor."""
    by_text = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("place", "bucket")).alias("wanted"))
    # Only texts of shared ids have tags; of repeated rows one is enough.
    once = rows.where("tag = 0").unionByName(rows.where("tag <> 0").dropDuplicates(["doc", "tag"]))
    joined = once.select("doc", "tag", "text").join(by_text, ["doc", "tag"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(3)
            bounds, flat = lists.offsets.to_numpy(), lists.flatten()
            places, buckets = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            first = int(bounds[0])
            start, offset, many = places >> (OFFSET_BITS + MANY_BITS), places >> MANY_BITS & ((1 << OFFSET_BITS) - 1), places & ((1 << MANY_BITS) - 1)
            at, stop = start + offset, start + many + LENGTH - 1
            left, right = [], []
            for text, a, b in zip(utf8(batch.column(2)), (bounds[:-1] - first).tolist(), (bounds[1:] - first).tolist()):
                for x, y, z in zip(start[a:b].tolist(), at[a:b].tolist(), stop[a:b].tolist()):
                    left.append(text[x:y])
                    right.append(text[y:z])
            n = np.diff(bounds)
            doc, tag = (np.repeat(batch.column(k).to_numpy(zero_copy_only=False), n) for k in (0, 1))
            columns = [pa.array(buckets), pa.array(right, pa.binary()), pa.array(left, pa.binary()), pa.array(doc), pa.array(tag), pa.array(at)]
            yield pa.record_batch(columns, ["bucket", "right", "left", "doc", "tag", "at"])

    return map_batches(joined.select("doc", "tag", "text", "wanted"), run, "bucket long, right binary, left binary, doc long, tag long, at long")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    apart = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (apart.bit_length() + 7) // 8


def intervals(prefixes: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """Intervals (first, last, depth, depth of the enclosing one) of a sorted array of
    strings from the common prefixes of neighbours, deepest first, by a scan with a stack.

    Only intervals of depth `least` and more count; `least - 1` stands for less.
    """
    stack = [(least - 1, 0)]
    for k, depth in enumerate([*prefixes, least - 1], 1):
        depth, first = max(depth, least - 1), k - 1
        while depth < stack[-1][0]:
            inner, first = stack.pop()
            yield first, k - 1, inner, max(depth, stack[-1][0])
        if depth > stack[-1][0]:
            stack.append((depth, first))


Occurrence = tuple[int, int, int]  # doc, tag, place of the anchor


def maximal_repeats(rights: list[bytes], lefts: list[bytes], where: list[Occurrence]) -> Iterator[tuple[int, int, list[Occurrence]]]:
    """(bytes before the anchor, bytes from it on, all occurrences) of every maximal
    repeat of LENGTH bytes or more in a bucket, whose rows are sorted by `rights`."""
    backwards = [x[::-1] for x in lefts]
    depths = [common_prefix(a, b) for a, b in zip(rights, rights[1:])]
    for first, last, depth, outer in intervals(depths, LENGTH - WIDTH + 1):
        # Strings that begin `before` bytes before the anchor have this very interval
        # in common for these values of `before`.
        lowest, highest = max(0, LENGTH - depth), LENGTH - 1 - outer
        members = sorted((k for k in range(first, last + 1) if len(backwards[k]) >= lowest), key=backwards.__getitem__)
        shared = [common_prefix(backwards[a], backwards[b]) for a, b in zip(members, members[1:])]
        for i, j, before, less in intervals(shared, lowest):
            if less < highest:
                yield before, depth, [where[k] for k in members[i : j + 1]]


def scan_buckets(sorted_rows: DataFrame) -> DataFrame:
    """All occurrences of maximal repeats but the earliest, and where that is."""

    def bucket_spans(rights: list[bytes], lefts: list[bytes], where: list[Occurrence]) -> Iterator[tuple]:
        for before, depth, found in maximal_repeats(rights, lefts, where):
            first = min(found)
            for doc, tag, at in found:
                if (doc, tag, at) != first:
                    yield doc, tag, at - before, at + depth, first[0], first[1], first[2] - before

    def run(batches: Batches) -> Batches:
        now, held = None, ([], [], [])
        for batch in batches:
            bucket = batch.column(0).to_numpy(zero_copy_only=False)
            right, left = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            where = list(zip(*(batch.column(k).to_pylist() for k in (3, 4, 5))))
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            spans = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if bucket[a] != now:
                    spans += bucket_spans(*held)
                    now, held = bucket[a], ([], [], [])
                for kept, more in zip(held, (right, left, where)):
                    kept += more[a:b]
            yield table(spans)
        yield table(list(bucket_spans(*held)))

    def table(spans: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*spans)) if spans else [()] * len(SPAN)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], SPAN)

    return map_batches(sorted_rows, run, ", ".join(f"{c} long" for c in SPAN))


SPAN = ["doc", "tag", "start", "stop", "first_doc", "first_tag", "first_start"]


def hot_anchors(rows: DataFrame) -> np.ndarray:
    """Buckets that would fill a good part of a task, told by a sample: at most
    HOT_SHARE a task."""
    none = np.zeros(0, np.uint64)
    sampled = runs(rows.where(F.pmod(F.hash("doc"), F.lit(HOT_SAMPLE)) == 0), none).where("not settled")
    counts = work_table(sampled.groupBy("bucket").count().where("count > 1"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    most = counts.where("count > 8").orderBy(F.desc("count"), "bucket").limit(HOT_SHARE * tasks).collect()
    return np.array([r.bucket for r in most if r["count"] > total / (HOT_SHARE * tasks)], np.int64).view(np.uint64)


def repeated(rows: DataFrame) -> DataFrame:
    """(doc, tag, start, stop): all bytes of strings that begin earlier, too.

    `rows` holds doc, tag and text (`tell_apart`).
    """
    ordered = runs(rows, hot_anchors(rows)).repartition("bucket").sortWithinPartitions("bucket", "content", "doc", "tag", "place")
    compared = work_table(compare_contents(ordered))
    several = compared.where("bucket is not null")
    arrays = cut_out(rows, several).repartition("bucket").sortWithinPartitions("bucket", "right")
    whole = compared.where("stop is not null").select("doc", "tag", F.col("place").alias("start"), "stop")
    return whole.unionByName(scan_buckets(arrays).select("doc", "tag", "start", "stop"))


def remove(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; `kept` is the UTF-8 text
    without the bytes of strings of LENGTH bytes that also start earlier: in a text with a
    smaller id, or in the same one further to the left.

    Ids must be integers (TypeError otherwise); rows without come last. Different texts of
    one id (or none) count as documents in the order of their 64-bit hashes; repeated rows
    are one document, and each loses the same bytes. Null texts are empty, texts of any
    length are read whole, an empty table gives no rows, and other columns are left behind.
    Equal contents are told by 64 + 64 bits of hashes, or byte by byte where a bucket
    has several.
    """
    rows = tell_apart(df, id_col, text_col)
    spans = repeated(rows).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(spans, ["doc", "tag"], "left").select("id", "text", "spans")

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, gone, cuts, kept = [], [], [], []
            for text, spans in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                out, at, n = [], 0, 0
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if start > at or not n:
                        n += 1
                        out.append(text[at:start])
                    at = max(at, stop)
                out.append(text[at:])
                kept.append(b"".join(out))
                sizes.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                cuts.append(n)
            columns = [pa.array(x, pa.int64()) for x in (sizes, gone, cuts)]
            return pa.record_batch([batch.column(0), *columns, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

        return work

    kind = joined.schema["id"].dataType.simpleString()
    out = map_slices(joined, step, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)
