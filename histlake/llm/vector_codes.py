"""Product codes of vectors: codebooks fitted exactly over Hilbert-sorted flat blocks.

Components become integers, vectors are cut into equal parts, and the rows that a task
reads are kept in chunks. In a chunk the parts of each position lie sorted along a
Hilbert curve and flat, block by block; a block keeps the box around its parts (least and
greatest components), their sum and their number.

An entry of a codebook can be nearest to some part of a block only if its least distance
to the box is at most the smallest of all greatest distances. Those entries are the
block's shortlist, found by arithmetic on boxes alone. A block with one entry on its list
goes to it as a whole, by its sum; other blocks are evaluated by a small exact integer
kernel against their list. Each round moves only sums per entry, and the chunks never
leave their partitions: vectors aren't shuffled, and no group of equal vectors, labels or
codes meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from histlake.llm.common import Batches, map_batches, work_table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
CHUNK_BYTES = 16 << 20  # integers that a task sorts at once
BLOCK_ROWS = 64
GREATEST = 1 << 60  # of an integer component; beyond it counts as this
SAFE = 1 << 26  # squared distances of smaller integers are exact in 64 bits
MOST_LONG = (1 << 63) - 1


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Order of integer points along a Hilbert curve through the box around them.

    The curve only decides which parts share a block: of more than 62 components the
    62 with the widest ranges count.
    """
    n, d = points.shape
    low, high = points.min(0), points.max(0)
    width = high.astype(float) - low
    if d > 62:
        widest = np.sort(np.argsort(-width, kind="stable")[:62])
        points, low, width, d = points[:, widest], low[widest], width[widest], 62
    bits = min(10, 62 // d)
    x = ((points - low) / np.maximum(width, 1) * ((1 << bits) - 1)).astype(np.int64).T.copy()
    # Axes to the transposed curve index, bit plane by bit plane.
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(d):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    index = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            index = index << 1 | (x[i] ^ turn) >> b & 1
    return np.argsort(index, kind="stable")


class Blocks:
    """The parts of one position of a chunk, sorted and flat, with boxes and sums by block."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.columns = rows, np.ascontiguousarray(rows.T)
        starts = np.arange(0, len(rows), BLOCK_ROWS)
        self.stops = np.r_[starts[1:], len(rows)]
        self.starts = starts
        self.low, self.high = np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts)
        self.sums = np.add.reduceat(rows, starts)

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Blocks by entries: may the entry be nearest to a part of the block?"""
        low, high = self.low[:, None], self.high[:, None]
        least = (np.maximum(np.maximum(low - entries, entries - high), 0) ** 2).sum(-1)
        most = (np.maximum(abs(entries - low), abs(high - entries)) ** 2).sum(-1)
        return least <= most.min(1)[:, None]

    def nearest(self, entries: np.ndarray, distances: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
        """Per block its bounds, the entry of each part (one for all if it is the only
        one on the list) and, if asked for, the squared distances."""
        lists = self.shortlists(entries)
        for k, (a, b) in enumerate(zip(self.starts.tolist(), self.stops.tolist())):
            listed = np.flatnonzero(lists[k])
            if len(listed) == 1 and not distances:
                yield a, b, listed, None
                continue
            far = 0
            for mine, theirs in zip(self.columns, entries.T):
                apart = np.subtract.outer(mine[a:b], theirs[listed])
                far = far + apart * apart
            best = far.argmin(1)  # the first, hence the lowest index, of equals
            yield a, b, listed[best], far[np.arange(b - a), best]


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exactly; beyond GREATEST that."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values.astype(np.float64) * SCALE), -GREATEST, GREATEST).astype(np.int64)


def exact(a: np.ndarray, greatest: int) -> np.ndarray:
    """As integers of 64 bits where squares fit, else as integers of any size."""
    return a if greatest < SAFE and a.shape[-1] < 512 else a.astype(object)


def build(rows: DataFrame, dims: int, parts: int) -> DataFrame:
    """Chunks of the rows (id, label, vector): ids and labels in the order read, and by
    position the sorted parts and where each came from."""
    size = dims // parts
    most = max(BLOCK_ROWS, CHUNK_BYTES // (8 * dims))
    narrow = [np.int16, np.int32, np.int64]

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                held.append(batch.slice(start, most))
                if sum(b.num_rows for b in held) >= most:
                    yield chunk(held)
                    held = []
        if sum(b.num_rows for b in held):
            yield chunk(held)

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, labels, vectors = (pa.concat_arrays([b.column(k) for b in held]) for k in range(3))
        ints = integers(vectors.flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), dims)
        flat, orders = [], []
        for p in range(parts):
            rows = ints[:, p * size : (p + 1) * size]
            order = hilbert_order(rows)
            flat.append(rows[order].ravel())
            orders.append(order.astype(np.uint32))
        flat = np.concatenate(flat)
        greatest = int(max(-flat.min(), flat.max()))
        kind = next(t for t in narrow if greatest <= np.iinfo(t).max)
        one = pa.array([0, len(ids)], pa.int32())
        columns = [pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels)]
        columns += [pa.array([x], t) for x, t in ((len(ids), pa.int32()), (greatest, pa.int64()), (np.dtype(kind).itemsize, pa.int32()))]
        columns += [pa.array([flat.astype(kind).tobytes()], pa.binary()), pa.array([np.concatenate(orders).tobytes()], pa.binary())]
        return pa.record_batch(columns, CHUNK_COLUMNS)

    schema = StructType().add("ids", ArrayType(rows.schema["id"].dataType)).add("labels", ArrayType(rows.schema["label"].dataType))
    schema = schema.add("n", IntegerType()).add("greatest", LongType()).add("width", IntegerType()).add("flat", BinaryType()).add("places", BinaryType())
    return map_batches(rows, run, schema)


CHUNK_COLUMNS = ["ids", "labels", "n", "greatest", "width", "flat", "places"]


def stored(batch: pa.RecordBatch, names: list[str], size: int, parts: int) -> Iterator[tuple[int, list[Blocks], np.ndarray, int]]:
    """Row, blocks by position, places by position and greatest integer of each chunk."""
    found = {c: batch.column(names.index(c)) for c in ("n", "greatest", "width", "flat", "places")}
    for k in range(batch.num_rows):
        n, greatest, width = (found[c][k].as_py() for c in ("n", "greatest", "width"))
        flat = np.frombuffer(found["flat"][k].as_buffer(), f"<i{width}").reshape(parts, n, size).astype(np.int64)
        places = np.frombuffer(found["places"][k].as_buffer(), np.uint32).reshape(parts, n)
        yield k, [Blocks(exact(rows, greatest)) for rows in flat], places, greatest


def sums_by_entry(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, n, total): number and sum of the parts nearest to each entry."""
    parts, entries, size = books.shape
    reach = int(abs(books).max(initial=0))
    names = CHUNK_COLUMNS[2:]

    def run(batches: Batches) -> Batches:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), object)
        for batch in batches:
            for _, blocks, _, greatest in stored(batch, names, size, parts):
                for p, b in enumerate(blocks):
                    here, held = np.zeros(entries, np.int64), np.zeros((entries, size), b.sums.dtype)
                    for k, (low, high, nearest, _) in enumerate(b.nearest(exact(books[p], max(greatest, reach)), False)):
                        if len(nearest) == 1 < high - low:
                            here[nearest] += high - low
                            held[nearest] += b.sums[k]
                        else:
                            here += np.bincount(nearest, minlength=entries)
                            np.add.at(held, nearest, b.rows[low:high])
                    n[p] += here
                    total[p] += held
        part, entry, place = (a.ravel() for a in np.indices(total.shape))
        used = np.flatnonzero(n[part, entry])
        totals = pa.array([Decimal(int(t)) for t in total.ravel()[used]], pa.decimal128(38, 0))
        counts = pa.array(n[part, entry][used])
        yield pa.record_batch([*(pa.array(a[used].astype(np.int32)) for a in (part, entry, place)), counts, totals], ["part", "entry", "place", "n", "total"])

    return map_batches(chunks.select(*names), run, "part int, entry int, place int, n long, total decimal(38,0)")


def next_books(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry moved to the floored mean of its parts; unused entries stay.

    The driver sees one row per component of the codebooks.
    """
    sums = sums_by_entry(chunks, books).groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = books.copy()
    for r in sums.collect():
        out[r.part, r.entry, r.place] = int(r.total) // r.n
    return out


def assign(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every row."""
    parts, entries, size = books.shape
    reach = int(abs(books).max(initial=0))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k, blocks, places, greatest in stored(batch, CHUNK_COLUMNS, size, parts):
                code = np.zeros((places.shape[1], parts), np.uint8)
                error = np.zeros(places.shape[1], object)
                for p, b in enumerate(blocks):
                    found = list(b.nearest(exact(books[p], max(greatest, reach)), True))
                    code[places[p], p] = np.concatenate([x[2] for x in found])
                    error[places[p]] += np.concatenate([x[3] for x in found]).astype(object)
                hexes = code.tobytes().hex()
                codes = [hexes[a : a + 2 * parts] for a in range(0, len(hexes), 2 * parts)]
                errors = pa.array([min(e, MOST_LONG) for e in error.tolist()], pa.int64())
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in (0, 1))
                yield pa.record_batch([ids, labels, pa.array(codes, pa.string()), errors], ["id", "label", "code", "error"])

    schema = StructType().add("id", chunks.schema["ids"].dataType.elementType).add("label", chunks.schema["labels"].dataType.elementType)
    return map_batches(chunks, run, schema.add("code", StringType()).add("error", LongType()))


def compress(
    df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors, as (id, label, code, error, label_error), and the codebooks.

    Left out are null vectors and those with null or non-finite components; also those
    whose length isn't a positive multiple of `parts` or isn't that of the usable vector
    with the smallest id, because they can't be cut alike. Codebooks start from the `entries`
    smallest ids (null last; rows with equal ids by their vectors); a table with fewer
    rows has as many entries as rows. Repeated rows each count and each get a code, ties
    go to the lower index, and an empty table gives no rows and codebooks without entries.
    Integer components beyond 2^60 count as 2^60, errors beyond 64 bits as the greatest.
    Other columns are left behind.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: between 1 and 256 entries")
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite)

    def smallest(some: DataFrame) -> list:
        return some.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()

    first = smallest(usable)
    dims = len(first[0].vector) if first else parts
    usable = usable.where(F.size("vector") == dims)
    if any(len(r.vector) != dims for r in first):
        first = smallest(usable)
    books = integers(np.array([r.vector for r in first], np.float64)).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    chunks = work_table(build(usable, dims, parts))
    for _ in range(rounds if first else 0):
        books = next_books(chunks, books)
    codes = work_table(assign(chunks, books))
    totals = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    totals = totals.select(F.col("label").alias("of"), F.least("total", F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    found = codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("id", "label", "code", "error", "label_error")
    return found.withColumnsRenamed({"id": id_col, "label": label_col}) if id_col != label_col else found, books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
