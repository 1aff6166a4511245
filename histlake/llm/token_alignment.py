"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both tokenizers cover the same bytes. An interval of tokens is divided at a byte offset
where a token of A and one of B both end: A's ends near the interval's middle are looked
up among B's by bisection, in a window that doubles until one is shared, and both halves
go on. An interval within which no end is shared becomes a leaf group. Small intervals
look up all their ends at once. The intervals of one depth are divided together.

A and B tokens that end together cover the same bytes, so the shorter one's bytes end the
longer one's. How many pairs of ids can ever be linked thus follows from the two
vocabularies alone (`Vocabularies.pairs`), not from the corpus: pair counts are
aggregated per task, then over tasks, and the finished table of that size goes to all
tasks. Texts are encoded once and never shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Tokenizer

from histlake.llm.common import Batches, map_batches, map_slices, texts, work_table

LEAF = 32  # A tokens of an interval whose ends are all looked up at once
MOST_PAIRS = 4_000_000  # of ids that two vocabularies may link; larger ones are refused
# Fixed value: how byte-level BPE splits text where the file asks for its own pattern.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    for itself, the others in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: byte-level BPE from a JSON file; encodes a space and the text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        ranks = {bytes(letters[c] for c in entry): k for entry, k in vocab.items() if all(c in letters for c in entry)}
        # Special tokens are never produced; their entries stand for nothing.
        specials = {t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {b: k for b, k in ranks.items() if k not in specials}
        self.tokens = [b""] * (1 + max(vocab.values()))
        for b, k in ranks.items():
            self.tokens[k] = b
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # Where merge k makes id 256 + k, ids are ranks, and the faster library does.
        in_order = all(vocab.get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
        kind = spec["pre_tokenizer"]
        usual = kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"] and not spec["normalizer"]
        self.fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}) if in_order and usual else None
        self.file = Tokenizer.from_file(path)
        self.file.encode_special_tokens = True

    def encode(self, found: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.fast.encode_ordinary(" " + t) for t in found]
        return [self.file.encode(" " + t, add_special_tokens=False).ids for t in found]


class Pieces:
    """Tokenizer B: sentencepiece with byte fallback, which adds the space itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            octet = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.tokens.append(bytes([int(octet[1], 16)]) if octet else piece.replace("▁", " ").encode())

    def encode(self, found: list[str]) -> list[list[int]]:
        return self.model.encode(found, num_threads=1) if found else []


class Vocabularies:
    """Both tokenizers and every pair of ids that can be linked, as sorted codes."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in v.tokens]) for v in (self.a, self.b))
        a_ids, b_ids = defaultdict(list), defaultdict(list)
        for ids, tokens in ((a_ids, self.a.tokens), (b_ids, self.b.tokens)):
            for k, t in enumerate(tokens):
                if t:
                    ids[t].append(k)
        codes = [self.code(i, j) for t in a_ids for k in range(len(t)) for i in a_ids[t] for j in b_ids.get(t[k:], ())]
        codes += [self.code(i, j) for t in b_ids for k in range(1, len(t)) for i in a_ids.get(t[k:], ()) for j in b_ids[t]]
        if len(codes) > MOST_PAIRS:
            raise ValueError(f"{len(codes)} pairs of ids can be linked; at most {MOST_PAIRS} go to every task")
        self.pairs = np.unique(np.array(codes, np.int64))
        self.pair_b = self.pairs % len(self.b.tokens)

    def code(self, a, b):
        return a * len(self.b.tokens) + b

    @functools.cached_property
    def decimals(self) -> list[str]:
        """Ids in decimal, each followed by one of the separators or none."""
        most = max(len(self.a.tokens), len(self.b.tokens))
        return [f"{k}{end}" for k in range(most) for end in SEPARATORS]


SEPARATORS = (",", "|", ";", "")


@functools.lru_cache(maxsize=1)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """Loaded once per worker process."""
    return Vocabularies(a_path, b_path)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and where each list begins (and the last one ends)."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=bounds[1:])
    ids = np.empty(bounds[-1], np.int32)
    for k, x in enumerate(lists):
        ids[bounds[k] : bounds[k + 1]] = x
    return ids, bounds


def ragged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and the range of each."""
    n = np.maximum(high - low, 0)
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n - low, n), of


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the A tokens and of the B tokens that end together, in order.

    Token ends increase over all texts; text k has the tokens between bounds k and k + 1,
    at least one of each kind, and its last ends are equal.
    """
    cuts = [(a_bounds[1:] - 1, b_bounds[1:] - 1)]
    # Of an interval [low, high) of A tokens and of B tokens the last ends are shared.
    a_low, a_high, b_low, b_high = a_bounds[:-1], a_bounds[1:], b_bounds[:-1], b_bounds[1:]

    def bisect(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = np.searchsorted(b_ends, a_ends[at])
        return there, b_ends[there] == a_ends[at]

    while True:
        several = (a_high - a_low > 1) & (b_high - b_low > 1)
        a_low, a_high, b_low, b_high = (x[several] for x in (a_low, a_high, b_low, b_high))
        small = a_high - a_low <= LEAF
        at, _ = ragged(a_low[small], a_high[small] - 1)
        there, hit = bisect(at)
        cuts.append((at[hit], there[hit]))
        a_low, a_high, b_low, b_high = (x[~small] for x in (a_low, a_high, b_low, b_high))
        if not len(a_low):
            break
        middle = (a_low + a_high - 1) // 2
        cut_a, cut_b = np.full(len(middle), -1), np.full(len(middle), -1)
        open_, reach = np.arange(len(middle)), 2
        while len(open_):
            low, high = np.maximum(a_low[open_], middle[open_] - reach), np.minimum(a_high[open_] - 1, middle[open_] + reach + 1)
            at, of = ragged(low, high)
            there, hit = bisect(at)
            at, there, of = at[hit], there[hit], open_[of[hit]]
            order = np.lexsort((at, abs(at - middle[of]), of))  # the nearest to the middle first
            first = order[np.r_[True, np.diff(of[order]) != 0][: len(order)]]
            cut_a[of[first]], cut_b[of[first]] = at[first], there[first]
            whole = (low <= a_low[open_]) & (high >= a_high[open_] - 1)
            open_ = open_[(cut_a[open_] < 0) & ~whole]
            reach *= 2
        found = cut_a >= 0  # the others are leaf groups
        cut_a, cut_b = cut_a[found], cut_b[found]
        cuts.append((cut_a, cut_b))
        a_low, a_high = np.r_[a_low[found], cut_a + 1], np.r_[cut_a + 1, a_high[found]]
        b_low, b_high = np.r_[b_low[found], cut_b + 1], np.r_[cut_b + 1, b_high[found]]
    a, b = (np.concatenate(x) for x in zip(*cuts))
    return np.sort(a), np.sort(b)


class Aligned:
    """Tokens and shared cuts of some texts. Texts without tokens take no part: null and
    empty ones, and those whose joined token bytes aren't a space and the text."""

    def __init__(self, both: Vocabularies, found: list[str]):
        self.both = both
        held = [k for k, t in enumerate(found) if t]
        a, b = both.a.encode([found[k] for k in held]), both.b.encode([found[k] for k in held])
        same = [self.covers(both, found[k], x, y) for k, x, y in zip(held, a, b)]
        self.held = [k for k, good in zip(held, same) if good]
        self.a, self.a_bounds = flat([x for x, good in zip(a, same) if good])
        self.b, self.b_bounds = flat([x for x, good in zip(b, same) if good])
        a_ends, b_ends = np.cumsum(both.a_lengths[self.a]), np.cumsum(both.b_lengths[self.b])
        self.cut_a, self.cut_b = shared_cuts(a_ends, b_ends, self.a_bounds, self.b_bounds)
        self.cut_bounds = np.searchsorted(self.cut_a, self.a_bounds)

    @staticmethod
    def covers(both: Vocabularies, text: str, a: list[int], b: list[int]) -> bool:
        want = b" " + text.encode()
        return b"".join(map(both.a.tokens.__getitem__, a)) == want == b"".join(map(both.b.tokens.__getitem__, b))

    def links(self) -> np.ndarray:
        """Of each shared cut the pair linked, by its place among all pairs."""
        code = self.both.code(self.a[self.cut_a].astype(np.int64), self.b[self.cut_b])
        place = np.searchsorted(self.both.pairs, code)
        if not np.array_equal(self.both.pairs.take(place, mode="clip"), code):
            raise AssertionError("tokens that end together must end alike")
        return place

    def written(self) -> list[str]:
        """Groups of each text that has tokens: `a1,a2|b1;a3|b2,b3`."""
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.cut_a], last_b[self.cut_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        line = np.empty(len(self.a) + len(self.b), np.int64)
        line[np.arange(len(self.a)) + np.r_[0, self.cut_b + 1][group_a]] = self.a * 4 + last_a
        line[np.arange(len(self.b)) + np.r_[self.cut_a + 1, 0][group_b]] = self.b * 4 + 2 * last_b
        bounds = self.a_bounds + self.b_bounds
        line[bounds[1:] - 1] += 1  # nothing after the last
        word = self.both.decimals.__getitem__
        return ["".join(map(word, line[a:b].tolist())) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def spread(n: int, held: list[int], values: list, other) -> list:
    """Values of the texts held among all n texts."""
    out = [other] * n
    for k, v in zip(held, values):
        out[k] = v
    return out


def align(df: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, `a_ids` and `b_ids`, and `a_cuts` and `b_cuts`, the
    places of the last A and B token of each group.

    Null and empty texts, and texts that a tokenizer doesn't give back byte by byte, have
    no tokens. Repeated rows are aligned each for itself, very long texts whole, an empty
    table gives no rows, and other columns are left behind. Both files must be readable
    by every executor.
    """

    def step():
        both = vocabularies(a_path, b_path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = Aligned(both, texts(batch.column(1)))

            def lists(values: np.ndarray, bounds: np.ndarray, less: np.ndarray) -> pa.Array:
                parts = [(values[a:b] - c).tolist() for a, b, c in zip(bounds, bounds[1:], less)]
                return pa.array(spread(batch.num_rows, x.held, parts, []), pa.list_(pa.int32()))

            none = np.zeros(len(x.held), np.int64)
            columns = [lists(x.a, x.a_bounds, none), lists(x.b, x.b_bounds, none)]
            columns += [lists(x.cut_a, x.cut_bounds, x.a_bounds), lists(x.cut_b, x.cut_bounds, x.b_bounds)]
            return pa.record_batch([batch.column(0), *columns], ["id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["id"]])
    for c in ("a_ids", "b_ids", "a_cuts", "b_cuts"):
        schema = schema.add(c, ArrayType(IntegerType()))
    return map_slices(rows, step, schema).withColumnRenamed("id", id_col)


def encoded(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts, digest of the groups and linked pairs (sorted, as differences) of every row."""

    def step():
        both = vocabularies(a_path, b_path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.num_rows
            x = Aligned(both, texts(batch.column(1)))
            counts = [np.diff(b).tolist() for b in (x.a_bounds, x.b_bounds, x.cut_bounds)]
            digest = [hashlib.sha256(w.encode()).hexdigest() for w in x.written()]
            of = np.repeat(np.arange(len(x.held)), np.diff(x.cut_bounds))
            links = np.sort(of << 32 | x.links()) & 0xFFFFFFFF
            parts = [np.diff(links[a:b], prepend=0).astype("<u4").tobytes() for a, b in zip(x.cut_bounds, x.cut_bounds[1:])]
            columns = [pa.array(spread(n, x.held, c, 0), pa.int64()) for c in counts]
            columns += [pa.array(spread(n, x.held, digest, ""), pa.string()), pa.array(spread(n, x.held, parts, b""), pa.binary())]
            return pa.record_batch([batch.column(0), *columns], ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

        return work

    schema = StructType([df.schema["id"]])
    for c, kind in (("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("groups_sha256", "string"), ("links", "binary")):
        schema = schema.add(c, kind)
    return map_slices(df.select("id", "text"), step, schema)


def linked(part: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(part, "<u4"), dtype=np.int64)


def count_pairs(links: DataFrame, most: int) -> DataFrame:
    """(pair, n) over all rows; every task sends one row per pair that it met."""

    def run(batches: Batches) -> Batches:
        n = np.zeros(most, np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                np.add.at(n, linked(part), 1)
        met = np.flatnonzero(n)
        yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(n[met])], ["pair", "n"])

    return map_batches(links.select("links"), run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(df: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, n): how many links of the corpus hold each pair that any link holds."""
    both = vocabularies(a_path, b_path)
    rows = encoded(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), a_path, b_path)
    codes = df.sparkSession.createDataFrame([(k, *divmod(c, len(both.b.tokens))) for k, c in enumerate(both.pairs.tolist())], "pair int, a_id int, b_id int")
    return count_pairs(rows, len(both.pairs)).join(codes, "pair").select("a_id", "b_id", "n")


def digests(df: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: its id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair is the most frequent one of their B id in the whole corpus, ties included),
    count_sum (corpus-wide counts summed over links) and groups_sha256.

    Rows without tokens (see `align`) have zeros and an empty digest. Repeated rows each
    count. Links are kept in a work table between the count and its use; the counts, one
    per pair that the vocabularies allow, go to every task.
    """
    spark: SparkSession = df.sparkSession
    both = vocabularies(a_path, b_path)
    rows = work_table(encoded(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), a_path, b_path))
    counts = np.zeros(len(both.pairs), np.int64)
    for r in count_pairs(rows, len(counts)).collect():
        counts[r.pair] = r.n
    highest = np.zeros(len(both.b.tokens), np.int64)
    np.maximum.at(highest, both.pair_b, counts)
    sent = spark.sparkContext.broadcast((counts, counts == highest[both.pair_b]))

    def step():
        counts, best = sent.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [linked(part) for part in batch.column(5).to_pylist()]
            n_best = [int(best[p].sum()) for p in pairs]
            total = [int(counts[p].sum()) for p in pairs]
            columns = [*batch.columns[:4], batch.column(3), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), batch.column(4)]
            return pa.record_batch(columns, [*names])

        return work

    names = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    schema = StructType([rows.schema["id"]])
    for c in names[1:]:
        schema = schema.add(c, "string" if c == "groups_sha256" else "long")
    return map_slices(rows, step, schema).withColumnRenamed("id", id_col)
