"""Byte-level BPE encoding and decoding by tree reduction.

A text is cut in halves down to leaves, leaves are encoded, and neighbours are joined
by encoding again a window around the seam that grows until what lies outside is
provably final. There are two such trees:

* pieces: the pattern decides about a piece [p, e) by characters before
  max(e + 1, p + 3) only, and from a boundary on it goes on without memory. Left of the
  seam a piece is final when that bound lies left of the seam; right of the seam
  everything is final as soon as matching arrives at a boundary that the right half has.
* bytes of a long piece: a token sequence is the encoding of its bytes exactly when every
  two neighbours are the encoding of their own concatenation. So the window is final as
  soon as its first and last token agree with their outer neighbours.

Both joins are associative. Decoding concatenates bytes up the tree.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from histlake.llm.common import map_slices, texts

LEAF_CHARS = 8192
LEAF_BYTES = 4
# Pieces, halves of pieces and token pairs a task remembers before it starts over.
MEMO_PIECES = 300_000
MEMO_LENGTH = 64


@functools.lru_cache(maxsize=1)
def char_classes() -> tuple[dict[str, str], str]:
    """Character sets of the classes in patterns, written as ranges, and the set of
    characters that the standard matcher's own short classes put elsewhere."""
    codes = np.r_[0:0xD800, 0xE000:0x110000]
    every = "".join(map(chr, codes.tolist()))

    def members(found) -> np.ndarray:
        held = np.zeros(len(codes), bool)
        for m in found:
            held[m.start() : m.end()] = True
        return held

    def ranges(held: np.ndarray) -> str:
        at = codes[held]
        cuts = np.flatnonzero(np.diff(at) != 1)
        runs = zip(at[np.r_[0, cuts + 1]].tolist(), at[np.r_[cuts, len(at) - 1]].tolist())
        return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)

    sets, unlike = {}, codes == ord("_")
    for name, short in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        held = members(regex.finditer(f"{name}+", every))
        unlike = unlike | (held != members(re.finditer(f"{short}+", every)))
        sets[name] = ranges(held)
    return sets, ranges(unlike)


class Matcher:
    """`findall` and `finditer` of a pattern with `\\p{L}`, `\\p{N}`, `\\s`, `\\S`.

    Runs on the standard library's matcher, which is the faster one but doesn't know
    `\\p`: with its short classes where they mean the same for all characters of a
    text, else with the classes written out.
    """

    def __init__(self, pattern: str):
        sets, unlike = char_classes()
        full, inside, k = "", False, 0
        while k < len(pattern):
            name = next((c for c in (*sets, r"\S") if pattern.startswith(c, k)), "")
            if name == r"\S":
                full += f"[^{sets[chr(92) + 's']}]"
            elif name:
                full += sets[name] if inside else f"[{sets[name]}]"
            else:
                inside = pattern[k] == "[" or inside and pattern[k] != "]"
                full += pattern[k]
            k += len(name) or 1
        self.full = re.compile(full)
        short = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\s\w]").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.short = re.compile(short) if "[[" not in short else self.full
        self.unlike = re.compile(f"[{unlike}]")
        self.unlike_octets = bytes(k for k in range(256) if self.unlike.match(chr(k)))

    def of(self, text: str) -> re.Pattern:
        try:
            octets = text.encode("latin-1")  # most texts; deleting bytes is far faster than a search
        except UnicodeEncodeError:
            return self.full if self.unlike.search(text) else self.short
        return self.short if len(octets.translate(None, self.unlike_octets)) == len(octets) else self.full


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ranks by token bytes, and token bytes by rank, of a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f))}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


class Encoder(dict):
    """Token ids by piece, remembered. When there are too many, the pieces met since
    the last time are kept and the others forgotten."""

    def __init__(self, ranks: dict[bytes, int], tokens: list[bytes], pattern: str):
        super().__init__()
        self.ranks, self.tokens = ranks, tokens
        self.matcher = Matcher(pattern)
        self.before: dict[str, tuple[int, ...]] = {}
        self.halves: dict[bytes, list[int]] = {}
        self.pairs: dict[tuple[int, int], list[int]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.before.get(piece) or tuple(self.encode_bytes(piece.encode("utf-8", "surrogatepass")))
        if len(self) >= MEMO_PIECES // 2:
            self.before = dict(self)
            self.clear()
        if len(piece) <= MEMO_LENGTH:
            self[piece] = ids
        return ids

    # Bytes of one piece

    def encode_bytes(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        known = self.halves.get(data)
        if known is not None:
            return known
        if len(data) <= LEAF_BYTES:
            ids = self.merge(data)
        else:
            half = len(data) // 2
            ids = self.join_bytes(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))
        if len(data) <= 8:
            if len(self.halves) >= MEMO_PIECES:
                self.halves.clear()
            self.halves[data] = ids
        return ids

    def join_bytes(self, left: list[int], right: list[int]) -> list[int]:
        window = self.pair(left[-1], right[0])
        i = j = 1
        while True:
            # Two neighbours of one half agree already; a new token may not.
            open_left = i < len(left) and window[0] != left[-i] and not self.fits(left[-i - 1], window[0])
            open_right = j < len(right) and window[-1] != right[j - 1] and not self.fits(window[-1], right[j])
            if not (open_left or open_right):
                return left[: len(left) - i] + window + right[j:]
            i, j = min(i * (1 + open_left), len(left)), min(j * (1 + open_right), len(right))
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i :] + right[:j])))

    def pair(self, a: int, b: int) -> list[int]:
        """Encoding of two tokens' bytes."""
        ids = self.pairs.get((a, b))
        if ids is None:
            if len(self.pairs) >= MEMO_PIECES:
                self.pairs.clear()
            ids = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return ids

    def fits(self, a: int, b: int) -> bool:
        ids = self.pair(a, b)
        return len(ids) == 2 and ids[0] == a

    def merge(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is known."""
        rank, none = self.ranks.get, len(self.tokens)
        if len(data) > 64:
            return self.merge_long(data)
        parts = [data[k : k + 1] for k in range(len(data))]
        found = [rank(data[k : k + 2], none) for k in range(len(data) - 1)]
        while found and (best := min(found)) != none:
            k = found.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del found[k]
            if k < len(found):
                found[k] = rank(parts[k] + parts[k + 1], none)
            if k:
                found[k - 1] = rank(parts[k - 1] + parts[k], none)
        return [self.ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of candidate pairs, for windows that had to grow."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
        before = list(range(-1, n - 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, stop = heapq.heappop(heap)
            middle = end[k]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two parts has changed meanwhile
            end[k], end[middle] = stop, 0
            if stop < n:
                before[stop] = k
            for a, b in ((k, end[stop] if stop < n else 0), (before[k], stop)):
                if a >= 0 and b and (r := ranks.get(data[a:b])) is not None:
                    heapq.heappush(heap, (r, a, b))
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k : end[k]]])
            k = end[k]
        return out

    # Pieces of one text

    def pieces(self, pattern: re.Pattern, text: str, low: int, high: int) -> list[str]:
        """Pieces of text[low:high], matched as if it were a text of its own."""
        if high - low <= LEAF_CHARS:
            return pattern.findall(text, low, high)
        middle = (low + high) // 2
        left, right = self.pieces(pattern, text, low, middle), self.pieces(pattern, text, middle, high)
        return self.join_pieces(pattern, text, left, right, middle, high)

    def join_pieces(self, pattern: re.Pattern, text: str, left: list[str], right: list[str], middle: int, high: int) -> list[str]:
        at = middle - len(left.pop())
        while left and max(at + 1, at - len(left[-1]) + 3) > middle:
            at -= len(left.pop())
        there, k = middle, 0
        for m in pattern.finditer(text, at, high):
            while there < m.start():
                there += len(right[k])
                k += 1
            if there == m.start():
                break
            left.append(m[0])
        else:
            k = len(right)
        return left + right[k:]

    def encode(self, text: str) -> list[int]:
        pieces = self.pieces(self.matcher.of(text), text, 0, len(text))
        return list(chain.from_iterable(map(self.__getitem__, pieces)))


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker process, which runs one task after another."""
    return Encoder(*load_ranks(path), pattern)


def decode_ids(tokens: list[bytes], ids: list[int]) -> bytes:
    """Bytes of the ids, concatenated up a tree of halves."""
    if len(ids) <= LEAF_CHARS:
        return b"".join(map(tokens.__getitem__, ids))
    half = len(ids) // 2
    return decode_ids(tokens, ids[:half]) + decode_ids(tokens, ids[half:])


def encode(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: its id and `token_ids`; other columns are left behind.

    Null and empty texts have no tokens. Repeated rows are encoded each for itself.
    `path` must be readable by every executor.
    """

    def step():
        encoder = shared_encoder(path, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [encoder.encode(t) for t in texts(batch.column(1))]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])))
            return pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["id", "token_ids"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """One row per row of `df`: its id, `token_ids` and `decoded` bytes; null ids give no bytes."""

    def step():
        tokens = load_ranks(path)[1]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(1)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = [decode_ids(tokens, flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            return pa.record_batch([batch.column(0), lists, pa.array(out, pa.binary())], ["id", "token_ids", "decoded"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("token_ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def digests(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode its ids, keeping counts and digests only.

    Columns: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256.
    """

    def step():
        encoder = shared_encoder(path, pattern)
        tokens = encoder.tokens
        decimal = [str(k) for k in range(len(tokens))]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, coded, decoded = [], [], []
            for text in texts(batch.column(1)):
                ids = encoder.encode(text)
                n.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode_ids(tokens, ids)).hexdigest())
            return pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_slices(rows, step, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def tokenize(df: DataFrame, path: str, pattern: str, *, text_col: str = "text") -> DataFrame:
    """The rows of `df` with n_tokens, token_ids and round_trip in place of the text.

    `round_trip` says that the decoded bytes are those of the text. Columns of these
    names are replaced. Null texts count as empty, very long ones are encoded whole, and
    repeated rows each for itself.
    """
    own = ("n_tokens", "token_ids", "round_trip")
    rest = [c for c in df.columns if c != text_col and c not in own]

    def step():
        encoder = shared_encoder(path, pattern)
        tokens = encoder.tokens

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = texts(batch.column(len(rest)))
            ids = [encoder.encode(t) for t in found]
            same = [decode_ids(tokens, x) == t.encode("utf-8", "surrogatepass") for x, t in zip(ids, found)]
            counts = pa.array([len(x) for x in ids], pa.int64())
            return pa.record_batch([*batch.columns[:-1], counts, pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())], [*rest, *own])

        return work

    rows = df.select(*rest, text_col)
    schema = StructType(rows.schema.fields[:-1]).add("n_tokens", "long").add("token_ids", ArrayType(IntegerType())).add("round_trip", "boolean")
    return map_slices(rows, step, schema)
