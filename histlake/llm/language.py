"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from its code point. A
trigram is the product (binding) of its three letter vectors, the first two rotated by
two places and one place (permutation); a text or a language is the sum (bundling) of
its trigrams' vectors. A text gets the language whose prototype has the largest cosine.

Sums are exact integers, so prototypes don't depend on partitioning. They are learnt
from all labelled rows: each task sums its rows by language, and tasks' sums are added.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, map_batches, map_slices, texts

DIMENSIONS = 1024
SEED = 7
MEMO_TRIGRAMS = 200_000  # whose products with the prototypes a task remembers
MAX_LANGUAGES = 500
TRAIN_CHARS, PREDICT_CHARS = 1 << 21, 1 << 18  # handled at once
MAX_PARTS = 512
PART_BITS, LETTER_BITS = 9, 18


@functools.lru_cache(maxsize=1)
def letter_ranks() -> np.ndarray:
    """Number of every code point among all letters, from 1 on; 0: not a letter."""
    held = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return np.where(held, np.cumsum(held), 0)


def keys_of(text: str) -> np.ndarray:
    """Trigram keys in order; a run of other characters is one space, also at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    ranks = letter_ranks()[codes]
    ranks = ranks[np.r_[True, (ranks[1:] > 0) | (ranks[:-1] > 0)]]
    if len(ranks) < 3:
        return np.zeros(0, np.int64)
    return ranks[:-2] << 2 * LETTER_BITS | ranks[1:-1] << LETTER_BITS | ranks[2:]


class Letters:
    """Vectors of letters by their numbers, in the three rotations that a trigram needs."""

    def __init__(self):
        self.known: dict[int, np.ndarray] = {}

    def of(self, numbers: np.ndarray, turn: int) -> np.ndarray:
        kinds, back = np.unique(numbers, return_inverse=True)
        if len(self.known) > 20_000:
            self.known.clear()
        for n in kinds.tolist():
            if n not in self.known:
                bits = np.random.Generator(np.random.Philox(key=[SEED, n])).integers(0, 2, DIMENSIONS, dtype=np.int8)
                self.known[n] = bits * np.int8(2) - np.int8(1)
        return np.roll(np.array([self.known[n] for n in kinds.tolist()]), turn, axis=1)[back]

    def trigrams(self, keys: np.ndarray) -> np.ndarray:
        mask = (1 << LETTER_BITS) - 1
        return self.of(keys >> 2 * LETTER_BITS, 2) * self.of(keys >> LETTER_BITS & mask, 1) * self.of(keys & mask, 0)


def counted(parts: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part, key and count of each distinct trigram of each part, in order."""
    keys = np.concatenate([np.zeros(0, np.int64), *found])
    owner = np.repeat(parts, [len(x) for x in found]).astype(np.int64)
    both = np.sort(owner << 3 * LETTER_BITS | keys)
    firsts = np.flatnonzero(np.r_[True, np.diff(both) != 0][: len(both)])
    counts = np.diff(np.r_[firsts, len(both)])
    return both[firsts] >> 3 * LETTER_BITS, both[firsts] & ((1 << 3 * LETTER_BITS) - 1), counts


def stretches(found: list[str], most: int) -> list[range]:
    """Consecutive texts that together stay near `most` characters."""
    out, start, total = [], 0, 0
    for k, text in enumerate(found):
        if k > start and (total + len(text) > most or k - start >= MAX_PARTS):
            out.append(range(start, k))
            start, total = k, 0
        total += len(text)
    return [*out, range(start, len(found))] if found else []


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype by language from all rows with a language; null texts add nothing."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Batches) -> Batches:
        letters, sums = Letters(), {}
        for batch in batches:
            langs, found = batch.column(0).to_pylist(), texts(batch.column(1))
            for rows in stretches(found, TRAIN_CHARS):
                names = sorted({langs[k] for k in rows})
                number = {name: n for n, name in enumerate(names)}
                part, keys, counts = counted(np.array([number[langs[k]] for k in rows]), [keys_of(found[k]) for k in rows])
                for at in range(0, len(keys), 4096):
                    here = slice(at, at + 4096)
                    vectors = letters.trigrams(keys[here]).astype(np.float64) * counts[here, None]
                    edges = np.flatnonzero(np.r_[True, np.diff(part[here]) != 0])
                    for n, v in zip(part[here][edges].tolist(), np.add.reduceat(vectors, edges)):
                        sums[names[n]] = sums[names[n]] + v if names[n] in sums else v
        values = pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(list(sums), pa.string()), values], ["lang", "sums"])

    parts = map_batches(rows, run, "lang string, sums array<long>")
    added = parts.select("lang", F.posexplode("sums").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = (
        added.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).limit(MAX_LANGUAGES + 1).collect()
    )
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: prototypes must stay small enough to send to all tasks")
    return {r.lang: np.array([x.value for x in r.v], np.float64) for r in found}


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row.

    `und` and 0 where the text is null or has no letter, or nothing was learnt. Else the
    language of the largest cosine, ties to the first name; a cosine below 0 scores 0.

    The product of a bundle with a prototype is the sum of its trigrams' products, so no
    text's own vector is needed; its length is taken as that of a sum of orthogonal
    trigram vectors, which random vectors of this dimension nearly are. The length
    is the same for all languages and so doesn't touch the choice.
    """
    names = sorted(k for k, v in prototypes.items() if np.any(v))
    table = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]).reshape(len(names), DIMENSIONS)

    def step():
        letters = Letters()
        known = [np.zeros(0, np.int64), np.zeros((0, len(names)))]  # rising keys, products

        def products(keys: np.ndarray) -> np.ndarray:
            kinds, back = np.unique(keys, return_inverse=True)
            new = kinds[~np.isin(kinds, known[0])]
            if len(known[0]) + len(new) > MEMO_TRIGRAMS:
                known[:] = known[0][:0], known[1][:0]
                new = kinds
            fresh = [letters.trigrams(new[at : at + 4096]).astype(np.float32) @ turned for at in range(0, len(new), 4096)]
            if fresh:
                merged = np.r_[known[0], new]
                order = np.argsort(merged)
                known[:] = merged[order], np.concatenate([known[1], *fresh])[order]
            return known[1][np.searchsorted(known[0], kinds)][back]

        turned = table.T.astype(np.float32)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            best, top = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            found = texts(batch.column(1))
            for rows in stretches(found, PREDICT_CHARS):
                part, keys, counts = counted(np.arange(len(rows)), [keys_of(found[k]) for k in rows])
                if not len(keys) or not names:
                    continue
                edges = np.flatnonzero(np.r_[True, np.diff(part) != 0])
                dots = np.add.reduceat(products(keys) * counts[:, None], edges)
                norms = np.sqrt(DIMENSIONS * np.add.reduceat(counts.astype(np.float64) ** 2, edges))
                cosines = np.clip(dots / norms[:, None], 0, 1)
                for n, k, c in zip(part[edges].tolist(), dots.argmax(axis=1).tolist(), cosines.max(axis=1).tolist()):
                    best[rows.start + n], top[rows.start + n] = names[k], c
            return pa.record_batch([batch.column(0), pa.array(best, pa.string()), pa.array(top, pa.float64())], ["id", "lang_pred", "score"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
