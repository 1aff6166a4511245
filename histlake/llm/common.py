"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

# Rows handled at once inside a Python task: bounds the memory beside the Arrow batch.
SLICE_ROWS = 256
# Distinct words a task remembers before it starts over: bounds its memory.
MEMO_WORDS = 300_000

Batches = Iterator[pa.RecordBatch]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which all executors share.

    Only a local session without the setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histlake-llm-"))
    return spark.sparkContext.getCheckpointDir()


def work_table(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet in the shared folder and go on from there.

    A lost executor then costs a read instead of the whole lineage, and the planner
    knows the true size. A retention rule on `llm-work` cleans up.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-work/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """`mapInArrow` whose workers find this package where the driver found it.

    Executors on other machines get it with `--py-files` or as an installed package.
    """
    env = df.sparkSession.sparkContext.environment
    home = str(Path(__file__).resolve().parents[2])
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (home, env.get("PYTHONPATH"))))
    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, step: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Apply a per-task function to slices of at most SLICE_ROWS rows.

    `step()` runs once per task and returns the function, so that memos live as long
    as the task and no longer.
    """

    def run(batches: Batches) -> Batches:
        work = step()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield work(batch.slice(start, SLICE_ROWS))

    return map_batches(df, run, schema)


# Stands for a missing integer id, which so comes last.
NO_ID = (1 << 63) - 1


def tell_apart(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as (id, doc, tag, text): the id as a number, NO_ID if it is null, and for ids
    that several rows share a hash of the text, else 0.

    Only ids are shuffled as long as few are shared. Other than integer ids are refused.
    """
    if not isinstance(df.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = df.select(F.col(id_col).alias("id"), doc.alias("doc"), F.col(text_col).alias("text"))
    several = work_table(rows.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("shared")))
    tag = F.when(F.col("shared").isNull(), F.lit(0)).otherwise(F.xxhash64("text"))
    return rows.join(several, F.col("doc") == F.col("shared"), "left").select("id", "doc", tag.alias("tag"), "text")


def unused(df: DataFrame, *stems: str) -> list[str]:
    """A name beginning with each stem that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (stem + "_" * k for k in range(1, len(taken) + 2)) if n.lower() not in taken) for stem in stems]


def texts(column: pa.Array) -> list[str]:
    """The column as strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """The column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """XXH64 of each word seen, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and xor-shift)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node, as (node, component).

    `edges` has columns a, b. Large-star and small-star steps alternate; each step
    keeps at most as many edges as there were, so a component of any size never
    meets in one row. A hub's neighbours are reduced to their minimum by partial
    aggregation and joined back, which adaptive execution may split.
    """
    edges = work_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        # Edges point from a larger to a smaller node.
        if large:
            both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        joined = both.join(low, both.a == low.c)
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("c").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    before = None
    for _ in range(rounds):
        edges = work_table(star(star(edges, True), False))
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
