"""Versioned Parquet tables: new folders first, one small list of folders last.

A table is a set of named parts, each a list of Parquet folders. Writing never
touches a folder that is being read; a new version becomes visible when its list is
written, so a load is either fully visible or not at all, and a lost job leaves only
unlisted folders behind. Parts that a load does not touch are carried over by
name, without reading them. A folder may be partitioned by an integer column; which of
its partitions are read is left to the reader's partition pruning.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove, rename_new, subfolders

Listing = dict[str, dict[str, list[str]]]

_ENTRY = "table_name string, part string, folder string"


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def latest(self) -> tuple[int, Listing]:
        """Newest version number and its folders; version 0 is the empty store."""
        try:
            versions = self.spark.read.schema(f"{_ENTRY}, v int").parquet(f"{self.root}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        newest = max(_partition_values(versions, "v"), default=0)
        listing: Listing = {}
        # One row per stored folder: file names, not data.
        for r in versions.where(F.col("v") == newest).orderBy("folder").collect():
            listing.setdefault(r.table_name, {}).setdefault(r.part, []).append(r.folder)
        return newest, listing

    def publish(self, version: int, listing: Listing) -> None:
        """Make `listing` the given version by one rename. A number that an interrupted
        job left without a list is passed over; one with a list means that another
        writer was faster, which is an error.
        """
        rows = [
            (table, part, folder)
            for table, parts in listing.items()
            for part, folders in parts.items()
            for folder in folders
        ]
        pending = f"{self.root}/pending/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(pending)
        while not rename_new(self.spark, pending, f"{self.root}/versions/v={version}"):
            if self.latest()[0] >= version:
                remove(self.spark, pending)
                raise RuntimeError(f"version {version} was published by another writer meanwhile")
            version += 1

    def vacuum(self) -> int:
        """Remove older versions and all folders the newest doesn't list; how many went.

        Not to be run while a load is under way or an older version is being read.
        """
        newest, listing = self.latest()
        used = {folder.split("/")[2] for parts in listing.values() for names in parts.values() for folder in names if folder.startswith("data/")}
        gone = [f"data/{table}/{name}" for table in subfolders(self.spark, f"{self.root}/data") for name in subfolders(self.spark, f"{self.root}/data/{table}") if name not in used]
        gone += [f"versions/{v}" for v in subfolders(self.spark, f"{self.root}/versions") if v != f"v={newest}"]
        gone += [f"pending/{p}" for p in subfolders(self.spark, f"{self.root}/pending")]
        for name in gone:
            remove(self.spark, f"{self.root}/{name}")
        return len(gone)

    def read(
        self,
        listing: Listing,
        table: str,
        ddl: str,
        parts: Callable[[str], bool] | None = None,
    ) -> DataFrame:
        """Rows of a table, or only of the partitions accepted by `parts`."""
        folders = [
            f"{self.root}/{folder}"
            for part, paths in listing.get(table, {}).items()
            if parts is None or parts(part)
            for folder in paths
        ]
        if not folders:
            return self.spark.createDataFrame([], ddl)
        # A folder is addressed itself, so its own name is not taken for a column.
        return self.spark.read.schema(ddl).option("recursiveFileLookup", True).parquet(*folders)

    def read_split(
        self, listing: Listing, table: str, ddl: str, part: str, column: str, values: Sequence[int] | None = None
    ) -> DataFrame:
        """Rows of a part written with `by=column`, or only its partitions `values`."""
        folders = [f"{self.root}/{f}" for f in listing.get(table, {}).get(part, [])]
        if not folders:
            return self.spark.createDataFrame([], ddl)
        rows = self.spark.read.schema(f"{ddl}, {column} int").parquet(*folders)
        if values is not None:
            rows = rows.where(F.col(column).isin(*values))
        return rows.drop(column)

    def write(
        self, table: str, df: DataFrame, part: str, by: str | None = None, counted: Observation | None = None
    ) -> Mapping[str, list[str]]:
        """Write `df` as one new folder of `part`, partitioned by an integer column if
        `by` names one. Adaptive rebalancing gathers each value into few files. `counted`
        gets the number of rows as `n`."""
        folder = f"data/{table}/{uuid.uuid4().hex}"
        gathered = df.hint("rebalance", F.col(by)) if by else df
        if counted:
            gathered = gathered.observe(counted, F.count(F.lit(1)).alias("n"))
        out = gathered.write.partitionBy(by) if by else gathered.write
        out.parquet(f"{self.root}/{folder}")
        return {part: [folder]}

    def write_split(
        self, table: str, df: DataFrame, column: str, prefix: str = ""
    ) -> Mapping[str, list[str]]:
        """Write `df` split by an integer column, one folder per value.

        Adaptive rebalancing gathers each value into few files and splits a value that
        holds a large share of the rows over several tasks.
        """
        if not isinstance(df.schema[column].dataType, T.IntegerType):
            raise TypeError(f"{column} must be an integer column")
        folder = f"data/{table}/{uuid.uuid4().hex}"
        path = f"{self.root}/{folder}"
        df.hint("rebalance", F.col(column)).write.partitionBy(column).parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        values = sorted(_partition_values(stored, column))
        return {f"{prefix}{v}": [f"{folder}/{column}={v}"] for v in values}


def _partition_values(df: DataFrame, column: str) -> set[int]:
    """Values of an integer partition column, from file names alone. Any other value
    (null, negative) is an error: its rows would be stored but never found."""
    names = df.inputFiles()
    found = [re.search(rf"/{column}=([0-9]+)/", name) for name in names]
    if None in found:
        raise ValueError(f"{column} must not be null or negative: {names[found.index(None)]}")
    return {int(m.group(1)) for m in found}


def with_parts(listing: Listing, table: str, replaced: Sequence[str], new: Mapping[str, list[str]]) -> None:
    """Drop the `replaced` partitions of a table and add the `new` ones."""
    parts = listing.setdefault(table, {})
    for part in replaced:
        parts.pop(part, None)
    for part, folders in new.items():
        parts[part] = parts.get(part, []) + list(folders)
