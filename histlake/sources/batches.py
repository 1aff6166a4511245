"""CSV batches: discovery, header-based reading, alignment to the canonical schema."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CANONICAL_COLUMNS, NEW
from ..session import qualified

# File naming of the daily batches.
FILE_PATTERN = "individual_tax_returns_*.csv"
FILE_PREFIX = "individual_tax_returns_"

# A quoted field that starts at a field boundary and is closed on the same line.
_CLOSED_QUOTES = r'(?<=^|,|")"[^"]*"'


@dataclass(frozen=True)
class BatchFile:
    path: str
    batch: str


@dataclass(frozen=True)
class Aligned:
    """Canonical rows together with what the header lacked or had too much."""

    rows: DataFrame
    added: list[str]
    unexpected: list[str]


def batch_name(path: str, prefix: str = FILE_PREFIX) -> str:
    """File stem without the common prefix, e.g. `day1`."""
    stem = path.rstrip("/").rsplit("/", 1)[-1]
    stem = stem[: stem.rfind(".")] if "." in stem else stem
    return stem.replace(prefix, "")


def batch_name_of(path: Column, prefix: str = FILE_PREFIX) -> Column:
    """`batch_name` as a Column over file names or paths."""
    stem = F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?/?\z", 1)
    return F.replace(stem, F.lit(prefix), F.lit(""))


def natural_order(name: str) -> list:
    """Sort key that puts `day2` before `day10`."""
    return [(1, int(p), "") if p.isdigit() else (0, 0, p) for p in re.split(r"([0-9]+)", name) if p]


def batch_path_of(path: Column, pattern: str = FILE_PATTERN) -> Column:
    """The part of a file path that names its batch: the file itself, or the folder
    of part files it lies in. Null for a file of no batch."""
    glob = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in pattern)
    found = F.regexp_extract(path, f"^(.*/{glob})(?:/.*)?$", 1)
    return F.when(found != "", found)


def list_batches(
    spark: SparkSession, folder: str, pattern: str = FILE_PATTERN, prefix: str = FILE_PREFIX
) -> list[BatchFile]:
    """Batches of a folder in natural name order.

    A batch is a file matching `pattern`, or a folder of part files so named. One
    path per batch reaches the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return ordered_batches(files.select("path"), pattern, prefix)


def ordered_batches(
    files: DataFrame, pattern: str = FILE_PATTERN, prefix: str = FILE_PREFIX
) -> list[BatchFile]:
    """Batches that the files in column `path` belong to, in natural name order."""
    paths = files.select(batch_path_of(F.col("path"), pattern).alias("path")).distinct()
    found = [BatchFile(r.path, batch_name(r.path, prefix)) for r in paths.collect() if r.path]
    return sorted(found, key=lambda f: natural_order(f.batch))


def select_batches(files: Sequence[BatchFile], wanted: str = "all") -> list[BatchFile]:
    """All files, or the one batch with exactly this name."""
    if wanted == "all":
        return list(files)
    chosen = [f for f in files if f.batch == wanted]
    if not chosen:
        raise ValueError(f"no batch file found for {wanted!r}")
    return chosen


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may contain a line break.

    After removing the quoted fields that close on their own line, a remaining quote
    means that a field continues on the next line or that quotes are used loosely.
    """
    lines = spark.read.text(path).where(F.contains("value", F.lit('"')))
    open_quote = F.contains(F.regexp_replace("value", _CLOSED_QUOTES, ""), F.lit('"'))
    return not lines.where(open_quote).isEmpty()


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, or of the first part file of a folder, from its first line."""
    first = spark.read.text(path).first()
    return next(csv.reader([first.value.removeprefix("\ufeff")])) if first else []


def distinct_names(names: Sequence[str], canonical: Sequence[str] = CANONICAL_COLUMNS) -> list[str]:
    """Names that can be told apart: the first column of a name keeps it. Further ones,
    and spellings of a canonical name that differ in case, get their place appended."""
    exact = {n for n in names if n in canonical}
    taken, out = set(), []
    for i, name in enumerate(names):
        low = name.lower()
        free = low not in taken and (name in exact or low not in {e.lower() for e in exact})
        out.append(name if free else f"{name}.{i + 1}")
        taken.add(out[-1].lower())
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Every field as text, by header; only the empty field is null. Several paths must
    have one header, `names` if it is known.

    Column `row_pos` orders rows as in the file: start of the split, then position
    within it. A file whose quoted fields span lines has to be read by one task; all
    others are split, and `multi_line=None` finds out which kind it is.
    """
    if multi_line is None:
        multi_line = spans_lines(spark, path)
    if names is None:
        names = header_names(spark, path)
    # Spark can't tell names apart that differ in case only, so such files are read by
    # position; all others are checked against their header.
    clear = len({n.lower() for n in names}) == len(names)
    schema = ", ".join(f"{_quoted(n if clear else f'_c{i}')} string" for i, n in enumerate(names))
    df = spark.read.csv(
        path,
        schema=schema,
        header=True,
        multiLine=multi_line,
        escape='"',
        enforceSchema=not clear,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    if not clear:
        df = df.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(distinct_names(names))])
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias("row_pos"))


def align(
    df: DataFrame,
    canonical: Sequence[str] = CANONICAL_COLUMNS,
    defaults: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> Aligned:
    """Exactly the canonical columns in order, as text.

    Missing columns become null, nulls take the column's default, anything else is
    dropped and reported. `keep` names columns to carry along untouched.
    """
    defaults = {"record_type": NEW} if defaults is None else defaults
    have = set(df.columns)

    def column(name: str) -> Column:
        value = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]))
        return value.alias(name)

    return Aligned(
        df.select(*[column(c) for c in canonical], *keep),
        [c for c in canonical if c not in have],
        sorted(have - set(canonical) - set(keep)),
    )


def read_batch(
    spark: SparkSession,
    path: str,
    default_record_type: str = NEW,
    multi_line: bool | None = None,
) -> Aligned:
    """One batch file in canonical form plus `row_pos`."""
    return align(
        read_csv(spark, path, multi_line),
        defaults={"record_type": default_record_type},
        keep=["row_pos"],
    )


@dataclass(frozen=True)
class Header:
    """First line of a batch as column names, and whether quoted fields span lines."""

    names: tuple[str, ...]
    multi_line: bool


def _one_slash(path: Column) -> Column:
    return F.regexp_replace(path, "^(file:)//(?=/)", "$1")


def _with_place(rows: DataFrame, files: Sequence[BatchFile], path: Column) -> DataFrame:
    """Add `place`, that of the batch in `files` which a row's file is or lies in.

    `files` was listed on the driver, one entry per batch, so sending it to the tasks
    stays small.
    """
    spark = rows.sparkSession
    known = spark.createDataFrame([(qualified(spark, f.path), i) for i, f in enumerate(files)], "_of string, _place int")
    known = F.broadcast(known.select(_one_slash(F.col("_of")).alias("_of"), "_place"))
    # Special characters come encoded in the paths of rows.
    found = rows.withColumn("_path", _one_slash(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))))
    found = found.withColumn("_folder", F.regexp_replace("_path", "/[^/]*$", ""))
    own, folder = known.withColumnRenamed("_place", "_own"), known.withColumnRenamed("_of", "_in")
    joined = found.join(own, F.col("_path") == F.col("_of"), "left").join(folder, F.col("_folder") == F.col("_in"), "left")
    return joined.select(*rows.columns, F.coalesce("_own", "_place").alias("place"))


def read_headers(spark: SparkSession, files: Sequence[BatchFile], multi_line: bool | None = None) -> list[Header]:
    """Headers of all batches by one job; one row per batch reaches the driver.

    The job reads all lines, as finding line breaks in quoted fields needs that anyway.
    A batch without any line has no columns.
    """
    if not files:
        return []
    text = spark.read.text([f.path for f in files]).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    lines = _with_place(text, files, F.col("file"))
    quoted = F.contains("value", F.lit('"'))
    open_quote = quoted & F.contains(F.regexp_replace("value", _CLOSED_QUOTES, ""), F.lit('"'))
    first = F.when(F.col("start") == 0, F.struct("file", "row"))
    found = lines.select("place", "value", first.alias("at"), open_quote.alias("open")).groupBy("place")
    rows = {r.place: r for r in found.agg(F.min_by("value", "at").alias("line"), F.max("open").alias("open")).collect()}
    out = []
    for k in range(len(files)):
        line = rows[k].line if k in rows else None
        names = next(csv.reader([line.removeprefix("\ufeff")]), []) if line is not None else []
        out.append(Header(tuple(names), rows[k].open if multi_line is None and k in rows else bool(multi_line)))
    return out


def drift(names: Sequence[str], canonical: Sequence[str] = CANONICAL_COLUMNS) -> tuple[list[str], list[str]]:
    """Canonical columns that a header lacks, and those it has too many."""
    have = set(distinct_names(names)) if len({n.lower() for n in names}) < len(names) else set(names)
    return [c for c in canonical if c not in have], sorted(have - set(canonical))


def read_log(
    spark: SparkSession,
    files: Sequence[BatchFile],
    default_record_type: str = NEW,
    multi_line: bool | None = None,
    headers: Sequence[Header] | None = None,
) -> DataFrame:
    """All batches as one log with `batch`, `batch_seq` (1, 2, ...) and `row_pos`.

    Batches with the same header are read by one scan, so the plan grows with the number
    of different headers, not of batches. `headers` are those of `files`, if known.
    """
    headers = read_headers(spark, files, multi_line) if headers is None else headers
    groups: dict[Header, list[BatchFile]] = {}
    for f, h in zip(files, headers):
        if h.names:
            groups.setdefault(h, []).append(f)
    seqs = {f: i for i, f in enumerate(files, 1)}
    frames = []
    for header, members in groups.items():
        read = read_csv(spark, [f.path for f in members], header.multi_line, header.names)
        rows = align(read, defaults={"record_type": default_record_type}, keep=["row_pos"]).rows
        batches = spark.createDataFrame([(i, f.batch, seqs[f]) for i, f in enumerate(members)], "_place int, batch string, batch_seq int")
        found = _with_place(rows, members, F.col("row_pos.file"))
        frames.append(found.join(F.broadcast(batches), F.col("place") == F.col("_place")).drop("place", "_place"))
    if not frames:
        empty = ", ".join(f"{c} string" for c in CANONICAL_COLUMNS)
        return spark.createDataFrame([], f"{empty}, row_pos struct<file:string,start:bigint,row:bigint>, batch string, batch_seq int")
    return with_batch_dates(reduce(DataFrame.unionByName, frames))


def first_date(order: str = "row_pos") -> Column:
    """Aggregate: `batch_date` of the first row that has one."""
    return F.min_by("batch_date", F.when(F.col("batch_date").isNotNull(), F.col(order)))


def batch_dates(log: DataFrame, order: str = "row_pos") -> DataFrame:
    """Date of each batch: the first that its rows carry, in file order, as it stands."""
    return log.groupBy("batch", "batch_seq").agg(first_date(order).alias("batch_date"))


def with_batch_dates(log: DataFrame) -> DataFrame:
    """Give every row the date of its batch. `batch_dates` has one row per batch, and
    the batches were listed on the driver before, so the broadcast stays small."""
    dates = batch_dates(log).select(
        F.col("batch_seq").alias("_seq"), F.col("batch_date").alias("_date")
    )
    return log.join(F.broadcast(dates), F.col("batch_seq") == F.col("_seq")).select(
        *[F.col("_date").alias(c) if c == "batch_date" else F.col(c) for c in log.columns]
    )
