"""Irregular JSON reference records, parsed one by one and never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EMPLOYER_COLUMNS

# Issue texts.
MISSING_ID = "missing employer_id"
MISSING_UEN = "missing uen"
MISSING_COUNT = "missing employee_count"
WRONG_COUNT_TYPE = "invalid employee_count type"
COERCED_COUNT = "employee_count was non-integer; coerced"
BAD_COUNT = "uncoercible employee_count"

# Fixed value: integer text, with single underscores between digits.
_INTEGER = r"^[+-]?[0-9]+(?:_[0-9]+)*\z"


# White space around it, of any kind.
_OUTER_SPACE = r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+\z"


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """A file holding one JSON array: `(pos, record)` per element.

    A single JSON document cannot be split; large inputs come as JSON Lines.
    """
    document = (
        spark.read.option("multiLine", True).option("singleVariantColumn", "doc").json(path)
    )
    elements = spark.tvf.variant_explode(F.col("doc").outer())
    return document.lateralJoin(elements).select("pos", F.col("value").alias("record"))


# Why a line is refused.
NOT_JSON, NOT_AN_OBJECT = "not JSON", "not an object"


def read_json_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """JSON Lines with broken lines: `(pos, record)` of every line that holds an object,
    and `(file, start, pos, line, reason)` of every other line that isn't blank.

    No line is fatal and none is lost. Lines are read in parallel; `pos` is unique and
    follows the file order within a split, which begins at byte `start` of `file`.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
    )
    read = lines.where(F.regexp_replace("line", _OUTER_SPACE, "") != "").withColumn("record", F.try_parse_json("line"))
    reason = F.when(F.col("record").isNull(), F.lit(NOT_JSON)).when(
        ~F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")), F.lit(NOT_AN_OBJECT)
    )
    judged = read.withColumn("reason", reason)
    return (
        judged.where("reason IS NULL").select("pos", "record"),
        judged.where("reason IS NOT NULL").select("file", "start", "pos", "line", "reason"),
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON record per line, read in parallel. `pos` is unique and follows the
    file order within each split, but has gaps."""
    return (
        spark.read.option("singleVariantColumn", "record")
        .json(path)
        .select(F.monotonically_increasing_id().alias("pos"), "record")
    )


def _text(name: str) -> Column:
    return F.try_variant_get("record", f"$.{name}", "string")


def _kind(name: str) -> Column:
    """Type of a field: null for an absent one, `VOID` for JSON null."""
    return F.schema_of_variant(F.try_variant_get("record", f"$.{name}", "variant"))


def _listed(names: Column) -> Column:
    """Names in quotes, separated by commas and in brackets."""
    quoted = F.transform(
        names,
        lambda k: F.when(
            F.contains(k, F.lit("'")) & ~F.contains(k, F.lit('"')),
            F.concat(F.lit('"'), k, F.lit('"')),
        ).otherwise(F.concat(F.lit("'"), F.replace(k, F.lit("'"), F.lit("\\'")), F.lit("'"))),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def parse_employers(records: DataFrame, keep_pos: bool = False) -> DataFrame:
    """Canonical employer columns plus `has_schema_issues` and `schema_issue_detail`.
    With `keep_pos` also `pos`, by which later records of an identifier win.

    `records` has a position `pos` and a variant `record`. A missing identifier becomes
    `UNKNOWN_{pos}`, a blank registration number null, and a count that is not a JSON
    integer is coerced from integer text or set to null. Keys beyond the canonical
    ones are dropped and listed.
    """
    id_text, id_kind = _text("employer_id"), _kind("employer_id")
    zero = id_kind.rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$") & (id_text.try_cast("double") == 0)
    empty = (
        id_text.isNull()
        | (id_text == "")
        | zero
        | ((id_kind == "BOOLEAN") & (id_text == "false"))
        | ((id_kind != "STRING") & id_text.isin("[]", "{}"))
    )
    no_id = F.coalesce(empty, F.lit(True))
    uen = F.when(_text("uen") != "", _text("uen"))

    count_kind, count_text = _kind("employee_count"), _text("employee_count")
    trimmed = F.regexp_replace(count_text, _OUTER_SPACE, "")
    # JSON integers are BIGINT, or long DECIMAL without fraction beyond 64 bits; the latter
    # are no issue, but no stored count can hold them.
    is_int = count_kind.rlike(r"^(BIGINT|DECIMAL\((19|[2-9][0-9]),0\))$")
    is_text_int = (count_kind == "STRING") & trimmed.rlike(_INTEGER)
    no_count = count_kind.isNull() | (count_kind == "VOID")
    count = F.when(is_int | is_text_int, F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("bigint"))
    count_issue = (
        F.when(no_count, F.lit(MISSING_COUNT))
        .when(count_kind == "BOOLEAN", F.lit(WRONG_COUNT_TYPE))
        .when(is_int, F.lit(None))
        .when(is_text_int, F.lit(COERCED_COUNT))
        .otherwise(F.lit(BAD_COUNT))
    )
    keys = F.map_keys(F.col("record").cast("map<string,variant>"))
    extras = F.array_sort(F.array_except(keys, F.array(*[F.lit(c) for c in EMPLOYER_COLUMNS])))

    issues = F.filter(
        F.array(
            F.when(no_id, F.lit(MISSING_ID)),
            F.when(uen.isNull(), F.lit(MISSING_UEN)),
            count_issue,
            F.when(F.size(extras) > 0, F.concat(F.lit("extra fields: "), _listed(extras))),
        ),
        lambda i: i.isNotNull(),
    )
    return records.select(
        F.when(no_id, F.concat(F.lit("UNKNOWN_"), F.col("pos").cast("string")))
        .otherwise(id_text)
        .alias("employer_id"),
        _text("company_name").alias("company_name"),
        uen.alias("uen"),
        _text("industry").alias("industry"),
        _text("address").alias("address"),
        count.alias("employee_count"),
        issues.alias("_issues"),
        "pos",
    ).select(
        *EMPLOYER_COLUMNS,
        *(["pos"] if keep_pos else []),
        (F.size("_issues") > 0).alias("has_schema_issues"),
        F.when(F.size("_issues") > 0, F.array_join("_issues", "; ")).alias("schema_issue_detail"),
    )


def count_issues(employers: DataFrame) -> DataFrame:
    """Records and flagged records: `(records, flagged)`."""
    return employers.agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.col("has_schema_issues").cast("bigint")), F.lit(0)).alias("flagged"),
    )
