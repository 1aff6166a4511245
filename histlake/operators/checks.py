"""Integrity checks. Each returns the violating rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KEY, PERIOD, UNKNOWN_MEMBER


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def several_current(dim: DataFrame, key: str = KEY) -> DataFrame:
    return duplicate_keys(dim.where("is_current"), [key])


def gaps_between_versions(
    dim: DataFrame, key: str = KEY, order: str | Column = "opened_seq"
) -> DataFrame:
    """Versions that do not end where the next version of the key begins. A key has
    at most one version per batch, so the window stays small."""
    w = Window.partitionBy(key).orderBy(order)
    return (
        dim.withColumn("_next", F.lead(F.struct("valid_from")).over(w))
        .where(F.col("_next").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("_next.valid_from")))
        .select(key, "valid_from", "valid_to", F.col("_next.valid_from").alias("next_from"))
    )


def repeated_grain(facts: DataFrame, grain: Sequence[str] = (KEY, PERIOD)) -> DataFrame:
    return duplicate_keys(facts, grain)


def dangling_links(
    facts: DataFrame,
    dim: DataFrame,
    employers: DataFrame,
    sk: str = "taxpayer_sk",
    lookup: str = "employer_id",
) -> DataFrame:
    """Facts whose version or employer does not exist, counted per missing value.

    Facts are reduced to distinct link values before each join.
    """

    def missing(link: str, members: DataFrame) -> DataFrame:
        used = facts.groupBy(link).agg(F.count(F.lit(1)).alias("n"))
        return used.join(members.select(link).distinct(), link, "left_anti").select(
            F.lit(link).alias("link"), F.col(link).cast("string").alias("value"), "n"
        )

    return missing(sk, dim).unionByName(missing(lookup, employers))


def unknown_links(facts: DataFrame, lookup: str = "employer_id") -> DataFrame:
    """How many facts point to the unknown member."""
    return facts.agg(
        F.count(F.lit(1)).alias("num_facts"),
        F.count_if(F.col(lookup) == UNKNOWN_MEMBER).alias("num_unknown"),
    )


def content_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows found on one side only, duplicates counted, with the side they are on."""
    columns = before.columns
    sides = before.withColumn("_n", F.lit(1)).unionByName(after.withColumn("_n", F.lit(-1)))
    surplus = sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("before")).otherwise(F.lit("after"))
    return surplus.select(*columns, side.alias("side"), F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_i")).drop("_i")


def on_keys(df: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose keys occur in `touched`: the side a check has to look at after a
    load of few keys. The keys are broadcast while they are small."""
    return df.join(touched.select(*keys).distinct(), list(keys), "left_semi").select(*df.columns)


def violations(
    dim: DataFrame,
    facts: DataFrame,
    employers: DataFrame,
    key: str = KEY,
    period: str = PERIOD,
    order: str | Column = "taxpayer_sk",
    sk: str = "taxpayer_sk",
    lookup: str = "employer_id",
) -> DataFrame:
    """What any check of the star schema finds, as (check, value, n).

    Over all rows, or over those of some keys: every check but that of links to employers
    compares rows of one key only, so what it finds for a key doesn't depend on others.
    """
    found = {
        "several current": several_current(dim, key).select(F.col(key).alias("value"), "n"),
        "gap between versions": gaps_between_versions(dim, key, order).groupBy(F.col(key).alias("value")).agg(F.count(F.lit(1)).alias("n")),
        "repeated grain": repeated_grain(facts, (key, period)).select(F.concat_ws("|", key, period).alias("value"), "n"),
        "dangling link": dangling_links(facts, dim, employers, sk, lookup).select(F.concat_ws("=", "link", "value").alias("value"), "n"),
    }
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("check"), "value", "n") for name, rows in found.items()])


def _row_hash(df: DataFrame, salt: str) -> Column:
    """64 bits of a row. Nulls, which a hash passes over, are told by their places."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    values = [F.to_json(F.col(f.name), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    nulls = F.concat(*[F.col(f.name).isNull().cast("int").cast("string") for f in df.schema])
    return F.xxhash64(F.lit(salt), nulls, *values)


def content_sums(df: DataFrame, parts: int = 1024) -> DataFrame:
    """(part, n, sum_a, sum_b) of the rows of `df`, dealt to parts by their content.

    The sums of two 64-bit hashes of the rows don't depend on order, and count duplicates.
    Sums of several sets of rows are added up by `merged_sums`. One row per part and task
    is shuffled, whatever the number of rows.
    """
    a, b = _row_hash(df, "a"), _row_hash(df, "b")
    return _sums(df.select(F.pmod(b, F.lit(parts)).cast("int").alias("part"), a.alias("a"), b.alias("b")), ["part"])


def _sums(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    wide = T.DecimalType(20, 0)
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast(wide)).alias("sum_a"), F.sum(F.col("b").cast(wide)).alias("sum_b"))


def merged_sums(*sums: DataFrame) -> DataFrame:
    """Sums of all rows that the given sums were taken of."""
    wide = T.DecimalType(30, 0)
    return (
        reduce(DataFrame.unionByName, sums)
        .groupBy("part")
        .agg(F.sum("n").alias("n"), F.sum("sum_a").cast(wide).alias("sum_a"), F.sum("sum_b").cast(wide).alias("sum_b"))
    )


def differing_parts(before: DataFrame, after: DataFrame, by: Sequence[str] = ("part",)) -> DataFrame:
    """Parts whose sums are not equal on both sides; a part without rows has none."""
    minus = after.select(*by, (-F.col("n")).alias("n"), (-F.col("sum_a")).alias("sum_a"), (-F.col("sum_b")).alias("sum_b"))
    net = before.unionByName(minus).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "sum_a", "sum_b")])
    return net.where("n <> 0 or sum_a <> 0 or sum_b <> 0").select(*by)


def content_difference_by_sums(before: DataFrame, after: DataFrame, parts: int = 1024) -> DataFrame:
    """As `content_difference`, with sums of hashes compared first.

    Parts of equal sums are passed over; parts that differ are cut into as many parts again, and only
    rows of those of them that differ are compared themselves: about one of parts squared for each row
    that differs. Each step reads the tables again and shuffles no row of an equal part.
    Two different sets of rows pass as equal if both 64-bit sums and their number agree.
    """

    def dealt(df: DataFrame) -> DataFrame:
        b = _row_hash(df, "b")
        fine = F.pmod(F.xxhash64(b), F.lit(parts)).cast("int")
        return df.select(F.struct(*df.columns).alias("row"), F.pmod(b, F.lit(parts)).cast("int").alias("part"), fine.alias("fine"), _row_hash(df, "a").alias("a"), b.alias("b"))

    sides = [dealt(before), dealt(after.select(*before.columns))]
    coarse = differing_parts(*[_sums(s, ["part"]) for s in sides])
    near = [s.join(coarse, "part", "left_semi") for s in sides]
    differing = differing_parts(*[_sums(s, ["part", "fine"]) for s in near], by=["part", "fine"])
    left = [s.join(differing, ["part", "fine"], "left_semi").select("row.*") for s in sides]
    return content_difference(*left)
