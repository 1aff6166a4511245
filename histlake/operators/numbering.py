"""Gapless surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def number_and_count(
    df: DataFrame, order_by: Sequence[str], name: str, start: int = 0
) -> tuple[DataFrame, int]:
    """Add `name` = start + 1, start + 2, ... in the order of `order_by`; also
    return how many rows there are.

    A global `row_number` would sort everything in one task. Here rows are range
    partitioned and sorted, each keeps its partition and position, and the partition
    sizes give each partition its first number. The driver sees one size per
    partition. The ranged rows are written out because range bounds come from a
    sample: a recomputation could place rows differently between the two reads.
    `order_by` must be unique per row.
    """
    spark = df.sparkSession
    part = F.shiftright("_id", _POSITION_BITS)
    position = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    ranged = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in order_by])
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    offsets, total = [], 0
    for r in sizes.orderBy("part").collect():
        offsets.append((r.part, total))
        total += r["size"]
    first = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    # `first` has one row per partition, whatever the size of the data.
    numbered = (
        ranged.withColumn("_part", part)
        .join(F.broadcast(first), "_part")
        .withColumn(name, F.lit(start) + F.col("_before") + position + 1)
        .select(*df.columns, name)
    )
    return numbered, total


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, start: int = 0) -> DataFrame:
    return number_and_count(df, order_by, name, start)[0]
