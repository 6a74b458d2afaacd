"""Positions in a global order, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.session import cut_lineage


def fresh_name(df: DataFrame, name: str) -> str:
    """The name, with more underscores in front if the table has such a column."""
    while name in df.columns:
        name = "_" + name
    return name


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the position (from 0) of each row in the given order; ties in any order.

    Rows are sorted by range partitions and numbered inside them; each partition's first position
    comes from the partitions' row counts, which are all that meets in one place. The numbered rows
    are stored, so that positions never change.
    """
    local = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = cut_lineage(local.withColumn("_local", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_local", 33)
    counts = local.groupBy(part.alias("_part")).count().collect()  # a row per partition
    first, starts = 0, []
    for row in sorted(counts, key=lambda r: r["_part"]):
        starts.append((row["_part"], first))
        first += row["count"]
    starts_df = df.sparkSession.createDataFrame(starts, "_part long, _first long")
    joined = local.withColumn("_part", part).join(F.broadcast(starts_df), "_part")
    place = F.col("_first") + F.col("_local") - F.shiftleft("_part", 33)
    return joined.withColumn(name, place).drop("_part", "_first", "_local")
