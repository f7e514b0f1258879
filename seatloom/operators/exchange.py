"""Tables as other steps need them: materialised, numbered in order, or broadcast where they are small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatloom.sources.files import shared_root


def materialised(df: DataFrame) -> DataFrame:
    """Computed once, into the shared checkpoint folder; a lost executor costs no recompute."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, most: int = 1 << 17) -> DataFrame:
    """A materialised table of short rows, with the hint to broadcast it if it has at most `most` of them (some MB)."""
    return F.broadcast(df) if df.count() <= most else df


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df, materialised, with its rows' numbers from 0 in that order. Rows are dealt by ranges of the order and sorted in each;
    a row's number is its place in its partition and the rows of the partitions before, whose counts are all that one
    task sees."""
    ranged = df.repartitionByRange(*[F.col(f"`{c}`") for c in order]).sortWithinPartitions(*[F.col(f"`{c}`") for c in order])
    ranged = materialised(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")
