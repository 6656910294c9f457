"""Dense positions in a total order, computed without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.session import stored


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row under ``order`` (which must be unique).

    Rows are range-partitioned on the whole order key, so a hot leading value is
    split too. The ranged rows are stored because range boundaries are sampled and must
    be the same for the rows and for the partition counts.
    """
    numbered = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", 33))
        .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid"),
        "ranked",
    )
    # one row per partition, whatever the data size
    per_part = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        numbered.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )


def page_of(position: Column, size: int) -> Column:
    return F.floor(position / F.lit(size)).cast("long")
