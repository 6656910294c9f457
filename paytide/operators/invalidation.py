"""Buckets touched behind an aggregate's back: logged, merged into ranges, refreshed alone.

Rows that arrive below what an aggregate has materialised, and rows that are erased, change closed
buckets. Their buckets are logged as a batch of the writer that saw them, before anything relies on
it; a refresh takes the ranges of adjacent buckets, recomputes exactly these from the rows, and only
then drops the batches it took. A crash in between repeats the refresh, which changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, interval, month_key
from paytide.sources import lake

SCHEMA = "bucket TIMESTAMP, n_rows BIGINT, yyyymm INT, writer STRING, batch_id BIGINT"
#: Ranges that are told apart in one predicate; more of them are joined month by month.
SPANS = 64

Span = tuple[datetime, datetime]


def touched(rows: DataFrame, unit: str, mark: Instant | None = None, at: str = "created_at") -> DataFrame:
    """Buckets of the rows below ``mark`` (the end of what is materialised; all rows without), and their number."""
    late = rows if mark is None else rows.filter(F.col(at) < instant(mark))
    buckets = late.groupBy(F.date_trunc(unit, at).alias("bucket")).agg(F.count("*").alias("n_rows"))
    return buckets.withColumn("yyyymm", month_key("bucket"))


def log_touched(buckets: DataFrame, path: str, batch_id: int, writer: str = "stream") -> None:
    """Keep the touched buckets of one batch; a replay replaces them."""
    lake.write_batch(buckets, path, batch_id, writer=writer)


def pending(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[tuple[str, str, int]]]:
    """The logged buckets not refreshed yet, and the batches they come from: only what is there now."""
    taken = lake.batches(spark, path)
    if not taken:
        return None, []
    folders = [f"{path}/yyyymm={part}/writer={writer}/batch_id={batch}" for part, writer, batch in taken]
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*folders), taken


def ranges(buckets: DataFrame, unit: str) -> DataFrame:
    """Half-open ranges of adjacent buckets, cut at months: at most 744 hours meet in a window."""
    step = interval(f"1 {unit}")
    every = buckets.select(F.date_trunc(unit, "bucket").alias("bucket")).distinct().withColumn("yyyymm", month_key("bucket"))
    month = Window.partitionBy("yyyymm").orderBy("bucket")
    begins = F.lag("bucket").over(month).isNull() | (F.lag("bucket").over(month) + step < F.col("bucket"))
    island = F.sum(begins.cast("int")).over(month)
    return (
        every.withColumn("island", island)
        .groupBy("yyyymm", "island")
        .agg(F.min("bucket").alias("range_start"), (F.max("bucket") + step).alias("range_end"), F.count("*").alias("buckets"))
        .drop("island")
    )


def spans(buckets: DataFrame, unit: str) -> list[Span]:
    """The ranges, for predicates; above ``SPANS`` one from the first to the last bucket of each month."""
    found = [(r.range_start, r.range_end) for r in ranges(buckets, unit).sort("range_start").collect()]
    if len(found) <= SPANS:
        return found
    months: dict[tuple[int, int], Span] = {}
    for a, b in found:
        first, _ = months.get((a.year, a.month), (a, b))
        months[a.year, a.month] = (first, b)
    return list(months.values())


def inside(at: Column, found: list[Span]) -> Column:
    """Is the instant in one of the ranges? Plain comparisons, which reach the scan."""
    hit = F.lit(False)
    for a, b in found:
        hit = hit | ((at >= F.lit(a)) & (at < F.lit(b)))
    return hit
