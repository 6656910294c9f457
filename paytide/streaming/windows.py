"""Tumbling windows of a stream: closed by a watermark, with late rows logged and repaired.

Whether a row is late depends on the row alone: it is, if its window had been over for longer than
the lateness when it arrived. Rows on time are counted in windows that Spark's watermark closes; the
watermark trails a second further than the lateness, so while batches come in order of arrival it
drops none of them (``late_rows`` of the progress log tells if it ever did). Late rows only have their
hour logged, and ``refresh_late`` builds the logged hours anew from the stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paytide.functions.timing import interval, month_key
from paytide.operators import aggregates, compaction, invalidation
from paytide.sources import lake
from paytide.streaming.ingest import Layout

SCHEMA = (
    "bucket TIMESTAMP, type STRING, status STRING, tx_count BIGINT, total_amount DECIMAL(28,2), "
    "min_amount DECIMAL(18,2), max_amount DECIMAL(18,2), yyyymm INT, writer STRING, batch_id BIGINT"
)


def path(layout: Layout) -> str:
    return f"{layout.root}/volume_windows"


def late_log(layout: Layout) -> str:
    return f"{layout.root}/late_hours"


def is_late(arrived: str, lateness: str, at: str = "created_at") -> Column:
    """Had the row's hour been over for longer than ``lateness`` when it arrived?"""
    return F.date_trunc("hour", at) + interval("1 hour") + interval(lateness) < F.col(arrived)


def closed(stream: DataFrame, arrived: str, lateness: str) -> DataFrame:
    """Hourly volume of the rows on time, each hour once, when the watermark has passed it."""
    timely = stream.withWatermark("created_at", f"{lateness} 1 second").filter(~is_late(arrived, lateness))
    counted = timely.groupBy(F.window("created_at", "1 hour").alias("w"), "type", "status").agg(
        F.count("*").alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    return counted.select(F.col("w.start").alias("bucket"), *counted.columns[1:], month_key("w.start").alias("yyyymm"))


def start(stream: DataFrame, layout: Layout, arrived: str, lateness: str = "1 hour", every: str | None = None) -> list[StreamingQuery]:
    """The two queries: closed windows into the table, and hours of late rows into the log."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(batch, path(layout), batch_id, writer=layout.writer)

    def note(batch: DataFrame, batch_id: int) -> None:
        invalidation.log_touched(invalidation.touched(batch, "hour"), late_log(layout), batch_id, layout.writer)

    queries = []
    late = stream.filter(is_late(arrived, lateness))
    for frame, run, name in ((closed(stream, arrived, lateness), keep, "windows"), (late, note, "late")):
        writer = frame.writeStream.outputMode("append").foreachBatch(run)
        writer = writer.option("checkpointLocation", f"{layout.checkpoint}_{name}")
        queries.append((writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start())
    return queries


def read(spark: SparkSession, layout: Layout) -> DataFrame:
    return compaction.rows(spark, path(layout), SCHEMA).drop("writer", "batch_id")


def closed_until(query: StreamingQuery) -> Column | None:
    """The watermark of the stream's last batch: hours that end by then have been written."""
    report = query.lastProgress
    mark = report["eventTime"].get("watermark") if report else None
    return F.lit(mark).cast("timestamp") if mark else None


def refresh_late(spark: SparkSession, layout: Layout, rows: DataFrame, until: Column | None = None) -> int:
    """Build the logged hours anew from all rows; returns how many ranges.

    Hours that the stream has not closed yet stay logged: it will still write them. Closed are those
    that end by ``until`` (see ``closed_until``); without it, those up to the newest one written.
    """
    log, taken = invalidation.pending(spark, late_log(layout))
    if log is None:
        return 0
    if until is None:
        last = read(spark, layout).agg(F.max("bucket")).head()[0] if lake.exists(spark, path(layout)) else None
        if last is None:
            return 0
        until = F.lit(last) + interval("1 hour")
    over = F.col("bucket") + interval("1 hour") <= until
    number = 1 + max(batch for _, _, batch in taken)
    invalidation.log_touched(log.filter(~over).drop("writer", "batch_id"), late_log(layout), number, "open")
    ready = log.filter(over)
    found = invalidation.spans(ready, "hour")
    if found:
        months = sorted(r.yyyymm for r in ready.select("yyyymm").distinct().collect())
        fresh = aggregates.volume_hourly(rows.filter(invalidation.inside(F.col("created_at"), found))).withColumn("yyyymm", month_key("bucket"))

        def merge(stored: DataFrame) -> DataFrame:
            kept = stored.filter(~invalidation.inside(F.col("bucket"), found))
            return kept.unionByName(fresh.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields]))

        missing = [m for m in months if str(m) not in lake.partitions(spark, path(layout), "yyyymm")]
        if missing:  # an hour that had late rows alone may be the first of its month
            lake.write_batch(fresh.filter(F.col("yyyymm").isin(missing)).select(*read(spark, layout).columns), path(layout), number, writer="late")
        compaction.compact(spark, path(layout), SCHEMA, merge, parts=months, again=True)
    lake.drop_batches(spark, late_log(layout), taken)
    return len(found)
