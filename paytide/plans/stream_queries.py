"""Registered queries that run a stream over the tables to completion and read its output."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from paytide.functions.timing import month_key
from paytide.operators import aggregates as agg
from paytide.operators import lifecycle, states, versions
from paytide.plans import mirror
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.scans import DAMAGE, change_events
from paytide.plans.views import Views, transactions, with_versions
from paytide.session import workspace
from paytide.sources import bulk, lake
from paytide.sources.tables import SCHEMAS
from paytide.streaming import ingest, poll


def _events(v: Views):
    # a glob, since a file source takes a folder or a pattern
    reader = v.spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 8)
    return reader.parquet(f"{v.root}/events.parquet*")


def _run(v: Views, stream, process) -> ingest.Layout:
    layout = ingest.Layout(workspace(v.spark, "mirror"))
    ingest.start(stream, process(layout), layout).awaitTermination()
    return layout


@query(
    "stream_cdc_mirror",
    sql(
        "tx",
        f"""SELECT type, status, CASE WHEN k = 9 THEN 1 ELSE 0 END AS _is_deleted, count(*) AS n_rows,
          CAST(sum(amount) AS DOUBLE) AS total FROM (SELECT *, {DAMAGE} AS reason FROM tx)
        WHERE reason IS NULL GROUP BY 1, 2, 3""",
    ),
)
def stream_cdc_mirror(v: Views):
    """Change events through the stream into the versioned table, read back resolved."""
    layout = _run(v, change_events(transactions(_events(v))), ingest.process_cdc)
    table = versions.final(ingest.read_raw(v.spark, layout))
    return table.groupBy("type", "status", "_is_deleted").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("total")
    )


@query(
    "stream_dead_letters",
    sql(
        "tx",
        f"""m AS (SELECT {DAMAGE} AS reason FROM tx)
        SELECT reason, count(*) AS n_rows FROM m WHERE reason IS NOT NULL GROUP BY 1""",
    ),
)
def stream_dead_letters(v: Views):
    layout = _run(v, change_events(transactions(_events(v))), ingest.process_cdc)
    letters = ingest.read_letters(v.spark, layout)
    return letters.groupBy("reason").agg(F.count("*").alias("n_rows"))


@query(
    "stream_batch_metrics",
    sql(
        "tx",
        f"""m AS (SELECT {DAMAGE} AS reason FROM tx)
        SELECT 'stream' AS writer, CAST(0 AS BIGINT) AS batch, count(*) AS rows_read,
          count(*) FILTER (WHERE reason IS NULL) AS rows_written, count(*) FILTER (WHERE reason IS NOT NULL) AS dead_letters,
          true AS behind_now FROM m""",
    ),
)
def stream_batch_metrics(v: Views):
    """Rows read, written and refused of each batch, and whether the newest version lies behind now."""
    layout = _run(v, change_events(transactions(_events(v))), ingest.process_cdc)
    return ingest.read_metrics(v.spark, layout).select(
        F.col("of_writer").alias("writer"), F.col("of_batch").alias("batch"), "rows_read", "rows_written", "dead_letters", (F.col("lag_ms") > 0).alias("behind_now")
    )


@query(
    "stream_trigger_states",
    sql(
        "raw",
        """SELECT CAST(created_at AS DATE) AS day, source_institution, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount,
          count(*) FILTER (WHERE status = 'settled') AS settled_count FROM raw GROUP BY 1, 2""",
    ),
)
def stream_trigger_states(v: Views):
    """Partial states added batch by batch: like an insert trigger, they count versions."""
    layout = _run(v, with_versions(transactions(_events(v))), ingest.process_rows)
    parts = ingest.read_daily(v.spark, layout)
    return states.merge_states(parts, "day", "source_institution").select(
        "day", "source_institution", "tx_count", "total_amount", "settled_count"
    )


@query(
    "stream_then_compact",
    sql(
        "final",
        """SELECT type, count(*) AS physical_rows, count(*) AS logical_rows, 1::BIGINT AS max_versions
        FROM final GROUP BY 1""",
    ),
)
def stream_then_compact(v: Views):
    """The versioned table after compaction: one physical row per transaction."""
    layout = _run(v, with_versions(transactions(_events(v))), ingest.process_rows)
    versions.compact(v.spark, layout.raw)
    return versions.final_vs_physical(ingest.read_raw(v.spark, layout))


@query("recluster_inventory")
def recluster_inventory(v: Views):
    """Rows, files and bytes after the clustered rewrite."""
    path = workspace(v.spark, "clustered")
    lifecycle.recluster(v.tx, path, files=8)
    copy = v.spark.read.parquet(path)
    return lake.inventory(copy, "type")


@query("file_inventory")
def file_inventory(v: Views):
    """Rows, files and bytes per event type of the stored table."""
    return lake.inventory(v.table("events"), "event_type")


@query(
    "poll_two_cycles",
    sql(
        "tx",
        """SELECT type, status, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total FROM tx GROUP BY 1, 2""",
    ),
)
def poll_two_cycles(v: Views):
    """Two watermark cycles over a table whose rows become visible late.

    The first sees what was committed by the middle of the month, the second, a full scan,
    everything. Rows committed late lie below the first watermark; none may be missing.
    """
    middle, end = datetime(2024, 1, 15), datetime(2024, 3, 1)
    layout = ingest.Layout(workspace(v.spark, "poll"))
    visible = v.visible_at(v.tx) <= F.lit(middle)
    poll.cycle(v.spark, v.tx.filter(visible), layout, middle, 0)
    poll.cycle(v.spark, v.tx, layout, end, 1)
    table = versions.final(poll.read_target(v.spark, layout))
    return table.groupBy("type", "status").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("total")
    )


BY_STATUS = """SELECT type, status, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total FROM tx GROUP BY ALL"""


def _by_status(v: Views, layout: ingest.Layout):
    return versions.final(ingest.read_raw(v.spark, layout)).groupBy("type", "status").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("total")
    )


@query("poll_capped_full_scan", sql("tx", BY_STATUS))
def poll_capped_full_scan(v: Views):
    """A poll that was down for two weeks drains its backlog, old late rows included, in capped cycles."""
    middle, end = datetime(2024, 1, 15), datetime(2024, 3, 1)
    layout = ingest.Layout(workspace(v.spark, "poll"))
    poll.cycle(v.spark, v.tx.filter(v.visible_at(v.tx) <= F.lit(middle)), layout, middle)
    poll.drain(v.spark, v.tx, layout, end, batch=max(1, v.tx.count() // 3))
    return _by_status(v, layout)


@query("two_writers_one_table", sql("tx", BY_STATUS))
def two_writers_one_table(v: Views):
    """Two jobs that both number their batches from 0 keep each other's rows."""
    layout = ingest.Layout(workspace(v.spark, "writers"))
    raw = with_versions(v.tx)
    for i, writer in enumerate(("one", "two")):
        own = ingest.Layout(layout.root, writer)
        ingest.process_rows(own)(raw.filter(F.col("tx_id") % 2 == i), 0)
    return _by_status(v, layout)


@query("load_then_stream", sql("tx", BY_STATUS))
def load_then_stream(v: Views):
    """A bulk load before and after a stream's batch, in one table."""
    layout = ingest.Layout(workspace(v.spark, "load"))
    months = bulk.month_slices(datetime(2024, 1, 1).date(), datetime(2024, 3, 1).date())
    half = v.tx.filter(F.col("id") % 2 == 0)
    ingest.load(half, layout, months)
    ingest.process_rows(layout)(with_versions(v.tx.filter(F.col("id") % 2 == 1)), 0)
    ingest.load(half, layout, months)
    return _by_status(v, layout)


@query(
    "refresh_emptied_month",
    sql("hourly", "SELECT bucket, type, status, tx_count, CAST(total_amount AS DOUBLE) AS total_amount FROM hourly"),
)
def refresh_emptied_month(v: Views):
    """A month of wrong buckets goes when its range is refreshed from rows that have none."""
    stored = mirror.Mirror(v.spark, workspace(v.spark, "emptied"))
    wrong = v.tx.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 60 DAYS"))
    both = agg.volume_hourly(v.tx.unionByName(wrong)).withColumn("yyyymm", month_key("bucket"))
    lake.replace_partitions(both, f"{stored.root}/volume_hourly", "yyyymm")
    stored.refresh_hourly(v.tx, datetime(2024, 2, 20), datetime(2024, 5, 1))
    return stored.hourly.select("bucket", "type", "status", "tx_count", "total_amount")


@query(
    "stored_aggregate_refresh",
    sql(
        "hourly",
        """SELECT bucket, type, status, tx_count, CAST(total_amount AS DOUBLE) AS total_amount FROM hourly""",
    ),
)
def stored_aggregate_refresh(v: Views):
    """A stored hourly aggregate that missed ten days, repaired by refreshing that range."""
    start, end = datetime(2024, 1, 10), datetime(2024, 1, 20)
    stored = mirror.Mirror(v.spark, workspace(v.spark, "stored"))
    hole = v.tx.filter((F.col("created_at") < start) | (F.col("created_at") >= end))
    partial = agg.volume_hourly(hole).withColumn("yyyymm", month_key("bucket"))
    lake.replace_partitions(partial, f"{stored.root}/volume_hourly", "yyyymm")
    stored.refresh_hourly(v.tx, start, end)
    return stored.hourly.select("bucket", "type", "status", "tx_count", "total_amount")
