"""Registered queries over stored tables: merges, loads, look-backs, refreshes, repairs and swaps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from paytide.functions.timing import month_key
from paytide.operators import aggregates as agg
from paytide.operators import compaction, lifecycle, states, versions
from paytide.plans import mirror
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.scans import DAMAGE, OVERLAP, change_events
from paytide.plans.stream_queries import BY_STATUS
from paytide.plans.views import Views, transactions, with_versions
from paytide.session import stored, workspace
from paytide.sources import bulk, increment, lake
from paytide.sources.tables import SCHEMAS, STORED_SCHEMA
from paytide.streaming import dual, ingest, progress, windows

FIRST, UNTIL = date(2024, 1, 1), date(2024, 3, 1)


def _batches(v: Views, layout: ingest.Layout, rows, first: int, until: int, of: int) -> None:
    """Some of the table's rows as batches ``first`` to ``until`` of a writer, dealt by number."""
    for i in range(first, until):
        ingest.process_rows(layout)(rows.filter(F.col("tx_id") % of == i), i)


@query(
    "states_then_compact",
    sql(
        "daily funnel",
        """SELECT 'daily' AS kind, source_institution, type, count(*) AS keys, CAST(1 AS BIGINT) AS rows_a_key,
          CAST(sum(tx_count) AS BIGINT) AS n, CAST(sum(settled_count) AS BIGINT) AS settled FROM daily GROUP BY 2, 3
        UNION ALL
        SELECT 'funnel', source_institution, type, count(*), 1, CAST(sum(cnt) AS BIGINT),
          CAST(coalesce(sum(cnt) FILTER (WHERE status = 'settled'), 0) AS BIGINT) FROM funnel GROUP BY 2, 3""",
    ),
)
def states_then_compact(v: Views):
    """Partial states of two writers, merged twice while batches go on coming: one row per key is left."""
    layout = ingest.Layout(workspace(v.spark, "compacted"), sketches=True)
    other = ingest.Layout(layout.root, "other", True)
    rows = stored(bulk.to_raw(v.tx), "versions")
    _batches(v, layout, rows.filter("tx_id % 2 = 0"), 0, 3, 6)
    _batches(v, other, rows.filter("tx_id % 2 = 1"), 0, 4, 6)
    ingest.compact(v.spark, layout)
    _batches(v, layout, rows.filter("tx_id % 2 = 0"), 3, 6, 6)
    _batches(v, other, rows.filter("tx_id % 2 = 1"), 4, 6, 6)
    ingest.compact(v.spark, layout)

    def summary(kind: str, df, keys, n, settled):
        per = df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(n).alias("n"), F.sum(settled).alias("settled"))
        out = per.groupBy("source_institution", "type").agg(
            F.count("*").alias("keys"), F.max("rows").alias("rows_a_key"), F.sum("n").alias("n"), F.sum("settled").alias("settled")
        )
        return out.select(F.lit(kind).alias("kind"), "*")

    daily = summary("daily", ingest.read_daily(v.spark, layout), states.DAILY_KEYS, F.col("tx_count"), F.col("settled_count"))
    settled = F.when(F.col("status") == "settled", F.col("cnt")).otherwise(0)
    return daily.unionByName(summary("funnel", ingest.read_funnel(v.spark, layout), states.FUNNEL_KEYS, F.col("cnt"), settled))


@query(
    "two_writers_dead_letters",
    sql(
        "tx",
        f"""m AS (SELECT {DAMAGE} AS reason, id % 2 AS w FROM tx)
        SELECT CASE w WHEN 0 THEN 'one' ELSE 'two' END AS writer, reason, count(*) AS n_rows FROM m
        WHERE reason IS NOT NULL GROUP BY 1, 2""",
    ),
)
def two_writers_dead_letters(v: Views):
    """Two event streams that both begin with batch 0 keep each other's dead letters."""
    root = workspace(v.spark, "letters")
    for i, writer in enumerate(("one", "two")):
        layout = ingest.Layout(root, writer)
        ingest.process_cdc(layout)(change_events(v.tx.filter(F.col("id") % 2 == i)), 0)
    return ingest.read_letters(v.spark, layout).groupBy("writer", "reason").agg(F.count("*").alias("n_rows"))


@query(
    "overlap_stored",
    sql(
        "tx anchor",
        OVERLAP
        + """
        SELECT id, updated_at FROM seen
        WHERE updated_at >= wm - INTERVAL 6 HOUR AND updated_at <= wm AND visible_at > wm""",
    ),
)
def overlap_stored(v: Views):
    """The look-back over a stored mirror: the months of the few rows it asks about prune its folders."""
    wm, layout = v.ago("2 days"), ingest.Layout(workspace(v.spark, "mirror"))
    written = v.tx.filter((F.col("updated_at") <= wm) & (v.visible_at(v.tx) <= wm))
    ingest.write_raw(bulk.to_raw(written), 0, layout)
    seen = stored(increment.looked_at_again(v.tx, wm, 21600), "seen")
    left = increment.lacking(seen, ingest.read_raw(v.spark, layout), increment.overlap_start(wm, 21600))
    return left.select("id", "updated_at")


HOURLY = "SELECT bucket, type, status, tx_count, CAST(total_amount AS DOUBLE) AS total_amount FROM hourly"


def _hourly(m: mirror.Mirror):
    return m.hourly.select("bucket", "type", "status", "tx_count", "total_amount")


@query("late_rows_refreshed", sql("hourly", HOURLY))
def late_rows_refreshed(v: Views):
    """An hourly aggregate that lacks late rows, brought up to date by the hours those fell into alone."""
    m = mirror.Mirror(v.spark, workspace(v.spark, "late"))
    late = F.col("id") % 211 == 0
    lake.replace_partitions(
        agg.volume_hourly(v.tx.filter(~late)).withColumn("yyyymm", month_key("bucket")), f"{m.root}/volume_hourly", "yyyymm"
    )
    for i in range(2):
        m.note_late(v.tx.filter(late & (F.col("id") % 2 == i)), i)
    m.refresh_touched(v.tx, "volume_hourly")
    return _hourly(m)


@query("backfill_skips_filled", sql("hourly", "SELECT *, CAST(0 AS BIGINT) AS filled_again FROM (" + HOURLY + ")"))
def backfill_skips_filled(v: Views):
    """An aggregate that lacks ten days is filled from its coverage; a second call finds nothing to do."""
    m = mirror.Mirror(v.spark, workspace(v.spark, "fill"))
    start, end = datetime(2024, 1, 10), datetime(2024, 1, 20)
    hole = v.tx.filter((F.col("created_at") < start) | (F.col("created_at") >= end))
    lake.replace_partitions(agg.volume_hourly(hole).withColumn("yyyymm", month_key("bucket")), f"{m.root}/volume_hourly", "yyyymm")
    m.backfill("volume_hourly", v.tx, datetime(2024, 3, 1))
    again = m.backfill("volume_hourly", v.tx, datetime(2024, 3, 1))
    return _hourly(m).withColumn("filled_again", F.lit(again).cast("long"))


LOADED = """d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1)
SELECT day, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total, any_value(d.n) AS state_rows
FROM tx JOIN d ON d.day = CAST(created_at AS DATE) GROUP BY 1"""


def _loaded(v: Views, layout: ingest.Layout):
    day = F.to_date("created_at").alias("day")
    rows = ingest.read_raw(v.spark, layout).groupBy(day).agg(F.count("*").alias("n_rows"), F.sum("amount").alias("total"))
    counted = states.merge_states(ingest.read_daily(v.spark, layout), "day").select("day", F.col("tx_count").alias("state_rows"))
    return rows.join(counted, "day")


@query("bulk_load_days", sql("tx", LOADED))
def bulk_load_days(v: Views):
    """Day slices of one month, twenty to a job: each keeps its rows, and its states."""
    layout = ingest.Layout(workspace(v.spark, "days"))
    ingest.load(v.tx, layout, bulk.day_slices(FIRST, UNTIL), slices_a_job=20)
    return _loaded(v, layout)


@query("bulk_load_resumed", sql("tx", LOADED))
def bulk_load_resumed(v: Views):
    """A load that was stopped after a week, with one more day written but not recorded, goes on."""
    layout, days = ingest.Layout(workspace(v.spark, "resumed")), bulk.day_slices(FIRST, UNTIL)
    ingest.load(v.tx, layout, days[:7])
    lost = v.tx.filter((F.col("created_at") >= F.lit(days[7][0])) & (F.col("created_at") < F.lit(days[7][1])))
    ingest.process_rows(ingest.Layout(layout.root, "load"))(bulk.to_raw(lost), 999)
    ingest.load(v.tx, layout, days, resume=True)
    return _loaded(v, layout)


@query("dual_write_swap", sql("tx", BY_STATUS))
def dual_write_swap(v: Views):
    """A second mirror, written beside the first from batch 2 on, with a batch that failed between the two."""
    first, second = (ingest.Layout(workspace(v.spark, name)) for name in ("first", "second"))
    rows = stored(bulk.to_raw(v.tx), "versions")
    _batches(v, first, rows, 0, 2, 4)

    def fails(layout: ingest.Layout):
        def run(batch, batch_id):
            if layout.root == second.root:
                raise RuntimeError("lost")
            ingest.process_rows(layout)(batch, batch_id)

        return run

    part = lambda i: rows.filter(F.col("tx_id") % 4 == i)
    try:
        dual.dual_write(first, second, fails)(part(2), 2)
    except RuntimeError:
        dual.dual_write(first, second)(part(2), 2)
    dual.copy_history(v.spark, first, second, 2)
    dual.dual_write(first, second)(part(3), 3)
    pointer = workspace(v.spark, "pointer")
    dual.swap(v.spark, first, second, pointer)
    live = ingest.Layout(lake.resolve(v.spark, pointer))
    return versions.final(ingest.read_raw(v.spark, live)).groupBy("type", "status").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("total")
    )


@query("stream_progress_log", "SELECT CAST(8 AS BIGINT) AS batches, count(*) AS rows_in, CAST(0 AS BIGINT) AS late_rows FROM events")
def stream_progress_log(v: Views):
    """A stream of eight files leaves a row for each batch, with the rows it read."""
    source, log = workspace(v.spark, "files"), workspace(v.spark, "progress")
    v.table("events").repartition(8, "event_id").write.parquet(source)
    listener = progress.ProgressLog(v.spark, log, every=3, name="progress_log")
    v.spark.streams.addListener(listener)
    try:
        stream = v.spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(source)
        layout = ingest.Layout(workspace(v.spark, "mirror"))
        writer = with_versions(transactions(stream)).writeStream.queryName("progress_log").trigger(availableNow=True)
        writer.foreachBatch(lambda batch, number: ingest.write_raw(batch, number, layout)).option(
            "checkpointLocation", layout.checkpoint
        ).start().awaitTermination()
        v.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        v.spark.streams.removeListener(listener)
    listener.flush()
    rows = progress.read_progress(v.spark, log)
    return rows.agg(
        F.count("*").alias("batches"), F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows")
    )


@query(
    "stream_tumbling_hourly",
    sql(
        "hourly",
        """SELECT bucket, type, status, tx_count, CAST(total_amount AS DOUBLE) AS total_amount,
          CAST(min_amount AS DOUBLE) AS min_amount, CAST(max_amount AS DOUBLE) AS max_amount FROM hourly
        WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR - INTERVAL 1 SECOND""",
    ),
)
def stream_tumbling_hourly(v: Views):
    """Hours closed by a watermark over files in order of arrival, late rows repaired: equal to a full count."""
    source, layout = workspace(v.spark, "arrivals"), ingest.Layout(workspace(v.spark, "windows"))
    rows = v.table("events")
    arrived = v.visible_at(transactions(rows)).alias("arrived")
    rows = stored(transactions(rows).select("*", arrived).drop("metadata"), "rows")
    stream = v.spark.readStream.schema(rows.schema).parquet
    edges = [datetime(2023, 12, 1), *(datetime(2024, 1, d) for d in (7, 13, 19, 25)), datetime(2024, 12, 1)]
    for a, b in zip(edges, edges[1:], strict=False):
        some = rows.filter((F.col("arrived") >= F.lit(a)) & (F.col("arrived") < F.lit(b)))
        # as many files as the rows fill; what has arrived is one batch, so none overtakes another
        some.write.mode("append").parquet(source)
        counting, late = windows.start(stream(source), layout, "arrived", "6 hours")
        for started in (counting, late):
            started.awaitTermination()
    windows.refresh_late(v.spark, layout, rows, windows.closed_until(counting))
    return windows.read(v.spark, layout).drop("yyyymm")


@query(
    "purge_account_repaired",
    sql(
        "tx",
        """SELECT type, count(*) AS n_rows, count(*) AS daily_rows, count(*) AS funnel_rows,
          CAST(sum(amount) AS DOUBLE) AS daily_amount FROM tx WHERE source_account_id % 50 <> 7 GROUP BY 1""",
    ),
)
def purge_account_repaired(v: Views):
    """Accounts erased from the versions and from the aggregates, which do not carry the account."""
    layout = ingest.Layout(workspace(v.spark, "purged"))
    rows = stored(bulk.to_raw(v.tx), "versions")
    _batches(v, layout, rows, 0, 2, 2)
    ingest.purge(v.spark, layout, F.col("source_account_id") % 50 == 7)
    left = versions.final(ingest.read_raw(v.spark, layout)).groupBy("type").agg(F.count("*").alias("n_rows"))
    daily = states.merge_states(ingest.read_daily(v.spark, layout), "type").select(
        "type", F.col("tx_count").alias("daily_rows"), F.col("total_amount").alias("daily_amount")
    )
    funnel = states.merge_states(ingest.read_funnel(v.spark, layout), "type").select("type", F.col("cnt").alias("funnel_rows"))
    return left.join(daily, "type").join(funnel, "type")


@query(
    "purge_versions_stored",
    sql(
        "raw",
        """t AS (SELECT *, max(_version) OVER (PARTITION BY type, source_institution,
             date_trunc('hour', created_at), external_id) AS top FROM raw)
        SELECT source_institution, status, count(*) AS n_rows FROM t
        WHERE source_institution <> '003' OR _version = top GROUP BY 1, 2""",
    ),
)
def purge_versions_stored(v: Views):
    """Superseded versions of one institution leave the stored table, month by month."""
    path = workspace(v.spark, "versions")
    lake.write_batch(v.raw, path, 0)
    versions.purge_stored_versions(v.spark, path, F.col("source_institution") == "003")
    left = compaction.rows(v.spark, path, STORED_SCHEMA)
    return left.groupBy("source_institution", "status").agg(F.count("*").alias("n_rows"))


@query(
    "guarded_drop_rolled_back",
    sql(
        "tx",
        """SELECT CAST(created_at AS DATE) AS day, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total FROM tx
        WHERE CAST(created_at AS DATE) <> DATE '2024-01-03' GROUP BY 1""",
    ),
)
def guarded_drop_rolled_back(v: Views):
    """Two days are to go; the aggregate answers for one of them alone, and the other one is put back."""
    path, root = workspace(v.spark, "days"), workspace(v.spark, "cover")
    rows = v.tx.withColumn("day", F.to_date("created_at"))
    lake.replace_partitions(rows, path, "day")
    covered, lost = date(2024, 1, 3), date(2024, 1, 4)
    daily = states.daily_states(bulk.to_raw(v.tx).filter(F.to_date("created_at") != F.lit(lost)))
    lake.replace_partitions(daily.withColumn("yyyymm", month_key("day")), root, "yyyymm")
    aggregate = v.spark.read.parquet(root)

    def answers(gone):
        day = gone.agg(F.max("day")).scalar()
        return lifecycle.same_totals(gone, aggregate.filter(F.col("day") == day), "tx_count", "total_amount")

    lifecycle.verified_drop(v.spark, path, "day", [covered, lost], answers, rows.schema)
    left = v.spark.read.schema(rows.schema).parquet(path)
    return left.groupBy("day").agg(F.count("*").alias("n_rows"), F.sum("amount").alias("total"))
