"""Micro-batch ingestion: change events or landed rows into versions and partial states."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paytide.functions.timing import month_key
from paytide.operators import compaction, invalidation, states, versions
from paytide.sources import lake
from paytide.sources.bulk import Slice, bulk_load
from paytide.sources.cdc import good_rows, parse_cdc, split_dlq
from paytide.sources.tables import STORED_SCHEMA


LETTERS_SCHEMA = "value STRING, reason STRING, writer STRING, batch_id BIGINT"
METRICS_SCHEMA = (
    "rows_read BIGINT, rows_written BIGINT, dead_letters BIGINT, watermark_ms BIGINT, lag_ms BIGINT, "
    "last_success TIMESTAMP, of_writer STRING, of_batch BIGINT, writer STRING, batch_id BIGINT"
)


@dataclass(frozen=True)
class Layout:
    """Folders of one analytical mirror, and the name under which this job writes to it.

    Two jobs that number their batches on their own need two names. With ``sketches`` the states
    carry quantile sketches.
    """

    root: str
    writer: str = "stream"
    sketches: bool = False

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def daily(self) -> str:
        return f"{self.root}/daily_states"

    @property
    def funnel(self) -> str:
        return f"{self.root}/funnel_states"

    @property
    def dlq(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint" + ("" if self.writer == "stream" else f"_{self.writer}")


def write_raw(batch: DataFrame, batch_id: int, layout: Layout) -> None:
    """Versioned append. A replayed batch overwrites its own files and nothing else."""
    lake.write_batch(batch, layout.raw, batch_id, writer=layout.writer)


def update_states(batch: DataFrame, batch_id: int, layout: Layout) -> None:
    """Add this batch's partial states. Every inserted version counts, as with an insert
    trigger; ``states.rebuild_states`` is the repair."""
    daily = states.daily_states(batch, layout.sketches).withColumn("yyyymm", month_key("day"))
    funnel = states.funnel_states(batch, layout.sketches).withColumn("yyyymm", month_key("hour"))
    lake.write_batch(daily, layout.daily, batch_id, writer=layout.writer)
    lake.write_batch(funnel, layout.funnel, batch_id, writer=layout.writer)


def load(
    tx: DataFrame, layout: Layout, slices: list[Slice], resume: bool = False, slices_a_job: int | None = None
) -> list[Slice]:
    """Bulk load into a live mirror: versions and states, as batches of the writer ``load``.

    A slice is recorded when all three tables have it; see ``bulk.bulk_load``.
    """
    own = replace(layout, writer="load")

    def daily(raw: DataFrame) -> DataFrame:
        return states.daily_states(raw, layout.sketches, ("batch_id",)).withColumn("yyyymm", month_key("day"))

    def funnel(raw: DataFrame) -> DataFrame:
        return states.funnel_states(raw, layout.sketches, ("batch_id",)).withColumn("yyyymm", month_key("hour"))

    return bulk_load(tx, own.raw, slices, own.writer, resume, slices_a_job, {own.daily: daily, own.funnel: funnel})


def batch_metrics(parsed: DataFrame) -> DataFrame:
    """Rows read, written and refused, the newest version, and the lag behind now."""
    return parsed.agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("_reason").isNull()).alias("rows_written"),
        F.count_if(F.col("_reason").isNotNull()).alias("dead_letters"),
        F.max(F.when(F.col("_reason").isNull(), F.col("_version"))).alias("watermark_ms"),
    ).select(
        "*",
        (F.unix_millis(F.current_timestamp()) - F.col("watermark_ms")).alias("lag_ms"),
        F.current_timestamp().alias("last_success"),
    )


def process_cdc(layout: Layout) -> Callable[[DataFrame, int], None]:
    """One batch: parse once, then versions, states, dead letters and metrics."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_cdc(batch).persist()
        try:
            good = good_rows(parsed)
            write_raw(good, batch_id, layout)
            update_states(good, batch_id, layout)
            lake.write_batch(split_dlq(parsed), layout.dlq, batch_id, None, layout.writer)
            metrics = batch_metrics(parsed).withColumns({"of_writer": F.lit(layout.writer), "of_batch": F.lit(batch_id).cast("long")})
            lake.write_batch(metrics, layout.metrics, batch_id, None, layout.writer)
        finally:
            parsed.unpersist()

    return run


def process_rows(layout: Layout) -> Callable[[DataFrame, int], None]:
    """One batch of rows already in versioned form."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_raw(batch, batch_id, layout)
        update_states(batch, batch_id, layout)

    return run


def start(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    layout: Layout,
    every: str | None = None,
) -> StreamingQuery:
    """Run a stream into the layout: all available data, or one batch per interval.

    Offsets are committed after the batch function returns, so a batch that fails is read
    again, and its rewrite is idempotent. A stream without a checkpoint counts its batches
    from 0 again, so it must not write under a name that has written before.
    """
    spark = stream.sparkSession
    known = layout.writer in lake.writers(spark, layout.raw) or compaction.last_merged(spark, layout.raw, layout.writer) >= 0
    if not lake.exists(spark, layout.checkpoint) and known:
        raise ValueError(f"no checkpoint, but writer {layout.writer!r} has batches: name another writer")
    writer = stream.writeStream.foreachBatch(process).option(
        "checkpointLocation", layout.checkpoint
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_raw(spark: SparkSession, layout: Layout) -> DataFrame:
    return compaction.rows(spark, layout.raw, STORED_SCHEMA)


def _schema(layout: Layout, schema: str) -> str:
    return schema if layout.sketches else schema.replace("amount_sketch BINARY, ", "").replace("seconds_sketch BINARY, ", "")


def read_daily(spark: SparkSession, layout: Layout) -> DataFrame:
    """Daily partial states of all batches; ``states.merge_states`` adds them up."""
    return compaction.rows(spark, layout.daily, _schema(layout, states.DAILY_SCHEMA))


def read_funnel(spark: SparkSession, layout: Layout) -> DataFrame:
    return compaction.rows(spark, layout.funnel, _schema(layout, states.FUNNEL_SCHEMA))


def read_letters(spark: SparkSession, layout: Layout) -> DataFrame:
    return compaction.rows(spark, layout.dlq, LETTERS_SCHEMA, None)


def read_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per batch and writer; both names stay in the rows when batches are merged."""
    return compaction.rows(spark, layout.metrics, METRICS_SCHEMA, None)


def compact(spark: SparkSession, layout: Layout, leave: int = 0) -> dict[str, int]:
    """Merge the batches of every table of the mirror; returns how many of each were replaced.

    Versions come down to one per key, states to one row per key, sketches included; dead letters
    and metrics are only brought together. Streams, polls and loads may append meanwhile.
    """
    def merge(path: str, schema: str, how: Callable[[DataFrame], DataFrame], by: str | None = "yyyymm") -> int:
        return compaction.compact(spark, path, schema, how, by, leave=leave)

    return {
        "raw": versions.compact(spark, layout.raw, leave=leave),
        "daily": merge(layout.daily, _schema(layout, states.DAILY_SCHEMA), states.merge_stored(states.DAILY_KEYS)),
        "funnel": merge(layout.funnel, _schema(layout, states.FUNNEL_SCHEMA), states.merge_stored(states.FUNNEL_KEYS)),
        "dlq": merge(layout.dlq, LETTERS_SCHEMA, lambda df: df.coalesce(1), None),
        "metrics": merge(layout.metrics, METRICS_SCHEMA, lambda df: df.coalesce(1), None),
    }


def purge(spark: SparkSession, layout: Layout, gone: Column) -> list[int]:
    """Erase the rows ``gone`` marks from the mirror, and repair the states they were counted in.

    States do not carry an account, so they cannot be filtered: the buckets the rows lay in are
    logged first, then the rows leave the versioned table, and exactly these buckets are built
    anew from what is left, resolved. Each table changes in one commit. A purge that died is
    finished by ``repair`` or by the next one. Returns the months rewritten.
    """
    hit = F.coalesce(gone, F.lit(False))
    log = f"{layout.root}/touched_buckets"
    number = 1 + max([b for _, w, b in lake.batches(spark, log) if w == "purge"], default=-1)
    invalidation.log_touched(invalidation.touched(read_raw(spark, layout).filter(hit), "hour"), log, number, "purge")
    logged, _ = invalidation.pending(spark, log)
    if logged is None:
        return []
    months = sorted(r.yyyymm for r in logged.select("yyyymm").distinct().collect())
    compaction.compact(spark, layout.raw, STORED_SCHEMA, lambda df: versions.final(df.filter(~hit)), parts=months, again=True)
    return repair(spark, layout)


def repair(spark: SparkSession, layout: Layout) -> list[int]:
    """Build the states of all logged buckets anew from the resolved rows; returns the months rewritten."""
    log = f"{layout.root}/touched_buckets"
    logged, taken = invalidation.pending(spark, log)
    if logged is None:
        return []
    months = sorted(r.yyyymm for r in logged.select("yyyymm").distinct().collect())
    kinds = (
        (layout.daily, states.DAILY_SCHEMA, states.DAILY_KEYS, states.daily_states, "day"),
        (layout.funnel, states.FUNNEL_SCHEMA, states.FUNNEL_KEYS, states.funnel_states, "hour"),
    )
    for path, schema, keys, build, unit in kinds:
        found = invalidation.spans(logged, unit)
        left = read_raw(spark, layout).filter(F.col("yyyymm").isin(months) & invalidation.inside(F.col("created_at"), found))
        fresh = build(versions.final(left), layout.sketches).withColumn("yyyymm", month_key(unit))

        def merge(stored: DataFrame, fresh=fresh, keys=keys, unit=unit, found=found) -> DataFrame:
            kept = stored.filter(~invalidation.inside(F.col(unit).cast("timestamp"), found))
            return states.merge_stored(keys)(kept.unionByName(fresh.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields])))

        compaction.compact(spark, path, _schema(layout, schema), merge, parts=months, again=True)
    lake.drop_batches(spark, log, taken)
    return months


def compacting(process: Callable[[DataFrame, int], None], layout: Layout, every: int) -> Callable[[DataFrame, int], None]:
    """``process``, followed by a merge of the mirror after each ``every`` batches.

    A stream that runs for months then keeps at most ``every`` batches of its own unmerged.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        if batch_id % every == every - 1:
            compact(batch.sparkSession, layout)

    return run


def hourly_counts(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Tumbling hourly counts of a stream of rows, closed by a watermark."""
    return (
        stream.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 hour").alias("w"), "type")
        .agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"))
        .select(F.col("w.start").alias("bucket"), "type", "tx_count", "total_amount")
    )
