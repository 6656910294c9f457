"""Poll ingestion: one watermark cycle over a mutable source table."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import interval
from paytide.operators import compaction
from paytide.session import staged
from paytide.sources import bulk, increment
from paytide.streaming import ingest
from paytide.streaming.ingest import Layout, update_states, write_raw


def state_path(layout: Layout) -> str:
    return f"{layout.root}/sync_state"


def read_target(spark: SparkSession, layout: Layout) -> DataFrame:
    """The mirror, or an empty table before the first cycle."""
    return ingest.read_raw(spark, layout)


def candidates(
    source: DataFrame,
    state: dict | None,
    full: bool,
    batch: int | None = None,
    overlap_seconds: int = 30,
    full_scan_hours: int = 24,
) -> tuple[DataFrame, Column | None, bool]:
    """Source rows one cycle looks at, ``again`` marking those below the watermark; since when those changed; and
    whether the batch is known to leave rows past the watermark.

    A normal cycle looks again at the seconds below the watermark. A full scan looks again
    at everything since one interval before the previous full scan, whatever its age.
    """
    again = lambda df, flag: df.withColumn("again", F.lit(flag))
    if state is None:
        first, more = (source, False) if batch is None else increment.first_rows(source, batch)
        return again(first, False), None, more
    wm, wm_id = state["last_updated_at"], state["last_id"]
    resumed, more = increment.read_increment(source, wm, wm_id, floor_days=None if full else 7, inclusive=False), False
    if batch is not None:
        resumed, more = increment.first_rows(resumed, batch)
    since = state["last_full_scan_at"]
    if not full:
        start = increment.overlap_start(wm, overlap_seconds)
    elif since is None:
        start = F.timestamp_seconds(F.lit(0))
    else:
        start = F.lit(since) - interval(f"{full_scan_hours} hours")
    # what the resumed scan reaches, in this cycle or a later one, is not looked at again: of a burst
    # that shares one change time each cycle takes its share
    reached = increment.after(wm, wm_id, inclusive=False)
    if not full:
        reached = reached & (F.col("created_at") >= F.lit(wm) - interval("7 days"))
    older = source.filter((F.col("updated_at") >= start) & (F.col("updated_at") <= F.lit(wm)) & ~reached)
    return again(resumed, False).unionByName(again(older, True)), start, more


def new_rows(seen: DataFrame, target: DataFrame, start: Column | None) -> DataFrame:
    """Of the stored candidates what has to be written: all above the watermark, and below it the versions the target lacks."""
    above = seen.filter(~F.col("again")).drop("again")
    if start is None:
        return above
    return increment.union_new(above, increment.lacking(seen.filter("again").drop("again"), target, start))


def cycle(
    spark: SparkSession,
    source: DataFrame,
    layout: Layout,
    now: datetime,
    batch_id: int | None = None,
    name: str = "transactions",
    batch: int | None = None,
    overlap_seconds: int = 30,
    full_scan_hours: int = 24,
    compact_every: int | None = None,
) -> dict:
    """Scan, write versions and states, then advance the watermark; in that order.

    The rows are stored once, so what is written, counted and marked is the same set
    although the source keeps changing; the copies go at the end of the cycle. If anything fails
    before the last step, the next cycle starts from the old watermark and its rewrite is harmless:
    unless ``batch_id`` is given, batches are numbered by the cycles committed so far, above what
    has been merged.

    With ``batch``, a cycle takes at most that many rows past the watermark. A full scan is
    committed as one only when it has found fewer: until then every cycle goes on with it, so
    no row falls behind the creation floor. The result tells whether the cycle was ``capped``.

    With ``compact_every`` the mirror is merged after every so many cycles, which bounds its files.
    """
    layout = layout if layout.writer != "stream" else replace(layout, writer="poll")
    marks = state_path(layout)
    state = increment.read_state(spark, marks, name)
    full = increment.full_scan_due(state and state["last_full_scan_at"], now, full_scan_hours)
    merged = compaction.last_merged(spark, layout.raw, layout.writer)
    number = batch_id if batch_id is not None else max((state["cycles"] or 0) if state else 0, merged + 1)
    if number <= merged:
        raise ValueError(f"batch {number} of {layout.writer!r} is merged already: number above {merged}")
    looked, start, capped = candidates(source, state, full, batch, overlap_seconds, full_scan_hours)
    with staged(looked, "candidates") as seen, staged(new_rows(seen, read_target(spark, layout), start), "cycle") as rows:
        if batch is not None and not capped:
            fresh = rows
            if state is not None:
                fresh = rows.filter(increment.after(state["last_updated_at"], state["last_id"], inclusive=False))
            capped = fresh.count() >= batch
        raw = bulk.to_raw(rows, F.lit(now))
        write_raw(raw, number, layout)
        update_states(raw, number, layout)
        done = increment.commit_state(
            spark, marks, name, rows, now, full=full and not capped, previous=state
        )
    if compact_every and done["cycles"] % compact_every == 0:
        ingest.compact(spark, layout)
    return done | {"capped": capped}


def drain(
    spark: SparkSession, source: DataFrame, layout: Layout, now: datetime, batch: int, **options
) -> dict:
    """Cycles until one is not full. A failed cycle raises; calling again resumes after the last."""
    while (state := cycle(spark, source, layout, now, batch=batch, **options))["capped"]:
        pass
    return state
