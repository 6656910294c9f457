"""Anchors, cut-offs, buckets and time differences."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Instant = datetime | Column


def interval(text: str) -> Column:
    """``interval("48 hours")``: a Spark interval literal."""
    return F.expr(f"INTERVAL {text}")


def instant(value: Instant) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def as_of(df: DataFrame, at: str = "created_at") -> Column:
    """The newest instant in the data, as a scalar subquery; the wall clock if there is none.

    Staying a subquery keeps the job lazy, and the scan still receives the resolved
    literal as a pushed filter.
    """
    newest = df.agg(F.max(at).alias("newest"))
    return newest.select(F.coalesce(F.col("newest"), F.current_timestamp())).scalar()


def last(at: Column | str, window: str, anchor: Instant) -> Column:
    """Trailing-window predicate on the raw column, so that pruning applies."""
    return F.col(at) >= instant(anchor) - interval(window) if isinstance(at, str) else (
        at >= instant(anchor) - interval(window)
    )


def aligned_cut(anchor: Instant, window: str, unit: str) -> Column:
    """Cut-off moved back to the start of its bucket, so no bucket is read in part."""
    return F.date_trunc(unit, instant(anchor) - interval(window))


def micros_between(later: Column | str, earlier: Column | str) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed seconds as an exact decimal, null when either side is."""
    micros = micros_between(later, earlier).cast("decimal(16,0)")
    return (micros * F.lit(Decimal("0.000001"))).cast("decimal(16,6)")


def boundary_seconds(later: Column | str, earlier: Column | str) -> Column:
    """Whole-second boundaries crossed, which is not the elapsed time rounded."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def boundary_minutes(later: Column | str, earlier: Column | str) -> Column:
    return F.floor(F.unix_seconds(later) / 60) - F.floor(F.unix_seconds(earlier) / 60)


def tumbling(at: Column | str, width: str) -> Column:
    """Start of the tumbling window holding ``at``; the same in batch and stream."""
    return F.window(at, width).start


def month_key(at: Column | str) -> Column:
    """Partition key yyyymm as an integer."""
    return (F.year(at) * 100 + F.month(at)).cast("int")


def slot_of(at: Column, width_seconds: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(width_seconds * 1_000_000)).cast("long")
