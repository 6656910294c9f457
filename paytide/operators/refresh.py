"""Keeping time-bucketed aggregates current: window refresh, coverage and gap filling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, interval, micros_between


def whole_buckets(start: Instant, end: Instant, unit: str) -> tuple[Column, Column]:
    """The largest range of whole buckets inside ``[start, end)``."""
    floor = F.date_trunc(unit, instant(start))
    first = F.when(floor == instant(start), floor).otherwise(floor + interval(f"1 {unit}"))
    return first, F.date_trunc(unit, instant(end))


def refresh(
    aggregate: DataFrame,
    source: DataFrame,
    start: Instant,
    end: Instant,
    unit: str,
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The aggregate with the whole buckets of ``[start, end)`` recomputed from source.

    Source rows are cut to the refreshed span on the raw column. Buckets outside stay as
    they are, and the open bucket is never touched as long as ``end`` lags behind now.
    """
    first, until = whole_buckets(start, end, unit)
    outside = (F.col("bucket") < first) | (F.col("bucket") >= until)
    span = (F.col("created_at") >= first) & (F.col("created_at") < until)
    return aggregate.filter(outside).unionByName(build(source.filter(span)))


def refreshed_buckets(
    source: DataFrame, start: Instant, end: Instant, unit: str, build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Only the recomputed buckets, for a dynamic partition overwrite of a stored aggregate."""
    first, until = whole_buckets(start, end, unit)
    return build(source.filter((F.col("created_at") >= first) & (F.col("created_at") < until)))


def materialized_until(aggregate: DataFrame, unit: str) -> Column:
    """End of the newest bucket an aggregate holds, as a scalar subquery."""
    return aggregate.agg(F.max("bucket") + interval(f"1 {unit}")).scalar()


def lag_hours(aggregates: dict[str, tuple[DataFrame, str]], now: Instant) -> DataFrame:
    """Materialised-until and the lag behind now, in hours, one row per aggregate."""
    rows = [
        df.agg((F.max("bucket") + interval(f"1 {unit}")).alias("materialized_until")).select(
            F.lit(name).alias("aggregate_name"),
            "materialized_until",
            (micros_between(instant(now), F.col("materialized_until")) / F.lit(3.6e9)).alias(
                "lag_hours"
            ),
        )
        for name, (df, unit) in aggregates.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def gapfill(
    aggregated: DataFrame,
    start: Instant,
    end: Instant,
    step: str,
    keys: list[str],
    zero: tuple[str, ...] = (),
    locf: tuple[str, ...] = (),
    interp: tuple[str, ...] = (),
) -> DataFrame:
    """Every bucket from the one holding ``start`` to the last before ``end``, for each key.

    Counts become zero, ``locf`` columns repeat the last known value, ``interp`` columns
    are joined by straight lines. Nothing is carried before a key's first value, and a
    line needs a value on both sides. The input has at most one row per key and bucket, so
    each window is as long as the range has buckets.
    """
    first = F.date_trunc(step, instant(start))
    final = F.date_trunc(step, instant(end) - interval("1 microsecond"))
    grid = F.sequence(first, final, interval(f"1 {step}"))
    spine = aggregated.select(*keys).distinct().withColumn("bucket", F.explode(grid))
    filled = spine.join(aggregated, [*keys, "bucket"], "left")
    by_time = Window.partitionBy(*keys).orderBy("bucket")
    back = by_time.rowsBetween(Window.unboundedPreceding, 0)
    ahead = by_time.rowsBetween(0, Window.unboundedFollowing)
    out = [F.col(k) for k in keys] + [F.col("bucket")]
    out += [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero]
    out += [F.last(c, ignorenulls=True).over(back).alias(f"{c}_locf") for c in locf]
    for c in interp:
        known = F.when(F.col(c).isNotNull(), F.unix_seconds("bucket"))
        x0, y0 = (F.last(v, ignorenulls=True).over(back) for v in (known, F.col(c)))
        x1, y1 = (F.first(v, ignorenulls=True).over(ahead) for v in (known, F.col(c)))
        x = F.unix_seconds("bucket")
        line = y0 + (y1 - y0) * ((x - x0) / (x1 - x0).cast("double"))
        out.append(F.when(F.col(c).isNotNull(), F.col(c)).when(x1 > x0, line).alias(f"{c}_interp"))
    return filled.select(*out)
