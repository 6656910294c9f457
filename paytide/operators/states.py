"""Mergeable partial aggregates: build, merge, read, backfill and rebuild.

A state is a plain row of parts that add up: counts, exact sums, a (sum, non-null count)
pair for each mean, and a KLL sketch for quantiles. The parts of two disjoint inputs are
merged by adding them, so states can be written per batch and combined on read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, last
from paytide.operators import versions
from paytide.operators.joins import lookup

DAILY_KEYS = ("day", "source_institution", "type")
FUNNEL_KEYS = ("hour", "type", "source_institution", "status")
PAIR_KEYS = ("hour", "source_institution", "destination_institution")
SKETCHES = ("amount_sketch", "seconds_sketch")


def _settle_parts() -> list[Column]:
    seconds = F.col("settlement_seconds").cast("decimal(16,3)")
    return [
        F.sum(seconds).alias("seconds_sum"),
        F.count("settlement_seconds").alias("seconds_n"),
    ]


# States as they lie in a table, under the batch of the job that wrote them.
DAILY_SCHEMA = (
    "day DATE, source_institution STRING, type STRING, tx_count BIGINT, total_amount DECIMAL(28,2), "
    "amount_n BIGINT, settled_count BIGINT, failed_count BIGINT, seconds_sum DECIMAL(26,3), "
    "seconds_n BIGINT, amount_sketch BINARY, yyyymm INT, writer STRING, batch_id BIGINT"
)
FUNNEL_SCHEMA = (
    "hour TIMESTAMP, type STRING, source_institution STRING, status STRING, cnt BIGINT, "
    "seconds_sum DECIMAL(26,3), seconds_n BIGINT, seconds_sketch BINARY, yyyymm INT, writer STRING, "
    "batch_id BIGINT"
)


def daily_states(raw: DataFrame, sketch: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Per day, institution and type (and ``by``). One sketch serves every amount quantile."""
    extra = [F.kll_sketch_agg_double(F.col("amount").cast("double")).alias("amount_sketch")]
    return raw.groupBy(
        F.to_date("created_at").alias("day"), "source_institution", "type", *by
    ).agg(
        F.count("*").alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        F.count("amount").alias("amount_n"),
        F.count_if(F.col("status") == "settled").alias("settled_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        *_settle_parts(),
        *(extra if sketch else []),
    )


def funnel_states(raw: DataFrame, sketch: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Per hour, type, institution and status (and ``by``): the state of rows now, not their transitions."""
    extra = [F.kll_sketch_agg_double("settlement_seconds").alias("seconds_sketch")]
    return raw.groupBy(
        F.date_trunc("hour", "created_at").alias("hour"), "type", "source_institution", "status", *by
    ).agg(F.count("*").alias("cnt"), *_settle_parts(), *(extra if sketch else []))


def pair_states(raw: DataFrame) -> DataFrame:
    """Per hour and origin → destination pair."""
    return raw.groupBy(
        F.date_trunc("hour", "created_at").alias("hour"),
        "source_institution",
        "destination_institution",
    ).agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"))


def merge_states(states: DataFrame, *keys: str | Column) -> DataFrame:
    """Merge to any coarser key: parts add, sketches merge."""
    known = {
        "tx_count", "total_amount", "amount_n", "settled_count", "failed_count",
        "seconds_sum", "seconds_n", "cnt",
    }
    parts = [F.sum(c).alias(c) for c in states.columns if c in known]
    sketches = [F.kll_merge_agg_double(c).alias(c) for c in states.columns if c in SKETCHES]
    return states.groupBy(*keys).agg(*parts, *sketches)


def merge_stored(keys: tuple[str, ...]) -> Callable[[DataFrame], DataFrame]:
    """Merge stored states of one kind to one row per key, in the types they are stored in."""

    def merge(stored: DataFrame) -> DataFrame:
        merged = merge_states(stored, *keys, "yyyymm")
        return merged.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields])

    return merge


def mean(total: str, n: str) -> Column:
    """Mean of merged parts; null when nothing was counted."""
    return F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0))


def quantile(sketch: str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def daily_report(states: DataFrame) -> DataFrame:
    """Finalised daily states (without sketches)."""
    return merge_states(states, *DAILY_KEYS).select(
        *DAILY_KEYS,
        "tx_count",
        "total_amount",
        mean("total_amount", "amount_n").alias("avg_amount"),
        "settled_count",
        "failed_count",
        mean("seconds_sum", "seconds_n").alias("avg_settle_seconds"),
    )


def funnel_report(states: DataFrame) -> DataFrame:
    return merge_states(states, *FUNNEL_KEYS).select(
        *FUNNEL_KEYS, "cnt", mean("seconds_sum", "seconds_n").alias("avg_seconds")
    )


def daily_volume(states: DataFrame, anchor: Instant, days: int, type_: str) -> DataFrame:
    """Daily volume per institution for one type, from merged states."""
    since = F.to_date(anchor if isinstance(anchor, Column) else F.lit(anchor)) - F.lit(days)
    chosen = states.filter((F.col("day") >= since) & (F.col("type") == type_))
    return merge_states(chosen, "day", "source_institution").select(
        "day", "source_institution", "tx_count", "total_amount", "settled_count"
    )


def named_volume(
    states: DataFrame, dim: DataFrame, anchor: Instant, days: int, short: bool = False
) -> DataFrame:
    """Volume per institution with its name, or a marker that names the unknown code."""
    since = F.to_date(anchor if isinstance(anchor, Column) else F.lit(anchor)) - F.lit(days)
    merged = merge_states(states.filter(F.col("day") >= since), "source_institution")
    marker = F.concat(F.lit("(unknown "), F.col("source_institution"), F.lit(")"))
    attribute = "short_name" if short else "name"
    return lookup(merged, dim, "source_institution", attribute, marker).select(
        F.col("source_institution").alias("code"),
        F.col(f"source_institution_{attribute}").alias("institution"),
        "tx_count",
        "total_amount",
    )


def success_rate_vs_previous_day(
    funnel: DataFrame, dim: DataFrame, anchor: Instant, type_: str | None = None
) -> DataFrame:
    """Success rate by hour of day over the last 24 h against the 24 h before, in points.

    One pass over 48 h of states: both periods are conditional sums of a single
    aggregation, so nothing is pivoted or joined back. The bucket that holds
    ``anchor - 24 h`` starts before it and counts as the previous day. A period with no
    traffic has a null rate, and the difference is then null.
    """
    recent = funnel.filter(last("hour", "48 hours", anchor))
    keys = [F.hour("hour").alias("hour_of_day"), F.col("source_institution")]
    if type_ is None:
        keys.append(F.col("type"))
    else:
        recent = recent.filter(F.col("type") == type_)
    today = last("hour", "24 hours", anchor)
    settled = F.col("status") == "settled"

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("cnt")).otherwise(0))

    sums = recent.groupBy(*keys).agg(
        total(today & settled).alias("ts"),
        total(today).alias("tt"),
        total(~today & settled).alias("ps"),
        total(~today).alias("pt"),
    )
    rate_today = F.col("ts") / F.nullif("tt", F.lit(0))
    rate_before = F.col("ps") / F.nullif("pt", F.lit(0))
    named = lookup(sums, dim, "source_institution", "name", F.col("source_institution"))
    return named.select(
        "hour_of_day",
        *([] if type_ is not None else ["type"]),
        F.col("source_institution_name").alias("institution"),
        F.round(F.lit(100) * rate_today, 2).alias("rate_today"),
        F.round(F.lit(100) * rate_before, 2).alias("rate_previous"),
        F.round(F.lit(100) * (rate_today - rate_before), 2).alias("delta_points"),
    )


def institution_health(
    funnel: DataFrame,
    dim: DataFrame,
    anchor: Instant,
    hours: int = 1,
    code: str | None = None,
    unknown: str = "unknown",
) -> DataFrame:
    """Routing health over the last hours; an institution without traffic has no row,
    because "unknown" and "healthy with nothing to do" call for opposite decisions."""
    recent = funnel.filter(last("hour", f"{hours} hours", anchor))
    if code is not None:
        recent = recent.filter(F.col("source_institution") == code)
    sketched = "seconds_sketch" in funnel.columns
    merged = recent.groupBy("source_institution").agg(
        F.sum("cnt").alias("total"),
        F.sum(F.when(F.col("status") == "settled", F.col("cnt")).otherwise(0)).alias("settled"),
        F.sum(F.when(F.col("status") == "failed", F.col("cnt")).otherwise(0)).alias("failed"),
        F.sum("seconds_sum").alias("seconds_sum"),
        F.sum("seconds_n").alias("seconds_n"),
        *([F.kll_merge_agg_double("seconds_sketch").alias("seconds_sketch")] if sketched else []),
    )
    p95 = F.when(F.col("seconds_n") > 0, F.round(quantile("seconds_sketch", 0.95), 3))
    return (
        lookup(merged, dim, "source_institution", "name", F.lit(unknown))
        .filter("total > 0")
        .select(
            F.col("source_institution").alias("institution"),
            F.col("source_institution_name").alias("institution_name"),
            "total",
            "settled",
            "failed",
            F.round(F.col("settled") / F.col("total"), 4).alias("success_rate"),
            F.round(F.col("failed") / F.col("total"), 4).alias("failure_rate"),
            F.round(mean("seconds_sum", "seconds_n"), 3).alias("avg_settlement_seconds"),
            *([p95.alias("p95_settlement_seconds")] if sketched else []),
        )
    )


def backfill_states(raw: DataFrame, cut: Instant, build=pair_states) -> DataFrame:
    """States of everything created before the cut; the live writer owns the rest."""
    before = F.col("created_at") < (cut if isinstance(cut, Column) else F.lit(cut))
    return build(raw.filter(before))


def rebuild_states(raw: DataFrame, build=daily_states) -> DataFrame:
    """States from resolved versions: the repair for states that counted every version."""
    return build(versions.final(raw))
