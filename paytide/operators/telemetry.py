"""Metric samples: counter increases, histogram quantiles and alert rules.

A sample is ``(ts, metric, labels MAP<STRING,STRING>, value)``. Evaluation happens on a
grid of instants; a series has a value at an instant if it was sampled within the lookback.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.operators.windows import with_previous


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL over metric names and ``now`` (epoch seconds of the instant)."""

    name: str
    condition: str
    hold_seconds: int
    metrics: tuple[str, ...]
    labels: dict[str, str] = field(default_factory=dict)


# fixed values: thresholds, durations and severities of the monitored platform
RULES = (
    Rule(
        "PipelineStalled",
        "now - sync_last_success_timestamp > 300 AND sync_lag_seconds > 60",
        60,
        ("sync_last_success_timestamp", "sync_lag_seconds"),
        {"severity": "SEV-1"},
    ),
    Rule("LagGrowing", "sync_lag_seconds > 60", 300, ("sync_lag_seconds",), {"severity": "SEV-2"}),
    Rule(
        "PipelineErrors",
        "sync_errors_increase_15m > 0",
        60,
        ("sync_errors_increase_15m",),
        {"severity": "SEV-3"},
    ),
    Rule(
        "ReferenceStale",
        "refsync_check_age_seconds > 900",
        300,
        ("refsync_check_age_seconds",),
        {"severity": "SEV-3"},
    ),
    Rule(
        "StorageHigh",
        "(1 - node_filesystem_avail_bytes / node_filesystem_size_bytes) * 100 > 85",
        600,
        ("node_filesystem_avail_bytes", "node_filesystem_size_bytes"),
        {"severity": "SEV-2"},
    ),
    Rule("TargetDown", "up = 0", 300, ("up",), {"severity": "SEV-2"}),
)


def series_key(labels: str = "labels") -> Column:
    """Labels as one comparable text, independent of map order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def _step_at_or_after(at: Column, step: int) -> Column:
    return (F.ceil(F.unix_micros(at) / F.lit(step * 1_000_000)) * step).cast("long")


def on_grid(samples: DataFrame, step: int = 60, lookback: int = 300) -> DataFrame:
    """Value of each series at each instant of the grid (``now``, epoch seconds).

    Samples are first reduced to the newest per series and step, before any window, so a
    busy series costs one row per instant. Each value then holds until the next one or
    until the lookback runs out.
    """
    newest = (
        samples.withColumn("series", series_key())
        .groupBy("metric", "series", _step_at_or_after(F.col("ts"), step).alias("now"))
        .agg(F.max_by("value", "ts").alias("value"), F.max(F.unix_micros("ts")).alias("at"))
    )
    by_time = Window.partitionBy("metric", "series").orderBy("now")
    stale = (F.floor((F.col("at") / F.lit(1e6) + lookback) / step) * step).cast("long")
    until = F.least(stale, F.coalesce(F.lead("now").over(by_time) - step, stale))
    return (
        newest.withColumn("until", until)
        .filter("until >= now")
        .select(
            "metric", "series", F.explode(F.sequence("now", "until", F.lit(step))).alias("now"), "value"
        )
    )


def counter_increase(samples: DataFrame, seconds: int, step: int = 60) -> DataFrame:
    """Growth of each counter over the trailing range, at each instant of the grid.

    The sum of steps between samples inside ``[now - seconds, now]``; a drop means the
    counter restarted and counts as its new value. Nothing is extrapolated to the edges.
    """
    keyed = samples.withColumn("series", series_key())
    paired = with_previous(
        keyed, ("metric", "series"), "ts", ("value",), seconds, {"prev": "value", "prev_ts": "ts"}
    ).filter("prev_ts IS NOT NULL")
    grown = F.when(F.col("value") >= F.col("prev"), F.col("value") - F.col("prev")).otherwise(
        F.col("value")
    )
    first = _step_at_or_after(F.col("ts"), step)
    until = (F.floor((F.unix_micros("prev_ts") / F.lit(1e6) + seconds) / step) * step).cast("long")
    steps = paired.select("metric", "series", grown.alias("g"), first.alias("f"), until.alias("u"))
    return (
        steps.filter("u >= f")
        .select("metric", "series", F.explode(F.sequence("f", "u", F.lit(step))).alias("now"), "g")
        .groupBy("metric", "series", "now")
        .agg(F.sum("g").alias("increase"))
    )


def rate(increase: DataFrame, seconds: int) -> DataFrame:
    return increase.withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def evaluate(grid: DataFrame, rule: Rule, step: int = 60) -> DataFrame:
    """Instants at which the rule's condition holds, with the time it has held without a gap.

    Metrics are matched by equal labels. ``firing`` is true once the condition has held
    for the rule's duration; an instant with no value breaks the run.
    """
    values = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in rule.metrics]
    matched = (
        grid.filter(F.col("metric").isin(*rule.metrics))
        .groupBy("series", "now")
        .agg(*values)
        .filter(F.expr(rule.condition))
    )
    by_time = Window.partitionBy("series").orderBy("now")
    run = F.col("now") - F.row_number().over(by_time) * step
    return (
        matched.withColumn("run", run)
        .withColumn("since", F.min("now").over(Window.partitionBy("series", "run")))
        .select(
            F.lit(rule.name).alias("alert"),
            "series",
            "now",
            (F.col("now") - F.col("since")).alias("held_seconds"),
            (F.col("now") - F.col("since") >= rule.hold_seconds).alias("firing"),
        )
    )


def evaluate_alerts(samples: DataFrame, rules: tuple[Rule, ...], at: Column, step: int = 60) -> DataFrame:
    """Alerts firing at one instant. Only samples that can matter to it are read."""
    reach = max(r.hold_seconds for r in rules) + 300
    near = samples.filter(
        (F.unix_seconds("ts") >= F.unix_seconds(at) - reach - step) & (F.col("ts") <= at)
    )
    grid = on_grid(near, step)
    out = None
    for rule in rules:
        fired = evaluate(grid, rule, step).filter(
            (F.col("now") == F.unix_seconds(at)) & F.col("firing")
        )
        severity = F.lit(rule.labels.get("severity"))
        fired = fired.select("alert", severity.alias("severity"), "series", "held_seconds")
        out = fired if out is None else out.unionByName(fired)
    return out


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets ``(le, cumulative)``; ``le`` ends with infinity.

    Linear inside the bucket that holds the rank. The first bucket starts at zero, and a
    rank in the last one answers its lower bound.
    """
    by_le = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    placed = (
        buckets.withColumn("below", F.coalesce(F.lag("cumulative").over(by_le), F.lit(0)))
        .withColumn("lower", F.coalesce(F.lag("le").over(by_le), F.lit(0.0)))
        .withColumn("rank", F.lit(q) * F.max("cumulative").over(whole))
    )
    holds = (F.col("cumulative") >= F.col("rank")) & (F.col("cumulative") > 0)
    hit = placed.filter(holds).groupBy(*keys).agg(
        F.min_by(F.struct("le", "lower", "below", "cumulative", "rank"), "le").alias("b")
    )
    within = F.col("b.lower") + (F.col("b.le") - F.col("b.lower")) * (
        (F.col("b.rank") - F.col("b.below")) / (F.col("b.cumulative") - F.col("b.below"))
    )
    infinite = F.col("b.le") == F.lit(float("inf"))
    return hit.select(
        *keys, F.when(infinite, F.col("b.lower")).otherwise(within).alias("quantile")
    )


def cumulative_buckets(df: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative bucket counts of a value column, one pass, one row per key and bound."""
    les = [*bounds, float("inf")]
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= F.lit(le)).alias(f"b{i}") for i, le in enumerate(les)]
    )
    entry = [
        F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("cumulative"))
        for i, le in enumerate(les)
    ]
    return counted.select(*keys, F.inline(F.array(*entry)))


def clamped_ratio(top: Column, bottom: Column, floor: float = 0.001) -> Column:
    return top / F.greatest(bottom.cast("double"), F.lit(floor))
