"""Registered queries: alert rules and metric functions over samples derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from paytide.operators import telemetry
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import Views

HOUR = 3600
GRID = """smp AS (SELECT source_institution AS s, epoch_us(created_at) AS us,
    coalesce(settlement_seconds, 0) AS lag, floor(epoch(created_at)) - k * 20 AS ok FROM tx),
g AS (SELECT unnest(generate_series(0, 721)) * 3600 + 1704067200 AS now),
v AS (SELECT s, now, arg_max(lag, us) AS lag, arg_max(ok, us) AS ok FROM smp JOIN g
      ON us <= now * 1000000 AND us >= (now - 7200) * 1000000 GROUP BY 1, 2),
hit AS (SELECT s, now FROM v WHERE {condition}),
runs AS (SELECT *, now - 3600 * row_number() OVER (PARTITION BY s ORDER BY now) AS run FROM hit),
held AS (SELECT s, now, now - min(now) OVER (PARTITION BY s, run) AS held FROM runs)
SELECT '{name}' AS alert, '{{"source":"' || s || '"}}' AS series, now, held AS held_seconds, held >= {hold} AS firing
FROM held"""


def _evaluated(v: Views, name: str):
    rule = next(r for r in telemetry.RULES if r.name == name)
    grid = telemetry.on_grid(v.lag_samples, HOUR, 2 * HOUR)
    return telemetry.evaluate(grid, rule, HOUR)


@query(
    "alerts_stalled",
    sql(
        "tx",
        GRID.format(condition="now - ok > 300 AND lag > 60", name="PipelineStalled", hold=60),
    ),
)
def alerts_stalled(v: Views):
    """Both conditions at once, at every hour of the data, per institution."""
    return _evaluated(v, "PipelineStalled")


@query(
    "alerts_lag_for",
    sql("tx", GRID.format(condition="lag > 60", name="LagGrowing", hold=300)),
)
def alerts_lag_for(v: Views):
    return _evaluated(v, "LagGrowing")


@query(
    "counter_increase",
    sql(
        "tx",
        """h AS (SELECT date_trunc('hour', created_at) AS ts, type, count(*) FILTER (WHERE k < 50) AS n FROM tx GROUP BY 1, 2),
        c AS (SELECT type, epoch_us(ts) // 1000000 AS t,
            sum(n) OVER (PARTITION BY type, CAST(ts AS DATE) ORDER BY ts) AS value FROM h),
        g AS (SELECT DISTINCT c.t + o * 3600 AS now FROM c, (SELECT unnest(generate_series(0, 6)) AS o)),
        w AS (SELECT c.type, g.now, c.t, value, lag(value) OVER (PARTITION BY c.type, g.now ORDER BY c.t) AS prev
              FROM c JOIN g ON c.t <= g.now AND c.t >= g.now - 21600)
        SELECT 'sync_errors_total' AS metric, '{"type":"' || type || '"}' AS series, now,
          CAST(sum(CASE WHEN value >= prev THEN value - prev ELSE value END) AS DOUBLE) AS increase
        FROM w WHERE prev IS NOT NULL GROUP BY 1, 2, 3""",
    ),
)
def counter_increase(v: Views):
    """Errors over the trailing six hours of a counter that restarts at midnight."""
    return telemetry.counter_increase(v.counter_samples, 6 * HOUR, HOUR)


BOUNDS = [1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0]


@query(
    "histogram_quantile",
    sql(
        "tx",
        """les AS (SELECT unnest([1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 'infinity'::DOUBLE]) AS le),
        b AS (SELECT type, CAST(created_at AS DATE) AS day, le,
            count(*) FILTER (WHERE settlement_seconds <= le) AS cum
          FROM tx, les WHERE settlement_seconds IS NOT NULL GROUP BY 1, 2, 3),
        p AS (SELECT *, coalesce(lag(cum) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS lower,
            0.95::DOUBLE * max(cum) OVER (PARTITION BY type, day) AS rnk
          FROM b WINDOW w AS (PARTITION BY type, day ORDER BY le))
        SELECT type, day, CASE WHEN le = 'infinity'::DOUBLE THEN lower
            ELSE lower + (le - lower) * ((rnk - below) / (cum - below)) END AS quantile
        FROM p WHERE cum >= rnk AND cum > 0 QUALIFY row_number() OVER (PARTITION BY type, day ORDER BY le) = 1""",
    ),
)
def histogram_quantile(v: Views):
    """P95 of settlement time per type and day from cumulative buckets."""
    rows = v.tx.select(
        "type",
        F.to_date("created_at").alias("day"),
        ((F.unix_millis("settled_at") - F.unix_millis("created_at")) / F.lit(1000.0)).alias("s"),
    )
    buckets = telemetry.cumulative_buckets(rows, ["type", "day"], "s", BOUNDS)
    return telemetry.histogram_quantile(buckets, ["type", "day"], 0.95)


@query(
    "ratio_clamped",
    sql(
        "tx",
        """SELECT date_trunc('hour', created_at) AS hour, type,
          count(*) FILTER (WHERE status = 'failed')
            / greatest(count(*) FILTER (WHERE status IN ('failed', 'pending'))::DOUBLE, 0.001::DOUBLE) AS ratio
        FROM tx GROUP BY 1, 2""",
    ),
)
def ratio_clamped(v: Views):
    """A ratio whose denominator is often zero and is clamped instead of dividing by it."""
    counts = v.tx.groupBy(F.date_trunc("hour", "created_at").alias("hour"), "type").agg(
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status").isin("failed", "pending")).alias("unsettled"),
    )
    ratio = telemetry.clamped_ratio(F.col("failed"), F.col("unsettled"))
    return counts.select("hour", "type", ratio.alias("ratio"))
