"""Registered queries: aggregations, partial states and their merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from paytide.functions.timing import aligned_cut, last, month_key, tumbling
from paytide.operators import aggregates as agg
from paytide.operators import joins, states, versions
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import Views


@query(
    "q1_volume_raw",
    sql(
        "tx anchor",
        """SELECT date_trunc('month', created_at) AS month, type, status, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount
        FROM tx, anchor WHERE created_at >= as_of - INTERVAL 6 MONTH GROUP BY 1, 2, 3""",
    ),
)
def q1_volume_raw(v: Views):
    return agg.volume_by_type_status(v.tx, v.ago("6 months"))


@query(
    "q1_volume_raw_20d",
    sql(
        "tx anchor",
        """SELECT date_trunc('month', created_at) AS month, type, status, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount
        FROM tx, anchor WHERE created_at >= as_of - INTERVAL 20 DAY GROUP BY 1, 2, 3""",
    ),
)
def q1_volume_raw_20d(v: Views):
    return agg.volume_by_type_status(v.tx, v.ago("20 days"))


@query(
    "q1_volume_from_hourly",
    sql(
        "hourly anchor",
        """SELECT date_trunc('month', bucket) AS month, type, status, sum(tx_count)::BIGINT AS tx_count,
          CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM hourly, anchor WHERE bucket >= date_trunc('hour', as_of - INTERVAL 20 DAY) GROUP BY 1, 2, 3""",
    ),
)
def q1_volume_from_hourly(v: Views):
    cut = aligned_cut(v.as_of, "20 days", "hour")
    rolled = agg.rollup(agg.volume_hourly(v.tx), "month", "type", "status", since=cut)
    return rolled.select("month", "type", "status", "tx_count", "total_amount")


@query(
    "cagg_volume_hourly",
    sql(
        "hourly",
        """SELECT bucket, type, status, tx_count, CAST(total_amount AS DOUBLE) AS total_amount,
          CAST(min_amount AS DOUBLE) AS min_amount, CAST(max_amount AS DOUBLE) AS max_amount,
          CAST(total_amount AS DOUBLE) / tx_count AS avg_amount FROM hourly""",
    ),
)
def cagg_volume_hourly(v: Views):
    return agg.volume_hourly(v.tx)


@query(
    "cagg_latency_daily",
    sql(
        "latency",
        """SELECT bucket, source_institution, type, settled_count, failed_count, total_count,
          CAST(ms_sum AS DOUBLE) / 1000 AS latency_sum_seconds,
          CAST(ms_sq AS DOUBLE) / 1000000 AS latency_sum_sq_seconds,
          ms_min / 1000.0::DOUBLE AS latency_min_seconds, ms_max / 1000.0::DOUBLE AS latency_max_seconds
        FROM latency""",
    ),
)
def cagg_latency_daily(v: Views):
    return agg.latency_daily(v.tx)


PERCENTILES = """SELECT date_trunc('day', created_at) AS bucket, {keys}, count(*) AS settled_count,
  round(quantile_cont(CAST(settle_ms * 1000 AS DOUBLE), 0.95) / 1e6, 6) AS p95_seconds,
  round(quantile_cont(CAST(settle_ms * 1000 AS DOUBLE), 0.99) / 1e6, 6) AS p99_seconds
FROM tx WHERE settled_at IS NOT NULL GROUP BY ALL"""


@query("latency_percentiles", sql("tx", PERCENTILES.format(keys="source_institution, type")))
def latency_percentiles(v: Views):
    return agg.latency_percentiles(v.tx)


@query("latency_percentiles_all_types", sql("tx", PERCENTILES.format(keys="source_institution")))
def latency_percentiles_all_types(v: Views):
    return agg.latency_percentiles_all_types(v.tx)


@query(
    "q3_top_institutions",
    sql(
        "tx anchor",
        """SELECT source_institution, count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS volume,
          CAST(sum(settle_ms) AS DOUBLE) / 1000 / count(settle_ms) AS mean_seconds,
          count(*) FILTER (WHERE status = 'failed')::DOUBLE / count(*) AS failure_rate
        FROM tx, anchor WHERE created_at >= as_of - INTERVAL 90 DAY
        GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 20""",
    ),
)
def q3_top_institutions(v: Views):
    return agg.top_institutions(v.tx, v.as_of, "90 days")


@query(
    "q3_top_5_institutions_20d",
    sql(
        "tx anchor",
        """SELECT source_institution, count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS volume,
          CAST(sum(settle_ms) AS DOUBLE) / 1000 / count(settle_ms) AS mean_seconds,
          count(*) FILTER (WHERE status = 'failed')::DOUBLE / count(*) AS failure_rate
        FROM tx, anchor WHERE created_at >= as_of - INTERVAL 20 DAY
        GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 5""",
    ),
)
def q3_top_5_institutions_20d(v: Views):
    return agg.top_institutions(v.tx, v.as_of, "20 days", 5)


@query(
    "q3_top_from_daily",
    sql(
        "latency anchor",
        """SELECT source_institution, sum(settled_count)::BIGINT AS settled,
          CAST(sum(ms_sum) AS DOUBLE) / 1000 / sum(settled_count) AS mean_seconds,
          max(ms_max) / 1000.0::DOUBLE AS worst_seconds
        FROM latency, anchor WHERE bucket >= date_trunc('day', as_of - INTERVAL 20 DAY)
        GROUP BY 1 ORDER BY settled DESC, 1 LIMIT 20""",
    ),
)
def q3_top_from_daily(v: Views):
    return agg.top_institutions_from_daily(agg.latency_daily(v.tx), v.as_of, "20 days")


@query(
    "latency_stddev_from_partials",
    sql(
        "tx",
        """SELECT type, count(*) AS n, round(avg(settle_ms / 1000.0::DOUBLE), 6) AS mean,
          round(stddev_pop(settle_ms / 1000.0::DOUBLE), 6) AS stddev
        FROM tx WHERE settled_at IS NOT NULL GROUP BY 1""",
    ),
)
def latency_stddev_from_partials(v: Views):
    """The deviation rebuilt from daily sums against the one taken over the rows."""
    return agg.stddev_from_partials(agg.latency_daily(v.tx), "type").select(
        "type", "n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev")
    )


@query(
    "type_share",
    "SELECT event_type AS type, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct"
    " FROM events GROUP BY 1",
)
def type_share(v: Views):
    return agg.share_of(v.tx, "type")


@query(
    "status_share",
    sql(
        "tx",
        """SELECT status, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct
        FROM tx GROUP BY 1""",
    ),
)
def status_share(v: Views):
    return agg.share_of(v.tx, "status")


@query(
    "total_vs_unique",
    sql(
        "raw",
        "SELECT type, count(*) AS total, count(DISTINCT external_id) AS distinct_ids FROM raw GROUP BY 1",
    ),
)
def total_vs_unique(v: Views):
    return agg.total_vs_unique(v.raw, "type")


@query(
    "partition_checksum",
    sql(
        "tx",
        """SELECT CAST(strftime(created_at, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n_rows,
          CAST(sum(id) AS DOUBLE) AS key_sum FROM tx GROUP BY 1""",
    ),
)
def partition_checksum(v: Views):
    return agg.partition_checksum(v.tx, month_key("created_at"), "yyyymm", "id").drop("hash_sum")


@query("partition_hash_checksum")
def partition_hash_checksum(v: Views):
    day = F.to_date("created_at")
    return agg.partition_checksum(v.tx, day, "day", "id", "id", "amount", "status", "updated_at")


@query(
    "hourly_by_pair",
    sql(
        "tx",
        """SELECT date_trunc('hour', created_at) AS hour, source_institution, destination_institution,
          count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM tx GROUP BY 1, 2, 3""",
    ),
)
def hourly_by_pair(v: Views):
    return states.pair_states(v.tx)


@query(
    "volume_now",
    sql(
        "live",
        """SELECT type, count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS total_amount
        FROM live WHERE created_at >= (SELECT max(created_at) FROM raw) - INTERVAL 60 MINUTE GROUP BY 1""",
    ),
)
def volume_now(v: Views):
    return agg.volume_now(v.raw, 60, v.as_of)


@query(
    "pruned_day_drilldown",
    sql(
        "live",
        """SELECT date_trunc('hour', created_at) AS hour, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS volume,
          CAST(sum(settle_ms) AS DOUBLE) / 1000 / nullif(count(settle_ms), 0) AS mean_seconds
        FROM live WHERE created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-20'
          AND type = 'click' AND source_institution = '007' GROUP BY 1""",
    ),
)
def pruned_day_drilldown(v: Views):
    """Both bounds are literals on the raw column, so they reach the scan."""
    start, end = datetime(2024, 1, 10), datetime(2024, 1, 20)
    return agg.hourly_drilldown(v.raw, start, end, "click", "007")


@query(
    "table_checksums",
    sql(
        "tx recon raw",
        """SELECT 'transactions' AS table_name, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total FROM tx
        UNION ALL SELECT 'reconciliations', count(*), CAST(sum(amount_received) AS DOUBLE) FROM recon
        UNION ALL SELECT 'versions', count(*), CAST(sum(amount) AS DOUBLE) FROM raw""",
    ),
)
def table_checksums(v: Views):
    return agg.table_checksums(
        {
            "transactions": (v.tx, "amount"),
            "reconciliations": (v.recon, "amount_received"),
            "versions": (v.raw, "amount"),
        }
    )


@query(
    "rows_per_partition",
    sql(
        "raw",
        """SELECT yyyymm, count(*) AS n_rows, count(DISTINCT CAST(created_at AS DATE)) AS days
        FROM raw GROUP BY 1""",
    ),
)
def rows_per_partition(v: Views):
    return agg.rows_per_partition(v.raw)


@query(
    "derive_recon",
    sql(
        "tx",
        """SELECT id, external_id, CAST(amount AS DOUBLE) AS amount_expected,
          CAST(amount + CASE WHEN id % 25 < 2 THEN 0.25 ELSE 0 END AS DOUBLE) AS amount_received
        FROM tx WHERE status IN ('settled', 'reversed')
          AND (id * 48271) % 1000003 % 1000 < 144""",
    ),
)
def derive_recon(v: Views):
    """A sampling operator: the draw is its result."""
    scattered = (F.col("id") * 48271) % 1000003
    drawn = agg.derive_recon(v.tx, 1000, 144, scattered)
    off = F.when(F.col("id") % 25 < 2, F.lit("0.25")).otherwise(F.lit("0")).cast("decimal(18,2)")
    return drawn.select(
        "id",
        "external_id",
        F.col("amount").alias("amount_expected"),
        (F.col("amount") + off).alias("amount_received"),
    )


@query(
    "hourly_series_24h",
    sql(
        "hourly",
        """SELECT bucket, type, sum(tx_count)::BIGINT AS tx_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM hourly WHERE bucket >= (SELECT max(bucket) FROM hourly) - INTERVAL 24 HOUR GROUP BY 1, 2""",
    ),
)
def hourly_series_24h(v: Views):
    newest_bucket = F.date_trunc("hour", v.as_of)
    return agg.hourly_series(agg.volume_hourly(v.tx), newest_bucket)


@query(
    "tumbling_hourly",
    sql(
        "tx",
        """SELECT time_bucket(INTERVAL '1 hour', created_at) AS bucket, type, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount FROM tx GROUP BY 1, 2""",
    ),
)
def tumbling_hourly(v: Views):
    return v.tx.groupBy(tumbling("created_at", "1 hour").alias("bucket"), "type").agg(
        F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount")
    )


DAILY = """SELECT day, source_institution, type, sum(tx_count)::BIGINT AS tx_count,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount,
  CAST(sum(total_amount) AS DOUBLE) / sum(amount_n) AS avg_amount,
  sum(settled_count)::BIGINT AS settled_count, sum(failed_count)::BIGINT AS failed_count,
  CAST(sum(ms_sum) AS DOUBLE) / 1000 / nullif(sum(ms_n), 0) AS avg_settle_seconds
FROM daily GROUP BY 1, 2, 3"""


@query("daily_by_institution", sql("daily", DAILY))
def daily_by_institution(v: Views):
    return states.daily_report(v.daily)


@query(
    "status_funnel",
    sql(
        "funnel",
        """SELECT hour, type, source_institution, status, cnt,
          CAST(ms_sum AS DOUBLE) / 1000 / nullif(ms_n, 0) AS avg_seconds FROM funnel""",
    ),
)
def status_funnel(v: Views):
    return states.funnel_report(v.funnel)


@query(
    "merge_daily_volume",
    sql(
        "daily anchor",
        """SELECT day, source_institution, sum(tx_count)::BIGINT AS tx_count,
          CAST(sum(total_amount) AS DOUBLE) AS total_amount, sum(settled_count)::BIGINT AS settled_count
        FROM daily, anchor WHERE day >= CAST(as_of AS DATE) - 20 AND type = 'click' GROUP BY 1, 2""",
    ),
)
def merge_daily_volume(v: Views):
    return states.daily_volume(v.daily_since("20 days"), v.as_of, 20, "click")


@query(
    "merge_named_volume",
    sql(
        "daily dict anchor",
        """SELECT source_institution AS code,
          coalesce(max(d.name), '(unknown ' || source_institution || ')') AS institution,
          sum(tx_count)::BIGINT AS tx_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM daily LEFT JOIN dict d ON d.code = source_institution, anchor
        WHERE day >= CAST(as_of AS DATE) - 7 GROUP BY source_institution""",
    ),
)
def merge_named_volume(v: Views):
    return states.named_volume(v.daily_since("7 days"), v.dictionary, v.as_of, 7)


@query(
    "merge_states_equals_raw",
    sql(
        "final",
        """SELECT source_institution, count(*) AS tx_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
          count(*) FILTER (WHERE status = 'settled') AS settled_count,
          count(*) FILTER (WHERE status = 'failed') AS failed_count,
          CAST(sum(settle_ms) AS DOUBLE) / 1000 / nullif(count(settle_ms), 0) AS avg_settle_seconds
        FROM final GROUP BY 1""",
    ),
)
def merge_states_equals_raw(v: Views):
    """States of two halves of the days, merged to institutions, against the rows themselves."""
    odd = F.dayofmonth("created_at") % 2 == 1
    halves = states.daily_states(v.final.filter(odd)).unionByName(
        states.daily_states(v.final.filter(~odd))
    )
    merged = states.merge_states(halves, "source_institution")
    return merged.select(
        "source_institution",
        "tx_count",
        "total_amount",
        "settled_count",
        "failed_count",
        states.mean("seconds_sum", "seconds_n").alias("avg_settle_seconds"),
    )


@query("daily_amount_quantiles")
def daily_amount_quantiles(v: Views):
    """P95 and P99 of amounts per institution from merged daily sketches (approximate)."""
    sketched = states.daily_states(v.final, sketch=True)
    merged = states.merge_states(sketched, "source_institution")
    return merged.select(
        "source_institution",
        "tx_count",
        states.quantile("amount_sketch", 0.95).alias("p95_amount"),
        states.quantile("amount_sketch", 0.99).alias("p99_amount"),
    )


FLAGSHIP = """s AS (SELECT hour(f.hour) AS h, f.source_institution AS code, {type_key}
    sum(cnt) FILTER (WHERE f.hour >= as_of - INTERVAL 24 HOUR AND status = 'settled') AS ts,
    sum(cnt) FILTER (WHERE f.hour >= as_of - INTERVAL 24 HOUR) AS tt,
    sum(cnt) FILTER (WHERE f.hour < as_of - INTERVAL 24 HOUR AND status = 'settled') AS ps,
    sum(cnt) FILTER (WHERE f.hour < as_of - INTERVAL 24 HOUR) AS pt
  FROM funnel f, anchor WHERE f.hour >= as_of - INTERVAL 48 HOUR {where} GROUP BY ALL),
r AS (SELECT *, CASE WHEN tt > 0 THEN coalesce(ts, 0)::DOUBLE / tt END AS rt,
    CASE WHEN pt > 0 THEN coalesce(ps, 0)::DOUBLE / pt END AS rp FROM s)
SELECT CAST(h AS INTEGER) AS hour_of_day, {type_out} coalesce(d.name, r.code) AS institution,
  round(100 * rt, 2) AS rate_today, round(100 * rp, 2) AS rate_previous,
  round(100 * (rt - rp), 2) AS delta_points
FROM r LEFT JOIN dict d ON d.code = r.code"""


@query(
    "success_rate_24h_vs_d1",
    sql("funnel dict anchor", FLAGSHIP.format(type_key="", type_out="", where="AND type = 'click'")),
)
def success_rate_24h_vs_d1(v: Views):
    return states.success_rate_vs_previous_day(
        v.funnel_since("48 hours"), v.dictionary, v.as_of, "click"
    )


@query(
    "success_rate_24h_vs_d1_all_types",
    sql("funnel dict anchor", FLAGSHIP.format(type_key="type,", type_out="type,", where="")),
)
def success_rate_24h_vs_d1_all_types(v: Views):
    return states.success_rate_vs_previous_day(v.funnel_since("48 hours"), v.dictionary, v.as_of)


HEALTH = """SELECT source_institution AS institution, coalesce(d.name, 'unknown') AS institution_name,
  sum(cnt)::BIGINT AS total, coalesce(sum(cnt) FILTER (WHERE status = 'settled'), 0)::BIGINT AS settled,
  coalesce(sum(cnt) FILTER (WHERE status = 'failed'), 0)::BIGINT AS failed,
  round(coalesce(sum(cnt) FILTER (WHERE status = 'settled'), 0)::DOUBLE / sum(cnt), 4) AS success_rate,
  round(coalesce(sum(cnt) FILTER (WHERE status = 'failed'), 0)::DOUBLE / sum(cnt), 4) AS failure_rate,
  round(CAST(sum(ms_sum) AS DOUBLE) / 1000 / nullif(sum(ms_n), 0), 3) AS avg_settlement_seconds
FROM funnel f LEFT JOIN dict d ON d.code = f.source_institution, anchor
WHERE f.hour >= as_of - INTERVAL {hours} HOUR {where} GROUP BY 1, 2"""


@query("institution_health", sql("funnel dict anchor", HEALTH.format(hours=24, where="")))
def institution_health(v: Views):
    return states.institution_health(v.funnel_since("24 hours"), v.dictionary, v.as_of, 24)


@query(
    "institution_health_one",
    sql(
        "funnel dict anchor",
        HEALTH.format(hours=168, where="AND source_institution = '013'"),
    ),
)
def institution_health_one(v: Views):
    return states.institution_health(
        v.funnel_since("168 hours"), v.dictionary, v.as_of, 168, code="013"
    )


@query("institution_health_p95")
def institution_health_p95(v: Views):
    """With the approximate P95 of settlement time from merged sketches."""
    funnel = v.funnel_since("168 hours", sketch=True)
    return states.institution_health(funnel, v.dictionary, v.as_of, 168)


@query(
    "backfill_cutoff_union",
    sql(
        "tx",
        """SELECT source_institution, destination_institution, count(*) AS tx_count,
          CAST(sum(amount) AS DOUBLE) AS total_amount FROM tx GROUP BY 1, 2""",
    ),
)
def backfill_cutoff_union(v: Views):
    """History before the cut and live states after it, together exactly the table."""
    cut = v.ago("10 days")
    history = states.backfill_states(v.tx, cut)
    live = states.pair_states(v.tx.filter(F.col("created_at") >= cut))
    return states.merge_states(
        history.unionByName(live), "source_institution", "destination_institution"
    )


@query("rebuild_from_final", sql("daily", DAILY))
def rebuild_from_final(v: Views):
    return states.daily_report(states.rebuild_states(v.raw))


@query(
    "trigger_states_drift",
    sql(
        "raw final",
        """a AS (SELECT type, count(*) AS n FROM raw GROUP BY 1), b AS (SELECT type, count(*) AS n FROM final GROUP BY 1)
        SELECT type, a.n AS tx_count_left, b.n AS tx_count_right, a.n <> b.n AS differs FROM a JOIN b USING (type)""",
    ),
)
def trigger_states_drift(v: Views):
    """States that counted every version against states rebuilt from resolved versions."""
    counted = states.merge_states(states.daily_states(v.raw), "type")
    rebuilt = states.merge_states(states.rebuild_states(v.raw), "type")
    return joins.diff_aggregates(counted, rebuilt, ["type"], ["tx_count"])


@query(
    "recent_live_share",
    sql(
        "live",
        """SELECT status, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct FROM live
        WHERE created_at >= (SELECT max(created_at) FROM raw) - INTERVAL 7 DAY GROUP BY 1""",
    ),
)
def recent_live_share(v: Views):
    return agg.share_of(versions.live(v.raw.filter(last("created_at", "7 days", v.as_of))), "status")
