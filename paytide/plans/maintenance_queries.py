"""Registered queries: versions, refresh, gap filling and table lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from paytide.functions.timing import aligned_cut, interval, last
from paytide.operators import aggregates as agg
from paytide.operators import lifecycle, refresh, states, versions
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.views import Views
from paytide.session import workspace
from paytide.sources import lake


@query(
    "latest_version",
    sql("final", "SELECT tx_id, type, status, _version, _is_deleted, settlement_seconds FROM final"),
)
def latest_version(v: Views):
    return v.final.select(
        "tx_id", "type", "status", "_version", "_is_deleted", "settlement_seconds"
    )


@query(
    "final_vs_physical_counts",
    sql(
        "raw final",
        """k AS (SELECT type, count(*) AS versions FROM raw GROUP BY type, external_id)
        SELECT type, sum(versions)::BIGINT AS physical_rows, count(*) AS logical_rows,
          max(versions) AS max_versions FROM k GROUP BY 1""",
    ),
)
def final_vs_physical_counts(v: Views):
    return versions.final_vs_physical(v.raw)


@query(
    "tombstone_filter",
    sql(
        "raw final",
        """a AS (SELECT type, count(*) AS logical_rows, count(*) FILTER (WHERE _is_deleted = 0) AS live_rows
            FROM final GROUP BY 1),
        b AS (SELECT type, count(DISTINCT external_id) AS filtered_first FROM raw WHERE _is_deleted = 0 GROUP BY 1)
        SELECT type, logical_rows, live_rows, filtered_first FROM a JOIN b USING (type)""",
    ),
)
def tombstone_filter(v: Views):
    """Filtering after resolving versions, beside the wrong order, which revives deleted rows."""
    right = v.final.groupBy("type").agg(
        F.count("*").alias("logical_rows"),
        F.count_if(F.col("_is_deleted") == 0).alias("live_rows"),
    )
    early = versions.final(v.raw.filter("_is_deleted = 0"))
    wrong = early.groupBy("type").agg(F.count("*").alias("filtered_first"))
    return right.join(wrong, "type")


@query(
    "replay_idempotent",
    sql(
        "raw final",
        """r AS (SELECT type, count(*) AS replayed FROM raw
              WHERE _version >= (SELECT max(_version) FROM raw) - 3600000 * 24 GROUP BY 1),
        p AS (SELECT type, count(*) AS n FROM raw GROUP BY 1),
        f AS (SELECT type, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS s FROM final GROUP BY 1)
        SELECT type, f.n AS logical_before, f.n AS logical_after, f.s AS total_before, f.s AS total_after,
          p.n + coalesce(replayed, 0) AS physical_after
        FROM f JOIN p USING (type) LEFT JOIN r USING (type)""",
    ),
)
def replay_idempotent(v: Views):
    """Rewinding the watermark a day re-ingests rows; the resolved table does not change."""
    newest = v.raw.agg(F.max("_version")).scalar()
    again = v.raw.filter(F.col("_version") >= newest - 86400000).withColumn(
        "_ingested_at", F.col("_ingested_at") + interval("1 hour")
    )
    both = v.raw.unionByName(again)

    def summary(df, when: str):
        return df.groupBy("type").agg(
            F.count("*").alias(f"logical_{when}"), F.sum("amount").alias(f"total_{when}")
        )

    physical = both.groupBy("type").agg(F.count("*").alias("physical_after"))
    return (
        summary(v.final, "before")
        .join(summary(versions.final(both), "after"), "type")
        .join(physical, "type")
    )


@query(
    "purge_old_versions",
    sql(
        "raw",
        """t AS (SELECT *, max(_version) OVER (PARTITION BY type, source_institution,
             date_trunc('hour', created_at), external_id) AS top FROM raw)
        SELECT source_institution, status, count(*) AS n_rows FROM t
        WHERE source_institution <> '003' OR _version = top GROUP BY 1, 2""",
    ),
)
def purge_old_versions(v: Views):
    kept = versions.purge_old_versions(v.raw, F.col("source_institution") == "003")
    return kept.groupBy("source_institution", "status").agg(F.count("*").alias("n_rows"))


@query(
    "touch_updated_at",
    sql(
        "tx anchor",
        """SELECT id, CASE WHEN status IN ('pending', 'settled') THEN 'settled' ELSE status END AS status,
          CASE WHEN status = 'pending' THEN as_of ELSE updated_at END AS updated_at FROM tx, anchor""",
    ),
)
def touch_updated_at(v: Views):
    """Settle everything pending; rows that already were settled keep their change time."""
    patch = v.tx.filter(F.col("status").isin("pending", "settled")).select(
        "id", F.lit("settled").alias("status")
    )
    rows = v.tx.select("id", "status", "updated_at")
    return lifecycle.apply_updates(rows, patch, "id", v.as_of)


@query(
    "refresh_window_hourly",
    sql(
        "tx anchor",
        """old AS (SELECT date_trunc('hour', created_at) AS bucket, type, status, count(*) AS n, sum(amount) AS s
            FROM tx, anchor WHERE created_at < as_of - INTERVAL 150 MINUTE GROUP BY 1, 2, 3),
        rng AS (SELECT date_trunc('hour', as_of - INTERVAL 3 HOUR) + INTERVAL 1 HOUR AS a,
                       date_trunc('hour', as_of - INTERVAL 1 HOUR) AS b FROM anchor),
        fresh AS (SELECT date_trunc('hour', created_at) AS bucket, type, status, count(*) AS n, sum(amount) AS s
            FROM tx, rng WHERE created_at >= a AND created_at < b GROUP BY 1, 2, 3)
        SELECT bucket, type, status, n AS tx_count, CAST(s AS DOUBLE) AS total_amount FROM old, rng
          WHERE bucket < a OR bucket >= b
        UNION ALL SELECT bucket, type, status, n, CAST(s AS DOUBLE) FROM fresh""",
    ),
)
def refresh_window_hourly(v: Views):
    """An aggregate stopped mid-bucket, then refreshed over whole buckets of the last 3 h to 1 h."""
    stale = agg.volume_hourly(v.tx.filter(F.col("created_at") < v.ago("150 minutes")))
    fresh = refresh.refresh(
        stale, v.tx, v.ago("3 hours"), v.ago("1 hour"), "hour", agg.volume_hourly
    )
    return fresh.select("bucket", "type", "status", "tx_count", "total_amount")


@query(
    "refresh_window_daily",
    sql(
        "tx anchor latency",
        """rng AS (SELECT date_trunc('day', as_of - INTERVAL 3 DAY) + INTERVAL 1 DAY AS a,
                       date_trunc('day', as_of - INTERVAL 1 HOUR) AS b FROM anchor),
        old AS (SELECT date_trunc('day', created_at) AS bucket, source_institution, type, count(*) AS n
            FROM tx, anchor WHERE settled_at IS NOT NULL AND created_at < as_of - INTERVAL 2 DAY GROUP BY 1, 2, 3)
        SELECT bucket, source_institution, type, n AS settled_count FROM old, rng WHERE bucket < a OR bucket >= b
        UNION ALL SELECT bucket, source_institution, type, settled_count FROM latency, rng
          WHERE bucket >= a AND bucket < b""",
    ),
)
def refresh_window_daily(v: Views):
    stale = agg.latency_daily(v.tx.filter(F.col("created_at") < v.ago("2 days")))
    fresh = refresh.refresh(
        stale, v.tx, v.ago("3 days"), v.ago("1 hour"), "day", agg.latency_daily
    )
    return fresh.select("bucket", "source_institution", "type", "settled_count")


@query(
    "cagg_lag_hours",
    sql(
        "tx hourly anchor",
        """SELECT 'volume_hourly' AS aggregate_name, max(bucket) + INTERVAL 1 HOUR AS materialized_until,
          (epoch_us(max(as_of)) - epoch_us(max(bucket) + INTERVAL 1 HOUR)) / 3.6e9 AS lag_hours FROM hourly, anchor
        WHERE bucket < date_trunc('hour', as_of - INTERVAL 1 HOUR)
        UNION ALL
        SELECT 'latency_daily', max(d) + INTERVAL 1 DAY, (epoch_us(max(as_of)) - epoch_us(max(d) + INTERVAL 1 DAY)) / 3.6e9
        FROM (SELECT date_trunc('day', created_at) AS d FROM tx, anchor
              WHERE created_at < date_trunc('day', as_of) AND settled_at IS NOT NULL), anchor""",
    ),
)
def cagg_lag_hours(v: Views):
    """Each aggregate as its policy leaves it: without the bucket still open."""
    hourly = agg.volume_hourly(
        v.tx.filter(F.col("created_at") < aligned_cut(v.as_of, "1 hour", "hour"))
    )
    daily = agg.latency_daily(v.tx.filter(F.col("created_at") < F.date_trunc("day", v.as_of)))
    return refresh.lag_hours(
        {"volume_hourly": (hourly, "hour"), "latency_daily": (daily, "day")}, v.as_of
    )


@query(
    "gapfill_48h",
    sql(
        "tx anchor",
        """g AS (SELECT date_trunc('hour', created_at) AS bucket, type, count(*) AS n,
             CAST(sum(amount) AS DOUBLE) / count(amount) AS m
           FROM tx, anchor WHERE created_at >= as_of - INTERVAL 48 HOUR AND created_at < as_of GROUP BY 1, 2),
        spine AS (SELECT type, unnest(generate_series(date_trunc('hour', as_of - INTERVAL 48 HOUR),
             date_trunc('hour', as_of - INTERVAL 1 MICROSECOND), INTERVAL 1 HOUR)) AS bucket
           FROM (SELECT DISTINCT type FROM g), anchor),
        f AS (SELECT spine.type, spine.bucket, n, m FROM spine LEFT JOIN g USING (type, bucket)),
        w AS (SELECT *, last_value(m IGNORE NULLS) OVER back AS y0, first_value(m IGNORE NULLS) OVER ahead AS y1,
            last_value(CASE WHEN m IS NOT NULL THEN epoch(bucket) END IGNORE NULLS) OVER back AS x0,
            first_value(CASE WHEN m IS NOT NULL THEN epoch(bucket) END IGNORE NULLS) OVER ahead AS x1
          FROM f WINDOW back AS (PARTITION BY type ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            ahead AS (PARTITION BY type ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT type, bucket, coalesce(n, 0) AS tx_count, y0 AS mean_amount_locf,
          CASE WHEN m IS NOT NULL THEN m WHEN x1 > x0
            THEN y0 + (y1 - y0) * ((epoch(bucket) - x0) / (x1 - x0)) END AS mean_amount_interp
        FROM w""",
    ),
)
def gapfill_48h(v: Views):
    inside = v.tx.filter(last("created_at", "48 hours", v.as_of) & (F.col("created_at") < v.as_of))
    hourly = inside.groupBy(F.date_trunc("hour", "created_at").alias("bucket"), "type").agg(
        F.count("*").alias("tx_count"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("mean_amount"),
    )
    return refresh.gapfill(
        hourly,
        v.ago("48 hours"),
        v.as_of,
        "hour",
        ["type"],
        zero=("tx_count",),
        locf=("mean_amount",),
        interp=("mean_amount",),
    )


@query(
    "retention_survivors",
    sql(
        "tx anchor",
        """SELECT CAST(created_at AS DATE) AS day, count(*) AS n_rows FROM tx, anchor
        WHERE created_at >= date_trunc('day', as_of - INTERVAL 20 DAY) GROUP BY 1""",
    ),
)
def retention_survivors(v: Views):
    kept = lifecycle.survivors(v.tx, "created_at", v.as_of, "20 days")
    return kept.groupBy(F.to_date("created_at").alias("day")).agg(F.count("*").alias("n_rows"))


@query(
    "droppable_partitions",
    sql(
        "tx anchor hourly",
        """cov AS (SELECT least(
            (SELECT max(bucket) + INTERVAL 1 HOUR FROM hourly, anchor WHERE bucket < date_trunc('hour', as_of - INTERVAL 15 DAY)),
            (SELECT date_trunc('day', max(created_at)) + INTERVAL 1 DAY FROM tx, anchor
             WHERE created_at < as_of - INTERVAL 12 DAY AND settled_at IS NOT NULL)) AS until),
        p AS (SELECT date_trunc('day', created_at) AS range_start, count(*) AS n_rows FROM tx GROUP BY 1)
        SELECT range_start, range_start + INTERVAL 1 DAY AS range_end, n_rows,
          until >= range_start + INTERVAL 1 DAY AS can_drop
        FROM p, cov, anchor WHERE range_start + INTERVAL 1 DAY < as_of - INTERVAL 10 DAY""",
    ),
)
def droppable_partitions(v: Views):
    """Aggregates that lag by 15 and 12 days: partitions they do not cover must stay."""
    hourly = agg.volume_hourly(
        v.tx.filter(F.col("created_at") < aligned_cut(v.as_of, "15 days", "hour"))
    )
    daily = agg.latency_daily(v.tx.filter(F.col("created_at") < v.ago("12 days")))
    covered = [
        refresh.materialized_until(hourly, "hour"),
        refresh.materialized_until(daily, "day"),
    ]
    return lifecycle.droppable(lifecycle.day_partitions(v.tx), covered, v.as_of, "10 days")


@query(
    "aggregate_survives_drop",
    sql(
        "tx anchor",
        """SELECT CAST(created_at AS DATE) AS day, count(*) AS aggregate_count,
          CAST(sum(amount) AS DOUBLE) AS aggregate_total,
          count(*) FILTER (WHERE created_at >= date_trunc('day', as_of - INTERVAL 20 DAY)) AS raw_rows_left
        FROM tx, anchor GROUP BY 1""",
    ),
)
def aggregate_survives_drop(v: Views):
    """After old raw partitions go, the aggregate still answers for their days."""
    by_day = agg.rollup(agg.volume_hourly(v.tx), "day").select(
        F.to_date("day").alias("day"),
        F.col("tx_count").alias("aggregate_count"),
        F.col("total_amount").alias("aggregate_total"),
    )
    kept = lifecycle.survivors(v.tx, "created_at", v.as_of, "20 days")
    left = kept.groupBy(F.to_date("created_at").alias("day")).agg(F.count("*").alias("n"))
    return by_day.join(left, "day", "left").select(
        "day", "aggregate_count", "aggregate_total", F.coalesce("n", F.lit(0)).alias("raw_rows_left")
    )


@query(
    "recovery_count_sum",
    sql(
        "tx anchor",
        """SELECT type, count(*) AS n_before, CAST(sum(amount) AS DOUBLE) AS total_before,
          count(*) AS n_after, CAST(sum(amount) AS DOUBLE) AS total_after, 0::BIGINT AS residue
        FROM tx, anchor WHERE created_at < as_of - INTERVAL 1 DAY GROUP BY 1""",
    ),
)
def recovery_count_sum(v: Views):
    """A recovery to a point a day back: same count and sum up to it, nothing after it."""
    point = v.ago("1 day")
    before = v.tx.filter(F.col("created_at") < point)
    restored = v.final.filter(F.col("created_at") < point)

    def proof(df, when):
        return df.groupBy("type").agg(
            F.count("*").alias(f"n_{when}"), F.sum("amount").alias(f"total_{when}")
        )

    residue = restored.groupBy("type").agg(
        F.count_if(F.col("created_at") >= point).alias("residue")
    )
    return proof(before, "before").join(proof(restored, "after"), "type").join(residue, "type")


def erasure_requests(v: Views):
    """The data's blocked holders have asked to be erased."""
    days = F.make_dt_interval(days=(F.col("id") % 400).cast("int"))
    return v.accounts.filter(F.col("status") == "blocked").select(
        "id", (v.as_of - days).alias("requested_at"), F.lit("dpo").alias("requester")
    )


@query(
    "anonymize_accounts",
    sql(
        "accounts erasures",
        """SELECT a.id, account_number, institution_code,
          CASE WHEN e.id IS NOT NULL THEN 'ANON-' || sha256(CAST(a.id AS VARCHAR) || 'salt') ELSE holder_document END AS holder_document,
          CASE WHEN e.id IS NOT NULL THEN 'ANONIMIZADO' ELSE holder_name END AS holder_name,
          CASE WHEN e.id IS NOT NULL THEN 'closed' ELSE status END AS status
        FROM accounts a LEFT JOIN erasures e ON e.id = a.id""",
    ),
)
def anonymize_accounts(v: Views):
    return lifecycle.anonymize(v.accounts, erasure_requests(v), "salt")


@query(
    "erasure_log",
    sql(
        "accounts erasures",
        """SELECT sha256(holder_document) AS document_hash, requested_at, executed_at, requester,
          1 AS affected_rows, executed_at < requested_at + INTERVAL 365 DAY AS backups_pending
        FROM erasures JOIN accounts USING (id)""",
    ),
)
def erasure_log(v: Views):
    return lifecycle.erasure_log(erasure_requests(v), v.accounts, v.as_of)


@query(
    "audited_read",
    sql(
        "accounts",
        """SELECT id, account_number, institution_code, holder_document, holder_name, status FROM accounts
        WHERE institution_code = '003' ORDER BY id LIMIT 100""",
    ),
)
def audited_read(v: Views):
    return lifecycle.read_accounts(v.accounts, "003", 100)


@query(
    "append_only_check",
    sql(
        "erasures anchor",
        """SELECT count(*) FILTER (WHERE requested_at < as_of - INTERVAL 100 DAY) AS old_rows,
          count(*) AS new_rows, 0::BIGINT AS rewritten_clean,
          count(*) FILTER (WHERE requested_at < as_of - INTERVAL 200 DAY) AS rewritten_tampered
        FROM erasures, anchor""",
    ),
)
def append_only_check(v: Views):
    log = lifecycle.erasure_log(erasure_requests(v), v.accounts, v.as_of)
    old = log.filter(F.col("requested_at") < v.ago("100 days"))
    tampered = log.withColumn(
        "requester",
        F.when(F.col("requested_at") < v.ago("200 days"), "other").otherwise(F.col("requester")),
    )

    def size(df):
        return df.agg(F.count("*")).scalar()

    return log.agg(F.count("*").alias("new_rows")).select(
        size(old).alias("old_rows"),
        "new_rows",
        size(lifecycle.rewritten_log_rows(old, log, "document_hash")).alias("rewritten_clean"),
        size(lifecycle.rewritten_log_rows(old, tampered, "document_hash")).alias(
            "rewritten_tampered"
        ),
    )


@query(
    "shadow_partition_diff",
    sql(
        "tx",
        """SELECT CAST(created_at AS DATE) AS day, count(*) AS n_rows_source, count(*) AS n_rows_shadow,
          count(*) FILTER (WHERE type = 'error' AND k = 50) = 0 AS matches FROM tx GROUP BY 1""",
    ),
)
def shadow_partition_diff(v: Views):
    """A copy made before the cut plus rows written twice after it, with damage planted in
    the amounts: every damaged day must fail, whatever its count says."""
    source = v.tx.select("id", "created_at", "type", "status", "amount")
    damaged = (F.col("type") == "error") & (F.col("k") == 50)
    amount = F.when(damaged, F.col("amount") + 1).otherwise(F.col("amount"))
    copy = v.tx.select(
        "id", "created_at", "type", "status", amount.cast("decimal(18,2)").alias("amount")
    )
    cut = v.ago("10 days")
    shadow = copy.filter(F.col("created_at") < cut).unionByName(
        copy.filter(F.col("created_at") >= cut)
    )
    diff = lifecycle.partition_diff(source, shadow, F.to_date("created_at"), "day", "id")
    return diff.select("day", "n_rows_source", "n_rows_shadow", "matches")


@query(
    "purge_consistency",
    sql(
        "raw daily funnel",
        """SELECT 'raw' AS table_name, count(*) AS rows_left, count(DISTINCT source_institution) AS institutions_left
        FROM raw WHERE source_institution <> '007'
        UNION ALL SELECT 'daily', count(*), count(DISTINCT source_institution) FROM daily WHERE source_institution <> '007'
        UNION ALL SELECT 'funnel', count(*), count(DISTINCT source_institution) FROM funnel WHERE source_institution <> '007'""",
    ),
)
def purge_consistency(v: Views):
    left = lifecycle.purge(
        {"raw": v.raw, "daily": v.daily, "funnel": v.funnel}, F.col("source_institution") == "007"
    )
    out = None
    for name, df in left.items():
        row = df.agg(
            F.count("*").alias("rows_left"),
            F.count_distinct("source_institution").alias("institutions_left"),
        ).select(F.lit(name).alias("table_name"), "rows_left", "institutions_left")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "purge_rewritten",
    sql(
        "raw daily funnel",
        """SELECT 'raw' AS table_name, count(*) AS rows_left, count(DISTINCT source_institution) AS institutions_left
        FROM raw WHERE source_institution <> '007'
        UNION ALL SELECT 'daily', count(*), count(DISTINCT source_institution) FROM daily WHERE source_institution <> '007'
        UNION ALL SELECT 'funnel', count(*), count(DISTINCT source_institution) FROM funnel WHERE source_institution <> '007'""",
    ),
)
def purge_rewritten(v: Views):
    """The same purge carried out on stored tables, which are then read back."""
    root = workspace(v.spark, "purged")
    out = None
    for name, df, day in (("raw", v.raw, "created_at"), ("daily", v.daily, "day"), ("funnel", v.funnel, "hour")):
        path = f"{root}/{name}"
        lake.replace_partitions(df.withColumn("on_day", F.to_date(day)), path, "on_day")
        lifecycle.purge_stored(v.spark, path, ("on_day",), F.col("source_institution") == "007")
        row = v.spark.read.parquet(path).agg(
            F.count("*").alias("rows_left"),
            F.count_distinct("source_institution").alias("institutions_left"),
        ).select(F.lit(name).alias("table_name"), "rows_left", "institutions_left")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "prefix_and_tag_filters",
    sql(
        "live",
        """SELECT count(*) FILTER (WHERE external_id LIKE 'a%') AS tagged,
          count(*) FILTER (WHERE external_id NOT LIKE 'a%' AND type <> 'error') AS other,
          count(*) AS n_rows FROM live""",
    ),
)
def prefix_and_tag_filters(v: Views):
    tagged = F.col("external_id").like("a%")
    return v.live.agg(
        F.count_if(tagged).alias("tagged"),
        F.count_if(~tagged & (F.col("type") != "error")).alias("other"),
        F.count("*").alias("n_rows"),
    )


@query(
    "named_state_volume_short",
    sql(
        "daily dict anchor",
        """SELECT source_institution AS code,
          coalesce(max(d.short_name), '(unknown ' || source_institution || ')') AS institution,
          sum(tx_count)::BIGINT AS tx_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM daily LEFT JOIN dict d ON d.code = source_institution, anchor
        WHERE day >= CAST(as_of AS DATE) - 30 GROUP BY source_institution""",
    ),
)
def named_state_volume_short(v: Views):
    return states.named_volume(v.daily_since("30 days"), v.dictionary, v.as_of, 30, short=True)
