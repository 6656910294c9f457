"""Aggregations over transactions and over their hourly and daily partials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.functions.percentile import exact_percentiles
from paytide.functions.timing import (
    Instant,
    aligned_cut,
    as_of,
    boundary_minutes,
    instant,
    last,
    micros_between,
    month_key,
    seconds_between,
)
from paytide.operators.answers import MOST_ROWS, document, stamp
from paytide.operators.versions import live

QUANTILES = {"p95_seconds": 0.95, "p99_seconds": 0.99}


def _ratio(top: Column, bottom: Column) -> Column:
    """Double quotient, null over zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def volume_by_type_status(tx: DataFrame, since: Column) -> DataFrame:
    """Count and amount by month, type and status, from the rows themselves."""
    return (
        tx.filter(F.col("created_at") >= since)
        .groupBy(F.date_trunc("month", "created_at").alias("month"), "type", "status")
        .agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"))
    )


def volume_hourly(tx: DataFrame) -> DataFrame:
    """Hourly partials. Mean is derived from sum and count, both of which roll up."""
    return (
        tx.groupBy(F.date_trunc("hour", "created_at").alias("bucket"), "type", "status")
        .agg(
            F.count("*").alias("tx_count"),
            F.sum("amount").alias("total_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
        )
        .withColumn("avg_amount", _ratio(F.col("total_amount"), F.col("tx_count")))
    )


def rollup(partials: DataFrame, unit: str, *keys: str, since: Column | None = None) -> DataFrame:
    """Coarser buckets from volume partials: exact, since counts, sums and extremes combine."""
    rows = partials if since is None else partials.filter(F.col("bucket") >= since)
    return rows.groupBy(F.date_trunc(unit, "bucket").alias(unit), *keys).agg(
        F.sum("tx_count").alias("tx_count"),
        F.sum("total_amount").alias("total_amount"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def latency_daily(tx: DataFrame) -> DataFrame:
    """Daily settlement-latency partials of settled rows; sums are exact decimals.

    ``failed_count`` counts failed rows that carry a settlement time, normally none: a
    failure rate must come from the volume partials.
    """
    seconds = seconds_between("settled_at", "created_at")
    return (
        tx.filter(F.col("settled_at").isNotNull())
        .withColumn("_s", seconds)
        .groupBy(F.date_trunc("day", "created_at").alias("bucket"), "source_institution", "type")
        .agg(
            F.count("settled_at").alias("settled_count"),
            F.count_if(F.col("status") == "failed").alias("failed_count"),
            F.count("*").alias("total_count"),
            F.sum("_s").alias("latency_sum_seconds"),
            F.sum(F.col("_s") * F.col("_s")).alias("latency_sum_sq_seconds"),
            F.min("_s").alias("latency_min_seconds"),
            F.max("_s").alias("latency_max_seconds"),
        )
    )


def _latency_percentiles(tx: DataFrame, *keys: str) -> DataFrame:
    settled = tx.filter(F.col("settled_at").isNotNull()).select(
        F.date_trunc("day", "created_at").alias("bucket"),
        *keys,
        micros_between("settled_at", "created_at").alias("micros"),
    )
    exact = exact_percentiles(
        settled, ["bucket", *keys], "micros", QUANTILES, count="settled_count"
    )
    return exact.select(
        "bucket",
        *keys,
        "settled_count",
        *[F.round(F.col(q) / F.lit(1e6), 6).alias(q) for q in QUANTILES],
    )


def latency_percentiles(tx: DataFrame) -> DataFrame:
    """Exact P95/P99 settlement latency by day, institution and type.

    The type belongs in the key: instruments settle on very different scales, and a mixed
    percentile answers for the slowest of them.
    """
    return _latency_percentiles(tx, "source_institution", "type")


def latency_percentiles_all_types(tx: DataFrame) -> DataFrame:
    """The mixed view by day and institution, under a name that says so."""
    return _latency_percentiles(tx, "source_institution")


def top_institutions(tx: DataFrame, anchor: Instant, window: str, n: int = 20) -> DataFrame:
    """Institutions by amount, with mean settlement time and failure ratio."""
    seconds = seconds_between("settled_at", "created_at")
    return (
        tx.filter(last("created_at", window, anchor))
        .groupBy("source_institution")
        .agg(
            F.count("*").alias("tx_count"),
            F.sum("amount").alias("volume"),
            _ratio(F.sum(seconds), F.count("settled_at")).alias("mean_seconds"),
            _ratio(F.count_if(F.col("status") == "failed"), F.count("*")).alias("failure_rate"),
        )
        .orderBy(F.desc("volume"), "source_institution")
        .limit(n)
    )


def top_institutions_from_daily(
    partials: DataFrame, anchor: Instant, window: str, n: int = 20
) -> DataFrame:
    """Ranking by settled count from the daily partials; a weighted mean, never a mean of means."""
    return (
        partials.filter(F.col("bucket") >= aligned_cut(anchor, window, "day"))
        .groupBy("source_institution")
        .agg(
            F.sum("settled_count").alias("settled"),
            _ratio(F.sum("latency_sum_seconds"), F.sum("settled_count")).alias("mean_seconds"),
            F.max("latency_max_seconds").alias("worst_seconds"),
        )
        .orderBy(F.desc("settled"), "source_institution")
        .limit(n)
    )


def stddev_from_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """Population variance and deviation from combined n, sum and sum of squares."""
    merged = partials.groupBy(*keys).agg(
        F.sum("settled_count").alias("n"),
        F.sum("latency_sum_seconds").cast("double").alias("s"),
        F.sum("latency_sum_sq_seconds").cast("double").alias("q"),
    )
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    variance = F.greatest((q - s * s / n) / n, F.lit(0.0))
    return merged.select(*keys, "n", (s / n).alias("mean"), F.sqrt(variance).alias("stddev"))


def share_of(df: DataFrame, category: str) -> DataFrame:
    """Rows and percentage per category. The window sees one row per category."""
    counts = df.groupBy(category).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(category, "n", (F.lit(100.0) * F.col("n") / total).alias("pct"))


def total_vs_unique(raw: DataFrame, *keys: str) -> DataFrame:
    """Rows against distinct transactions; a gap means several versions or duplicates."""
    return raw.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_distinct("external_id").alias("distinct_ids")
    )


def volume_now(raw: DataFrame, minutes: int = 5, anchor: Instant | None = None) -> DataFrame:
    """Count and amount by type in the last minutes before the newest transaction.

    ``raw`` is versioned; only the versions inside the window are resolved.
    """
    at = as_of(raw) if anchor is None else anchor
    return (
        live(raw.filter(last("created_at", f"{minutes} minutes", at)))
        .groupBy("type")
        .agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("tx_count"), "type")
    )


def to_payload(
    rows: DataFrame, window: str, anchor: Instant, *columns: str, limit: int = MOST_ROWS
) -> DataFrame:
    """One JSON document: window, anchor and the first ``limit`` result rows, ordered by count."""
    order = [-F.col("tx_count"), *map(F.col, columns)]
    return document(rows, order, list(columns), limit, window=F.lit(window), anchor=stamp(instant(anchor)))


def hourly_drilldown(
    raw: DataFrame, start: Instant, end: Instant, type_: str, institution: str
) -> DataFrame:
    """One type and institution by hour in ``[start, end)``.

    Every filter is on a raw column and applies before versions are resolved.
    """
    chosen = raw.filter((F.col("created_at") >= start) & (F.col("created_at") < end)).filter(
        (F.col("type") == type_) & (F.col("source_institution") == institution)
    )
    return (
        live(chosen)
        .groupBy(F.date_trunc("hour", "created_at").alias("hour"))
        .agg(
            F.count("*").alias("tx_count"),
            F.sum("amount").alias("volume"),
            _ratio(
                F.sum(F.col("settlement_seconds").cast("decimal(16,3)")),
                F.count("settlement_seconds"),
            ).alias("mean_seconds"),
        )
    )


def freshness(raw: DataFrame, now: Instant) -> DataFrame:
    newest = raw.agg(F.max("created_at").alias("newest"))
    now_col = now if isinstance(now, Column) else F.lit(now)
    return newest.select(
        F.col("newest").alias("last_created_at"),
        boundary_minutes(now_col, F.col("newest")).alias("minutes_behind"),
    )


def table_checksums(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and amount sum of several tables, one row each."""
    rows = [
        df.agg(F.count("*").alias("n_rows"), F.sum(F.col(c).cast("decimal(18,2)")).alias("total"))
        .select(F.lit(name).alias("table_name"), "n_rows", F.col("total").cast("decimal(38,2)").alias("total"))
        for name, (df, c) in tables.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def partition_checksum(df: DataFrame, by: Column, name: str, key: str, *columns: str) -> DataFrame:
    """Count, key sum and row-hash sum per partition: order-free, so copies compare equal."""
    digest = F.sum(F.xxhash64(*(columns or (key,))).cast("decimal(20,0)"))
    return df.groupBy(by.alias(name)).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(key).cast("decimal(20,0)")).alias("key_sum"),
        digest.alias("hash_sum"),
    )


def rows_per_partition(raw: DataFrame) -> DataFrame:
    return raw.groupBy(month_key("created_at").alias("yyyymm")).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.to_date("created_at")).alias("days"),
    )


def derive_recon(tx: DataFrame, keep_mod: int, keep_below: int, bucket: Column) -> DataFrame:
    """A repeatable sample of settled or reversed rows, as reconciliation candidates.

    Sampling is this operator's purpose. ``bucket`` is any integer column, usually a hash
    of the id, so a rerun draws the same rows on any cluster.
    """
    chosen = F.pmod(bucket, F.lit(keep_mod)) < keep_below
    return tx.filter(F.col("status").isin("settled", "reversed") & chosen)


def hourly_series(partials: DataFrame, anchor: Instant, hours: int = 24) -> DataFrame:
    """Hourly count and amount by type over the last hours that hold data."""
    return (
        partials.filter(last("bucket", f"{hours} hours", anchor))
        .groupBy("bucket", "type")
        .agg(F.sum("tx_count").alias("tx_count"), F.sum("total_amount").alias("total_amount"))
    )
