"""Registered queries that hold what SQL cannot compute, hashes, sketches and files, against a bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.operators import aggregates as agg
from paytide.operators import lifecycle, states
from paytide.plans.oracle import sql
from paytide.plans.registry import query
from paytide.plans.scans import DAMAGE
from paytide.plans.stream_queries import stream_batch_metrics
from paytide.plans.views import Views
from paytide.session import workspace
from paytide.sources import lake

#: Rank error a KLL sketch of the default size stays within, with room for merges.
RANK_ERROR = 0.02


@query(
    "checksum_detects_changes",
    sql(
        "tx",
        """SELECT CAST(created_at AS DATE) AS day, count(*) AS n_rows, true AS copy_agrees,
          count_if(id % 97 = 5) = 0 AS changed_copy_agrees FROM tx GROUP BY 1""",
    ),
)
def checksum_detects_changes(v: Views):
    """The row hash of a day is the same in any order, and another after one amount changed."""

    def sums(df: DataFrame, name: str) -> DataFrame:
        day = F.to_date("created_at")
        out = agg.partition_checksum(df, day, "day", "id", "id", "amount", "status", "updated_at")
        return out.select("day", F.col("n_rows").alias(f"{name}_rows"), F.col("hash_sum").alias(name))

    cents = F.when(F.col("id") % 97 == 5, F.lit(0.01)).otherwise(F.lit(0)).cast("decimal(18,2)")
    changed = v.tx.withColumn("amount", (F.col("amount") + cents).cast("decimal(18,2)"))
    other = v.tx.repartition(5, "status", "amount")
    joined = sums(v.tx, "a").join(sums(other, "b"), "day").join(sums(changed, "c"), "day")
    return joined.select(
        "day",
        F.col("a_rows").alias("n_rows"),
        (F.col("a") == F.col("b")).alias("copy_agrees"),
        (F.col("a") == F.col("c")).alias("changed_copy_agrees"),
    )


def _within(value: Column, at: Column, q: float) -> Column:
    """Whether ``at`` has rank ``q`` among the non-null values, within the sketch's error."""
    n = F.count(value)
    below, upto = F.count_if(value < at) / n, F.count_if(value <= at) / n
    return (below <= q + RANK_ERROR) & (upto >= q - RANK_ERROR)


@query(
    "amount_quantiles_in_bound",
    sql(
        "final",
        """SELECT source_institution, count(*) AS tx_count, true AS p95_in_bound, true AS p99_in_bound
        FROM final GROUP BY 1""",
    ),
)
def amount_quantiles_in_bound(v: Views):
    """P95 and P99 of merged daily sketches lie within the sketch's rank error."""
    merged = states.merge_states(states.daily_states(v.final, sketch=True), "source_institution")
    found = merged.select(
        F.col("source_institution").alias("_code"),
        "tx_count",
        states.quantile("amount_sketch", 0.95).alias("p95"),
        states.quantile("amount_sketch", 0.99).alias("p99"),
    )
    rows = v.final.join(found, F.col("source_institution") == F.col("_code"))
    amount = F.col("amount").cast("double")
    return rows.groupBy("source_institution", "tx_count").agg(
        _within(amount, F.col("p95"), 0.95).alias("p95_in_bound"),
        _within(amount, F.col("p99"), 0.99).alias("p99_in_bound"),
    )


@query(
    "settlement_quantiles_in_bound",
    sql(
        "final",
        """SELECT source_institution, count(settlement_seconds) AS seconds_n, true AS p50_in_bound,
          true AS p95_in_bound FROM final GROUP BY 1 HAVING count(settlement_seconds) > 0""",
    ),
)
def settlement_quantiles_in_bound(v: Views):
    """P50 and P95 of settlement time, finalised from merged funnel sketches."""
    merged = states.merge_states(states.funnel_states(v.final, sketch=True), "source_institution")
    found = merged.filter("seconds_n > 0").select(
        F.col("source_institution").alias("_code"),
        "seconds_n",
        states.quantile("seconds_sketch", 0.5).alias("p50"),
        states.quantile("seconds_sketch", 0.95).alias("p95"),
    )
    rows = v.final.join(found, F.col("source_institution") == F.col("_code"))
    seconds = F.col("settlement_seconds")
    return rows.groupBy("source_institution", "seconds_n").agg(
        _within(seconds, F.col("p50"), 0.5).alias("p50_in_bound"),
        _within(seconds, F.col("p95"), 0.95).alias("p95_in_bound"),
    )


@query(
    "stream_batch_counts",
    sql(
        "tx",
        f"""m AS (SELECT {DAMAGE} AS reason FROM tx)
        SELECT count(*) AS rows_read, count_if(reason IS NULL)::BIGINT AS rows_written,
          count_if(reason IS NOT NULL)::BIGINT AS dead_letters FROM m""",
    ),
)
def stream_batch_counts(v: Views):
    """What the batches of a stream report, added up."""
    names = ("rows_read", "rows_written", "dead_letters")
    return stream_batch_metrics(v).agg(*[F.sum(n).alias(n) for n in names])


BY_TYPE = """SELECT {key}, count(*) AS n_rows, true AS has_files, true AS has_bytes FROM {source} GROUP BY 1"""


def _listed(inventory: DataFrame, key: str) -> DataFrame:
    return inventory.select(key, "n_rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


@query("recluster_rows", sql("tx", BY_TYPE.format(key="type", source="tx")))
def recluster_rows(v: Views):
    """The clustered rewrite has every row, in files that exist."""
    path = workspace(v.spark, "clustered")
    lifecycle.recluster(v.tx, path, files=8)
    return _listed(lake.inventory(v.spark.read.schema(v.tx.schema).parquet(path), "type"), "type")


@query("file_inventory_rows", BY_TYPE.format(key="event_type", source="events"))
def file_inventory_rows(v: Views):
    return _listed(lake.inventory(v.table("events"), "event_type"), "event_type")
