"""Stored aggregates of one scale folder, as a service would keep them.

The registered queries derive every aggregate from the rows, so that their results can be
checked alone. In use, aggregates are written once, refreshed by bucket, and read: this
module does that, and the bench times both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, month_key
from paytide.operators import aggregates as agg
from paytide.operators import invalidation, refresh, states
from paytide.plans.views import Views
from paytide.session import staged
from paytide.sources import lake


@dataclass(frozen=True)
class Aggregate:
    """How one stored aggregate is built, and its bucket."""

    build: Callable[[DataFrame], DataFrame]
    bucket: str
    unit: str


AGGREGATES = {
    "volume_hourly": Aggregate(agg.volume_hourly, "bucket", "hour"),
    "latency_daily": Aggregate(agg.latency_daily, "bucket", "day"),
    "status_funnel": Aggregate(states.funnel_states, "hour", "hour"),
    "daily_by_institution": Aggregate(states.daily_states, "day", "day"),
}


@dataclass(frozen=True)
class Mirror:
    spark: SparkSession
    root: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    @property
    def hourly(self) -> DataFrame:
        return self._read("volume_hourly")

    @property
    def latency(self) -> DataFrame:
        return self._read("latency_daily")

    @property
    def funnel(self) -> DataFrame:
        return self._read("status_funnel")

    @property
    def daily(self) -> DataFrame:
        return self._read("daily_by_institution")

    @property
    def current(self) -> DataFrame:
        return self._read("transactions_by_day")

    @property
    def dictionary(self) -> DataFrame:
        return self._read("institutions")

    def build(self, v: Views) -> Mirror:
        """Write the aggregates and the current rows, clustered by day."""
        def put(df: DataFrame, name: str, bucket: str) -> None:
            part = df.withColumn("yyyymm", month_key(bucket))
            lake.replace_partitions(part, f"{self.root}/{name}", "yyyymm")

        by_day = v.final.withColumn("day", F.to_date("created_at"))
        ordered = by_day.repartitionByRange("day", "source_institution", "type", "created_at")
        lake.replace_partitions(
            ordered.sortWithinPartitions("day", "source_institution", "type", "created_at"),
            f"{self.root}/transactions_by_day",
            "day",
        )
        current = self.current
        put(agg.volume_hourly(v.tx), "volume_hourly", "bucket")
        put(agg.latency_daily(v.tx), "latency_daily", "bucket")
        put(states.funnel_states(current), "status_funnel", "hour")
        put(states.daily_states(current), "daily_by_institution", "day")
        v.dictionary.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/institutions")
        return self

    @property
    def touched(self) -> str:
        """Log of buckets whose rows changed after they were materialised."""
        return f"{self.root}/touched_buckets"

    def _replace(self, name: str, rows: DataFrame, spans: list[invalidation.Span]) -> None:
        """Recompute the buckets of some ranges; months without one of them are not opened."""
        a, path = AGGREGATES[name], f"{self.root}/{name}"
        fresh = a.build(rows.filter(invalidation.inside(F.col("created_at"), spans))).withColumn("yyyymm", month_key(a.bucket))
        months = sorted({s.year * 100 + s.month for s, _ in spans})
        have = set(map(int, lake.partitions(self.spark, path, "yyyymm")))
        if have & set(months):
            old = self._read(name).filter(F.col("yyyymm").isin(months))
            fresh = old.filter(~invalidation.inside(F.col(a.bucket).cast("timestamp"), spans)).unionByName(fresh)
        with staged(fresh, name) as whole:
            lake.replace_range(whole, path, "yyyymm", months)

    def note_late(self, rows: DataFrame, batch_id: int, name: str = "volume_hourly", writer: str = "stream") -> None:
        """Log the buckets that rows fall into below what the aggregate holds; call it with every batch."""
        a = AGGREGATES[name]
        mark = refresh.materialized_until(self._read(name).withColumnRenamed(a.bucket, "bucket"), a.unit)
        invalidation.log_touched(invalidation.touched(rows, "hour", mark), self.touched, batch_id, writer)

    def refresh_touched(self, rows: DataFrame, *names: str) -> dict[str, int]:
        """Recompute the logged buckets of the named aggregates (all without); returns the ranges of each."""
        log, taken = invalidation.pending(self.spark, self.touched)
        done = {}
        for name in (names or AGGREGATES) if taken else ():
            found = invalidation.spans(log, AGGREGATES[name].unit)
            self._replace(name, rows, found)
            done[name] = len(found)
        lake.drop_batches(self.spark, self.touched, taken)
        return done

    def missing(self, name: str, rows: DataFrame, cut: Instant) -> DataFrame:
        """Buckets that the source has rows in, whole before the cut, and the stored aggregate has not.

        Only the time column of the source and the bucket column of the aggregate are read.
        """
        a = AGGREGATES[name]
        buckets = rows.filter(F.col("created_at") < F.date_trunc(a.unit, instant(cut))).select(F.date_trunc(a.unit, "created_at").alias("bucket"))
        if not lake.partitions(self.spark, f"{self.root}/{name}", "yyyymm"):
            return buckets.distinct()
        return buckets.distinct().join(self._read(name).select(F.col(a.bucket).cast("timestamp").alias("bucket")), "bucket", "left_anti")

    def backfill(self, name: str, rows: DataFrame, cut: Instant) -> int:
        """Fill the buckets before the cut that the aggregate lacks; returns how many. Filled ones are not touched.

        Without a missing bucket nothing is written, so it can be called until it returns 0.
        """
        with staged(self.missing(name, rows, cut), "missing") as buckets:
            count = buckets.count()
            if count:
                # a range holds missing buckets alone; months' hulls hold filled ones too, which come out the same
                whole = rows.filter(F.col("created_at") < F.date_trunc(AGGREGATES[name].unit, instant(cut)))
                self._replace(name, whole, invalidation.spans(buckets, AGGREGATES[name].unit))
            return count

    def refresh_hourly(self, tx: DataFrame, start: Instant, end: Instant) -> None:
        """Recompute the whole buckets of a range in the stored hourly partials.

        The months touched are rewritten through a staging folder; one that has no rows left
        goes. Other months stay.
        """
        first, until = refresh.whole_buckets(start, end, "hour")
        months = (F.col("yyyymm") >= month_key(first)) & (F.col("yyyymm") <= month_key(until))
        kept = self.hourly.filter(months)
        merged = refresh.refresh(
            kept.drop("yyyymm"), tx, start, end, "hour", agg.volume_hourly
        ).withColumn("yyyymm", month_key("bucket"))
        touched = [r[0] for r in kept.select("yyyymm").distinct().collect()]
        with staged(merged, "hourly") as whole:
            lake.replace_range(whole, f"{self.root}/volume_hourly", "yyyymm", touched)
