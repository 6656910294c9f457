"""The payments tables, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import aligned_cut, as_of, interval, seconds_between
from paytide.operators import joins, quality, states, versions
from paytide.sources import bulk, reference
from paytide.sources.tables import read_table

CONFIG_KEYS = ("daily_limit", "pix_fee", "settlement_window", "max_tx_amount")
TYPES = ("click", "view", "purchase", "signup", "error")


def _plus_millis(at: Column, millis: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(at) + millis * 1000)


def transactions(events: DataFrame) -> DataFrame:
    """``events`` as transactions; works on a stream as well."""
    k = F.expr("CAST(substr(props, 7, length(props) - 7) AS INT)")
    millis = F.round(F.col("value") * 1000).cast("long")
    status = (
        F.when(k < 4, "failed").when(k < 6, "pending").when(k < 7, "reversed").otherwise("settled")
    )
    settled = F.when(k >= 6, _plus_millis(F.col("ts"), millis))

    def institution(number: Column) -> Column:
        return F.lpad((number % 15).cast("string"), 3, "0")

    return events.select(
        F.col("event_id").alias("id"),
        F.md5(F.col("event_id").cast("string")).alias("external_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.lit("BRL").alias("currency"),
        status.alias("status"),
        F.col("event_type").alias("type"),
        institution(F.col("user_id")).alias("source_institution"),
        institution(F.col("user_id") * 7 + k).alias("destination_institution"),
        F.col("user_id").alias("source_account_id"),
        ((F.col("user_id") + 1 + k) % 15).alias("destination_account_id"),
        F.col("ts").alias("created_at"),
        settled.alias("settled_at"),
        F.coalesce(settled, F.col("ts")).alias("updated_at"),
        F.col("props").alias("metadata"),
        k.alias("k"),
    )


def with_versions(tx: DataFrame) -> DataFrame:
    """Every version each transaction went through: pending when created, then its final
    state. The final version of some is a delete."""
    steps = F.when(F.col("status") == "pending", F.array(F.lit(1))).otherwise(
        F.array(F.lit(0), F.lit(1))
    )
    initial = F.col("step") == 0
    seen = tx.withColumn("step", F.explode(steps))
    as_seen = (
        seen.withColumn("updated_at", F.when(initial, F.col("created_at")).otherwise(F.col("updated_at")))
        .withColumn("settled_at", F.when(~initial, F.col("settled_at")))
        .withColumn("status", F.when(initial, "pending").otherwise(F.col("status")))
    )
    delay = F.when(initial, F.lit(1000)).otherwise(F.lit(2000))
    gone = F.when(~initial & (F.col("id") % 97 == 0), 1).otherwise(0)
    ingested = _plus_millis(F.col("updated_at"), delay)
    return bulk.to_raw(as_seen, ingested, gone)


class Views:
    """Lazy views over one scale folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    @cached_property
    def tx(self) -> DataFrame:
        return transactions(self.table("events"))

    @cached_property
    def as_of(self) -> Column:
        """Newest creation instant, read from the one column it needs."""
        return as_of(self.table("events").select(F.col("ts").alias("created_at")))

    @cached_property
    def raw(self) -> DataFrame:
        return with_versions(self.tx)

    @cached_property
    def live(self) -> DataFrame:
        return versions.live(self.raw)

    @cached_property
    def final(self) -> DataFrame:
        return versions.final(self.raw)

    @cached_property
    def recon(self) -> DataFrame:
        """One reconciliation per settled or reversed transaction, some of them off."""
        i = F.col("id")
        off = F.when(i % 91 == 0, ((i % 1001) - 500).cast("decimal(18,2)") / 100).otherwise(0)
        return quality.with_difference(
            self.tx.filter(F.col("status").isin("settled", "reversed")).select(
                "id",
                i.alias("transaction_id"),
                F.col("created_at").alias("transaction_created_at"),
                F.col("external_id").alias("external_reference"),
                F.lit("settlement").alias("event_type"),
                F.col("amount").alias("amount_expected"),
                (F.col("amount") + off).cast("decimal(18,2)").alias("amount_received"),
                (F.col("created_at") + F.make_dt_interval(mins=(i % 480).cast("int"))).alias(
                    "reconciled_at"
                ),
            )
        )

    @cached_property
    def accounts(self) -> DataFrame:
        i = F.col("c_custkey")
        return self.table("customer").select(
            i.alias("id"),
            F.lpad(i.cast("string"), 10, "0").alias("account_number"),
            F.lpad((F.col("c_nationkey") % 15).cast("string"), 3, "0").alias("institution_code"),
            F.lpad((i * 97 + 12345678).cast("string"), 11, "0").alias("holder_document"),
            F.col("c_name").alias("holder_name"),
            F.when(i % 50 == 0, "blocked").when(i % 50 == 1, "closed").otherwise("active").alias(
                "status"
            ),
        )

    @cached_property
    def institutions(self) -> DataFrame:
        i = F.col("n_nationkey")
        kinds = F.array(F.lit("bank"), F.lit("fintech"), F.lit("broker"))
        return self.table("nation").select(
            i.alias("id"),
            F.lpad(i.cast("string"), 3, "0").alias("code"),
            F.col("n_name").alias("name"),
            F.substring("n_name", 1, 8).alias("short_name"),
            F.element_at(kinds, (i % 3 + 1).cast("int")).alias("inst_type"),
            (i != 14).alias("is_active"),
            F.timestamp_seconds(F.lit(1704067200) + i).alias("updated_at"),
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        """The dictionary, lacking one code so that defaults and coverage are exercised."""
        return reference.load_institutions(self.institutions.filter(F.col("code") != "013"))

    @cached_property
    def configs(self) -> DataFrame:
        return joins.expand_configs(self.institutions, self.as_of)

    @cached_property
    def legacy_users(self) -> DataFrame:
        i = F.col("c_custkey")
        return self.table("customer").select(
            i.alias("id"), F.when(i % 50 == 0, "blocked").otherwise("active").alias("status")
        )

    @cached_property
    def legacy_accounts(self) -> DataFrame:
        i = F.col("o_orderkey")
        return self.table("orders").select(
            i.alias("id"),
            F.col("o_custkey").alias("user_id"),
            (i % 25).cast("int").alias("institution_id"),
            F.when(i % 40 == 0, "blocked").otherwise("active").alias("status"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("balance"),
        )

    @cached_property
    def funnel(self) -> DataFrame:
        return states.funnel_states(self.final)

    @cached_property
    def daily(self) -> DataFrame:
        return states.daily_states(self.final)

    def _resolved_since(self, window: str, unit: str) -> DataFrame:
        cut = aligned_cut(self.as_of, window, unit)
        return versions.final(self.raw.filter(F.col("created_at") >= cut))

    def funnel_since(self, window: str, sketch: bool = False) -> DataFrame:
        """Funnel states of the last whole hours only: the cut is on the raw column, ahead
        of version resolution."""
        return states.funnel_states(self._resolved_since(window, "hour"), sketch)

    def daily_since(self, window: str) -> DataFrame:
        return states.daily_states(self._resolved_since(window, "day"))

    @cached_property
    def status_log(self) -> DataFrame:
        """Status changes of each transaction, one row per change."""
        return self.raw.select(
            "tx_id",
            "type",
            "status",
            F.timestamp_millis("_version").alias("changed_at"),
            F.when(F.col("status") == "pending", 0).otherwise(1).alias("seq"),
        )

    @cached_property
    def lag_samples(self) -> DataFrame:
        """Gauge and success-time samples per institution: settlement lag of each payment."""
        return self._samples(
            {
                "sync_lag_seconds": F.coalesce(
                    seconds_between("settled_at", "created_at").cast("double"), F.lit(0.0)
                ),
                "sync_last_success_timestamp": F.floor(
                    F.unix_seconds("created_at") - F.col("k") * 20
                ).cast("double"),
            }
        )

    def _samples(self, metrics: dict[str, Column]) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics.items()]
        )
        return self.tx.select(
            F.col("created_at").alias("ts"),
            F.create_map(F.lit("source"), F.col("source_institution")).alias("labels"),
            F.inline(entries),
        )

    @cached_property
    def counter_samples(self) -> DataFrame:
        """An error counter per type, sampled each hour, that restarts every midnight."""
        from pyspark.sql import Window

        hourly = self.tx.groupBy(
            F.date_trunc("hour", "created_at").alias("ts"), "type"
        ).agg(F.count_if(F.col("k") < 50).alias("n"))
        day = Window.partitionBy("type", F.to_date("ts")).orderBy("ts")
        return hourly.select(
            "ts",
            F.lit("sync_errors_total").alias("metric"),
            F.create_map(F.lit("type"), F.col("type")).alias("labels"),
            F.sum("n").over(day).cast("double").alias("value"),
        )

    def visible_at(self, tx: DataFrame) -> Column:
        """When a row's commit became visible: up to 16.5 hours after its change."""
        return F.col("updated_at") + F.make_dt_interval(mins=F.col("k") * 10)

    def ago(self, text: str) -> Column:
        return self.as_of - interval(text)
