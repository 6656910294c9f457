"""Joins: reconciliation, dimensions, validity, duplicate pairs and audits."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, interval, last, slot_of
from paytide.operators.windows import PAYMENT_KEYS


def recon_divergences(
    recon: DataFrame,
    tx: DataFrame,
    accounts: DataFrame,
    anchor: Instant,
    days: int = 30,
    eps: str = "0.01",
) -> DataFrame:
    """Reconciliations off by more than ``eps``, with both holders' names.

    The fact side is matched on creation time too: equal for a true match, and it bounds
    the fact scan. The span of the wanted creation times is read first and pushed into
    that scan, so old facts are not read at all; a table with a ``day`` partition on both
    sides is joined on it as well, which prunes partition by partition. Holders are two
    left joins of one dimension.
    """
    off = recon.filter(
        last("reconciled_at", f"{days} days", anchor)
        & (F.abs("difference") > F.lit(Decimal(eps)))
    )
    on = ["transaction_id", "transaction_created_at"]
    by_day = ["day"] if "day" in recon.columns and "day" in tx.columns else []
    span = (
        F.col("created_at") >= off.agg(F.min("transaction_created_at")).scalar()
    ) & (F.col("created_at") <= off.agg(F.max("transaction_created_at")).scalar())
    t = tx.filter(span).select(
        *by_day,
        F.col("id").alias("transaction_id"),
        F.col("created_at").alias("transaction_created_at"),
        "external_id",
        "type",
        "source_account_id",
        "destination_account_id",
    )
    origin = accounts.select(
        F.col("id").alias("source_account_id"), F.col("holder_name").alias("origin")
    )
    destination = accounts.select(
        F.col("id").alias("destination_account_id"), F.col("holder_name").alias("destination")
    )
    return (
        off.join(t, on + by_day)
        .join(origin, "source_account_id", "left")
        .join(destination, "destination_account_id", "left")
        .select(
            "id",
            "external_reference",
            "amount_expected",
            "amount_received",
            "difference",
            "external_id",
            "type",
            "origin",
            "destination",
        )
    )


def accounts_by_institution(
    institutions: DataFrame, accounts: DataFrame, users: DataFrame
) -> DataFrame:
    """Account counts and balances per active institution; every institution appears.

    The user's status belongs to the join condition: as a filter it would drop accounts.
    Accounts are first reduced per institution and user, which also settles the distinct
    count without an expanded aggregate.
    """
    active_users = users.filter(F.col("status") == "active").select(F.col("id").alias("user_id"))
    is_active, is_blocked = F.col("status") == "active", F.col("status") == "blocked"
    per_user = accounts.groupBy("institution_id", "user_id").agg(
        F.count_if(is_active).alias("active"),
        F.count_if(is_blocked).alias("blocked"),
        F.sum(F.when(is_active, F.col("balance"))).alias("balance"),
        F.count(F.when(is_active, F.col("balance"))).alias("balance_n"),
    )
    known = per_user.join(active_users.withColumn("known", F.lit(True)), "user_id", "left")
    per_institution = known.groupBy(F.col("institution_id").alias("id")).agg(
        F.sum("active").alias("active_accounts"),
        F.sum("blocked").alias("blocked_accounts"),
        F.sum("balance").alias("total_balance"),
        F.sum("balance_n").alias("balance_n"),
        F.count_if("known").alias("distinct_users"),
    )
    return (
        institutions.filter("is_active")
        .join(per_institution, "id", "left")
        .select(
            "code",
            "name",
            F.coalesce("active_accounts", F.lit(0)).alias("active_accounts"),
            F.coalesce("blocked_accounts", F.lit(0)).alias("blocked_accounts"),
            "total_balance",
            (F.col("total_balance").cast("double") / F.nullif("balance_n", F.lit(0))).alias(
                "mean_balance"
            ),
            F.coalesce("distinct_users", F.lit(0)).alias("distinct_users"),
        )
        .orderBy(F.desc_nulls_last("total_balance"), "code")
    )


def valid_at(at: Instant) -> Column:
    """Validity predicate of a slowly changing row: from inclusive, until exclusive."""
    return (F.col("effective_from") <= instant(at)) & (
        F.col("effective_until").isNull() | (F.col("effective_until") > instant(at))
    )


def current_config(
    institutions: DataFrame, configs: DataFrame, at: Instant, keys: list[str]
) -> DataFrame:
    current = configs.filter(valid_at(at) & F.col("config_key").isin(keys))
    return (
        institutions.filter("is_active")
        .select(F.col("id").alias("institution_id"), "code", "name")
        .join(current, "institution_id")
        .select("code", "name", "config_key", "config_value", "value_type")
    )


def config_as_of_row(tx: DataFrame, institutions: DataFrame, configs: DataFrame, key: str) -> DataFrame:
    """Each transaction with the value of one config key valid when it was created."""
    history = (
        configs.filter(F.col("config_key") == key)
        .join(institutions.select(F.col("id").alias("institution_id"), "code"), "institution_id")
        .select("code", "config_value", "effective_from", "effective_until")
    )
    return tx.join(
        history, (tx["source_institution"] == history["code"]) & valid_at(tx["created_at"]), "left"
    )


def duplicate_pairs(
    tx: DataFrame,
    anchor: Instant,
    days: int = 7,
    seconds: int = 300,
    keys: tuple[str, ...] = PAYMENT_KEYS,
) -> DataFrame:
    """Every pair on the same keys at most ``seconds`` apart, lower id first in the pair.

    A range join on equal keys and time slots: the later row has one slot, the earlier row
    looks into its own and, if its reach crosses the edge, the next. Only rows of adjacent
    slots meet, so work follows the output, and a hot key is split by time.
    """
    width = 2 * seconds
    rows = tx.filter(last("created_at", f"{days} days", anchor)).select(
        "id", "amount", "created_at", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    )
    slot = slot_of(F.col("created_at"), width)
    reach = slot_of(F.col("created_at") + interval(f"{seconds} seconds"), width)
    a = rows.withColumn("_slot", F.explode(F.array_distinct(F.array(slot, reach)))).alias("a")
    b = rows.withColumn("_slot", slot).alias("b")
    same = reduce(
        lambda x, y: x & y,
        [F.col(f"a._k{i}") == F.col(f"b._k{i}") for i in range(len(keys))],
        F.col("a._slot") == F.col("b._slot"),
    )
    near = (
        (F.col("b.created_at") >= F.col("a.created_at"))
        & (F.col("b.created_at") <= F.col("a.created_at") + interval(f"{seconds} seconds"))
        & (F.col("a.id") < F.col("b.id"))
    )
    return a.join(b, same & near).select(
        F.col("a.id").alias("id_a"),
        F.col("b.id").alias("id_b"),
        F.col("a.amount").alias("amount"),
        F.col("a.created_at").alias("created_at_a"),
        F.col("b.created_at").alias("created_at_b"),
    )


def lookup(df: DataFrame, dim: DataFrame, code: str, attribute: str, default: Column) -> DataFrame:
    """Attribute by code, or ``default`` for a code the dimension lacks.

    Spark broadcasts the dimension when its measured size is under the threshold and
    shuffles otherwise; there is no hint to outgrow.
    """
    found = dim.select(F.col("code").alias("_code"), F.col(attribute).alias("_found"))
    return (
        df.join(found, F.col(code) == F.col("_code"), "left")
        .withColumn(f"{code}_{attribute}", F.coalesce("_found", default))
        .drop("_code", "_found")
    )


def dict_coverage(tx: DataFrame, dim: DataFrame, code: str = "source_institution") -> DataFrame:
    """How many rows resolve in the dimension. Rows are counted per code before the join."""
    per_code = tx.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"))
    known = dim.select("code").withColumn("known", F.lit(True))
    return per_code.join(known, "code", "left").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("resolved"),
        F.count("*").alias("codes"),
        F.count_if("known").alias("codes_resolved"),
    )


def expand_configs(institutions: DataFrame, at: Instant, revisions: int = 8) -> DataFrame:
    """Config history: four keys per institution, ``revisions`` back, 45 days each.

    Revision 1 is open-ended; numeric values drift by revision.
    """
    i, revision = F.col("id"), F.col("revision")
    # fixed values: keys, value formulas and the revision length of the reference data
    fee = (F.lit(Decimal("0.10")) + (i % 5) * F.lit(Decimal("0.05"))).cast("decimal(12,2)")
    windows = F.array(F.lit("D+0"), F.lit("D+1"), F.lit("D+2"))
    drift = F.lit(Decimal("0.90")) + revision * F.lit(Decimal("0.01"))

    def numeric(key: str, base: Column, scale: int) -> Column:
        drifted = (base * drift).cast(f"decimal(20,{scale + 2})").cast("string")
        return F.struct(
            F.lit(key).alias("config_key"),
            F.when(revision == 1, base.cast("string")).otherwise(drifted).alias("config_value"),
            F.lit("numeric").alias("value_type"),
        )

    keys = F.array(
        numeric("daily_limit", (5000 + (i * 137) % 45000).cast("decimal(12,0)"), 0),
        numeric("pix_fee", fee, 2),
        F.struct(
            F.lit("settlement_window").alias("config_key"),
            F.element_at(windows, (i % 3 + 1).cast("int")).alias("config_value"),
            F.lit("string").alias("value_type"),
        ),
        numeric("max_tx_amount", (100000 + (i * 977) % 900000).cast("decimal(12,0)"), 0),
    )
    begins = instant(at) - F.make_dt_interval(days=(revision - 1) * 45)
    ends = instant(at) - F.make_dt_interval(days=(revision - 2) * 45)
    return (
        institutions.select(i, F.explode(F.sequence(F.lit(1), F.lit(revisions))).alias("revision"))
        .select(i, "revision", F.explode(keys).alias("k"))
        .select(
            i.alias("institution_id"),
            "k.config_key",
            "k.config_value",
            "k.value_type",
            "revision",
            begins.alias("effective_from"),
            F.when(revision > 1, ends).alias("effective_until"),
        )
    )


def partitions_with_key(parts: DataFrame, tx: DataFrame, key: Column) -> DataFrame:
    """Partitions ``[range_start, range_end)`` holding at least one row matched by ``key``.

    Partitions may have any width and alignment. Each is spread over the days it covers, and
    meets the distinct times of the matching rows day by day, so no partition is compared with
    rows outside its days. An empty range holds nothing.
    """
    last = F.col("range_end") - F.expr("INTERVAL 1 MICROSECOND")
    days = F.explode(F.sequence(F.to_date("range_start"), F.to_date(last)))
    spread = parts.filter(F.col("range_start") < F.col("range_end")).select("range_start", "range_end", days.alias("_day"))
    times = tx.filter(key).select(F.to_date("created_at").alias("_at_day"), F.col("created_at").alias("_at")).distinct()
    inside = (
        (spread["_day"] == times["_at_day"])
        & (times["_at"] >= spread["range_start"])
        & (times["_at"] < spread["range_end"])
    )
    touched = spread.join(times, inside, "left_semi").select("range_start", "range_end").distinct()
    return parts.join(touched, ["range_start", "range_end"], "left_semi")


def diff_aggregates(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full outer comparison of two aggregates; rows that differ in any value."""
    a = left.select(*keys, *[F.col(v).alias(f"{v}_left") for v in values])
    b = right.select(*keys, *[F.col(v).alias(f"{v}_right") for v in values])
    differs = reduce(
        lambda x, y: x | y, [~F.col(f"{v}_left").eqNullSafe(F.col(f"{v}_right")) for v in values]
    )
    return a.join(b, keys, "full_outer").withColumn("differs", differs)


def diff_counts(source: DataFrame, target: DataFrame, bucket: Column, name: str) -> DataFrame:
    """Row counts of two tables per bucket, side by side."""
    a = source.groupBy(bucket.alias(name)).agg(F.count("*").alias("source_rows"))
    b = target.groupBy(bucket.alias(name)).agg(F.count("*").alias("target_rows"))
    return a.join(b, name, "full_outer").select(
        name,
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        (~F.col("source_rows").eqNullSafe(F.col("target_rows"))).alias("differs"),
    )


def orphans(target: DataFrame, source: DataFrame, target_key: str, source_key: str) -> DataFrame:
    """Target rows whose source row is gone: deletes a watermark cannot see."""
    have = source.select(F.col(source_key).alias("_have"))
    return target.join(have, F.col(target_key) == F.col("_have"), "left_anti")
