"""Ordered-neighbour operators: repeated payments and stage durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytide.functions.timing import (
    Instant,
    boundary_seconds,
    last,
    micros_between,
    seconds_between,
    slot_of,
)
from paytide.operators.versions import live

PAYMENT_KEYS = ("amount", "source_account_id", "destination_account_id")


def with_previous(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    at: str,
    order: tuple[str, ...],
    reach_seconds: int,
    carry: dict[str, str],
    slot_seconds: int = 3600,
) -> DataFrame:
    """Add the preceding row's columns (``carry``: new name -> source column).

    The result equals ``lag`` over the whole key for every predecessor at most
    ``reach_seconds`` older; older predecessors may come out null. That limit lets one key
    be cut into time slots that sort apart: each row joins its own slot, and rows within
    reach of the slot's end are also shown to the next one. A key holding a large share of
    the table is then spread over as many tasks as it has slots.
    """
    width = max(slot_seconds, reach_seconds)
    slot = slot_of(F.col(at), width)
    to_end = (slot + 1) * F.lit(width * 1_000_000) - F.unix_micros(at)
    near_end = to_end <= F.lit(reach_seconds * 1_000_000)
    shown = df.withColumn("_own", slot).withColumn(
        "_slot",
        F.explode(
            F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
                F.array(F.col("_own"))
            )
        ),
    )
    ordered = Window.partitionBy(*keys, "_slot").orderBy(at, *order)
    for name, source in carry.items():
        shown = shown.withColumn(name, F.lag(source).over(ordered))
    return shown.filter("_slot = _own").drop("_slot", "_own")


def duplicates_consecutive(
    tx: DataFrame,
    anchor: Instant,
    days: int = 7,
    seconds: int = 300,
    keys: tuple[str, ...] = PAYMENT_KEYS,
) -> DataFrame:
    """Each payment that repeats its predecessor on the same keys within ``seconds``.

    Consecutive pairs only: three equal payments give two rows. Elapsed time counts
    fractions of a second; ties in time are ordered by id.
    """
    recent = tx.filter(last("created_at", f"{days} days", anchor))
    paired = with_previous(
        recent,
        keys,
        "created_at",
        ("id",),
        seconds,
        {"previous_at": "created_at", "previous_id": "id"},
    )
    gap = micros_between("created_at", "previous_at")
    return paired.filter(gap <= seconds * 1_000_000).select(
        "id",
        "previous_id",
        "external_id",
        "amount",
        "created_at",
        "previous_at",
        seconds_between("created_at", "previous_at").alias("seconds_between"),
    )


def fraud_duplicates(
    raw: DataFrame,
    anchor: Instant,
    hours: int = 24,
    window_seconds: int = 300,
    limit: int = 100,
    keys: tuple[str, ...] = PAYMENT_KEYS,
) -> DataFrame:
    """The alerting form over current rows: whole-second distance, newest first, bounded.

    The versioned table is cut to the window before its versions are resolved.
    """
    recent = live(raw.filter(last("created_at", f"{hours} hours", anchor)))
    # a boundary count of N seconds can span just under N + 1 elapsed seconds
    paired = with_previous(
        recent, keys, "created_at", ("tx_id",), window_seconds + 1, {"previous_at": "created_at"}
    )
    apart = boundary_seconds("created_at", "previous_at")
    return (
        paired.filter(apart <= window_seconds)
        .select(
            "external_id",
            "tx_id",
            "amount",
            "created_at",
            "status",
            "source_account_id",
            "destination_account_id",
            "previous_at",
            apart.alias("seconds_apart"),
        )
        .orderBy(F.desc("created_at"), F.desc("tx_id"))
        .limit(limit)
    )


def with_next(
    df: DataFrame, keys: tuple[str, ...], at: str, order: tuple[str, ...], name: str, slot_seconds: int
) -> DataFrame:
    """Add the following row's ``at``, however far away it is.

    Rows are ordered within time slots of their key. The last row of a slot takes the
    first instant of the key's next slot, found from one aggregated row per slot, so that
    a key holding much of the table is still spread over its slots.
    """
    slotted = df.withColumn("_slot", slot_of(F.col(at), slot_seconds))
    firsts = slotted.groupBy(*keys, "_slot").agg(F.min(at).alias("_first"))
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    following = firsts.select(*keys, "_slot", F.lead("_first").over(by_slot).alias("_following"))
    inside = Window.partitionBy(*keys, "_slot").orderBy(at, *order)
    led = slotted.withColumn("_next", F.lead(at).over(inside))
    return (
        led.join(following, [*keys, "_slot"])
        .withColumn(name, F.coalesce("_next", "_following"))
        .select(*df.columns, name)
    )


def stage_durations(
    events: DataFrame, by: str = "tx_id", at: str = "changed_at", slot_seconds: int = 86400
) -> DataFrame:
    """Time spent in each status, from a log with one row per status change."""
    timed = with_next(events, (by,), at, ("seq",), "left_at", slot_seconds)
    return timed.withColumn("seconds_in_stage", seconds_between("left_at", at))
