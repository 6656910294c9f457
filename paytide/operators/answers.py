"""Answers as JSON documents, for a service to hand on as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant

#: Rows a document may list at most: it is one string, built in one task.
MOST_ROWS = 1000

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WITH_NULLS = {"ignoreNullFields": "false"}


def stamp(at: Column | str) -> Column:
    return F.date_format(at, STAMP)


def document(
    rows: DataFrame, order: list[Column], columns: list[str], limit: int = MOST_ROWS, **head: Column
) -> DataFrame:
    """One row, ``payload``: the fields of ``head``, then ``data``, the first ``limit`` rows in ``order``.

    The rows are limited where they lie, before any of them is gathered. Without rows ``data`` is an
    empty list. A head field may count what is listed with ``F.size("data")``. Nulls are written out.
    """
    if not 1 <= limit <= MOST_ROWS:
        raise ValueError(f"a document lists 1 to {MOST_ROWS} rows, not {limit}")
    place = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)])
    first = rows.select(place.alias("_o"), F.struct(*columns).alias("_r")).orderBy("_o", "_r").limit(limit)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_o", "_r"))), lambda r: r["_r"])
    fields = [value.alias(name) for name, value in head.items()]
    return first.agg(listed.alias("data")).select(
        F.to_json(F.struct(*fields, "data"), WITH_NULLS).alias("payload")
    )


def duplicates_answer(
    hits: DataFrame, hours: int, window_seconds: int, anchor: Instant, limit: int = 100
) -> DataFrame:
    """Suspected repeats (``windows.fraud_duplicates``) as one document, newest first."""
    rows = hits.select(
        "external_id",
        "tx_id",
        "amount",
        stamp("created_at").alias("created_at"),
        "status",
        "source_account_id",
        "destination_account_id",
        stamp("previous_at").alias("previous_at"),
        "seconds_apart",
        F.unix_micros("created_at").alias("_at"),
    )
    return document(
        rows,
        [-F.col("_at"), -F.col("tx_id")],
        [c for c in rows.columns if c != "_at"],
        limit,
        window=F.lit(f"{hours}h"),
        duplicate_window_seconds=F.lit(window_seconds),
        anchor=stamp(instant(anchor)),
        count=F.size("data"),
    )


def health_answers(
    health: DataFrame, hours: int, anchor: Instant, p95: DataFrame | None = None
) -> DataFrame:
    """Routing health (``states.institution_health``), one document per institution.

    An institution without traffic has none. ``p95`` brings exact percentiles (``institution``,
    ``p95_settlement_seconds``); else the value of the sketches is taken, or null where there are none.
    """
    name = "p95_settlement_seconds"
    rows = health if p95 is None else health.drop(name).join(p95, "institution", "left")
    if name not in rows.columns:
        rows = rows.withColumn(name, F.lit(None))

    def ratio(c: str) -> Column:
        return F.col(c).cast("decimal(5,4)").alias(c)

    def seconds(c: str) -> Column:
        return F.round(F.col(c).cast("double"), 3).cast("decimal(18,3)").alias(c)

    fields = F.struct(
        "institution",
        "institution_name",
        F.lit(f"{hours}h").alias("window"),
        stamp(instant(anchor)).alias("anchor"),
        "total",
        "settled",
        "failed",
        ratio("success_rate"),
        ratio("failure_rate"),
        seconds(name),
        seconds("avg_settlement_seconds"),
    )
    return rows.select("institution", F.to_json(fields, WITH_NULLS).alias("payload"))
