"""Versioned rows: newest version per key, compaction and purge of old versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytide.operators import compaction
from paytide.sources.tables import STORED_SCHEMA

# Status is mutable and stays out of the key: a status change must replace, not add.
KEY = ("type", "source_institution", "hour", "external_id")


def _with_key(raw: DataFrame) -> DataFrame:
    return raw.withColumn("hour", F.date_trunc("hour", "created_at"))


def latest(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    version: str = "_version",
    ties: tuple[str, ...] = ("_ingested_at",),
) -> DataFrame:
    """The row with the highest version per key; equal versions go to the last ingested.

    Spark keeps one row per key on the map side (a group limit before the exchange), so a
    key with very many versions is reduced before it moves.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (version, *ties)])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def final(raw: DataFrame) -> DataFrame:
    """One row per transaction, tombstones included."""
    return latest(_with_key(raw), KEY).drop("hour")


def live(raw: DataFrame) -> DataFrame:
    """Current rows only. Callers cut ``raw`` to their time span first: a transaction's
    creation time is the same in all its versions, so no version is lost, and the history
    outside the span is never resolved.
    The delete flag is read after versions are resolved: filtering
    first would bring back the older version of a deleted row."""
    return final(raw).filter(F.col("_is_deleted") == 0)


def final_vs_physical(raw: DataFrame) -> DataFrame:
    """Physical versions against logical rows, by type."""
    per_key = _with_key(raw).groupBy(*KEY).agg(F.count("*").alias("versions"))
    return per_key.groupBy("type").agg(
        F.sum("versions").alias("physical_rows"),
        F.count("*").alias("logical_rows"),
        F.max("versions").alias("max_versions"),
    )


def purge_old_versions(raw: DataFrame, touched: Column) -> DataFrame:
    """Physically remove superseded versions, but only of the keys ``touched`` marks.

    The newest version per key is an aggregate, combined before it moves, and is joined
    back; a key with very many versions is then split by the skewed-join rule instead of
    being buffered whole.
    """
    keyed = _with_key(raw)
    top = (
        keyed.groupBy(*KEY)
        .agg(F.max("_version").alias("_top"), F.max(touched.cast("int")).alias("_hit"))
        .filter(F.col("_hit") == 1)
        .drop("_hit")
    )
    kept = F.col("_top").isNull() | (F.col("_version") == F.col("_top"))
    return keyed.join(top, list(KEY), "left").filter(kept).select(*raw.columns)


def purge_stored_versions(spark: SparkSession, path: str, touched: Column) -> list[int]:
    """Remove superseded versions of the ``touched`` keys from a stored table; returns the months rewritten.

    Only months that hold such a version are read again. What is left of them becomes the merged
    batch of the month, committed as one (see ``compaction``), so readers see a month either before or after.
    """
    table = compaction.rows(spark, path, STORED_SCHEMA)
    keyed = _with_key(table.select(*KEY[:2], "created_at", KEY[3], "_version", "yyyymm", touched.cast("int").alias("_hit")))
    spans = keyed.groupBy(*KEY, "yyyymm").agg(F.max("_hit").alias("_hit"), F.min("_version").alias("a"), F.max("_version").alias("b"))
    months = sorted(r.yyyymm for r in spans.filter("_hit = 1 AND a < b").select("yyyymm").distinct().collect())
    if months:
        compaction.compact(spark, path, STORED_SCHEMA, lambda df: purge_old_versions(df, touched), parts=months, again=True)
    return months


def compact(spark: SparkSession, path: str, months: list[int] | None = None, leave: int = 0) -> int:
    """Rewrite the months (all without) to one version per key, while other jobs append; see ``compaction``."""
    return compaction.compact(spark, path, STORED_SCHEMA, final, parts=months, leave=leave)
