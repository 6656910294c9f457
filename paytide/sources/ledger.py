"""The record of loaded slices: what a restarted load skips and a check compares with the table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.sources import lake

Slice = tuple[datetime, datetime]

SCHEMA = (
    "writer STRING, slice_start TIMESTAMP, slice_end TIMESTAMP, batch_id BIGINT, n_rows BIGINT, "
    "key_sum DECIMAL(38,0), hash_sum DECIMAL(38,0), loaded_at TIMESTAMP"
)


def path_of(table: str) -> str:
    """Under the table; its readers skip names that begin with an underscore."""
    return f"{table}/_slices"


def read(spark: SparkSession, table: str, writer: str) -> DataFrame:
    """The newest record of each slice of a writer."""
    path = path_of(table)
    if not lake.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    log = spark.read.schema(SCHEMA).parquet(path).filter(F.col("writer") == writer)
    newest = log.groupBy("slice_start", "slice_end").agg(F.max_by(F.struct(*log.columns), "batch_id").alias("r"))
    return newest.select("r.*")


def book(spark: SparkSession, table: str, writer: str) -> dict[Slice, int]:
    """Batch of each recorded slice; as many entries as slices were ever loaded."""
    return {(r.slice_start, r.slice_end): r.batch_id for r in read(spark, table, writer).collect()}


def record(spark: SparkSession, table: str, entries: list[tuple]) -> None:
    """Append the records of one job: one file, so they appear together or not at all."""
    spark.createDataFrame(entries, SCHEMA).coalesce(1).write.mode("append").parquet(path_of(table))


def refuse_overlaps(slices: list[Slice], known: dict[Slice, int]) -> None:
    """Raise where two slices overlap, or one overlaps another that is recorded with other bounds."""
    everything = sorted({*slices, *known})
    for (a, b), (c, d) in zip(everything, everything[1:], strict=False):
        if c < b:
            raise ValueError(f"slice {a} to {b} overlaps {c} to {d}: load under another writer")
    empty = [s for s in slices if s[0] >= s[1]]
    if empty or len(set(slices)) < len(slices):
        raise ValueError(f"empty or repeated slices: {empty or slices}")
