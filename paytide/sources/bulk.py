"""Sliced bulk load of transactions into the versioned table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import interval, month_key
from paytide.operators import compaction
from paytide.operators.aggregates import partition_checksum
from paytide.sources import lake, ledger
from paytide.sources.ledger import Slice
from paytide.sources.tables import STORED_SCHEMA


def month_slices(first: date, until: date) -> list[tuple[date, date]]:
    """Half-open month slices covering ``[first, until)``."""
    slices, start = [], first.replace(day=1)
    while start < until:
        end = date(start.year + start.month // 12, start.month % 12 + 1, 1)
        slices.append((start, end))
        start = end
    return slices


def day_slices(first: date, until: date) -> list[tuple[date, date]]:
    """Half-open day slices covering ``[first, until)``."""
    days = (until - first).days
    return [(first + timedelta(days=i), first + timedelta(days=i + 1)) for i in range(days)]


def read_jdbc_slices(
    spark: SparkSession, url: str, table: str, slices: list[tuple[date, date]], properties: dict
) -> DataFrame:
    """One JDBC partition per slice, so no slice is read twice and each task is retryable.

    Give ``day_slices`` where a month is more than one task should read.
    """
    predicates = [f"created_at >= '{a}' AND created_at < '{b}'" for a, b in slices]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def settlement_seconds() -> Column:
    """Whole milliseconds between creation and settlement, in seconds; null if unsettled."""
    millis = F.unix_millis("settled_at") - F.unix_millis("created_at")
    return (millis / F.lit(1000.0)).cast("double")


def to_raw(
    tx: DataFrame, ingested_at: Column | None = None, deleted: Column | None = None
) -> DataFrame:
    """Source row to versioned row: version is the change time in milliseconds."""
    return tx.select(
        F.col("external_id"),
        F.col("id").alias("tx_id"),
        "created_at",
        "settled_at",
        "type",
        "status",
        "amount",
        "currency",
        "source_institution",
        "destination_institution",
        F.coalesce("source_account_id", F.lit(0).cast("long")).alias("source_account_id"),
        F.coalesce("destination_account_id", F.lit(0).cast("long")).alias("destination_account_id"),
        settlement_seconds().alias("settlement_seconds"),
        F.coalesce("metadata", F.lit("{}")).alias("metadata"),
        F.unix_millis("updated_at").alias("_version"),
        (F.lit(0) if deleted is None else deleted).alias("_is_deleted"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
        month_key("created_at").alias("yyyymm"),
    )


def _sliced(tx: DataFrame, numbered: dict[Slice, int]) -> DataFrame:
    """Rows of the slices in versioned form, each with the batch of its slice.

    Slices meet rows by day, so neither their number nor their width matters.
    """
    spark = tx.sparkSession
    bounds = spark.createDataFrame([(a, b, n) for (a, b), n in numbered.items()], "_from TIMESTAMP, _until TIMESTAMP, batch_id BIGINT")
    days = F.sequence(F.to_date("_from"), F.to_date(F.col("_until") - interval("1 microsecond")))
    bounds = bounds.withColumn("_day", F.explode(days))
    span = (F.col("created_at") >= F.lit(min(a for a, _ in numbered))) & (F.col("created_at") < F.lit(max(b for _, b in numbered)))
    raw = to_raw(tx.filter(span))
    inside = (F.to_date("created_at") == F.col("_day")) & (F.col("created_at") >= F.col("_from")) & (F.col("created_at") < F.col("_until"))
    return raw.join(bounds, inside).select(*raw.columns, "batch_id")


def checksums(raw: DataFrame) -> DataFrame:
    """Rows, key sum and hash sum of each batch, free of order; load times are left out."""
    columns = [c for c in raw.columns if c not in ("_ingested_at", "writer", "batch_id")]
    return partition_checksum(raw, F.col("batch_id"), "batch_id", "tx_id", *columns)


def bulk_load(
    tx: DataFrame,
    path: str,
    slices: list[Slice],
    writer: str = "load",
    resume: bool = False,
    slices_a_job: int | None = None,
    beside: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> list[Slice]:
    """Load slices of any width into the table that streams and polls write, as batches of ``writer``.

    A slice is one batch; ``slices_a_job`` of them (all without) are written by one Spark job. After
    each job its rows are read back and recorded in the ledger under the table, with their number and
    checksums, which ``verify`` compares with the table and the source later on. ``beside`` names tables that are
    derived from the rows just written, by batch; a slice is recorded when they have it too.

    With ``resume`` recorded slices are skipped: a load that was stopped goes on where it was.
    Without, they are loaded again under a new batch, and the old one goes, rows that left the
    source included; until then readers see both, which ``final`` resolves. What a stopped load left
    without a record goes first. Slices must not overlap each other or recorded ones. Returns the
    slices loaded.
    """
    spark, tables = tx.sparkSession, {path: None, **(beside or {})}
    slices = [tuple(datetime(t.year, t.month, t.day) if type(t) is date else t for t in s) for s in slices]
    known = ledger.book(spark, path, writer)
    ledger.refuse_overlaps(slices, known)
    for table in tables:
        lost = [x for x in lake.batches(spark, table) if x[1] == writer and x[2] not in known.values()]
        lake.drop_batches(spark, table, lost)
    todo = [s for s in slices if not (resume and s in known)]
    number = 1 + max([*known.values(), compaction.last_merged(spark, path, writer)], default=-1)
    step = slices_a_job or max(1, len(todo))
    for at in range(0, len(todo), step):
        job = {s: number + i for i, s in enumerate(todo[at : at + step])}
        number += len(job)
        _load(tx, path, job, writer, tables)
        old = {known[s] for s in job if s in known}
        for table in tables:
            lake.drop_batches(spark, table, [x for x in lake.batches(spark, table) if x[1] == writer and x[2] in old])
    return todo


def _load(tx: DataFrame, path: str, job: dict[Slice, int], writer: str, tables: dict) -> None:
    spark = tx.sparkSession
    raw = _sliced(tx, job)
    # one task's rows spread over many batches would be as many small files
    raw = raw.hint("rebalance", "yyyymm", "batch_id") if len(job) > 1 else raw
    lake.write_batches(raw, path, writer=writer)
    mine = (F.col("writer") == writer) & F.col("batch_id").isin(list(job.values()))
    written = compaction.rows(spark, path, STORED_SCHEMA).filter(mine)
    for table, build in tables.items():
        if build:
            lake.write_batches(build(written), table, writer=writer)
    sums = {r.batch_id: (r.n_rows, r.key_sum, r.hash_sum) for r in checksums(written).collect()}
    now = datetime.now()
    ledger.record(spark, path, [(writer, a, b, n, *sums.get(n, (0, Decimal(0), Decimal(0))), now) for (a, b), n in job.items()])


def verify(spark: SparkSession, path: str, writer: str = "load", tx: DataFrame | None = None) -> DataFrame:
    """Recorded slices beside what the table holds of them now; ``matches`` tells whether they agree.

    With ``tx`` they are held against the source instead, content included. Slices that a merge took
    in have no rows of their own any more: only the source tells about them.
    """
    parts = ("n_rows", "key_sum", "hash_sum")
    if tx is not None:
        book = ledger.read(spark, path, writer)
        known = {(r.slice_start, r.slice_end): r.batch_id for r in book.select("slice_start", "slice_end", "batch_id").collect()}
        return _matched(book, _sliced(tx, known) if known else None, parts)
    last = compaction.last_merged(spark, path, writer)
    book = ledger.read(spark, path, writer).filter(F.col("batch_id") > last)
    rows = compaction.rows(spark, path, STORED_SCHEMA).filter((F.col("writer") == writer) & (F.col("batch_id") > last))
    return _matched(book, rows, parts)


def _matched(book: DataFrame, rows: DataFrame | None, parts: tuple[str, ...]) -> DataFrame:
    if rows is None:
        return book.select("slice_start", "slice_end", "n_rows", F.col("n_rows").alias("n_rows_now"), F.lit(True).alias("matches"))
    have = checksums(rows).select("batch_id", *[F.col(c).alias(f"{c}_now") for c in parts])
    both = book.join(have, "batch_id", "left")
    same = F.lit(True)
    for c in parts:
        same = same & (F.coalesce(F.col(f"{c}_now"), F.lit(0)) == F.coalesce(F.col(c), F.lit(0)))
    return both.select("slice_start", "slice_end", "n_rows", F.coalesce("n_rows_now", F.lit(0)).alias("n_rows_now"), same.alias("matches"))
