"""Table-lifecycle jobs: retention, erasure, audited reads, rebuilds and updates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, interval
from paytide.operators.aggregates import partition_checksum
from paytide.session import workspace
from paytide.sources import lake


def survivors(df: DataFrame, at: str, anchor: Instant, keep: str, unit: str = "day") -> DataFrame:
    """Rows retention keeps: a bucket goes only when all of it is older than the limit."""
    cut = F.date_trunc(unit, instant(anchor) - interval(keep))
    return df.filter(F.col(at) >= cut)


def day_partitions(df: DataFrame) -> DataFrame:
    """Day partitions with their range and rows."""
    day = F.date_trunc("day", "created_at")
    return df.groupBy(day.alias("range_start")).agg(F.count("*").alias("n_rows")).select(
        "range_start", (F.col("range_start") + interval("1 day")).alias("range_end"), "n_rows"
    )


def droppable(parts: DataFrame, covered_until: list[Column], anchor: Instant, age: str) -> DataFrame:
    """Old partitions, and whether every aggregate covers each: only those may go."""
    covered = F.least(*covered_until) if len(covered_until) > 1 else covered_until[0]
    old = parts.filter(F.col("range_end") < instant(anchor) - interval(age))
    return old.withColumn("can_drop", covered >= F.col("range_end"))


def verified_drop(
    spark: SparkSession, path: str, key: str, values: list, covered: Callable[[DataFrame], DataFrame], schema: str
) -> dict[str, bool]:
    """Drop partitions in two phases: move aside, compare, then delete or put back.

    ``covered`` gets the rows of one partition, already out of every reader's sight, and returns
    one row whose ``covered`` tells whether what must outlive them (an aggregate, say) still answers for
    them. A partition it does not approve, or whose check fails, is where it was before; one that a
    crash left aside is put back by the next call. Returns what was dropped.
    """
    aside, done = f"{path}/_aside", {}
    lake.put_back(spark, path, aside)
    for value in map(str, values):
        spec = f"{key}={value}"
        if not lake.exists(spark, f"{path}/{spec}"):
            continue
        lake.move(spark, f"{path}/{spec}", f"{aside}/{spec}")
        done[value] = False
        try:
            rows = spark.read.schema(schema).option("basePath", aside).parquet(f"{aside}/{spec}")
            done[value] = bool(covered(rows).head()["covered"])
        finally:
            if done[value]:
                lake.drop_partition(spark, aside, spec)
            else:
                lake.move(spark, f"{aside}/{spec}", f"{path}/{spec}")
    return done


def same_totals(rows: DataFrame, aggregate: DataFrame, n: str, total: str, amount: str = "amount") -> DataFrame:
    """One row: does the aggregate hold as many rows, and the same amount, as the rows themselves?"""
    a = rows.agg(F.count("*").alias("n"), F.sum(amount).cast("decimal(38,2)").alias("t"))
    b = aggregate.agg(F.coalesce(F.sum(n), F.lit(0)).alias("m"), F.sum(total).cast("decimal(38,2)").alias("u"))
    return a.select(((F.col("n") == b.select("m").scalar()) & F.col("t").eqNullSafe(b.select("u").scalar())).alias("covered"))


def recluster(df: DataFrame, path: str, older_than: Column | None = None, files: int = 64) -> None:
    """Rewrite in the order readers filter by, with a stronger codec.

    Range partitioning includes time, so an institution with a large share of the rows is
    spread over several files instead of one task.
    """
    rows = df if older_than is None else df.filter(F.col("created_at") < older_than)
    order = ("source_institution", "type", F.desc("created_at"), "status")
    (
        rows.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def recluster_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows, files and bytes of two Parquet-backed copies, and how many times smaller the second is."""
    def sizes(df: DataFrame, when: str) -> DataFrame:
        return lake.inventory(df).select(*[F.col(c).alias(f"{c}_{when}") for c in ("n_rows", "files", "bytes")])

    a, b = sizes(before, "before"), sizes(after, "after")
    out = a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])
    return out.withColumn("ratio", F.col("bytes_before") / F.col("bytes_after"))


def recovery_proof(
    before: DataFrame, after: DataFrame, tag: str, key: str, point: Instant, at: str = "created_at", amount: str = "amount"
) -> DataFrame:
    """Does ``after`` hold, tag by tag, exactly what ``before`` held up to ``point``?

    ``missing`` counts rows of the first that the second lacks, ``residue`` rows of the second that do
    not belong: later than the point, unknown, doubled, or moved from another tag. Equal counts and sums
    alone do not prove a tag. Both sides meet in one shuffle by key; null tags and keys compare equal.
    """
    old = before.filter(F.col(at) < instant(point)).select(tag, key, F.col(amount).alias("_x"), F.lit(True).alias("_old"))
    new = after.select(tag, key, F.col(amount).alias("_x"), F.lit(False).alias("_old"))
    by_key = old.unionByName(new).groupBy(tag, key).agg(
        F.count_if("_old").alias("_b"),
        F.count_if(~F.col("_old")).alias("_a"),
        F.sum(F.when(F.col("_old"), F.col("_x"))).alias("_tb"),
        F.sum(F.when(~F.col("_old"), F.col("_x"))).alias("_ta"),
    )
    changed = (F.col("_b") == F.col("_a")) & ~F.col("_tb").eqNullSafe(F.col("_ta"))
    by_tag = by_key.groupBy(tag).agg(
        F.sum("_b").alias("n_before"),
        F.sum("_tb").alias("total_before"),
        F.sum("_a").alias("n_after"),
        F.sum("_ta").alias("total_after"),
        F.sum(F.greatest(F.col("_b") - F.col("_a"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("_a") - F.col("_b"), F.lit(0))).alias("residue"),
        F.count_if(changed).alias("changed"),
    )
    return by_tag.withColumn("proven", (F.col("missing") == 0) & (F.col("residue") == 0) & (F.col("changed") == 0))


def anonymize(accounts: DataFrame, requests: DataFrame, salt: str) -> DataFrame:
    """Blank out the requested holders; facts keep pointing at the account."""
    asked = requests.select("id").distinct().withColumn("_asked", F.lit(True))
    marked = accounts.join(asked, "id", "left")
    hit = F.col("_asked").isNotNull()
    digest = F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)), 256)
    return (
        marked.withColumn("holder_name", F.when(hit, "ANONIMIZADO").otherwise(F.col("holder_name")))
        .withColumn(
            "holder_document",
            F.when(hit, F.concat(F.lit("ANON-"), digest)).otherwise(F.col("holder_document")),
        )
        .withColumn("status", F.when(hit, "closed").otherwise(F.col("status")))
        .select(*accounts.columns)
    )


def require_known(requests: DataFrame, accounts: DataFrame) -> None:
    """Raise if a request names an account that does not exist."""
    unknown = requests.join(accounts.select("id"), "id", "left_anti").select("id").head()
    if unknown is not None:
        raise ValueError(f"account {unknown['id']} not found")


def erasure_log(requests: DataFrame, accounts: DataFrame, now: Instant) -> DataFrame:
    """Log rows, to be written before anything is erased. The document appears hashed only;
    backups stay pending for the 365 days they live.

    A request repeated for the same account is one row, dated by the first. ``affected_rows`` counts
    the account's rows that are about to change: zero if its holder was blanked out before.
    """
    first = requests.groupBy("id").agg(F.min(F.struct("requested_at", "requester")).alias("_r"))
    blank = (F.col("holder_name") == "ANONIMIZADO") & F.col("holder_document").startswith("ANON-")
    rows = (
        accounts.select("id", "holder_document", "holder_name")
        .join(first, "id")
        .groupBy("id", "holder_document", "_r")
        .agg(F.count_if(~F.coalesce(blank, F.lit(False))).cast("int").alias("affected_rows"))
    )
    return rows.select(
        F.sha2("holder_document", 256).alias("document_hash"),
        F.col("_r.requested_at").alias("requested_at"),
        instant(now).alias("executed_at"),
        F.col("_r.requester").alias("requester"),
        "affected_rows",
        (instant(now) < F.col("_r.requested_at") + interval("365 days")).alias("backups_pending"),
    )


def erase_holders(
    spark: SparkSession,
    accounts: DataFrame,
    requests: DataFrame,
    salt: str,
    now: datetime,
    log_path: str,
    out_path: str,
) -> None:
    """Log first, then write the anonymised dimension: a crash leaves a trace, not a gap."""
    require_known(requests, accounts)
    erasure_log(requests, accounts, now).write.mode("append").parquet(log_path)
    anonymize(accounts, requests, salt).write.mode("overwrite").parquet(out_path)


AUDIT_SCHEMA = (
    "accessed_at TIMESTAMP, db_user STRING, application STRING, purpose STRING, "
    "rows_returned INT, query_text STRING"
)


def read_accounts(accounts: DataFrame, institution: str | None = None, limit: int = 100) -> DataFrame:
    rows = accounts if institution is None else accounts.filter(
        F.col("institution_code") == institution
    )
    return rows.select(
        "id", "account_number", "institution_code", "holder_document", "holder_name", "status"
    ).orderBy("id").limit(limit)


def read_accounts_audited(
    accounts: DataFrame,
    purpose: str | None,
    log_path: str,
    now: datetime,
    user: str,
    institution: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Personal data behind a stated purpose; the log says how many rows went out."""
    if purpose is None or not purpose.strip():
        raise ValueError("a purpose is required to read personal data")
    spark = accounts.sparkSession
    rows = read_accounts(accounts, institution, limit)
    entry = (
        now,
        user,
        spark.sparkContext.appName,
        purpose,
        rows.count(),
        f"read_accounts_audited(institution={institution or 'TODAS'}, limit={limit})",
    )
    spark.createDataFrame([entry], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    return rows


def rewritten_log_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of the earlier log that the later one lacks or changed; append-only means none."""
    columns = [c for c in old.columns if c != key]
    a = old.select(key, F.xxhash64(*columns).alias("_h"))
    b = new.select(key, F.xxhash64(*columns).alias("_h"))
    return a.join(b, [key, "_h"], "left_anti").select(key)


def apply_updates(df: DataFrame, updates: DataFrame, key: str, at: Column) -> DataFrame:
    """Set the given columns; ``updated_at`` moves only on rows that really change."""
    columns = [c for c in updates.columns if c != key]
    patch = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = df.join(patch, key, "left")
    hit = F.col("_hit").isNotNull()
    moved = F.lit(False)
    for c in columns:
        moved = moved | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    out = joined.withColumn("updated_at", F.when(hit & moved, at).otherwise(F.col("updated_at")))
    for c in columns:
        out = out.withColumn(c, F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)))
    return out.select(*df.columns)


def purge(tables: dict[str, DataFrame], predicate: Column) -> dict[str, DataFrame]:
    """Remove matching rows from the raw table and its aggregates alike."""
    keep = ~F.coalesce(predicate, F.lit(False))
    return {name: df.filter(keep) for name, df in tables.items()}


def purge_stored(spark: SparkSession, path: str, by: tuple[str, ...], predicate: Column) -> list[tuple]:
    """Physically remove matching rows from a partitioned table; returns the partitions rewritten.

    Only partitions that hold such rows are read again and rewritten. Their names, a list as
    short as the folder listing, are all that reaches the driver.
    """
    table = spark.read.parquet(path)
    hit = F.coalesce(predicate, F.lit(False))
    touched = [tuple(r) for r in table.filter(hit).select(*by).distinct().collect()]
    if touched:
        names = spark.createDataFrame(touched, table.select(*by).schema)
        kept = table.join(names, list(by), "left_semi").filter(~hit)
        lake.rewrite(kept, path, by, touched, workspace(spark, "purge"))
    return touched


def partition_diff(source: DataFrame, shadow: DataFrame, by: Column, name: str, key: str) -> DataFrame:
    """Counts and checksums of two copies by partition; any difference forbids the swap."""
    a = partition_checksum(source, by, name, key, *source.columns)
    b = partition_checksum(shadow, by, name, key, *source.columns)
    parts = ("n_rows", "key_sum", "hash_sum")
    left = a.select(name, *[F.col(c).alias(f"{c}_source") for c in parts])
    right = b.select(name, *[F.col(c).alias(f"{c}_shadow") for c in parts])
    same = F.lit(True)
    for c in parts:
        same = same & F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_shadow"))
    return left.join(right, name, "full_outer").withColumn("matches", same)


def shadow_swap(
    spark: SparkSession, source: DataFrame, live: DataFrame, cut: datetime, pointer: str, key: str
) -> str:
    """Copy rows before the cut, add the dual-written rest, compare, then swap the pointer.

    ``live`` holds what the second writer received from the cut on. Raises, leaving the
    pointer alone, if any partition differs.
    """
    target = workspace(spark, "shadow")
    history = source.filter(F.col("created_at") < F.lit(cut))
    history.write.mode("append").partitionBy("yyyymm").parquet(target)
    live.write.mode("append").partitionBy("yyyymm").parquet(target)
    shadow = spark.read.schema(source.schema).parquet(target)
    diff = partition_diff(source, shadow.select(*source.columns), F.col("yyyymm"), "part", key)
    bad = diff.filter(~F.col("matches")).select("part").head()
    if bad is not None:
        raise RuntimeError(f"partition {bad['part']} differs, not swapped")
    lake.point_to(spark, pointer, target)
    return target
