"""Watermark scans of a mutable table: resume, full scan, overlap and state."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.functions.timing import Instant, instant, interval, micros_between, month_key
from paytide.session import staged
from paytide.sources import lake

#: Cycles whose state is kept.
KEPT_STATES = 8
#: A batch of so many rows is simply put in order and cut; a larger one is cut by counting.
IN_ORDER = 1 << 10
#: Ranges that are counted at once, as a power of two, and pairs that are listed.
RANGE_BITS = 12
LISTED = 1 << 14
LEAST = -(1 << 63)
STATE_SCHEMA = (
    "source STRING, last_updated_at TIMESTAMP, last_id BIGINT, last_run_at TIMESTAMP, "
    "rows_synced BIGINT, last_full_scan_at TIMESTAMP, cycles BIGINT"
)


def after(updated_at: Instant, row_id: int | Column, inclusive: bool = True) -> Column:
    """``(updated_at, id) >= (wm, wm_id)`` spelled so that the time part is pushed down."""
    wm, wid = instant(updated_at), row_id if isinstance(row_id, Column) else F.lit(row_id)
    tie = F.col("id") >= wid if inclusive else F.col("id") > wid
    return (F.col("updated_at") >= wm) & ((F.col("updated_at") > wm) | tie)


def read_increment(
    df: DataFrame,
    updated_at: Instant,
    row_id: int | Column = 0,
    batch: int | None = None,
    floor_days: int | None = 7,
    inclusive: bool = True,
) -> DataFrame:
    """Rows at or after the watermark pair, in pair order.

    The floor on ``created_at`` is what lets a table partitioned by creation day skip old
    partitions; ``floor_days=None`` is the full-scan form. Without ``batch`` the whole
    increment is read, which is the usual choice on Spark; neither it nor a batch above
    ``IN_ORDER`` is sorted (see ``first_rows``).
    """
    rows = df.filter(after(updated_at, row_id, inclusive))
    if floor_days is not None:
        rows = rows.filter(
            F.col("created_at") >= instant(updated_at) - interval(f"{floor_days} days")
        )
    return rows if batch is None else first_rows(rows, batch)[0]


def first_rows(rows: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """The first ``n`` rows in pair order, nulls first, and whether more are known to follow.

    Ordering and cutting would bring all of them to one task. Instead the ``n``-th pair is found by
    counting rows per range of change times and, where many share one, of ids; the range that holds
    it is divided again until its pairs can be listed. What comes up to the pair is then a filter.
    Of rows that share this pair as many are taken as there is room for.
    """
    if n <= IN_ORDER:
        return rows.orderBy("updated_at", "id").limit(n), False
    least = F.lit(LEAST)
    time, key = F.coalesce(F.unix_micros("updated_at"), least), F.coalesce(F.col("id").cast("long"), least)
    with staged(rows.select(time.alias("t"), key.alias("i")), "pairs") as part:  # the source may change meanwhile
        bounds = [F.count("*").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.min("i").alias("i0"), F.max("i").alias("i1")]
        found, left = part.agg(*bounds).head(), n
        if found.n <= n:
            return rows, False
        for k in ("t", "i"):
            while found.n > LISTED and (width := found[f"{k}1"] - found[f"{k}0"]):
                number = F.shiftright(k, max(0, width.bit_length() - RANGE_BITS)).alias("number")
                for found in part.groupBy(number).agg(*bounds).orderBy("number").collect():  # at most 2**RANGE_BITS + 1 rows
                    if left <= found.n:
                        break
                    left -= found.n
                part = part.filter(F.col(k).between(found[f"{k}0"], found[f"{k}1"]))
        last, copies, room = (found.t0, found.i0), found.n, left
        if found.n <= LISTED:
            pairs = sorted(map(tuple, part.collect()))
            last = pairs[left - 1]
            copies, room = pairs.count(last), left - pairs.index(last)
    before = (time < last[0]) | ((time == last[0]) & (key < last[1]))
    at = (time == last[0]) & (key == last[1])
    if room == copies:
        return rows.filter(before | at), True
    return rows.filter(before).unionByName(rows.filter(at).limit(room)), True


def full_scan_due(last_full_scan_at: datetime | None, now: datetime, hours: int = 24) -> bool:
    if last_full_scan_at is None:
        return True
    return (now - last_full_scan_at).total_seconds() >= hours * 3600


def full_scan(df: DataFrame, last_full_scan_at: Instant) -> DataFrame:
    """All rows changed since the previous full scan, however old they are.

    Starting at the current watermark instead would never see an old row updated between
    two full scans once newer traffic had moved the watermark past it.
    """
    return read_increment(df, last_full_scan_at, floor_days=None)


def overlap_window(
    df: DataFrame, updated_at: Instant, target: DataFrame, seconds: int = 30
) -> DataFrame:
    """Rows just below the watermark that the target does not hold yet (late commits).

    ``target`` has ``tx_id`` and ``_version``; only its versions of the same span are read.
    """
    return lacking(looked_at_again(df, updated_at, seconds), target, overlap_start(updated_at, seconds))


def overlap_start(updated_at: Instant, seconds: int) -> Column:
    return instant(updated_at) - interval(f"{seconds} seconds")


def looked_at_again(df: DataFrame, updated_at: Instant, seconds: int = 30) -> DataFrame:
    """The source rows of the last seconds up to the watermark."""
    return df.filter((F.col("updated_at") >= overlap_start(updated_at, seconds)) & (F.col("updated_at") <= instant(updated_at)))


def lacking(rows: DataFrame, target: DataFrame, start: Column) -> DataFrame:
    """The rows whose version the target does not hold; all rows changed at ``start`` or later.

    The target's versions that the rows name are found first, by a semi-join that includes the
    month where the target is partitioned by it. A transaction's month is the same in all its
    versions, so when the rows are few enough to be broadcast their months prune the target's
    partitions at run time: a look-back over seconds opens the months it touches, not the mirror.
    """
    since = F.unix_millis(start)
    names = rows.select(F.col("id").alias("tx_id"), F.unix_millis("updated_at").alias("_version"), month_key("created_at").alias("yyyymm"))
    keys = ["tx_id", "_version", *(["yyyymm"] if "yyyymm" in target.columns else [])]
    wanted = names.filter(F.col("_version") >= since).select(*keys)
    have = target.filter(F.col("_version") >= since).select(*keys).join(wanted, keys, "left_semi").select("tx_id", "_version")
    missing = (rows["id"] == have["tx_id"]) & (F.unix_millis(rows["updated_at"]) == have["_version"])
    return rows.join(have, missing, "left_anti")


def union_new(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """``first`` plus the rows of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def high_mark(df: DataFrame) -> DataFrame:
    """The greatest (updated_at, id) pair and the row count, as one row."""
    return df.agg(
        F.max(F.struct("updated_at", "id")).alias("top"), F.count("*").alias("rows_synced")
    ).select(
        F.col("top.updated_at").alias("last_updated_at"),
        F.col("top.id").alias("last_id"),
        "rows_synced",
    )


def read_state(spark: SparkSession, path: str, source: str) -> dict | None:
    """Newest state row of a source: the highest cycle whose folder holds one.

    States are only ever added and the newest few are kept, so a crash cannot lose the mark,
    and a cycle reads one file however long the source has been polled.
    """
    at = _states(path, source)
    for cycle in sorted(map(int, lake.partitions(spark, at, "cycle")), reverse=True):
        row = spark.read.schema(STATE_SCHEMA).parquet(f"{at}/cycle={cycle}").head()
        if row is not None:
            return row.asDict()
    return None


def _states(path: str, source: str) -> str:
    return f"{path}/source={quote(source, safe='')}"


def commit_state(
    spark: SparkSession,
    path: str,
    source: str,
    batch: DataFrame,
    now: datetime,
    full: bool = False,
    previous: dict | None = None,
) -> dict:
    """Advance the watermark past ``batch``. Call it only after the write has succeeded."""
    top = high_mark(batch).head()
    prior = previous or {}
    pairs = [
        (u, i)
        for u, i in (
            (prior.get("last_updated_at"), prior.get("last_id")),
            (top["last_updated_at"], top["last_id"]),
        )
        if u is not None
    ]
    mark = max(pairs) if pairs else (None, None)
    state = {
        "source": source,
        "last_updated_at": mark[0],
        "last_id": mark[1],
        "last_run_at": now,
        "rows_synced": (prior.get("rows_synced") or 0) + top["rows_synced"],
        "last_full_scan_at": now if full else prior.get("last_full_scan_at"),
        "cycles": (prior.get("cycles") or 0) + 1,
    }
    if mark[0] is None:
        return state  # nothing seen yet, so nothing to resume from
    at = _states(path, source)
    row = spark.createDataFrame([tuple(state.values())], STATE_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{at}/cycle={state['cycles']}")
    for cycle in lake.partitions(spark, at, "cycle"):
        if int(cycle) <= state["cycles"] - KEPT_STATES:
            lake.drop_partition(spark, at, f"cycle={cycle}")
    return state


def watermark_health(state: DataFrame, source: DataFrame, written: Column) -> DataFrame:
    """One row: is the watermark at or past the source's newest change with nothing written?"""
    newest = source.agg(F.max("updated_at")).scalar()
    return state.select(
        "last_updated_at",
        newest.alias("source_max_updated_at"),
        written.alias("rows_written"),
        ((F.col("last_updated_at") >= newest) & (written == 0)).alias("stuck"),
        F.greatest(micros_between(newest, F.col("last_updated_at")), F.lit(0))
        .cast("long")
        .alias("behind_micros"),
    )
