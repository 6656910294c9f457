"""Merging the batches of a table while others append to it.

A table of batches lies in folders by part (a month, say), writer and batch. A merge reads, for each
part, every batch up to the newest one of each writer, writes one batch of the writer
``compacted``, and then commits: one file of the log under the table says, for each part, which
merged batch holds and up to which batch of each writer it replaces them. Readers (``rows``) take
the merged batch and what lies above those bounds, so that partial sums are counted once at every
moment: a merge that dies before its commit is not seen, and what one that dies after it left
behind is not seen either and goes with the next merge.

A replayed batch that has been merged stays out of sight. A writer must therefore never number
batches at or below ``last_merged`` anew. One merge of a table runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.sources import lake

#: Writer name of merged batches.
COMPACTED = "compacted"
LOG = "_merged"
LOG_SCHEMA = "part STRING, number BIGINT, writer STRING, last_batch BIGINT"
#: Files the log may have before it is written anew.
LOG_FILES = 32

Commits = dict[str, tuple[int, dict[str, int]]]


def commits(spark: SparkSession, path: str) -> Commits:
    """For each merged part: the batch that holds, and the last replaced batch of each writer."""
    if not lake.exists(spark, f"{path}/{LOG}"):
        return {}
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/{LOG}")
    newest = log.groupBy("part").agg(F.max("number").alias("number"))
    found: Commits = {}
    for r in log.join(newest, ["part", "number"], "left_semi").distinct().collect():
        found.setdefault(r.part, (r.number, {}))[1][r.writer] = r.last_batch
    return found


def last_merged(spark: SparkSession, path: str, writer: str) -> int:
    """The highest batch of a writer that a merge has replaced; -1 if there is none."""
    return max((bounds.get(writer, -1) for _, bounds in commits(spark, path).values()), default=-1)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _upto(bounds: dict[str, int]) -> Column:
    return _any([(F.col("writer") == w) & (F.col("batch_id") <= n) for w, n in sorted(bounds.items())])


def _alike(found: Commits) -> list[tuple[list[str], int, dict[str, int]]]:
    """Parts with the same commit, together: predicates stay as short as the commits differ."""
    groups: dict[tuple, list[str]] = {}
    for part, (number, bounds) in sorted(found.items()):
        groups.setdefault((number, tuple(sorted(bounds.items()))), []).append(part)
    return [(parts, number, dict(bounds)) for (number, bounds), parts in groups.items()]


def _within(by: str | None, parts: list[str]) -> Column:
    return F.col(by).cast("string").isin(parts) if by else F.lit(True)


def current(found: Commits, by: str | None = "yyyymm") -> Column:
    """What readers may see, as a predicate on the partition columns alone."""
    other = F.col("writer") != COMPACTED
    seen = [
        _within(by, parts) & (((~other) & (F.col("batch_id") == number)) | (other & ~_upto(bounds)))
        for parts, number, bounds in _alike(found)
    ]
    if by or not found:
        rest = ~F.col(by).cast("string").isin(sorted(found)) & other if found else other
        seen.append(rest)
    return _any(seen)


def rows(spark: SparkSession, path: str, schema: str, by: str | None = "yyyymm") -> DataFrame:
    """The table as its readers see it; the predicate prunes folders."""
    if not lake.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).filter(current(commits(spark, path), by))


def compact(
    spark: SparkSession,
    path: str,
    schema: str,
    merge: Callable[[DataFrame], DataFrame],
    by: str | None = "yyyymm",
    parts: list | None = None,
    leave: int = 0,
    fewest: int = 1,
    again: bool = False,
) -> int:
    """Merge the batches of the parts (all without ``parts``) in one job; returns how many it replaced.

    ``merge`` gets the rows of all chosen parts and keeps ``by``. Parts with fewer than ``fewest``
    batches besides their merged one stay as they are, as do the newest ``leave`` batches of each
    writer: a merge beside a poll that may repeat its last cycle wants 1. With ``again`` a part that
    has only its merged batch is written anew as well.
    """
    before, present = commits(spark, path), lake.batches(spark, path, by)
    wanted = None if parts is None else set(map(str, parts))
    newest: dict[tuple[str, str], list[int]] = {}
    for part, writer, batch in present:
        if writer != COMPACTED and (wanted is None or part in wanted):
            if batch > before.get(part, (0, {}))[1].get(writer, -1):
                newest.setdefault((part, writer), []).append(batch)
    after: Commits = {}
    if again:
        newest |= {(part, ""): [] for part in before if wanted is None or part in wanted}
    number = 1 + max([n for n, _ in before.values()] + [b for _, w, b in present if w == COMPACTED], default=-1)
    counts: dict[str, int] = {}
    for (part, writer), found in newest.items():
        if again:
            after.setdefault(part, (number, dict(before.get(part, (0, {}))[1])))
        for batch in sorted(found)[: max(0, len(found) - leave)]:
            bounds = after.setdefault(part, (number, dict(before.get(part, (0, {}))[1])))[1]
            bounds[writer] = batch
            counts[part] = counts.get(part, 0) + 1
    after = {part: commit for part, commit in after.items() if again or counts.get(part, 0) >= fewest}
    if after:
        upto = [_within(by, p) & ((F.col("writer") == COMPACTED) | _upto(bounds)) for p, _, bounds in _alike(after)]
        chosen = rows(spark, path, schema, by).filter(_any(upto)).drop("writer", "batch_id")
        lake.write_batch(merge(chosen), path, number, by, COMPACTED)
        _commit(spark, path, [(part, n, w, b) for part, (n, bounds) in after.items() for w, b in bounds.items()])
    now = before | after
    gone = [
        (part, writer, batch)
        for part, writer, batch in present
        if (batch != now.get(part, (-1,))[0] if writer == COMPACTED else batch <= now.get(part, (0, {}))[1].get(writer, -1))
    ]
    lake.drop_batches(spark, path, gone, by)
    return sum(counts.get(part, 0) for part in after)


def _commit(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    """One more file of the log; a log of many files is written anew before the old ones go."""
    log = f"{path}/{LOG}"

    def append(found: list[tuple]) -> None:
        spark.createDataFrame(found, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)

    append(entries)
    old = lake.files(spark, log)
    if len(old) > LOG_FILES:
        append([(part, n, w, b) for part, (n, bounds) in commits(spark, path).items() for w, b in bounds.items()])
        lake.delete_files(spark, old)
