"""Partitioned Parquet tables on the cluster's file system: write, list, drop, swap."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def write_batch(
    df: DataFrame, path: str, batch_id: int, by: str | None = "yyyymm", writer: str = "stream"
) -> None:
    """Append one batch; replaying the same batch of the same writer replaces only its own files.

    Writers number their batches on their own: a stream, a poll and a load can share a table.
    ``by`` is the partition above the writers, None for a table that has none.
    """
    write_batches(df.withColumn("batch_id", F.lit(batch_id).cast("long")), path, by, writer)


def write_batches(df: DataFrame, path: str, by: str | None = "yyyymm", writer: str = "stream") -> None:
    """Append the batches that the column ``batch_id`` tells, in one job."""
    replace_partitions(df.withColumn("writer", F.lit(writer)), path, *([by] if by else []), "writer", "batch_id")


def batches(spark: SparkSession, path: str, by: str | None = "yyyymm") -> list[tuple[str, str, int]]:
    """(part, writer, batch) of a table, from folder names; part is empty where ``by`` is None."""
    tops = {value: f"{path}/{by}={value}" for value in partitions(spark, path, by)} if by else {"": path}
    return [
        (part, writer, int(batch))
        for part, top in tops.items()
        for writer in partitions(spark, top, "writer")
        for batch in partitions(spark, f"{top}/writer={writer}", "batch_id")
    ]


def drop_batches(spark: SparkSession, path: str, found: list[tuple[str, str, int]], by: str | None = "yyyymm") -> None:
    """Remove batches as ``batches`` names them; the calls only wait for the file system."""
    fs, _ = _fs(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [f"{path}/{f'{by}={part}/' if by else ''}writer={writer}/batch_id={batch}" for part, writer, batch in found]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda name: fs.delete(at(name), True), names))


def writers(spark: SparkSession, path: str, by: str | None = "yyyymm") -> set[str]:
    """Names of those that have batches in a table (metadata only)."""
    return {writer for _, writer, _ in batches(spark, path, by)}


def replace_range(df: DataFrame, path: str, by: str, values: list) -> None:
    """Make the partitions ``values`` hold exactly ``df``: those it has no rows for go too."""
    spark = df.sparkSession
    replace_partitions(df, path, by)
    have = {str(r[0]) for r in df.select(F.col(by).cast("string")).distinct().collect()}
    for value in values:
        if str(value) not in have and str(value) in partitions(spark, path, by):
            drop_partition(spark, path, f"{by}={value}")


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite just the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


def rewrite(kept: DataFrame, path: str, by: tuple[str, ...], touched: list[tuple], staging: str) -> None:
    """Make the partitions ``touched`` (values of ``by``) hold exactly ``kept``, read from themselves.

    Rows go through ``staging`` first, since a partition cannot be overwritten while it is
    read; a crash before the overwrite leaves the table as it was. Emptied partitions go.
    """
    spark = kept.sparkSession
    kept.write.parquet(staging)
    rows = spark.read.schema(kept.schema).parquet(staging)
    replace_partitions(rows, path, *by)
    have = {tuple(map(str, r)) for r in rows.select(*by).distinct().collect()}
    for values in touched:
        if tuple(map(str, values)) not in have:
            drop_partition(spark, path, "/".join(f"{c}={v}" for c, v in zip(by, values, strict=True)))
    fs, target = _fs(spark, staging)
    fs.delete(target, True)


def partitions(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the top-level partition key, from folder names (metadata only)."""
    if not exists(spark, path):
        return []
    fs, root = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}="))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; raises where the file system refuses."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise RuntimeError(f"cannot move {source} to {target}")


def put_back(spark: SparkSession, path: str, aside: str) -> None:
    """Return the partitions a drop left aside; what has come back meanwhile wins over them."""
    if not exists(spark, aside):
        return
    fs, root = _fs(spark, aside)
    for name in [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]:
        if not exists(spark, f"{path}/{name}"):
            move(spark, f"{aside}/{name}", f"{path}/{name}")


def touch(spark: SparkSession, name: str) -> None:
    """An empty file, which appears at once."""
    fs, target = _fs(spark, name)
    fs.create(target, True).close()


def files(spark: SparkSession, path: str) -> list[str]:
    """Data files right under a folder (metadata only)."""
    if not exists(spark, path):
        return []
    fs, root = _fs(spark, path)
    found = [s.getPath() for s in fs.listStatus(root) if s.isFile()]
    return [f.toString() for f in found if not f.getName().startswith(("_", "."))]


def delete_files(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        fs, target = _fs(spark, name)
        fs.delete(target, False)


def drop_partition(spark: SparkSession, path: str, spec: str) -> bool:
    """Remove one partition folder such as ``day=2024-01-03``."""
    fs, target = _fs(spark, f"{path}/{spec}")
    return fs.delete(target, True)


def expire(spark: SparkSession, path: str, key: str, before: str, droppable=None) -> list[str]:
    """Drop, one at a time, the partitions wholly before ``before``; returns what went.

    ``droppable`` limits the drop to partitions a coverage check has approved.
    """
    gone = []
    for value in partitions(spark, path, key):
        if value < before and (droppable is None or value in droppable):
            if drop_partition(spark, path, f"{key}={value}"):
                gone.append(value)
    return gone


def inventory(df: DataFrame, *by: str) -> DataFrame:
    """Rows, files and bytes for each partition of a Parquet-backed DataFrame."""
    files = df.groupBy(*by, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("size")
    )
    return files.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("files"), F.sum("size").alias("bytes")
    )


def point_to(spark: SparkSession, pointer: str, target: str) -> None:
    """Publish ``target`` as the live version behind ``pointer`` in one append."""
    row = spark.createDataFrame([(target,)], "target STRING").withColumn(
        "at_micros", F.unix_micros(F.current_timestamp())
    )
    row.coalesce(1).write.mode("append").parquet(pointer)


def resolve(spark: SparkSession, pointer: str) -> str:
    """Folder the pointer names now (its newest row)."""
    rows = spark.read.schema("target STRING, at_micros BIGINT").parquet(pointer)
    return rows.agg(F.max_by("target", "at_micros")).head()[0]
