"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on; safe to repeat."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "paytide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", **RUNTIME_SETTINGS, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder for one run, under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="paytide-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: dict[int, list] = {}  # by session: blocks of ``tidy`` now open, and the setting before the first
_lock = threading.Lock()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """In the block, a query's shuffle files go when it ends, not when the driver's garbage is collected.

    For queries whose result is written or gathered whole and whose plan is not run again.
    """
    key = id(spark._jsparkSession)
    with _lock:
        blocks = _open.setdefault(key, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        blocks[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            blocks[0] -= 1
            if not blocks[0]:
                del _open[key]
                if blocks[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, blocks[1])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage in a form every executor can reach, fixes the rows, and gives later
    joins their true size, so that Spark itself decides whether to broadcast them. Shuffle
    files of the write go with its end.
    """
    path = workspace(df.sparkSession, name)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` for the length of a block; the folder is deleted at its end."""
    spark, path = df.sparkSession, workspace(df.sparkSession, name)
    try:
        with tidy(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
