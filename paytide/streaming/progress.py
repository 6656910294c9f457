"""Query progress as rows: batch sizes, rates, durations and rows refused for lateness."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paytide.operators import compaction
from paytide.sources import lake

PROGRESS_SCHEMA = (
    "query STRING, of_writer STRING, of_batch BIGINT, ts STRING, rows_in BIGINT, rows_per_second DOUBLE, duration_ms BIGINT, late_rows BIGINT"
)
STORED_PROGRESS = f"{PROGRESS_SCHEMA}, writer STRING, batch_id BIGINT"


class ProgressLog(StreamingQueryListener):
    """Appends a row per batch and query to a table, however long the query runs.

    Reports are written ``every`` so many batches and when the query ends. A report that Spark
    repeats after a restart replaces its row on reading. Only queries whose name is ``name`` are
    logged, all without one.
    """

    def __init__(self, spark: SparkSession, path: str, writer: str = "stream", every: int = 50, name: str | None = None):
        self.spark, self.path, self.writer, self.every, self.name = spark, path, writer, every, name
        self.held: list[tuple] = []
        self.lock = Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        row = (
            str(p.id), self.writer, int(p.batchId), p.timestamp, int(p.numInputRows),
            float(p.processedRowsPerSecond or 0.0), int((p.durationMs or {}).get("triggerExecution", 0)), int(late),
        )
        with self.lock:
            self.held.append(row)
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1)
            lake.write_batch(frame, self.path, min(r[2] for r in rows), None, f"{self.writer}-{rows[0][0][:8]}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, writer and batch: the newest report of each."""
    rows = compaction.rows(spark, path, STORED_PROGRESS, None)
    newest = rows.groupBy("query", "of_writer", "of_batch").agg(F.max_by(F.struct(*rows.columns), "ts").alias("r"))
    return newest.select("r.*").drop("writer", "batch_id")


def compact_progress(spark: SparkSession, path: str) -> int:
    return compaction.compact(spark, path, STORED_PROGRESS, lambda df: df.coalesce(1), None)


def progress_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent reports Spark keeps in memory for a query (a bounded list); ``ProgressLog`` keeps all."""
    rows = [
        (
            str(query.id),
            query.name,
            int(p["batchId"]),
            p["timestamp"],
            int(p["numInputRows"]),
            float(p.get("processedRowsPerSecond") or 0.0),
            int(p["durationMs"].get("triggerExecution", 0)),
            sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p["stateOperators"]),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
