"""Writing two mirrors from one stream, and the swap to the second without downtime.

From batch ``start`` on every batch goes to both mirrors. What the first one held before is copied
once, by batch number, so nothing is copied twice and nothing falls between. When both agree month
by month, the pointer that readers follow is moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.operators import compaction, lifecycle, versions
from paytide.sources import lake
from paytide.streaming import ingest
from paytide.streaming.ingest import Layout

#: Batches whose markers are kept.
MARKS = 64
HISTORY = "history"


def _marks(layout: Layout) -> str:
    return f"{layout.root}/_written/{layout.writer}"


def written(spark: SparkSession, layout: Layout, batch_id: int) -> bool:
    return lake.exists(spark, f"{_marks(layout)}/batch={batch_id}")


def dual_write(
    first: Layout, second: Layout, process: Callable[[Layout], Callable[[DataFrame, int], None]] = ingest.process_rows
) -> Callable[[DataFrame, int], None]:
    """A batch function that writes both mirrors, and marks each batch in each when it is there.

    A batch that failed between the two is read again: the mirror that has its mark is left alone,
    the other one is written; a write without a mark is replaced as a whole.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = [layout for layout in (first, second) if not written(spark, layout, batch_id)]
        rows = batch.persist() if len(todo) > 1 else batch
        try:
            for layout in todo:
                process(layout)(rows, batch_id)
                lake.touch(spark, f"{_marks(layout)}/batch={batch_id}")
                lake.delete_files(spark, [f"{_marks(layout)}/batch={batch_id - MARKS}"] if batch_id >= MARKS else [])
        finally:
            if rows is not batch or len(todo) > 1:
                rows.unpersist()

    return run


def copy_history(spark: SparkSession, first: Layout, second: Layout, start: int) -> None:
    """Everything the first mirror held before batch ``start`` of its writer, as one batch of the second.

    Other writers of the first mirror must be at rest from then on. A merge may have taken in
    batches at or above ``start``; then the copy is refused.
    """
    if compaction.last_merged(spark, first.raw, first.writer) >= start:
        raise ValueError(f"batches from {start} on are merged already: merge the first mirror after the swap")
    own = Layout(second.root, HISTORY, second.sketches)
    before = (F.col("writer") != first.writer) | (F.col("batch_id") < start)
    rows = ingest.read_raw(spark, first).filter(before).drop("writer", "batch_id")
    ingest.write_raw(rows, 0, own)
    ingest.update_states(ingest.read_raw(spark, second).filter(F.col("writer") == HISTORY).drop("writer", "batch_id"), 0, own)


def swap(spark: SparkSession, first: Layout, second: Layout, pointer: str) -> None:
    """Move the pointer to the second mirror if every month holds the same resolved rows; raise if not."""
    # the time a row was written may differ, what it says may not
    a, b = (versions.final(ingest.read_raw(spark, x)).drop("writer", "batch_id", "_ingested_at") for x in (first, second))
    diff = lifecycle.partition_diff(a, b, F.col("yyyymm"), "part", "tx_id")
    bad = diff.filter(~F.coalesce("matches", F.lit(False))).select("part").head()
    if bad is not None:
        raise RuntimeError(f"month {bad['part']} differs, not swapped")
    lake.point_to(spark, pointer, second.root)
