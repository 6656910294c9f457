"""Watermark scans: bursts, late commits, full scans and crash-safe state."""

import random
from datetime import date, timedelta

from conftest import T0, payment, plan
from pyspark.sql import functions as F

from paytide.functions.position import page_of, with_position
from paytide.operators import compaction, versions
from paytide.sources import bulk, increment
from paytide.sources.reference import ReferenceTable, changed
from paytide.sources.tables import STORED_SCHEMA

START = T0 - timedelta(days=1)


def drain(spark, tx, path, batch, started=START):
    """Repeat scan, (write), commit until a scan brings nothing new."""
    state, pages = {"last_updated_at": started, "last_id": 0}, []
    while True:
        rows = increment.read_increment(
            tx, state["last_updated_at"], state["last_id"], batch=batch, inclusive=False
        )
        ids = [r.id for r in rows.select("id").collect()]
        if not ids:
            return pages, increment.read_state(spark, path, "tx")
        pages.append(ids)
        state = increment.commit_state(spark, path, "tx", rows, T0, previous=state)


def test_burst_larger_than_a_batch_is_fully_delivered(spark, make_tx, tmp_path):
    tx = make_tx([payment(i, T0, updated_at=T0) for i in range(1, 61)])
    pages, state = drain(spark, tx, str(tmp_path / "s"), 50)
    assert [len(p) for p in pages] == [50, 10]
    assert sorted(sum(pages, [])) == list(range(1, 61))
    assert (state["last_updated_at"], state["last_id"], state["rows_synced"]) == (T0, 60, 60)


def test_a_large_batch_is_cut_by_counting(spark, make_tx, monkeypatch):
    monkeypatch.setattr(increment, "IN_ORDER", 0)
    order = random.Random(1)
    at = [T0 + timedelta(microseconds=order.choice((0, 0, 7, 10**9)) * (i % 3)) for i in range(60)]
    tx = make_tx([payment(i * 10**17 - 3 * 10**18, at[i], updated_at=at[i]) for i in range(60)])
    empty = [payment(None, T0, updated_at=T0), payment(4, T0, updated_at=None), payment(None, T0, updated_at=None)]
    copied = tx.unionByName(tx.filter("id % 7 < 3")).unionByName(tx.filter("id = 0")).unionByName(make_tx(empty)).repartition(5)

    def pairs(rows):
        return sorted((r.updated_at is not None, r.updated_at or T0, r.id is not None, r.id or 0) for r in rows.select("updated_at", "id").collect())

    whole = pairs(copied)
    for listed, bits in ((1 << 14, 12), (4, 2), (0, 3)):
        monkeypatch.setattr(increment, "LISTED", listed)
        monkeypatch.setattr(increment, "RANGE_BITS", bits)
        for n in (1, 2, 17, 40, len(whole) - 1, len(whole), 200):
            first, more = increment.first_rows(copied, n)
            assert pairs(first) == whole[:n] and more == (n < len(whole))


def test_a_large_batch_is_not_ordered_in_one_task(spark, make_tx):
    rows = make_tx([payment(i, T0) for i in range(increment.IN_ORDER + 20)])
    text = plan(increment.read_increment(rows, START, batch=increment.IN_ORDER + 10))
    assert "TakeOrdered" not in text and "Limit" not in text


def test_state_survives_until_committed(spark, make_tx, tmp_path):
    path = str(tmp_path / "s")
    first = make_tx([payment(1, T0)])
    state = increment.commit_state(spark, path, "tx", first, T0, full=True)
    # a write that fails never reaches commit_state, so the next cycle starts here again
    again = increment.read_state(spark, path, "tx")
    assert again["last_id"] == 1 and again["last_full_scan_at"] == T0 and again == state
    assert increment.read_state(spark, path, "other") is None


def test_watermark_never_moves_back(spark, make_tx, tmp_path):
    path = str(tmp_path / "s")
    newer = increment.commit_state(spark, path, "tx", make_tx([payment(9, T0)]), T0)
    older = make_tx([payment(3, T0 - timedelta(hours=1))])
    state = increment.commit_state(spark, path, "tx", older, T0, previous=newer)
    assert state["last_id"] == 9 and state["rows_synced"] == 2


def test_late_commit_below_the_watermark_is_caught(make_tx):
    rows = [payment(i, T0 - timedelta(seconds=5 * i), status="pending") for i in range(1, 9)]
    tx = make_tx(rows)
    wm = T0 - timedelta(seconds=5)
    target = bulk.to_raw(tx.filter("id NOT IN (3, 8)"))
    assert [r.id for r in increment.overlap_window(tx, wm, target).collect()] == [3]


def test_an_updated_version_in_the_overlap_is_not_mistaken_for_the_old(make_tx):
    old = make_tx([payment(1, T0, status="pending")])
    new = make_tx([payment(1, T0)])
    wm = T0 + timedelta(seconds=3)
    assert increment.overlap_window(new, wm, bulk.to_raw(old)).count() == 1


def test_full_scan_starts_at_the_previous_full_scan(make_tx):
    stale = payment(1, T0 - timedelta(days=60), updated_at=T0 - timedelta(hours=5))
    tx = make_tx([stale, payment(2, T0)])
    wm = T0
    assert increment.read_increment(tx, wm, 0).filter("id = 1").count() == 0
    ids = {r.id for r in increment.full_scan(tx, T0 - timedelta(hours=24)).collect()}
    assert ids == {1, 2}
    assert increment.full_scan_due(None, T0)
    assert not increment.full_scan_due(T0 - timedelta(hours=23), T0)
    assert increment.full_scan_due(T0 - timedelta(hours=24), T0)


def test_watermark_scan_skips_partitions_and_pushes_time(spark, make_tx, tmp_path):
    path = str(tmp_path / "t")
    tx = make_tx([payment(i, T0 - timedelta(days=i)) for i in range(20)])
    tx.withColumn("day", F.to_date("created_at")).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    floor = F.col("day") >= F.lit((T0 - timedelta(days=7)).date())
    text = increment.read_increment(table, T0, 5).filter(floor)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    assert "GreaterThanOrEqual(updated_at" in text and "GreaterThanOrEqual(created_at" in text


def test_bulk_load_rerun_replaces_its_months(spark, make_tx, tmp_path):
    path = str(tmp_path / "raw")
    tx = make_tx([payment(i, T0 - timedelta(days=15 * i)) for i in range(4)])
    slices = bulk.month_slices(date(2023, 11, 1), date(2024, 2, 1))
    assert [s[0].month for s in slices] == [11, 12, 1]
    bulk.bulk_load(tx, path, slices)
    bulk.bulk_load(tx, path, slices[-1:])
    raw = compaction.rows(spark, path, STORED_SCHEMA)
    assert raw.count() == 4 and raw.select("_version").distinct().count() == 4


def test_versions_arrive_in_any_order(make_tx, spark):
    pending = bulk.to_raw(make_tx([payment(1, T0, status="pending")]), F.lit(T0))
    settled = bulk.to_raw(make_tx([payment(1, T0)]), F.lit(T0 - timedelta(hours=1)))
    for both in (pending.unionByName(settled), settled.unionByName(pending)):
        assert [r.status for r in versions.final(both).collect()] == ["settled"]


def test_equal_versions_go_to_the_last_ingested(make_tx):
    a = bulk.to_raw(make_tx([payment(1, T0, status="pending")]), F.lit(T0))
    b = bulk.to_raw(
        make_tx([payment(1, T0, status="failed")]), F.lit(T0 + timedelta(seconds=1))
    )
    assert [r.status for r in versions.final(b.unionByName(a)).collect()] == ["failed"]


def test_a_delete_hides_the_older_version(make_tx):
    alive = bulk.to_raw(make_tx([payment(1, T0, status="pending")]), F.lit(T0))
    gone = bulk.to_raw(make_tx([payment(1, T0)]), F.lit(T0), F.lit(1))
    assert versions.live(alive.unionByName(gone)).count() == 0


def test_positions_are_dense_across_partitions_and_ties(spark):
    df = spark.range(0, 5000).select(F.lit(1).alias("t"), "id").repartition(7)
    rows = with_position(df, ["t", "id"])
    assert rows.filter("position <> id").count() == 0 and rows.count() == 5000
    pages = rows.groupBy(page_of(F.col("position"), 2000).alias("p")).count().collect()
    assert {r.p: r["count"] for r in pages} == {0: 2000, 1: 2000, 2: 1000}


def test_reference_reloads_on_insert_update_and_delete(spark):
    schema = "code STRING, name STRING, short_name STRING, inst_type STRING, is_active BOOLEAN, updated_at TIMESTAMP"
    rows = [("001", "A", "A", "bank", True, T0), ("002", "B", "B", "bank", True, T0)]
    frames = [rows, rows, rows[:1], [("001", "Z", "A", "bank", True, T0 + timedelta(days=1))]]
    current = {"i": 0}
    table = ReferenceTable(lambda: spark.createDataFrame(frames[current["i"]], schema))
    seen = []
    for current["i"] in range(4):
        seen.append(table.cycle())
    assert seen == [True, False, True, True]
    assert [r.name for r in table.frame.collect()] == ["Z"]
    assert changed(None, (0, None))


def test_stuck_watermark(spark, make_tx):
    tx = make_tx([payment(1, T0)])
    state = increment.high_mark(tx)
    row = increment.watermark_health(state, tx, F.lit(0)).head()
    assert row.stuck and row.behind_micros == 0
    assert not increment.watermark_health(state, tx, F.lit(3)).head().stuck
