"""Late rows, coverage, erasure, two-phase drops, dual writes and the progress log."""

import os
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from conftest import T0, plan
from conftest import payment
from pyspark.sql import functions as F

from paytide.functions.timing import month_key
from paytide.operators import aggregates as agg
from paytide.operators import invalidation, lifecycle, states, versions
from paytide.plans import mirror
from paytide.sources import bulk, lake
from paytide.streaming import dual, ingest, progress, windows

HOUR = timedelta(hours=1)


def hours(spark, *when):
    return spark.createDataFrame([(w,) for w in when], "bucket TIMESTAMP")


def test_adjacent_buckets_become_ranges_cut_at_months(spark, monkeypatch):
    last = datetime(2024, 1, 31, 23)
    found = hours(spark, T0, T0 + HOUR, T0 + 3 * HOUR, T0, last, last + HOUR, last + 2 * HOUR)
    assert invalidation.spans(found, "hour") == [
        (T0, T0 + 2 * HOUR), (T0 + 3 * HOUR, T0 + 4 * HOUR), (last, last + HOUR), (last + HOUR, last + 3 * HOUR)
    ]
    assert invalidation.spans(found, "day") == [
        (datetime(2024, 1, 10), datetime(2024, 1, 11)), (datetime(2024, 1, 31), datetime(2024, 2, 1)), (datetime(2024, 2, 1), datetime(2024, 2, 2))
    ]
    monkeypatch.setattr(invalidation, "SPANS", 2)
    assert invalidation.spans(found, "hour") == [(T0, last + HOUR), (last + HOUR, last + 3 * HOUR)]
    assert invalidation.spans(hours(spark), "hour") == []


@pytest.fixture()
def hourly(spark, make_tx, tmp_path):
    rows = [payment(i, T0 + i * HOUR) for i in range(30)] + [payment(100 + i, T0 + timedelta(days=40) + i * HOUR) for i in range(5)]
    tx = make_tx(rows)
    m = mirror.Mirror(spark, str(tmp_path / "agg"))
    lake.replace_partitions(agg.volume_hourly(tx).withColumn("yyyymm", month_key("bucket")), f"{m.root}/volume_hourly", "yyyymm")
    return m, rows


def totals(m):
    return {r.bucket: r.tx_count for r in m.hourly.collect()}


def test_late_rows_refresh_their_hours_alone(spark, make_tx, hourly):
    m, rows = hourly
    late = [payment(200, T0 + 3 * HOUR), payment(201, T0 + 4 * HOUR), payment(202, T0 + 9 * HOUR)]
    new = payment(203, T0 + timedelta(days=60))
    m.note_late(make_tx([*late, new]), 7)
    m.note_late(make_tx([*late, new]), 7)  # a replay
    log, taken = invalidation.pending(spark, m.touched)
    assert log.count() == 3 and len(taken) == 1
    whole = make_tx([*rows, *late])
    untouched = os.path.getmtime(os.path.join(m.root, "volume_hourly", "yyyymm=202402"))
    text = plan(whole.filter(invalidation.inside(F.col("created_at"), invalidation.spans(log, "hour"))))
    assert text.count("created_at") > 2
    assert m.refresh_touched(whole, "volume_hourly") == {"volume_hourly": 2}
    assert totals(m) == {r.bucket: r.tx_count for r in agg.volume_hourly(whole).collect()}
    assert os.path.getmtime(os.path.join(m.root, "volume_hourly", "yyyymm=202402")) == untouched
    assert m.refresh_touched(whole) == {}


def test_a_refresh_that_dies_is_repeated(spark, make_tx, hourly, monkeypatch):
    m, rows = hourly
    whole = make_tx([*rows, payment(200, T0)])
    m.note_late(make_tx([payment(200, T0)]), 0)
    with monkeypatch.context() as patch:
        patch.setattr(mirror.lake, "drop_batches", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            m.refresh_touched(whole, "volume_hourly")
    assert m.refresh_touched(whole, "volume_hourly") == {"volume_hourly": 1} and totals(m)[T0] == 2


def test_backfill_fills_what_is_missing_and_nothing_else(spark, make_tx, hourly):
    m, rows = hourly
    gap = [payment(300, T0 - timedelta(days=50)), payment(301, T0 - 5 * HOUR), payment(302, T0 + timedelta(days=90))]
    whole = make_tx([*rows, *gap])
    february = os.path.join(m.root, "volume_hourly", "yyyymm=202402")
    before = os.path.getmtime(february)
    assert m.backfill("volume_hourly", whole, T0 + timedelta(days=60)) == 2
    after = {d: os.path.getmtime(os.path.join(m.root, "volume_hourly", d)) for d in os.listdir(os.path.join(m.root, "volume_hourly"))}
    assert len(totals(m)) == 37 and os.path.getmtime(february) == before
    assert m.backfill("volume_hourly", whole, T0 + timedelta(days=60)) == 0
    assert after == {d: os.path.getmtime(os.path.join(m.root, "volume_hourly", d)) for d in after}
    assert m.backfill("daily_by_institution", bulk.to_raw(whole), T0 + timedelta(days=200)) == whole.select(F.to_date("created_at")).distinct().count()


def test_erased_accounts_leave_versions_and_states(spark, make_tx, tmp_path, monkeypatch):
    layout = ingest.Layout(str(tmp_path / "m"), sketches=True)
    rows = [payment(i, T0 + i * 7 * HOUR, src=i % 3) for i in range(12)] + [payment(50, T0 + timedelta(days=40), src=1)]
    ingest.process_rows(layout)(bulk.to_raw(make_tx(rows[:7])), 0)
    ingest.process_rows(layout)(bulk.to_raw(make_tx(rows[7:])), 1)
    left = [r for r in rows if r[8] != 1]
    with monkeypatch.context() as patch:  # dies after the versions are gone
        patch.setattr(ingest, "repair", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.purge(spark, layout, F.col("source_account_id") == 1)
    assert ingest.read_raw(spark, layout).count() == len(left)
    assert ingest.repair(spark, layout) == [202401, 202402]
    want = states.daily_report(states.daily_states(bulk.to_raw(make_tx(left)))).sort(*states.DAILY_KEYS).collect()
    assert states.daily_report(ingest.read_daily(spark, layout)).sort(*states.DAILY_KEYS).collect() == want
    assert states.merge_states(ingest.read_funnel(spark, layout)).head().cnt == len(left)
    assert ingest.purge(spark, layout, F.col("source_account_id") == 1) == []
    ingest.process_rows(layout)(bulk.to_raw(make_tx([payment(60, T0)])), 2)
    assert states.merge_states(ingest.read_daily(spark, layout)).head().tx_count == len(left) + 1


def test_a_partition_that_is_not_covered_comes_back(spark, make_tx, tmp_path):
    path = str(tmp_path / "t")
    rows = make_tx([payment(i, T0 + timedelta(days=i)) for i in range(4)]).withColumn("day", F.to_date("created_at"))
    lake.replace_partitions(rows, path, "day")
    aggregate = spark.createDataFrame([("2024-01-10", 1, 149.90), ("2024-01-11", 1, 1.0)], "d STRING, n BIGINT, t DOUBLE")

    def answers(gone):
        if gone.filter("id = 3").count():
            raise RuntimeError("no answer")
        return lifecycle.same_totals(gone, aggregate.filter(F.col("d") == gone.agg(F.max("day").cast("string")).scalar()), "n", "t")

    done = lifecycle.verified_drop(spark, path, "day", ["2024-01-10", "2024-01-11", "2023-01-01"], answers, rows.schema)
    assert done == {"2024-01-10": True, "2024-01-11": False}
    with pytest.raises(RuntimeError, match="no answer"):
        lifecycle.verified_drop(spark, path, "day", ["2024-01-13"], answers, rows.schema)
    assert lake.partitions(spark, path, "day") == ["2024-01-11", "2024-01-12", "2024-01-13"]
    # one that a crash left aside
    lake.move(spark, f"{path}/day=2024-01-12", f"{path}/_aside/day=2024-01-12")
    assert lifecycle.verified_drop(spark, path, "day", [], answers, rows.schema) == {}
    assert spark.read.schema(rows.schema).parquet(path).count() == 3


def test_dual_writes_are_exact_after_a_crash_between_the_two(spark, make_tx, tmp_path):
    first, second = (ingest.Layout(str(tmp_path / n)) for n in ("a", "b"))
    raw = [bulk.to_raw(make_tx([payment(10 * i + j, T0 + timedelta(days=9 * j)) for j in range(3)])) for i in range(4)]
    ingest.process_rows(first)(raw[0], 0)
    calls = []

    def process(layout):
        def run(batch, number):
            calls.append((layout.root, number))
            if layout is second and calls.count((layout.root, number)) == 1 and number == 1:
                raise RuntimeError("lost")
            ingest.process_rows(layout)(batch, number)

        return run

    both = dual.dual_write(first, second, process)
    with pytest.raises(RuntimeError):
        both(raw[1], 1)
    both(raw[1], 1)
    assert [c for c in calls if c[0] == first.root] == [(first.root, 1)]
    pointer = str(tmp_path / "live")
    with pytest.raises(RuntimeError, match="not swapped"):
        dual.swap(spark, first, second, pointer)
    dual.copy_history(spark, first, second, 1)
    both(raw[2], 2)
    dual.swap(spark, first, second, pointer)
    assert lake.resolve(spark, pointer) == second.root
    assert versions.final(ingest.read_raw(spark, second)).count() == 9 == states.merge_states(ingest.read_daily(spark, second)).head().tx_count
    ingest.compact(spark, first)
    with pytest.raises(ValueError, match="after the swap"):
        dual.copy_history(spark, first, second, 1)


def test_every_batch_leaves_a_row_of_progress(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "p"), "one", every=40)
    report = lambda i, n: SimpleNamespace(
        progress=SimpleNamespace(
            id="5f0c", name=None, batchId=i, timestamp=f"2024-01-10T12:{n:02}:00.000Z", numInputRows=n, processedRowsPerSecond=1.5,
            durationMs={"triggerExecution": 7}, stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=1)],
        )
    )
    for i in range(150):
        log.onQueryProgress(report(i, 1))
    log.onQueryProgress(report(149, 3))  # repeated after a restart
    log.onQueryTerminated(None)
    rows = progress.read_progress(spark, log.path)
    assert rows.count() == 150 and rows.agg(F.sum("rows_in"), F.sum("late_rows")).head()[:] == (152, 150)
    assert progress.compact_progress(spark, log.path) == 4 and progress.read_progress(spark, log.path).count() == 150


def test_windows_leave_open_hours_to_the_stream(spark, make_tx, tmp_path):
    layout, source = ingest.Layout(str(tmp_path / "w")), str(tmp_path / "in")
    rows = [payment(i, T0 + i * HOUR) for i in range(6)] + [payment(20, T0 + HOUR), payment(21, T0 + 5 * HOUR)]
    tx = make_tx(rows).withColumn("arrived", F.expr("IF(id >= 20, created_at + INTERVAL 9 HOURS, created_at)"))
    tx.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(tx.schema).parquet(source)
    for q in windows.start(stream, layout, "arrived", "1 hour"):
        q.awaitTermination()
    closed = lambda: {r.bucket: r.tx_count for r in windows.read(spark, layout).collect()}
    assert closed() == {T0 + i * HOUR: 1 for i in range(3)}
    assert windows.refresh_late(spark, layout, tx) == 1
    assert closed() == {T0: 1, T0 + HOUR: 2, T0 + 2 * HOUR: 1}
    left, _ = invalidation.pending(spark, windows.late_log(layout))
    assert [r.bucket for r in left.collect()] == [T0 + 5 * HOUR]
    assert windows.refresh_late(spark, layout, tx) == 0 and closed()[T0 + HOUR] == 2
