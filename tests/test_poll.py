"""Poll cycles: late commits, crashes between steps, and updates to old rows."""

from datetime import timedelta

import pytest
from conftest import T0, payment

from paytide.operators import versions
from paytide.sources import bulk, lake
from paytide.streaming import ingest, poll


def ids(spark, layout):
    return sorted(r.tx_id for r in versions.live(poll.read_target(spark, layout)).collect())


def test_cycles_catch_late_commits_and_old_updates(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path))
    old = payment(1, T0 - timedelta(days=60), status="pending")
    base = [old, payment(2, T0, status="pending"), payment(4, T0 + timedelta(seconds=10), status="pending")]
    first = poll.cycle(spark, make_tx(base), layout, T0 + timedelta(minutes=1), 0)
    assert first["last_id"] == 4 and first["last_full_scan_at"] is not None

    # 3 committed late, just below the watermark
    late = [*base, payment(3, T0 + timedelta(seconds=5), status="pending")]
    second = poll.cycle(spark, make_tx(late), layout, T0 + timedelta(minutes=2), 1)
    assert ids(spark, layout) == [1, 2, 3, 4] and second["last_id"] == 4
    assert second["rows_synced"] == 4

    # an old row changes behind the creation floor: only the daily full scan sees it
    reversed_ = payment(
        1, T0 - timedelta(days=60), status="reversed", updated_at=T0 + timedelta(hours=2)
    )
    changed = [reversed_, *late[1:]]
    poll.cycle(spark, make_tx(changed), layout, T0 + timedelta(hours=3), 2)
    current = versions.final(poll.read_target(spark, layout))
    assert current.filter("tx_id = 1").head().status == "pending"
    poll.cycle(spark, make_tx(changed), layout, T0 + timedelta(hours=26), 3)
    current = versions.final(poll.read_target(spark, layout))
    assert current.filter("tx_id = 1").head().status == "reversed"


def test_a_crash_before_the_commit_rereads_the_same_rows(spark, make_tx, tmp_path, monkeypatch):
    layout = ingest.Layout(str(tmp_path))
    tx = make_tx([payment(i, T0) for i in range(5)])
    real = poll.increment.commit_state

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(poll.increment, "commit_state", dies)
    with pytest.raises(RuntimeError):
        poll.cycle(spark, tx, layout, T0, 0)
    monkeypatch.setattr(poll.increment, "commit_state", real)
    state = poll.cycle(spark, tx, layout, T0, 0)
    assert state["rows_synced"] == 5 and ids(spark, layout) == [0, 1, 2, 3, 4]
    assert poll.read_target(spark, layout).count() == 5


def test_an_idle_cycle_writes_nothing_and_keeps_the_mark(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path))
    tx = make_tx([payment(1, T0)])
    a = poll.cycle(spark, tx, layout, T0, 0)
    b = poll.cycle(spark, tx, layout, T0 + timedelta(seconds=10), 1)
    assert poll.read_target(spark, layout).count() == 1
    assert (a["last_updated_at"], a["last_id"]) == (b["last_updated_at"], b["last_id"])


def test_a_capped_full_scan_goes_on_until_it_is_drained(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path))
    rows = [payment(i, T0 + timedelta(minutes=i)) for i in (1, 2)]
    poll.drain(spark, make_tx(rows), layout, T0 + timedelta(hours=1), batch=1)
    # five days later; row 3 is new to the source but was created long ago
    back = T0 + timedelta(days=5)
    rows += [
        payment(3, T0 - timedelta(days=60), updated_at=back),
        payment(4, back + timedelta(minutes=1)),
        payment(5, back + timedelta(minutes=2)),
    ]
    first = poll.cycle(spark, make_tx(rows), layout, back + timedelta(hours=1), batch=1)
    assert first["capped"] and first["last_full_scan_at"] < back
    last = poll.drain(spark, make_tx(rows), layout, back + timedelta(hours=2), batch=1)
    assert ids(spark, layout) == [1, 2, 3, 4, 5]
    assert not last["capped"] and last["last_full_scan_at"] == back + timedelta(hours=2)
    assert poll.read_target(spark, layout).count() == 5


def test_an_empty_source_leaves_no_mark(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path))
    assert poll.cycle(spark, make_tx([]), layout, T0)["last_updated_at"] is None
    poll.cycle(spark, make_tx([payment(1, T0)]), layout, T0 + timedelta(minutes=1))
    state = poll.cycle(spark, make_tx([payment(1, T0), payment(2, T0 + timedelta(minutes=1))]), layout, T0 + timedelta(minutes=2))
    assert state["last_id"] == 2 and ids(spark, layout) == [1, 2]


def test_writers_share_a_table_without_erasing_each_other(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path))
    ingest.process_rows(layout)(bulk.to_raw(make_tx([payment(1, T0)])), 0)
    ingest.process_rows(ingest.Layout(str(tmp_path), writer="other"))(bulk.to_raw(make_tx([payment(2, T0)])), 0)
    poll.cycle(spark, make_tx([payment(3, T0)]), layout, T0 + timedelta(hours=1))
    months = bulk.month_slices(T0.date(), T0.date() + timedelta(days=1))
    ingest.load(make_tx([payment(4, T0), payment(5, T0)]), layout, months)
    assert ids(spark, layout) == [1, 2, 3, 4, 5]
    ingest.load(make_tx([payment(5, T0)]), layout, months)
    assert ids(spark, layout) == [1, 2, 3, 5]
    ingest.load(make_tx([]), layout, months)
    assert ids(spark, layout) == [1, 2, 3]
    assert spark.read.parquet(layout.funnel).filter("writer = 'load'").count() == 0
    versions.compact(spark, layout.raw, [202401])
    assert ids(spark, layout) == [1, 2, 3] and lake.writers(spark, layout.raw) == {"compacted"}


def test_a_new_checkpoint_needs_a_new_writer(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "mirror"))
    raw = bulk.to_raw(make_tx([payment(1, T0)]))
    raw.write.parquet(str(tmp_path / "in"))
    ingest.process_rows(layout)(raw, 0)
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="another writer"):
        ingest.start(stream, ingest.process_rows(layout), layout)


def test_a_range_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 202401), (2, 202402)], "v INT, yyyymm INT")
    lake.replace_partitions(rows, path, "yyyymm")
    lake.replace_range(rows.filter("v = 2"), path, "yyyymm", [202401, 202402])
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
