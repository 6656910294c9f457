"""A mirror that is merged while others write, loads that resume, and look-backs that prune."""

from datetime import date, datetime, timedelta

import pytest
from conftest import T0, executed, payment
from pyspark.sql import functions as F

from paytide.operators import compaction, states, versions
from paytide.sources import bulk, increment, lake, ledger
from paytide.sources.tables import STORED_SCHEMA
from paytide.streaming import ingest, poll

FIRST, UNTIL = date(2024, 1, 1), date(2024, 2, 1)


def counted(spark, layout):
    return states.merge_states(ingest.read_daily(spark, layout)).head()


def batch(make_tx, i, n=5):
    return bulk.to_raw(make_tx([payment(10 * i + j, T0 + timedelta(hours=7 * j), amount=f"{j}.25") for j in range(n)]))


@pytest.fixture()
def mirror(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"), sketches=True)
    for i in range(6):
        ingest.process_rows(layout)(batch(make_tx, i), i)
    ingest.process_rows(ingest.Layout(layout.root, "other", True))(batch(make_tx, 9), 0)
    return layout


def test_states_are_merged_to_one_row_per_key(spark, make_tx, mirror):
    before = states.daily_report(ingest.read_daily(spark, mirror)).sort(*states.DAILY_KEYS).collect()
    assert ingest.compact(spark, mirror) == {"raw": 7, "daily": 7, "funnel": 7, "dlq": 0, "metrics": 0}
    daily = ingest.read_daily(spark, mirror)
    assert daily.groupBy(*states.DAILY_KEYS).count().agg(F.max("count")).head()[0] == 1
    assert states.daily_report(daily).sort(*states.DAILY_KEYS).collect() == before
    assert lake.writers(spark, mirror.daily) == {"compacted"} and len(lake.batches(spark, mirror.daily)) == 1
    funnel = ingest.read_funnel(spark, mirror)
    assert funnel.count() == funnel.select(*states.FUNNEL_KEYS).distinct().count() and funnel.agg(F.sum("cnt")).head()[0] == 35
    # the merged sketch answers as one over all rows
    merged = states.merge_states(daily).select(states.quantile("amount_sketch", 0.5).alias("q")).head().q
    assert merged == 2.25
    assert versions.final(ingest.read_raw(spark, mirror)).count() == 35
    assert ingest.compact(spark, mirror)["daily"] == 0


def test_a_batch_written_during_a_merge_stays(spark, make_tx, mirror, monkeypatch):
    real = lake.write_batch

    def slow(df, path, batch_id, by="yyyymm", writer="stream"):
        real(df, path, batch_id, by, writer)
        if writer == compaction.COMPACTED and path == mirror.daily:
            monkeypatch.setattr(lake, "write_batch", real)
            ingest.process_rows(mirror)(batch(make_tx, 6), 6)

    monkeypatch.setattr(compaction.lake, "write_batch", slow)
    ingest.compact(spark, mirror)
    assert counted(spark, mirror).tx_count == 40
    ingest.compact(spark, mirror)
    assert counted(spark, mirror).tx_count == 40 and len(lake.batches(spark, mirror.daily)) == 1


@pytest.mark.parametrize("dies", ["_commit", "drop"])
def test_a_merge_that_dies_counts_nothing_twice(spark, make_tx, mirror, monkeypatch, dies):
    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(*((compaction, "_commit") if dies == "_commit" else (compaction.lake, "drop_batches")), fail)
        with pytest.raises(RuntimeError):
            ingest.compact(spark, mirror)
        assert ingest.read_raw(spark, mirror).count() == 35 and counted(spark, mirror).tx_count == 35
    # a replay of a batch that is merged stays out of sight
    ingest.process_rows(mirror)(batch(make_tx, 5), 5)
    assert counted(spark, mirror).tx_count == 35
    ingest.compact(spark, mirror)
    assert counted(spark, mirror).tx_count == 35
    assert len(lake.batches(spark, mirror.daily)) == 1 == len(lake.batches(spark, mirror.raw))


def test_newest_batches_can_be_left(spark, make_tx, mirror):
    assert ingest.compact(spark, mirror, leave=1)["raw"] == 5
    left = sorted(x[1:] for x in lake.batches(spark, mirror.raw) if x[1] != "compacted")
    assert left == [("other", 0), ("stream", 5)] and compaction.last_merged(spark, mirror.raw, "stream") == 4


def test_the_log_of_merges_stays_short(spark, make_tx, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "LOG_FILES", 2)
    layout = ingest.Layout(str(tmp_path / "m"))
    for i in range(5):
        ingest.write_raw(batch(make_tx, i, 1), i, layout)
        versions.compact(spark, layout.raw)
        assert len(lake.files(spark, f"{layout.raw}/{compaction.LOG}")) <= 3
    assert ingest.read_raw(spark, layout).count() == 5


def test_merged_parts_are_pruned_by_folder(spark, mirror):
    ingest.compact(spark, mirror)
    plan = executed(ingest.read_daily(spark, mirror).filter("yyyymm = 202401"))
    assert "PartitionFilters: []" not in plan and "batch_id" in plan.split("PartitionFilters")[1]


def test_a_merged_writer_needs_another_name(spark, make_tx, mirror, tmp_path):
    ingest.compact(spark, mirror)
    batch(make_tx, 7).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch(make_tx, 7).schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="another writer"):
        ingest.start(stream, ingest.process_rows(mirror), mirror)


def test_polls_leave_a_bounded_number_of_files(spark, make_tx, tmp_path):
    layout, rows = ingest.Layout(str(tmp_path / "p")), []
    for i in range(10):
        rows.append(payment(i, T0 + timedelta(minutes=i)))
        poll.cycle(spark, make_tx(rows), layout, T0 + timedelta(hours=1, minutes=i), compact_every=3)
        assert len(lake.batches(spark, layout.raw)) <= 3 and len(lake.batches(spark, layout.daily)) <= 3
    assert len(lake.partitions(spark, f"{layout.root}/sync_state/source=transactions", "cycle")) == increment.KEPT_STATES
    assert counted(spark, layout).tx_count == 10 == versions.final(ingest.read_raw(spark, layout)).count()
    shared = spark.conf.get("spark.checkpoint.dir")
    assert not any(d.startswith(("cycle-", "candidates-")) for d in __import__("os").listdir(shared))


def test_a_poll_that_lost_its_state_numbers_above_what_is_merged(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "p"))
    poll.cycle(spark, make_tx([payment(1, T0)]), layout, T0, compact_every=1)
    lake.drop_partition(spark, layout.root, "sync_state")
    poll.cycle(spark, make_tx([payment(1, T0), payment(2, T0)]), layout, T0)
    assert versions.final(ingest.read_raw(spark, layout)).count() == 2
    with pytest.raises(ValueError, match="merged already"):
        poll.cycle(spark, make_tx([payment(3, T0)]), layout, T0, batch_id=0)


def test_two_writers_keep_each_others_letters_and_metrics(spark, tmp_path):
    for name in ("one", "two"):
        layout = ingest.Layout(str(tmp_path / "d"), name)
        ingest.process_cdc(layout)(spark.createDataFrame([(f"bad {name}".encode(),)], "value BINARY"), 0)
    letters = ingest.read_letters(spark, layout)
    assert sorted(r.value for r in letters.collect()) == ["bad one", "bad two"]
    ingest.process_cdc(layout)(spark.createDataFrame([(b"{",)], "value BINARY"), 1)
    assert ingest.compact(spark, layout)["dlq"] == 3
    assert ingest.read_letters(spark, layout).count() == 3 and len(lake.batches(spark, layout.dlq, None)) == 1
    metrics = ingest.read_metrics(spark, layout).collect()
    assert sorted((m.of_writer, m.of_batch, m.dead_letters) for m in metrics) == [("one", 0, 1), ("two", 0, 1), ("two", 1, 1)]


def test_a_look_back_opens_only_the_months_it_touches(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"))
    tx = make_tx([payment(i, T0 - timedelta(days=20 * i), updated_at=T0 - timedelta(days=20 * i)) for i in range(12)])
    ingest.write_raw(bulk.to_raw(tx.filter("id <> 1")), 0, layout)
    wm = T0 + timedelta(seconds=1)
    tx.write.parquet(str(tmp_path / "seen"))
    seen = increment.looked_at_again(spark.read.schema(tx.schema).parquet(str(tmp_path / "seen")), wm, 21 * 86400)
    left = increment.lacking(seen, ingest.read_raw(spark, layout), increment.overlap_start(wm, 21 * 86400))
    plan = executed(left)
    assert [r.id for r in left.collect()] == [1]
    filters = [p.split("DataFilters")[0].split("PushedFilters")[0] for p in plan.split("PartitionFilters: ")[1:]]
    assert any("dynamicpruning" in f and "yyyymm" in f for f in filters), filters


def days(n=31):
    return bulk.day_slices(FIRST, FIRST + timedelta(days=n))


def test_day_slices_of_one_month_keep_their_rows(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"))
    tx = make_tx([payment(i, datetime(2024, 1, 1, 5) + timedelta(days=i)) for i in range(4)])
    assert len(ingest.load(tx, layout, days(), slices_a_job=7)) == 31
    assert sorted(r.tx_id for r in ingest.read_raw(spark, layout).collect()) == [0, 1, 2, 3]
    assert counted(spark, layout).tx_count == 4
    hours = [(datetime(2024, 2, 1, h), datetime(2024, 2, 1, h + 1)) for h in range(3)]
    more = make_tx([payment(10 + h, datetime(2024, 2, 1, h, 59, 59)) for h in range(4)])
    ingest.load(more, layout, hours)
    assert ingest.read_raw(spark, layout).count() == 7 and counted(spark, layout).tx_count == 7
    with pytest.raises(ValueError, match="overlaps"):
        ingest.load(tx, layout, bulk.month_slices(FIRST, UNTIL))
    with pytest.raises(ValueError, match="overlaps"):
        bulk.bulk_load(tx, str(tmp_path / "x"), [*days(3), (date(2024, 1, 3), date(2024, 1, 9))])


def test_a_stopped_load_goes_on_where_it_was(spark, make_tx, tmp_path, monkeypatch):
    layout = ingest.Layout(str(tmp_path / "m"))
    tx = make_tx([payment(i, datetime(2024, 1, 1) + timedelta(hours=6 * i)) for i in range(80)])
    real, jobs = ledger.record, []

    def stops(spark_, table, entries):
        jobs.append(len(entries))
        if len(jobs) == 3:
            raise RuntimeError("stopped")  # rows and states are written, the record is not
        real(spark_, table, entries)

    monkeypatch.setattr(bulk.ledger, "record", stops)
    with pytest.raises(RuntimeError):
        ingest.load(tx, layout, days(), slices_a_job=5)
    monkeypatch.setattr(bulk.ledger, "record", real)
    assert len(ledger.book(spark, layout.raw, "load")) == 10
    assert len(ingest.load(tx, layout, days(), resume=True, slices_a_job=5)) == 21
    assert ingest.load(tx, layout, days(), resume=True) == []
    assert ingest.read_raw(spark, layout).count() == 80 and counted(spark, layout).tx_count == 80
    checked = bulk.verify(spark, layout.raw).collect()
    assert len(checked) == 31 and all(r.matches for r in checked) and sum(r.n_rows for r in checked) == 80
    assert all(r.matches for r in bulk.verify(spark, layout.raw, tx=tx).collect())
    assert [r.matches for r in bulk.verify(spark, layout.raw, tx=tx.filter("id <> 7")).collect()].count(False) == 1
    lake.drop_batches(spark, layout.raw, [x for x in lake.batches(spark, layout.raw)][:1])
    assert [r.matches for r in bulk.verify(spark, layout.raw).collect()].count(False) == 1


def test_a_slice_loaded_again_replaces_itself(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"))
    rows = [payment(i, datetime(2024, 1, 1 + i)) for i in range(3)]
    ingest.load(make_tx(rows), layout, days(3))
    ingest.load(make_tx(rows[:2]), layout, days(3)[2:])
    assert sorted(r.tx_id for r in ingest.read_raw(spark, layout).collect()) == [0, 1]
    ingest.load(make_tx([payment(0, datetime(2024, 1, 1), status="failed")]), layout, days(1))
    assert counted(spark, layout).tx_count == 2 and counted(spark, layout).failed_count == 1
    # after a merge the new batch lies above it, and versions decide
    ingest.compact(spark, layout)
    later = payment(0, datetime(2024, 1, 1), updated_at=datetime(2024, 1, 9))
    ingest.load(make_tx([later]), layout, days(1))
    assert sorted((r.tx_id, r.status) for r in versions.final(ingest.read_raw(spark, layout)).collect()) == [(0, "settled"), (1, "settled")]


def test_superseded_versions_leave_the_stored_table(spark, make_tx, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"))
    pending = [payment(i, T0 - timedelta(days=40 * i), status="pending", inst=f"00{i}") for i in range(3)]
    ingest.write_raw(bulk.to_raw(make_tx(pending)), 0, layout)
    ingest.write_raw(bulk.to_raw(make_tx([payment(i, T0 - timedelta(days=40 * i), inst=f"00{i}") for i in range(3)])), 1, layout)
    assert versions.purge_stored_versions(spark, layout.raw, F.col("source_institution") == "001") == [202312]
    left = compaction.rows(spark, layout.raw, STORED_SCHEMA).groupBy("tx_id").count().collect()
    assert sorted(map(tuple, left)) == [(0, 2), (1, 1), (2, 2)]
    assert versions.purge_stored_versions(spark, layout.raw, F.col("source_institution") == "001") == []
