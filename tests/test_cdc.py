"""Change events: every refusal reason, typed fields, and the stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paytide.operators import states, versions
from paytide.sources import cdc, lake
from paytide.streaming import ingest
from paytide.streaming.progress import progress_metrics

ROW = {
    "id": 7, "external_id": "u-7", "amount": "10.50", "currency": "BRL", "status": "pending",
    "type": "pix", "source_institution": "001", "destination_institution": "002",
    "source_account_id": 5, "destination_account_id": None,
    "created_at": "2024-01-10T12:00:00.123456Z", "settled_at": None,
    "updated_at": "2024-01-10T12:00:01.999999Z", "metadata": None,
}


def event(op="c", source=None, image=None, **over):
    row = {**ROW, **over}
    row = {k: v for k, v in row.items() if v != "<absent>"}
    payload = {"op": op, "source": source or {"ts_ms": 1}}
    payload["before" if op == "d" else "after"] = row if image is None else image
    return json.dumps({"payload": payload})


BAD = [
    ("{", "invalid JSON"),
    ("", "invalid JSON"),
    (event() + " x", "invalid JSON"),
    (event() + "," + event(), "invalid JSON"),
    ("[1, 2]", "envelope is not an object"),
    ("3", "envelope is not an object"),
    ('{"a": 1}', "payload missing or not an object"),
    ('{"payload": 5}', "payload missing or not an object"),
    ('{"payload": {"after": {}}}', "op missing"),
    ('{"payload": {"op": "d", "after": {"id": 1}}}', "row image missing"),
    ('{"payload": {"op": "u", "after": null}}', "row image missing"),
    (event(amount="ten"), "invalid amount"),
    (event(amount="<absent>"), "invalid amount"),
    (event(created_at="yesterday"), "invalid timestamp"),
    (event(created_at="<absent>"), "invalid timestamp"),
    (event(created_at="2024"), "invalid timestamp"),
    (event(created_at="12:34:56.789"), "invalid timestamp"),
    (event(created_at="2024-1-1T00:00:00Z"), "invalid timestamp"),
    (event(settled_at="2024-13-01T00:00:00Z"), "invalid timestamp"),
    (event(updated_at="noon"), "invalid updated_at"),
    (event(updated_at=None, source={"other": 1}), "no version"),
    (event(id="x7"), "invalid id"),
    (event(external_id=None), "missing field"),
    (event(status="<absent>"), "missing field"),
    (event(source_account_id="abc"), "invalid account id"),
    (event(destination_account_id=""), "invalid account id"),
]


def parse(spark, texts):
    return cdc.parse_cdc(spark.createDataFrame([(t.encode(),) for t in texts], "value BINARY"))


def test_every_reason(spark):
    rows = parse(spark, [t for t, _ in BAD]).select("_text", "_reason").collect()
    assert {r._text: r._reason for r in rows} == dict(BAD)
    assert {r for _, r in BAD} == set(cdc.REASONS)


def test_dead_letters_keep_the_whole_text(spark):
    long = event(amount="x" * 5000)
    letter = cdc.split_dlq(parse(spark, [long, event()])).collect()
    assert [(r.value, r.reason) for r in letter] == [(long, "invalid amount")]


def test_typed_fields_and_defaults(spark):
    row = cdc.good_rows(parse(spark, [event(currency="<absent>", amount=10.5)])).collect()[0]
    assert (row.tx_id, str(row.amount), row.currency) == (7, "10.50", "BRL")
    assert row.created_at == datetime(2024, 1, 10, 12, 0, 0, 123456)
    assert (row.source_account_id, row.destination_account_id, row.metadata) == (5, 0, "{}")
    # milliseconds are cut, not rounded
    assert row._version % 1000 == 999 and row._is_deleted == 0 and row.settlement_seconds is None


def test_delete_reads_the_before_image(spark):
    row = cdc.good_rows(parse(spark, [event(op="d")])).collect()[0]
    assert row._is_deleted == 1 and row.external_id == "u-7"


def test_version_falls_back_to_the_event_time(spark):
    row = cdc.good_rows(parse(spark, [event(updated_at=None, source={"ts_ms": 42})])).collect()[0]
    assert row._version == 42


def test_offset_times_are_converted(spark):
    row = cdc.good_rows(parse(spark, [event(created_at="2024-01-10T09:00:00-03:00")])).collect()[0]
    assert row.created_at == datetime(2024, 1, 10, 12, 0)


@pytest.fixture()
def landed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, events):
        (folder / name).write_text("\n".join(events) + "\n")
        return str(folder)

    return land


def test_stream_delivers_versions_letters_states_and_metrics(spark, landed, tmp_path):
    source = landed("a.json", [event(), event(id=8, external_id="u-8"), "{"])
    layout = ingest.Layout(str(tmp_path / "out"))
    stream = cdc.file_source(spark, source)
    query = ingest.start(stream, ingest.process_cdc(layout), layout)
    query.awaitTermination()
    assert progress_metrics(spark, query).agg(F.sum("rows_in")).head()[0] == 3
    settled = event(
        op="u", status="settled", settled_at="2024-01-10T12:00:02Z", updated_at="2024-01-10T12:00:02Z"
    )
    landed("b.json", [settled, event(op="d", id=8, external_id="u-8", updated_at="2024-01-10T12:00:03Z")])
    ingest.start(cdc.file_source(spark, source), ingest.process_cdc(layout), layout).awaitTermination()

    raw = ingest.read_raw(spark, layout)
    assert raw.count() == 4
    live = versions.live(raw).collect()
    assert [(r.external_id, r.status) for r in live] == [("u-7", "settled")]
    # the states count every version inserted; rebuilding from resolved versions repairs them
    daily = ingest.read_daily(spark, layout)
    assert states.merge_states(daily).head().tx_count == 4
    assert states.merge_states(states.rebuild_states(raw)).head().tx_count == 2
    assert ingest.read_letters(spark, layout).count() == 1
    metrics = ingest.read_metrics(spark, layout).orderBy("of_batch").collect()
    assert [(m.rows_read, m.rows_written, m.dead_letters) for m in metrics] == [(3, 2, 1), (2, 2, 0)]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    layout = ingest.Layout(str(tmp_path / "m"))
    batch = spark.createDataFrame([(event().encode(),), (b"{",)], "value BINARY")
    run = ingest.process_cdc(layout)
    for batch_id in (0, 0, 1):
        run(batch, batch_id)
    assert ingest.read_raw(spark, layout).count() == 2
    assert versions.final(ingest.read_raw(spark, layout)).count() == 1
    assert ingest.read_letters(spark, layout).count() == 2
    assert states.merge_states(ingest.read_daily(spark, layout)).head().tx_count == 2


def test_a_failed_batch_is_read_again(spark, landed, tmp_path):
    source = landed("a.json", [event()])
    layout = ingest.Layout(str(tmp_path / "f"))
    real = ingest.process_cdc(layout)

    def fails(batch, batch_id):
        real(batch, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        ingest.start(cdc.file_source(spark, source), fails, layout).awaitTermination()
    ingest.start(cdc.file_source(spark, source), real, layout).awaitTermination()
    assert ingest.read_raw(spark, layout).count() == 1


def test_compaction_leaves_one_version(spark, tmp_path):
    layout = ingest.Layout(str(tmp_path / "c"))
    run = ingest.process_cdc(layout)
    run(spark.createDataFrame([(event().encode(),)], "value BINARY"), 0)
    newer = event(op="u", status="failed", updated_at="2024-01-10T12:01:00Z")
    run(spark.createDataFrame([(newer.encode(),)], "value BINARY"), 1)
    before = versions.final(ingest.read_raw(spark, layout)).drop("writer", "batch_id").collect()
    versions.compact(spark, layout.raw, [202401])
    after = ingest.read_raw(spark, layout).drop("writer", "batch_id").collect()
    assert after == before and len(after) == 1
    assert lake.partitions(spark, f"{layout.raw}/yyyymm=202401/writer=compacted", "batch_id") == ["0"]
    # the stream goes on under its own name, and a later compaction takes both in
    again = event(op="u", status="settled", updated_at="2024-01-10T12:02:00Z")
    run(spark.createDataFrame([(again.encode(),)], "value BINARY"), 2)
    versions.compact(spark, layout.raw, [202401])
    assert [r.status for r in ingest.read_raw(spark, layout).collect()] == ["settled"]
    assert lake.partitions(spark, f"{layout.raw}/yyyymm=202401/writer=compacted", "batch_id") == ["1"]


def test_hourly_stream_closes_windows(spark, make_tx, tmp_path):
    from datetime import timedelta

    from conftest import T0, TX_SCHEMA, payment

    folder = str(tmp_path / "tx")
    make_tx([payment(i, T0 + timedelta(minutes=30 * i)) for i in range(8)]).write.parquet(folder)
    stream = spark.readStream.schema(TX_SCHEMA).parquet(folder)
    out = str(tmp_path / "agg")
    (
        ingest.hourly_counts(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    rows = spark.read.parquet(out).orderBy("bucket").collect()
    # the newest event is at 15:30 and lateness is an hour: windows up to 14:00 are closed
    assert [(r.bucket.hour, r.tx_count) for r in rows] == [(12, 2), (13, 2)]
