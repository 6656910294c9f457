"""Retention, erasure, audited reads, rebuild and swap, refresh and gap filling."""

import hashlib
from datetime import datetime, timedelta

import pytest
from conftest import T0, payment
from pyspark.sql import functions as F

from paytide.functions.timing import month_key
from paytide.operators import aggregates as agg
from paytide.operators import lifecycle, quality, refresh, states
from paytide.operators.versions import purge_old_versions
from paytide.sources import bulk, lake

ACCOUNTS = (
    "id BIGINT, account_number STRING, institution_code STRING, holder_document STRING, "
    "holder_name STRING, status STRING"
)


@pytest.fixture()
def accounts(spark):
    rows = [(i, f"{i:04}", "001" if i < 4 else "002", f"0{i}", f"N{i}", "active") for i in range(1, 6)]
    return spark.createDataFrame(rows, ACCOUNTS)


def requests(spark, *ids):
    return spark.createDataFrame(
        [(i, T0, "dpo") for i in ids], "id BIGINT, requested_at TIMESTAMP, requester STRING"
    )


def test_retention_drops_whole_partitions_only(spark, make_tx, tmp_path):
    path = str(tmp_path / "t")
    old = [payment(d * 100 + i, datetime(2020, 1, 1 + d, 1)) for d in range(3) for i in range(100)]
    tx = make_tx(old).withColumn("day", F.to_date("created_at"))
    lake.replace_partitions(tx, path, "day")
    before = agg.volume_hourly(spark.read.parquet(path)).agg(F.sum("tx_count")).head()[0]
    parts = lifecycle.day_partitions(spark.read.parquet(path))
    covered = F.lit(datetime(2020, 1, 3))
    marks = lifecycle.droppable(parts, [covered], T0, "90 days").collect()
    may = {str(r.range_start.date()) for r in marks if r.can_drop}
    assert may == {"2020-01-01", "2020-01-02"}
    gone = lake.expire(spark, path, "day", "2020-12-31", may)
    assert gone == ["2020-01-01", "2020-01-02"]
    assert before == 300 and spark.read.parquet(path).count() == 100
    assert lake.expire(spark, path, "day", "2020-12-31", may) == []


def test_partial_bucket_survives_retention(make_tx):
    tx = make_tx([payment(1, T0 - timedelta(days=2, hours=3)), payment(2, T0 - timedelta(days=3))])
    assert [r.id for r in lifecycle.survivors(tx, "created_at", T0, "2 days").collect()] == [1]


def test_erasure_hashes_logs_and_keeps_facts(spark, accounts, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    lifecycle.erase_holders(spark, accounts, requests(spark, 2), "salt", T0, log, out)
    entry = spark.read.parquet(log).head()
    assert entry.document_hash == hashlib.sha256(b"02").hexdigest()
    assert entry.affected_rows == 1 and entry.backups_pending
    rows = {r.id: r for r in spark.read.parquet(out).collect()}
    assert rows[2].holder_name == "ANONIMIZADO" and rows[2].status == "closed"
    assert rows[2].holder_document == "ANON-" + hashlib.sha256(b"2salt").hexdigest()
    assert rows[1].holder_name == "N1" and len(rows) == 5


def test_unknown_account_is_an_error(spark, accounts, tmp_path):
    with pytest.raises(ValueError, match="99"):
        lifecycle.erase_holders(
            spark, accounts, requests(spark, 99), "s", T0, str(tmp_path / "l"), str(tmp_path / "o")
        )


def test_audited_read(spark, accounts, tmp_path):
    log = str(tmp_path / "log")
    rows = lifecycle.read_accounts_audited(accounts, "check", log, T0, "ana", "001", 2)
    assert [r.id for r in rows.collect()] == [1, 2]
    lifecycle.read_accounts_audited(accounts, "check", log, T0, "ana")
    entries = spark.read.parquet(log).orderBy("rows_returned").collect()
    assert [(e.rows_returned, e.purpose) for e in entries] == [(2, "check"), (5, "check")]
    assert "institution=TODAS" in entries[1].query_text
    for nothing in (None, "  "):
        with pytest.raises(ValueError):
            lifecycle.read_accounts_audited(accounts, nothing, log, T0, "ana")


def test_rewritten_log_is_found(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, x STRING")
    grown = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id INT, x STRING")
    forged = spark.createDataFrame([(1, "a"), (2, "B")], "id INT, x STRING")
    assert lifecycle.rewritten_log_rows(old, grown, "id").count() == 0
    assert [r.id for r in lifecycle.rewritten_log_rows(old, forged, "id").collect()] == [2]


def with_month(tx):
    return tx.select("id", "created_at", "amount", month_key("created_at").alias("yyyymm"))


def test_swap_only_after_every_partition_matches(spark, make_tx, tmp_path):
    pointer, cut = str(tmp_path / "ptr"), T0 - timedelta(days=1)
    source = with_month(make_tx([payment(i, T0 - timedelta(days=10 * i)) for i in range(6)]))
    lake.point_to(spark, pointer, "old")
    doubled = source.filter(F.col("created_at") >= F.lit(cut))
    with pytest.raises(RuntimeError):
        lifecycle.shadow_swap(spark, source, doubled.limit(0), cut, pointer, "id")
    assert lake.resolve(spark, pointer) == "old"
    target = lifecycle.shadow_swap(spark, source, doubled, cut, pointer, "id")
    assert lake.resolve(spark, pointer) == target
    assert spark.read.parquet(target).count() == 6


def test_equal_totals_do_not_hide_a_swapped_amount(spark, make_tx):
    a = with_month(make_tx([payment(1, T0, "1.00"), payment(2, T0, "2.00")]))
    b = with_month(make_tx([payment(1, T0, "2.00"), payment(2, T0, "1.00")]))
    diff = lifecycle.partition_diff(a, b, F.col("yyyymm"), "part", "id").head()
    assert diff.n_rows_source == diff.n_rows_shadow and not diff.matches


def test_recluster_spreads_and_keeps_rows(spark, make_tx, tmp_path):
    path = str(tmp_path / "c")
    tx = make_tx([payment(i, T0 - timedelta(minutes=i)) for i in range(400)])
    lifecycle.recluster(tx, path, files=4)
    copy = spark.read.parquet(path)
    assert copy.count() == 400 and len(copy.inputFiles()) == 4
    kept = lake.inventory(copy, "type").head()
    assert kept.n_rows == 400 and kept.files == 4 and kept.bytes > 0


def test_updates_touch_changed_rows_only(spark, make_tx):
    tx = make_tx([payment(1, T0, status="pending"), payment(2, T0), payment(3, T0, status="failed")])
    patch = spark.createDataFrame([(1, "settled"), (2, "settled")], "id BIGINT, status STRING")
    at = T0 + timedelta(days=1)
    rows = {r.id: r for r in lifecycle.apply_updates(tx, patch, "id", F.lit(at)).collect()}
    assert rows[1].status == "settled" and rows[1].updated_at == at
    assert rows[2].updated_at == T0 + timedelta(seconds=2) and rows[3].status == "failed"


def test_purge_of_old_versions_spares_other_keys(make_tx):
    def raw(i, status):
        return bulk.to_raw(make_tx([payment(i, T0, status=status)]), F.lit(T0))

    table = raw(1, "pending").unionByName(raw(1, "settled")).unionByName(raw(2, "pending"))
    table = table.unionByName(raw(2, "settled"))
    left = purge_old_versions(table, F.col("tx_id") == 1).collect()
    assert sorted((r.tx_id, r.status) for r in left) == [(1, "settled"), (2, "pending"), (2, "settled")]


def test_refresh_takes_whole_buckets_and_spares_the_open_one(make_tx):
    rows = [payment(i, T0 - timedelta(minutes=20 * i)) for i in range(15)]
    tx = make_tx(rows)
    empty = agg.volume_hourly(tx.limit(0))
    now = T0 + timedelta(minutes=30)
    got = refresh.refresh(
        empty, tx, now - timedelta(hours=3), now - timedelta(hours=1), "hour", agg.volume_hourly
    )
    assert sorted((r.bucket.hour, r.tx_count) for r in got.collect()) == [(10, 3)]
    stored = agg.volume_hourly(tx)
    again = refresh.refresh(
        stored, tx, now - timedelta(hours=3), now - timedelta(hours=1), "hour", agg.volume_hourly
    )
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stored.collect()))


def test_gapfill_edges(spark):
    h = datetime(2024, 1, 1)
    rows = [("a", h + timedelta(hours=2), 2, 10.0), ("a", h + timedelta(hours=5), 1, 40.0)]
    df = spark.createDataFrame(rows, "type STRING, bucket TIMESTAMP, n BIGINT, m DOUBLE")
    start, end = h + timedelta(minutes=30), h + timedelta(hours=7)
    out = refresh.gapfill(
        df, start, end, "hour", ["type"], zero=("n",), locf=("m",), interp=("m",)
    ).orderBy("bucket").collect()
    assert [r.n for r in out] == [0, 0, 2, 0, 0, 1, 0]
    assert [r.m_locf for r in out] == [None, None, 10, 10, 10, 40, 40]
    assert [r.m_interp for r in out] == [None, None, 10, 20, 30, 40, None]


def test_48_hours_from_mid_hour_touch_49_buckets(spark, make_tx):
    now = T0 + timedelta(minutes=17)
    tx = make_tx([payment(i, now - timedelta(hours=5 * i, minutes=1)) for i in range(9)])
    hourly = tx.groupBy(F.date_trunc("hour", "created_at").alias("bucket"), "type").agg(
        F.count("*").alias("n")
    )
    filled = refresh.gapfill(hourly, now - timedelta(hours=48), now, "hour", ["type"], zero=("n",))
    assert filled.count() == 49 and filled.filter("n IS NULL").count() == 0


def test_failure_rate_is_not_in_the_latency_partials(make_tx):
    tx = make_tx([payment(1, T0), payment(2, T0, status="failed")])
    assert agg.latency_daily(tx).head().failed_count == 0
    assert agg.top_institutions(tx, T0, "1 day").head().failure_rate == 0.5


def test_mean_of_means_is_not_used(make_tx):
    slow = [payment(1, T0, settled_at=T0 + timedelta(seconds=100))]
    fast = [payment(i, T0 + timedelta(days=1), settled_at=T0 + timedelta(days=1, seconds=1)) for i in range(2, 6)]
    top = agg.top_institutions_from_daily(agg.latency_daily(make_tx(slow + fast)), T0, "9 days")
    assert top.head().mean_seconds == (100 + 4) / 5 and float(top.head().worst_seconds) == 100


def test_means_ignore_unsettled_rows(make_tx):
    raw = bulk.to_raw(make_tx([payment(1, T0), payment(2, T0, status="pending")]), F.lit(T0))
    assert states.daily_report(states.daily_states(raw)).head().avg_settle_seconds == 2.0


def test_sketch_quantiles_by_rank_error(spark, make_tx):
    rows = [payment(i, T0 + timedelta(days=i % 3), f"{(i * 7919) % 5000 + 1}.00") for i in range(6000)]
    raw = bulk.to_raw(make_tx(rows), F.lit(T0)).persist()
    merged = states.merge_states(states.daily_states(raw, sketch=True), "source_institution")
    for q in (0.5, 0.95, 0.99):
        estimate = merged.select(states.quantile("amount_sketch", q)).head()[0]
        rank = raw.filter(F.col("amount") <= estimate).count() / 6000
        assert abs(rank - q) <= 0.02


def test_health_has_no_row_without_traffic(spark, make_tx):
    raw = bulk.to_raw(make_tx([payment(1, T0), payment(2, T0, status="failed")]), F.lit(T0))
    dim = spark.createDataFrame([("009", "Nine")], "code STRING, name STRING")
    funnel = states.funnel_states(raw, sketch=True)
    row = states.institution_health(funnel, dim, T0, 1, code="001").head()
    assert (row.institution_name, row.total, row.success_rate) == ("unknown", 2, 0.5)
    assert row.p95_settlement_seconds == 2.0
    assert states.institution_health(funnel, dim, T0, 1, code="005").count() == 0


def test_success_rate_without_a_previous_day_has_no_delta(spark, make_tx):
    now = T0 + timedelta(minutes=30)
    raw = bulk.to_raw(
        make_tx([payment(1, T0), payment(2, T0, status="failed"), payment(3, T0 - timedelta(hours=24))]),
        F.lit(T0),
    )
    dim = spark.createDataFrame([("001", "One")], "code STRING, name STRING")
    rows = states.success_rate_vs_previous_day(states.funnel_states(raw), dim, now, "pix").collect()
    # the bucket holding now - 24 h began before it, so it belongs to the previous day
    assert [(r.hour_of_day, r.institution, r.rate_today, r.rate_previous, r.delta_points) for r in rows] == [
        (12, "One", 50.0, 100.0, -50.0)
    ]
    only = states.success_rate_vs_previous_day(
        states.funnel_states(raw.filter("tx_id < 3")), dim, now, "pix"
    ).head()
    assert only.rate_previous is None and only.delta_points is None


def test_rules_count_planted_violations(make_tx):
    tx = make_tx(
        [
            payment(1, T0, "0.00"),
            payment(2, T0, status="lost"),
            payment(3, T0, settled_at=T0 - timedelta(seconds=1)),
            payment(4, T0, src=None, dst=None),
            payment(5, T0 + timedelta(days=9)),
            payment(6, T0, type_="cash"),
        ]
    )
    rules = quality.transaction_rules(F.lit(T0 + timedelta(days=1)), ("pix", "ted"))
    got = {r.rule: r.violations for r in quality.violations(tx, rules).collect()}
    assert {k: v for k, v in got.items() if v} == {
        "amount_not_positive": 1, "settled_before_created": 1, "status_out_of_domain": 1,
        "type_out_of_domain": 1, "no_account": 1, "created_in_future": 1, "settled_in_future": 1,
    }


def test_generated_difference(spark):
    df = spark.sql("SELECT CAST(100.00 AS DECIMAL(18,2)) amount_expected, CAST(99.95 AS DECIMAL(18,2)) amount_received")
    assert str(quality.with_difference(df).head().difference) == "-0.05"


def test_personal_columns_are_absent_from_the_mirror(spark, make_tx, accounts):
    raw = bulk.to_raw(make_tx([payment(1, T0)]))
    tables = {"raw": raw, "daily": states.daily_states(raw), "accounts": accounts}
    hits = {r.table_name for r in quality.pii_columns(spark, tables).collect()}
    assert hits == {"accounts"}
