"""Repeated payments: planted frames, brute force, and keys that hold most of the table."""

from datetime import timedelta
from pathlib import Path

import numpy as np
import pandas as pd
from conftest import T0, payment
from pyspark.sql import Window
from pyspark.sql import functions as F

from paytide.operators import joins, windows
from paytide.plans import stored_queries  # noqa: F401
from paytide.plans.registry import QUERIES
from paytide.plans.views import Views
from paytide.sources import bulk

KEYS = windows.PAYMENT_KEYS


def planted(make_tx):
    return make_tx([payment(i, T0 + timedelta(seconds=90 * i)) for i in (1, 2, 3)])


def test_three_equal_payments_give_two_consecutive_hits(make_tx):
    rows = windows.duplicates_consecutive(planted(make_tx), T0 + timedelta(minutes=10)).collect()
    assert sorted((r.previous_id, r.id) for r in rows) == [(1, 2), (2, 3)]
    assert {float(r.seconds_between) for r in rows} == {90.0}


def test_three_equal_payments_give_three_pairs(make_tx):
    rows = joins.duplicate_pairs(planted(make_tx), T0 + timedelta(minutes=10)).collect()
    assert sorted((r.id_a, r.id_b) for r in rows) == [(1, 2), (1, 3), (2, 3)]


def test_ids_against_time_hide_pairs_but_not_neighbours(make_tx):
    tx = make_tx([payment(4 - i, T0 + timedelta(seconds=90 * i)) for i in (1, 2, 3)])
    end = T0 + timedelta(minutes=10)
    assert joins.duplicate_pairs(tx, end).count() == 0
    assert windows.duplicates_consecutive(tx, end).count() == 2


def test_edge_of_the_window_is_included(make_tx):
    tx = make_tx(
        [
            payment(1, T0),
            payment(2, T0 + timedelta(seconds=300)),
            payment(3, T0 + timedelta(seconds=600, microseconds=1)),
        ]
    )
    end = T0 + timedelta(hours=1)
    assert [r.id for r in windows.duplicates_consecutive(tx, end).collect()] == [2]
    assert [(r.id_a, r.id_b) for r in joins.duplicate_pairs(tx, end).collect()] == [(1, 2)]


def random_payments(spark, n=4000, seed=3):
    """A third of the rows share one key; times cluster around slot edges."""
    g = np.random.default_rng(seed)
    hot = g.random(n) < 0.34
    near_edge = g.integers(0, 12, n) * 3600 + g.integers(-400, 400, n)
    seconds = np.where(g.random(n) < 0.5, near_edge, g.integers(0, 43200, n)) + 3600
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "amount": np.where(hot, 10, g.integers(1, 40, n)).astype("int64"),
            "source_account_id": np.where(hot, 1, g.integers(1, 30, n)),
            "destination_account_id": np.where(hot, 2, g.integers(1, 5, n)),
            "created_at": pd.Timestamp(T0) + pd.to_timedelta(seconds, unit="s"),
        }
    )
    pdf["external_id"] = pdf["id"].astype(str)
    return pdf, spark.createDataFrame(pdf)


def test_slotted_lag_equals_plain_lag(spark):
    _, tx = random_payments(spark)
    end = T0 + timedelta(days=1)
    w = Window.partitionBy(*KEYS).orderBy("created_at", "id")
    plain = tx.withColumn("p", F.lag("id").over(w)).withColumn("pt", F.lag("created_at").over(w))
    gap = F.unix_micros("created_at") - F.unix_micros("pt")
    want = {(r.id, r.p) for r in plain.filter(gap <= 300_000_000).collect()}
    got = windows.duplicates_consecutive(tx, end).collect()
    assert len(got) == len(want) > 500
    assert {(r.id, r.previous_id) for r in got} == want


def test_slotted_pairs_equal_brute_force(spark):
    pdf, tx = random_payments(spark, 1500)
    got = {(r.id_a, r.id_b) for r in joins.duplicate_pairs(tx, T0 + timedelta(days=1)).collect()}
    want = set()
    for _, g in pdf.groupby(list(KEYS)):
        t, i = g["created_at"].to_numpy(), g["id"].to_numpy()
        d = (t[None, :] - t[:, None]).astype("timedelta64[us]").astype("int64")
        a, b = np.nonzero((d >= 0) & (d <= 300_000_000) & (i[:, None] < i[None, :]))
        want |= set(zip(i[a].tolist(), i[b].tolist()))
    assert got == want and len(want) > 500


def test_hot_key_is_cut_into_slots(spark):
    _, tx = random_payments(spark)
    df = windows.duplicates_consecutive(tx, T0 + timedelta(days=1))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_slot" in text and "windowspecdefinition(amount" in text


def test_consecutive_hits_are_among_the_pairs(spark):
    pdf, tx = random_payments(spark, 1500)
    ordered = tx.withColumn(
        "id", F.unix_seconds("created_at") * 10000 + F.col("id")
    )  # ids now follow time
    end = T0 + timedelta(days=1)
    pairs = {(r.id_a, r.id_b) for r in joins.duplicate_pairs(ordered, end).collect()}
    hits = {
        (r.previous_id, r.id) for r in windows.duplicates_consecutive(ordered, end).collect()
    }
    assert hits and hits <= pairs


def test_service_form_counts_whole_second_boundaries(make_tx):
    tx = make_tx(
        [
            payment(1, T0 + timedelta(milliseconds=900)),
            payment(2, T0 + timedelta(seconds=300, milliseconds=950)),
            payment(3, T0 + timedelta(seconds=601)),
        ]
    )
    tx = bulk.to_raw(tx, F.lit(T0))
    end = T0 + timedelta(hours=1)
    rows = windows.fraud_duplicates(tx, end).collect()
    # 1 -> 2 crosses 300 boundaries although 300.05 s passed; 2 -> 3 crosses 301
    assert [(r.tx_id, r.seconds_apart) for r in rows] == [(2, 300)]
    assert windows.fraud_duplicates(tx, end, limit=0).count() == 0


def test_stage_durations(spark):
    log = spark.createDataFrame(
        [
            (1, "pending", T0, 0),
            (1, "failed", T0 + timedelta(seconds=5), 1),
            (1, "settled", T0 + timedelta(seconds=65), 2),
        ],
        "tx_id BIGINT, status STRING, changed_at TIMESTAMP, seq INT",
    )
    rows = windows.stage_durations(log).orderBy("seq").collect()
    assert [None if r.seconds_in_stage is None else float(r.seconds_in_stage) for r in rows] == [
        5.0, 60.0, None,
    ]


def test_arrivals_are_written_by_as_many_tasks_as_hold_rows(spark, tmp_path):
    events = spark.range(1600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 26 AS INT)) AS ts", "id % 40 AS user_id",
        "'click' AS event_type", "cast(id % 7 AS DOUBLE) AS value", "concat('{\"k\": ', id % 100, '}') AS props",
    )
    events.repartition(16, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("arrivals-*"))
    rows = QUERIES["stream_tumbling_hourly"](Views(spark, str(tmp_path))).collect()
    (folder,) = set(shared.glob("arrivals-*")) - before
    assert len(list(folder.glob("part-*"))) > 5 * 2
    last = events.selectExpr("max(ts)").head()[0] - timedelta(hours=6, seconds=1)
    over = [e.ts for e in events.collect() if e.ts.replace(minute=0, second=0) + timedelta(hours=1) <= last]
    assert sum(r.tx_count for r in rows) == len(over) and max(r.bucket for r in rows) == max(over).replace(minute=0, second=0)
