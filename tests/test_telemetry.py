"""Alert rules on the eleven known scenarios, and the metric functions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paytide.operators import telemetry as t

EPOCH = datetime(1970, 1, 1)
SCHEMA = "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, value DOUBLE"


def series(spark, *specs):
    """(metric, labels, [value at minute 0, 1, ...])"""
    rows = [
        (EPOCH + timedelta(minutes=i), metric, labels, float(v))
        for metric, labels, values in specs
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def firing(samples, minute):
    at = F.lit(EPOCH + timedelta(minutes=minute))
    return t.evaluate_alerts(samples, t.RULES, at).collect()


SAW = [60, 120, 180, 240, 300, 0, 60, 120, 180, 240, 300, 0, 60, 120, 180, 240]
UP = {"job": "worker", "instance": "worker:1"}
CASES = [
    ("stalled needs both", [("sync_last_success_timestamp", {}, [0] * 21), ("sync_lag_seconds", {}, [120] * 21)], 10, {"PipelineStalled", "LagGrowing"}),
    ("idle is not stalled", [("sync_last_success_timestamp", {}, [0] * 21), ("sync_lag_seconds", {}, [0] * 21)], 10, set()),
    ("lag still pending", [("sync_lag_seconds", {}, [90] * 21)], 3, set()),
    ("lag after its hold", [("sync_lag_seconds", {}, [90] * 21)], 6, {"LagGrowing"}),
    ("lag within target", [("sync_lag_seconds", {}, [10] * 21)], 10, set()),
    ("reference not checked", [("refsync_check_age_seconds", {}, [900 + 60 * i for i in range(21)])], 8, {"ReferenceStale"}),
    ("reference static but checked", [("refsync_check_age_seconds", {}, SAW), ("refsync_dictionary_age_seconds", {}, [10000 + 60 * i for i in range(21)])], 15, set()),
    ("target down", [("up", UP, [0] * 21)], 6, {"TargetDown"}),
    ("target up", [("up", UP, [1] * 21)], 10, set()),
    ("storage high", [("node_filesystem_avail_bytes", {}, [10] * 21), ("node_filesystem_size_bytes", {}, [100] * 21)], 10, {"StorageHigh"}),
    ("storage high for too short", [("node_filesystem_avail_bytes", {}, [10] * 21), ("node_filesystem_size_bytes", {}, [100] * 21)], 9, set()),
]


@pytest.mark.parametrize("specs,minute,expected", [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_rules(spark, specs, minute, expected):
    assert {r.alert for r in firing(series(spark, *specs), minute)} == expected


@pytest.mark.parametrize("step,fires", [(1, True), (0, False)])
def test_errors_in_the_range(spark, step, fires):
    errors = series(spark, ("sync_errors_total", {"type": "sink"}, [step * i for i in range(21)]))
    grown = t.counter_increase(errors, 900)
    at16 = grown.filter("now = 960").head()
    assert at16.increase == 15.0 * step
    as_samples = grown.select(
        F.timestamp_seconds("now").alias("ts"),
        F.lit("sync_errors_increase_15m").alias("metric"),
        F.from_json("series", "MAP<STRING,STRING>").alias("labels"),
        F.col("increase").alias("value"),
    )
    rows = firing(as_samples, 16)
    assert [(r.alert, r.series) for r in rows] == (
        [("PipelineErrors", '{"type":"sink"}')] if fires else []
    )


def test_labels_must_match(spark):
    samples = series(
        spark,
        ("sync_last_success_timestamp", {"w": "a"}, [0] * 21),
        ("sync_lag_seconds", {"w": "b"}, [120] * 21),
    )
    assert {r.alert for r in firing(samples, 10)} == {"LagGrowing"}


def test_a_silent_series_goes_stale(spark):
    samples = series(spark, ("up", UP, [0] * 7))
    assert firing(samples, 11) and not firing(samples, 13)


def test_counter_restart_counts_the_new_value(spark):
    samples = series(spark, ("c", {}, [5, 8, 2, 4]))
    grown = {r.now: r.increase for r in t.counter_increase(samples, 600).collect()}
    assert grown[180] == 3 + 2 + 2
    assert t.rate(t.counter_increase(samples, 600), 600).filter("now = 180").head().rate == 7 / 600


def test_label_order_does_not_split_a_series(spark):
    a = spark.sql("SELECT map('x','1','y','2') AS labels UNION ALL SELECT map('y','2','x','1')")
    assert a.select(t.series_key()).distinct().count() == 1


def test_histogram_quantile(spark):
    inf = float("inf")
    rows = [("a", 1.0, 10), ("a", 2.0, 30), ("a", inf, 40), ("b", 1.0, 0), ("b", inf, 4), ("c", 1.0, 0), ("c", inf, 0)]
    buckets = spark.createDataFrame(rows, "k STRING, le DOUBLE, cumulative BIGINT")
    got = {r.k: r.quantile for r in t.histogram_quantile(buckets, ["k"], 0.5).collect()}
    assert got == {"a": 1.5, "b": 1.0}  # rank in the open bucket answers its lower bound; no data, no row


def test_cumulative_buckets(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 3.0), ("a", None)], "k STRING, v DOUBLE")
    rows = t.cumulative_buckets(df, ["k"], "v", [1.0, 2.0]).orderBy("le").collect()
    assert [(r.le, r.cumulative) for r in rows] == [(1.0, 1), (2.0, 1), (float("inf"), 2)]
