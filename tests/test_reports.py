"""JSON answers, the erasure log's counts, recovery proofs and the report of a rewrite."""

import json
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import T0, payment
from pyspark.sql import functions as F
from test_lifecycle import accounts, requests  # noqa: F401

from paytide.operators import aggregates as agg
from paytide.operators import answers, lifecycle

HITS = (
    "external_id STRING, tx_id BIGINT, amount DECIMAL(18,2), created_at TIMESTAMP, status STRING, "
    "source_account_id BIGINT, destination_account_id BIGINT, previous_at TIMESTAMP, seconds_apart BIGINT"
)
HEALTH = (
    "institution STRING, institution_name STRING, total BIGINT, settled BIGINT, failed BIGINT, "
    "success_rate DOUBLE, failure_rate DOUBLE, avg_settlement_seconds DOUBLE"
)


def hit(i, at, status="settled"):
    return (f"e{i}", i, Decimal("9.90"), at, status, 1, 2, at - timedelta(seconds=7), 7)


def parsed(df):
    return json.loads(df.head().payload)


def test_duplicates_answer_lists_newest_first(spark):
    rows = [hit(1, T0), hit(3, T0), hit(2, T0 + timedelta(seconds=1), None)]
    df = spark.createDataFrame(rows, HITS)
    found = parsed(answers.duplicates_answer(df, 24, 300, T0))
    assert [r["tx_id"] for r in found["data"]] == [2, 3, 1]
    assert found["count"] == 3 and found["window"] == "24h" and found["duplicate_window_seconds"] == 300
    assert found["data"][0]["status"] is None and found["data"][1]["amount"] == 9.9
    assert found["data"][1]["previous_at"] == "2024-01-10T11:59:53.000000"
    assert [r["tx_id"] for r in parsed(answers.duplicates_answer(df, 24, 300, T0, 2))["data"]] == [2, 3]


def test_answers_without_rows(spark):
    none = parsed(answers.duplicates_answer(spark.createDataFrame([], HITS), 1, 300, T0))
    assert none["count"] == 0 and none["data"] == []
    assert answers.health_answers(spark.createDataFrame([], HEALTH), 1, T0).count() == 0


def test_a_document_is_bounded(spark):
    rows = spark.range(2000).select(F.col("id").alias("tx_count"), F.lit("x").alias("type"))
    found = parsed(agg.to_payload(rows, "5m", T0, "type", "tx_count"))["data"]
    assert len(found) == 1000 and found[0]["tx_count"] == 1999 and found[-1]["tx_count"] == 1000
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            agg.to_payload(rows, "5m", T0, "type", limit=limit)


def test_health_answers_take_the_exact_percentile_or_null(spark):
    df = spark.createDataFrame(
        [("001", "One", 4, 3, 1, 0.75, 0.25, 1.2345), ("002", "unknown", 1, 0, 1, 0.0, 1.0, None)], HEALTH
    )
    p95 = spark.createDataFrame([("001", 2.0004)], "institution STRING, p95_settlement_seconds DOUBLE")
    found = {r.institution: json.loads(r.payload) for r in answers.health_answers(df, 1, T0, p95).collect()}
    assert found["001"]["p95_settlement_seconds"] == 2.0 and found["001"]["success_rate"] == 0.75
    assert found["002"]["p95_settlement_seconds"] is None and found["002"]["avg_settlement_seconds"] is None
    assert list(found["001"])[:4] == ["institution", "institution_name", "window", "anchor"]
    plain = json.loads(answers.health_answers(df, 1, T0).filter("institution = '001'").head().payload)
    assert plain["p95_settlement_seconds"] is None


def test_a_repeated_request_is_one_log_row(spark, accounts):  # noqa: F811
    later = requests(spark, 2, 3).withColumn("requested_at", F.col("requested_at") + F.expr("INTERVAL 1 DAY"))
    asked = later.unionByName(requests(spark, 2, 2))
    log = {r.requested_at: r for r in lifecycle.erasure_log(asked, accounts, T0 + timedelta(days=2)).collect()}
    assert len(log) == 2 and {r.affected_rows for r in log.values()} == {1}
    blank = lifecycle.anonymize(accounts, asked, "salt")
    again = lifecycle.erasure_log(requests(spark, 2, 4), blank, T0).collect()
    assert sorted(r.affected_rows for r in again) == [0, 1]


def test_account_rows_are_counted(spark, accounts):  # noqa: F811
    twice = accounts.unionByName(accounts.filter("id = 2"))
    assert lifecycle.erasure_log(requests(spark, 2), twice, T0).head().affected_rows == 2


def test_recovery_proof_sees_what_counts_and_sums_hide(make_tx):
    rows = [payment(i, T0 - timedelta(days=i), "1.00", type_="pix" if i % 2 else "ted") for i in range(1, 7)]
    before = make_tx(rows + [payment(9, T0, "5.00")])
    good = {r.type: r for r in lifecycle.recovery_proof(before, make_tx(rows), "type", "id", T0).collect()}
    assert good["pix"].proven and good["ted"].proven and good["pix"].n_before == 3
    # one row replaced by a stranger of the same amount, two amounts swapped against each other
    other = [payment(10, T0 - timedelta(days=1), "1.00")] + rows[1:]
    swapped = [payment(i, T0 - timedelta(days=i), a, type_="ted") for i, a in ((2, "0.50"), (4, "1.50"), (6, "1.00"))]
    bad = {r.type: r for r in lifecycle.recovery_proof(
        before, make_tx(other[:1] + [r for r in rows[1:] if r[5] == "pix"] + swapped), "type", "id", T0
    ).collect()}
    assert (bad["pix"].missing, bad["pix"].residue, bad["pix"].total_after) == (1, 1, bad["pix"].total_before)
    assert (bad["ted"].changed, bad["ted"].total_after) == (2, bad["ted"].total_before)
    assert not bad["pix"].proven and not bad["ted"].proven


def test_recovery_proof_of_nothing(make_tx):
    empty = make_tx([])
    assert lifecycle.recovery_proof(empty, empty, "type", "id", T0).count() == 0
    left = lifecycle.recovery_proof(empty, make_tx([payment(1, T0, type_=None)]), "type", "id", T0).head()
    assert left.type is None and left.residue == 1 and left.total_before is None and not left.proven


def test_recluster_report(spark, make_tx, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    make_tx([payment(i, T0 - timedelta(minutes=i)) for i in range(500)]).repartition(5).write.parquet(a)
    plain = spark.read.parquet(a)
    lifecycle.recluster(plain, b, files=2)
    row = lifecycle.recluster_report(plain, spark.read.parquet(b)).head()
    assert (row.n_rows_before, row.n_rows_after, row.files_after) == (500, 500, 2)
    assert row.ratio == row.bytes_before / row.bytes_after
