"""Physical plans: pruning, pushdown, map-side limits, and joins chosen by size."""

from datetime import timedelta

import pytest
from conftest import T0, executed, payment, plan
from pyspark.sql import functions as F

from paytide.operators import aggregates as agg
from paytide.operators import joins, versions
from paytide.plans.views import Views
from paytide.sources import bulk

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def v(spark):
    return Views(spark, ROOT)


def test_day_partitions_are_pruned_and_bounds_reach_the_scan(spark, make_tx, tmp_path):
    path = str(tmp_path / "t")
    tx = make_tx([payment(i, T0 - timedelta(hours=7 * i)) for i in range(40)])
    raw = bulk.to_raw(tx).withColumn("day", F.to_date("created_at"))
    raw.write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    day = T0.replace(hour=0) - timedelta(days=3)
    df = agg.hourly_drilldown(
        table.filter(F.col("day") == F.lit(day.date())), day, day + timedelta(days=1), "pix", "001"
    )
    text = plan(df)
    assert "PartitionFilters: [isnotnull(day" in text and "GreaterThanOrEqual(created_at" in text
    assert "EqualTo(type,pix)" in text and "EqualTo(source_institution,001)" in text
    # all of it below the resolution of versions, and without the columns nobody asked for
    assert "metadata" not in text.split("== Physical Plan ==")[1]


def test_only_needed_columns_are_read(v):
    text = plan(agg.share_of(v.tx, "type"))
    assert "ReadSchema: struct<event_type:string>" in text


def test_top_k_does_not_sort_everything(v):
    assert "TakeOrderedAndProject" in plan(agg.top_institutions(v.tx, v.as_of, "20 days", 5))


def test_latest_version_is_limited_before_the_exchange(v):
    text = plan(versions.final(v.raw))
    assert "WindowGroupLimit" in text and ", Partial" in text


def test_small_dimension_is_broadcast_by_size_not_by_hint(spark, v):
    rows = v.tx.groupBy("source_institution").agg(F.count("*").alias("n"))
    named = joins.lookup(rows, v.dictionary, "source_institution", "name", F.lit("?"))
    assert "BroadcastHashJoin" in executed(named)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = joins.lookup(rows, v.dictionary, "source_institution", "name", F.lit("?"))
        assert "Broadcast" not in executed(again)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_is_a_cross_join_or_nested_loop(spark):
    import __spark_entry__ as contract

    streams = {n for n in contract.queries() if n.startswith("stream_")}
    for name, fn in contract.queries().items():
        if name in streams or name in ("recluster_inventory", "burst_resume_pages", "ordered_array_pick", "pipeline"):
            continue
        text = plan(fn(spark, ROOT))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_anchor_is_a_subquery_pushed_into_the_scan(v):
    from paytide.functions.timing import last

    df = v.tx.filter(last("created_at", "7 days", v.as_of)).groupBy("type").count()
    text = plan(df)
    assert "Subquery" in text and "ReadSchema: struct<ts:timestamp>" in text


def test_raw_and_rolled_up_volume_agree(v):
    from paytide.functions.timing import aligned_cut

    cut = aligned_cut(v.as_of, "20 days", "hour")
    raw = agg.volume_by_type_status(v.tx, cut)
    rolled = agg.rollup(agg.volume_hourly(v.tx), "month", "type", "status", since=cut)
    diff = joins.diff_aggregates(raw, rolled, ["month", "type", "status"], ["tx_count", "total_amount"])
    assert diff.filter("differs").count() == 0 and diff.count() > 10
