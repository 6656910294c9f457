from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytide.functions.percentile import COARSE, FINE, exact_percentiles, value_bin

PROBS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def check(spark, pdf):
    got = exact_percentiles(spark.createDataFrame(pdf), ["g"], "v", PROBS).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        v = part["v"].to_numpy(dtype="float64")
        assert got.loc[g, "n"] == len(v)
        for name, p in PROBS.items():
            assert got.loc[g, name] == pytest.approx(np.percentile(v, p * 100), rel=1e-12, abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(2**45), 2**45), min_size=1, max_size=80), st.integers(1, 3))
def test_any_integers(spark, values, groups):
    check(spark, pd.DataFrame({"v": values, "g": [i % groups for i in range(len(values))]}))


def test_one_group_holds_most_rows_and_most_of_it_one_value(spark):
    g = np.random.default_rng(5)
    n = 30000
    hot = g.random(n) < 0.6
    v = np.where(g.random(n) < 0.5, 1_234_567, g.lognormal(14, 2, n)).astype("int64")
    check(spark, pd.DataFrame({"v": v, "g": np.where(hot, 0, g.integers(1, 9, n))}))


def test_bins_never_decrease(spark):
    edges = sorted({s * (2**e + d) for e in range(0, 52) for d in (-1, 0, 1) for s in (-1, 1)})
    df = spark.createDataFrame([(e,) for e in edges], "v BIGINT")
    both = df.select("v", value_bin(F.col("v"), COARSE).alias("c"), value_bin(F.col("v"), FINE).alias("f"))
    rows = both.orderBy("v").collect()
    coarse, fine = [r.c for r in rows], [r.f for r in rows]
    assert coarse == sorted(coarse) and fine == sorted(fine)
    # each fine bin lies in one coarse bin
    assert len({(r.c, r.f) for r in rows}) == len({r.f for r in rows})


def test_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", None), ("a", 5)], "g STRING, v BIGINT")
    rows = exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()
    assert {(r.g, r.n, r.p50) for r in rows} == {(None, 2, 2.0), ("a", 1, 5.0)}


def test_mixing_instruments_changes_the_answer(make_tx, spark):
    from conftest import payment

    from paytide.operators.aggregates import latency_percentiles, latency_percentiles_all_types

    fast = [payment(i, T0, settled_at=T0 + timedelta(seconds=1)) for i in range(90)]
    slow = [
        payment(100 + i, T0, type_="boleto", settled_at=T0 + timedelta(hours=18)) for i in range(10)
    ]
    tx = make_tx(fast + slow)
    by_type = {r.type: r.p95_seconds for r in latency_percentiles(tx).collect()}
    assert by_type == {"pix": 1.0, "boleto": 64800.0}
    assert latency_percentiles_all_types(tx).collect()[0].p95_seconds > 60000
