"""Bootstrap intervals and season deltas."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.bootstrap import bootstrap_means, replicate_sums, replicate_weights, weight_sql
from tallyframe.operators.season_axis import season_deltas, with_season_week

from .conftest import rows


def test_weights_are_poisson_and_the_same_in_sql():
    duckdb = pytest.importorskip("duckdb")
    keys = np.array([0, 1, 2, 12345, 2**31, 2**40 + 7, -5])
    w = replicate_weights(keys, 20)
    found = duckdb.sql(
        f"SELECT k, r, {weight_sql('k', 'r')} FROM (SELECT unnest({keys.tolist()}) AS k), range(20) AS t(r)"
    ).fetchall()
    assert {(k, r): v for k, r, v in found} == {(int(k), r): w[i, r] for i, k in enumerate(keys) for r in range(20)}
    big = replicate_weights(np.arange(50_000), 40)
    assert big.mean() == pytest.approx(1, abs=0.01) and big.var() == pytest.approx(1, abs=0.02)
    share = np.corrcoef(big[:, :8].T) - np.eye(8)
    assert np.abs(share).max() < 0.03
    neighbours = np.corrcoef(big[:-1, 0], big[1:, 0])[0, 1]
    assert abs(neighbours) < 0.03


def test_sums_equal_weighting_every_row(spark):
    data = [(i, float(i % 7), None if i % 5 == 0 else 1.0 * i, float("nan")) for i in range(300)] + [(None, 3.0, 1.0, None)]
    df = spark.createDataFrame(data, "k long, a double, b double, c double")
    weights = replicate_weights(np.array([k or 0 for k, *_ in data]), 10)
    got = {(r.metric, r.replicate): (r.weight, r.total) for r in replicate_sums(df.repartition(5), F.col("k"), ["a", "b", "c"], 10).collect()}
    for i, name in enumerate("abc"):
        v = np.array([np.nan if x[i + 1] is None else x[i + 1] for x in data])
        has = ~np.isnan(v)
        for r in range(10):
            assert got[name, r] == pytest.approx((weights[has, r].sum(), (weights[has, r] * v[has]).sum()))


def test_interval_holds_the_estimate_and_narrows(spark):
    def width(n):
        df = spark.range(n).select("id", (F.col("id") % 4 == 0).cast("int").alias("hit"), F.lit(None).cast("double").alias("none"))
        out = {r.metric: r for r in bootstrap_means(df, F.col("id"), ["hit", "none"], 100).collect()}
        assert out["none"].estimate is None and out["none"].low is None and out["none"].n == 0
        r = out["hit"]
        assert r.n == n and r.low < r.estimate < r.high
        return r.high - r.low

    small, large = width(400), width(6400)
    assert small == pytest.approx(4 * large, rel=0.35) and small == pytest.approx(2 * 1.96 * (0.25 * 0.75 / 400) ** 0.5, rel=0.25)
    same = spark.range(50).select("id", F.lit(1.0).alias("x"))
    assert rows(bootstrap_means(same.repartition(3), F.col("id"), ["x"], 20)) == rows(bootstrap_means(same, F.col("id"), ["x"], 20))


def test_weeks_keep_gaps_and_seasons_follow(spark):
    d = dt.date
    data = [
        (2020, d(2020, 10, 1), 10), (2020, d(2020, 10, 7), 20), (2020, d(2020, 10, 8), 30), (2020, d(2020, 10, 29), 40),
        (2021, d(2021, 11, 3), 16), (2021, d(2021, 11, 17), 50), (2021, None, 99), (None, d(2021, 1, 1), 99),
        (2023, d(2023, 1, 1), 7),
    ]
    df = spark.createDataFrame(data, "season int, game_date date, pts int")
    assert [r.season_week for r in with_season_week(df).filter("season = 2020").orderBy("game_date").collect()] == [0, 0, 1, 4]
    got = rows(season_deltas(df, {"p": F.avg("pts")}), "season", "season_week", "p", "prev_p", "delta_p")
    assert got == [
        (2020, 0, 15.0, None, None), (2020, 1, 30.0, None, None), (2020, 4, 40.0, None, None),
        (2021, 0, 16.0, 15.0, 1.0), (2021, 1, None, 30.0, None), (2021, 2, 50.0, None, None), (2021, 4, None, 40.0, None),
        (2023, 0, 7.0, None, None),
    ]
    assert season_deltas(df.limit(0), {"p": F.avg("pts")}).isEmpty()
