import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.skew import SplitPolicy, plan_splits
from tallyframe.operators.windows import (
    asof_join,
    drop_first_event,
    lagged,
    latest_per_entity,
    leaderboard_order,
    rolling_features,
    trailing,
    trajectories,
)
from tallyframe.plans.jobs import features_for_day, features_since_season, last_games
from tallyframe.schema import ROLLING, ROLLING_COLUMNS, TEAM_GAME, conform

from .conftest import day, exchanges, rows

TINY = SplitPolicy(min_rows=40, max_chunks=50, sample_per_chunk=5)


def team_games(spark):
    """12 games of BOS (odd at home, all won), 4 of LAL (even at home and won)."""
    data = []
    for i in range(1, 13):
        data.append((2025, f"2026-01-{i:02d}", f"g{i:02d}", 1, "BOS", i % 2 == 1, True, 100 + i, 0.5, 0.6, 2.0))
    for i in range(1, 5):
        data.append((2025, f"2026-01-{i:02d}", f"h{i:02d}", 2, "LAL", i % 2 == 0, i % 2 == 0, 90 + i, 0.4, 0.5, 1.0))
    schema = "season int, game_date string, game_id string, team_id int, team_abbreviation string, is_home boolean, win boolean, pts long, effective_fg_pct double, true_shooting_pct double, assist_to_turnover double"
    return spark.createDataFrame(data, schema).withColumn("game_date", F.to_date("game_date"))


def test_rolling_by_hand(spark):
    out = rolling_features(team_games(spark))
    assert out.schema.names == ROLLING.names and out.schema["games_in_window"].dataType.simpleString() == "int"
    by = {r.game_id: r for r in out.collect()}
    last = by["g12"]
    assert (last.games_in_window, last.rolling_pts, last.rolling_pts_home, last.rolling_pts_away, last.rolling_win_pct) == (10, 107.5, 107.0, 108.0, 1.0)
    first = by["g01"]
    assert (first.games_in_window, first.rolling_pts, first.rolling_pts_away) == (1, 101.0, None)
    lal = by["h04"]
    assert (lal.games_in_window, lal.rolling_pts, lal.rolling_win_pct) == (4, 92.5, 0.5)
    assert last.rolling_ortg is None  # no rating columns in the source
    assert out.count() == 16


def test_advanced_columns_roll(spark):
    df = team_games(spark).filter("game_id in ('g01', 'g02', 'g03')").withColumns(
        {"off_rating": 105.0 + F.substring("game_id", 2, 2).cast("int") * 5.0, "def_rating": F.lit(105.0), "net_rating": F.lit(10.0), "pace": F.lit(99.0)}
    )
    last = {r.game_id: r for r in rolling_features(df).collect()}["g03"]
    assert (last.rolling_ortg, last.rolling_drtg, last.rolling_net_rtg, last.rolling_pace) == (115.0, 105.0, 10.0, 99.0)


def test_window_must_be_positive(spark):
    with pytest.raises(ValueError):
        rolling_features(team_games(spark), 0)


def test_one_shuffle(spark):
    assert exchanges(rolling_features(team_games(spark))) == 1
    rolled = rolling_features(team_games(spark))
    assert exchanges(lagged(rolled, ROLLING_COLUMNS)) == 1


def test_lag_of_rolling_equals_prior_frame(spark):
    games = team_games(spark)
    lag = drop_first_event(lagged(rolling_features(games), ROLLING_COLUMNS))
    prior = rolling_features(games, include_current=False).filter("games_in_window > 0")
    assert rows(lag, "game_id", *[f"lag_{c}" for c in ROLLING_COLUMNS]) == rows(prior, "game_id", *ROLLING_COLUMNS)
    assert lag.count() == 14


def test_latest_and_leaderboard(spark):
    latest = latest_per_entity(rolling_features(team_games(spark)))
    assert rows(latest, "team_abbreviation", "game_id") == [("BOS", "g12"), ("LAL", "h04")]
    scored = latest.withColumn("rolling_ts_pct", F.when(F.col("team_abbreviation") == "LAL", 0.7))
    assert [r[0] for r in leaderboard_order(scored).select("team_abbreviation").collect()] == ["LAL", "BOS"]


def test_trajectories(spark):
    out = trajectories(rolling_features(team_games(spark)), ["LAL"], ["rolling_pts"])
    assert [r.rolling_pts for r in out.collect()] == [91.0, 91.5, 92.0, 92.5]


def hot_rows(spark, seed=7):
    """One entity with most rows, several on the same day, some small, one NULL."""
    rng = random.Random(seed)
    start = dt.date(2026, 1, 1)
    data = [("hot", start + dt.timedelta(days=rng.randrange(40)), i, float(rng.randrange(100))) for i in range(600)]
    data += [(None, start + dt.timedelta(days=rng.randrange(40)), 1000 + i, float(i)) for i in range(90)]
    data += [(f"e{i % 9}", start + dt.timedelta(days=rng.randrange(40)), 2000 + i, float(i)) for i in range(180)]
    return spark.createDataFrame(data, "entity string, day date, id long, v double").repartition(4)


def test_split_plan_is_exact(spark):
    df = hot_rows(spark)
    plan = plan_splits(df, ["entity"], ["day", "id"], 10, TINY)
    assert plan.active and plan.bounds.count() == 2
    outputs = {"n": F.count("id"), "avg": F.avg("v"), "lo": F.min("v"), "first": F.min("id")}
    for window in (1, 3, 10):
        for current in (True, False):
            args = dict(entity=["entity"], order=["day", "id"], window=window, include_current=current)
            plain = trailing(df, outputs, **args)
            split = trailing(df, outputs, policy=TINY, **args)
            assert rows(plain, "id", *outputs) == rows(split, "id", *outputs)


def test_window_longer_than_sample(spark):
    df = hot_rows(spark)
    args = dict(entity=["entity"], order=["day", "id"], window=60)
    outputs = {"n": F.count("id"), "s": F.sum("v")}
    assert rows(trailing(df, outputs, **args), "id", "n", "s") == rows(trailing(df, outputs, policy=TINY, **args), "id", "n", "s")


def test_split_lag_is_exact(spark):
    df = hot_rows(spark)
    args = dict(columns=["v", "id"], entity=["entity"], order=["day", "id"])
    assert rows(lagged(df, **args), "id", "lag_v", "lag_id") == rows(lagged(df, policy=TINY, **args), "id", "lag_v", "lag_id")


def test_split_spreads_the_hot_entity(spark):
    from tallyframe.operators.skew import window_input

    df = hot_rows(spark)
    source = window_input(df, plan_splits(df, ["entity"], ["day", "id"], 3, TINY))
    biggest = source.rows.groupBy(*source.partition_cols).count().agg(F.max("count")).first()[0]
    assert biggest < 200  # 600 rows of one entity


def test_reused_plan_must_look_back_far_enough(spark):
    df = hot_rows(spark)
    plan = plan_splits(df, ["entity"], ["day", "id"], 2, TINY)
    with pytest.raises(ValueError):
        trailing(df, {"n": F.count("id")}, ["entity"], ["day", "id"], 10, splits=plan)


def test_cold_tables_keep_the_plain_plan(spark):
    df = hot_rows(spark)
    assert not plan_splits(df, ["entity"], ["day", "id"], 5).active
    assert not plan_splits(df.filter("id < 0"), ["entity"], ["day", "id"], 5, TINY).active


def brute_asof(left, right, allow_equal):
    out = []
    for l in left:
        known = [
            r for r in right
            if l.entity is not None and r.entity == l.entity and (r.day <= l.at if allow_equal else r.day < l.at)
        ]
        best = max(known, key=lambda r: (r.day, r.id), default=None)
        out.append((l.key, best and best.id, best and best.v))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("policy", [SplitPolicy(), TINY])
@pytest.mark.parametrize("allow_equal", [False, True])
def test_asof_equals_brute_force(spark, policy, allow_equal):
    right = hot_rows(spark)
    rng = random.Random(3)
    left = spark.createDataFrame(
        [(i, rng.choice(["hot", "hot", "e1", "e2", "none", None]), dt.date(2025, 12, 28) + dt.timedelta(days=rng.randrange(50))) for i in range(300)],
        "key int, entity string, at date",
    )
    out = asof_join(left, right, "entity", "at", ["day", "id"], ["id", "v"], prefix="r_", allow_equal=allow_equal, policy=policy)
    assert rows(out, "key", "r_id", "r_v") == brute_asof(left.collect(), right.collect(), allow_equal)


def test_asof_never_sees_the_same_day(spark):
    features = team_games(spark)
    games = spark.createDataFrame([(1, "BOS", day("2026-01-05")), (2, "BOS", day("2026-01-01")), (3, "XXX", day("2026-01-05"))], "k int, team_abbreviation string, at date")
    out = asof_join(games, features, "team_abbreviation", "at", ["game_date", "game_id"], ["pts"], prefix="f_")
    assert rows(out, "k", "f_pts") == [(1, 104), (2, None), (3, None)]


def test_incremental_equals_full(spark):
    games = conform(team_games(spark), TEAM_GAME)
    full = rolling_features(games).filter(F.col("game_date") == day("2026-01-04"))
    part = features_for_day(games, "2026-01-04")
    assert rows(full, "game_id", *ROLLING_COLUMNS) == rows(part, "game_id", *ROLLING_COLUMNS)


def test_features_since_season_equal_full(spark):
    games = conform(team_games(spark), TEAM_GAME).withColumn(
        "season", F.when(F.dayofmonth("game_date") <= 5, 2024).when(F.dayofmonth("game_date") <= 7, 2025).otherwise(2026)
    )
    for season in (2024, 2025, 2026):
        full = rolling_features(games, 6).filter(F.col("season") >= season)
        part = features_since_season(games, season, last_games(games.filter(F.col("season") < season), 6), 6)
        assert rows(full, "season", "game_id", *ROLLING_COLUMNS) == rows(part, "season", "game_id", *ROLLING_COLUMNS)
    plan = last_games(games, 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
