import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.catalog.base import sided_by_team, sided_games
from tallyframe.operators import evaluate as E
from tallyframe.operators import training as TR
from tallyframe.operators.skew import DEFAULT_POLICY, SplitPolicy
from tallyframe.operators.windows import rolling_features, rolling_outputs, trailing
from tallyframe.schema import ROLLING, TEAM_GAME, TRAINING_COLUMNS, conform

from .conftest import day, exchanges, rows


def pair(spark, extra=()):
    """HOME and AWAY meet on four days; rolling points 101.. and 201..; home wins games 1 and 3."""
    features, processed = [], []
    for i in range(1, 5):
        date = day(f"2026-02-0{i}")
        features.append((2025, date, f"G{i}", 1, "HOME", i, 100.0 + i))
        features.append((2025, date, f"G{i}", 2, "AWAY", i, 200.0 + i))
        processed.append((2025, date, f"G{i}", 1, "HOME", "AWAY", True, i in (1, 3)))
        processed.append((2025, date, f"G{i}", 2, "AWAY", "HOME", False, i not in (1, 3)))
    for f, p in extra:
        features += f
        processed += p
    f = spark.createDataFrame(features, "season int, game_date date, game_id string, team_id int, team_abbreviation string, games_in_window int, rolling_pts double")
    p = spark.createDataFrame(processed, "season int, game_date date, game_id string, team_id int, team_abbreviation string, opponent_abbreviation string, is_home boolean, win boolean")
    return conform(f, ROLLING), conform(p, TEAM_GAME)


def test_leak_free_values(spark):
    out = TR.training_frame(*pair(spark))
    assert out.columns == TRAINING_COLUMNS
    got = rows(out, "game_id", "home_rolling_pts", "away_rolling_pts", "label")
    assert got == [("G2", 101.0, 201.0, 0), ("G3", 102.0, 202.0, 1), ("G4", 103.0, 203.0, 0)]


def test_missing_rating_columns_are_null(spark):
    features, processed = pair(spark)
    out = TR.training_frame(features.drop("rolling_ortg", "rolling_pace"), processed)
    assert out.columns == TRAINING_COLUMNS and out.first()["home_rolling_ortg"] is None


def test_newcomer_drops_its_game(spark):
    date = day("2026-02-09")
    extra = [([(2025, date, "N", 1, "HOME", 5, 105.0), (2025, date, "N", 3, "NEW", 1, 300.0)],
              [(2025, date, "N", 1, "HOME", "NEW", True, True), (2025, date, "N", 3, "NEW", "HOME", False, False)])]
    assert {r.game_id for r in TR.training_frame(*pair(spark, extra)).collect()} == {"G2", "G3", "G4"}


@pytest.mark.parametrize("side", [True, False])
def test_bad_orientation_drops_the_game(spark, side):
    features, processed = pair(spark)
    bad = processed.withColumn("is_home", F.when(F.col("game_id") == "G3", F.lit(side)).otherwise(F.col("is_home")))
    assert {r.game_id for r in TR.training_frame(features, bad).collect()} == {"G2", "G4"}
    assert rows(TR.dropped_games(bad), "game_id") == [("G3",)]
    assert {r.game_id for r in TR.usable_games(bad).collect()} == {"G1", "G2", "G4"}
    assert [r.game_id for r in TR.dropped_sample(bad).collect()] == ["G3"]


def test_game_without_result_is_left_out(spark):
    features, processed = pair(spark)
    unknown = processed.withColumn("win", F.when(F.col("game_id") != "G2", F.col("win")))
    assert {r.game_id for r in TR.training_frame(features, unknown).collect()} == {"G3", "G4"}


def test_empty_keeps_schema(spark):
    out = TR.training_frame(spark.createDataFrame([], ROLLING), spark.createDataFrame([], TEAM_GAME))
    assert out.count() == 0 and out.columns == TRAINING_COLUMNS


def season(spark, games=40, teams=5):
    data = []
    for g in range(games):
        h, a = g % teams, (g * 2 + 1) % teams
        if h == a:
            a = (a + 1) % teams
        date = dt.date(2026, 1, 1) + dt.timedelta(days=g // 2)
        for team, other, home in ((h, a, True), (a, h, False)):
            win = ((g * 7) % 3 > 0) == home
            data.append((2025, date, f"g{g:03d}", team, f"T{team}", f"T{other}", home, win, 90 + (g * 13 + team * 5) % 40, 0.5, 0.5 + team / 50, 1.5))
    return conform(
        spark.createDataFrame(
            data,
            "season int, game_date date, game_id string, team_id int, team_abbreviation string, opponent_abbreviation string, is_home boolean, win boolean, pts long, effective_fg_pct double, true_shooting_pct double, assist_to_turnover double",
        ),
        TEAM_GAME,
    )


def test_fused_equals_two_table_path(spark):
    processed = season(spark)
    two = TR.training_frame(rolling_features(processed), processed)
    fused = TR.training_frame_from_processed(processed)
    assert rows(two) == rows(fused) and fused.count() > 20
    assert exchanges(fused) == 2


def test_two_table_path_moves_each_table_once(spark):
    processed = season(spark)
    features = rolling_features(processed).localCheckpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = TR.training_frame(features, processed)
        # Features by team, lagged history by game, sides by game.
        assert exchanges(out) == 3
        assert rows(out) == rows(TR.training_frame_from_processed(processed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_repeated_history_pairs_up_as_in_a_join(spark):
    games = spark.createDataFrame(
        [("G1", "A", "B", 1), ("G2", "A", "C", 0), ("G3", "B", "B", 1), ("G4", None, "A", 0)],
        "game_id string, home_team string, away_team string, label int",
    )
    data = [("G1", "A", 1), ("G1", "A", 2), ("G1", "B", 3), ("G1", "B", None), ("G1", "D", 9), ("G2", "A", 4)]
    data += [("G3", "B", 5), ("G3", "B", 6), ("G4", "A", 7), ("G4", None, 8)]
    history = spark.createDataFrame(
        [(g, day("2026-02-01"), 2025, t, v) for g, t, v in data],
        "game_id string, game_date date, season int, team_abbreviation string, lag_pts int",
    )
    out = TR.attach_lagged(games, history, ["pts"])
    assert out.columns == ["game_id", "away_team", "home_team", "label", "game_date", "season", "home_pts", "away_pts"]
    pairs = {("G1", h, a) for h in (1, 2) for a in (3, None)} | {("G3", h, a) for h in (5, 6) for a in (5, 6)}
    got = [tuple(r) for r in out.select("game_id", "home_pts", "away_pts").collect()]
    assert len(got) == len(pairs) and set(got) == pairs


def test_team_to_be_cut_is_not_gathered(spark, sf_dir):
    def frames(policy):
        games, plan = sided_by_team(spark, sf_dir, policy)
        features = trailing(games, rolling_outputs(games.columns), splits=plan)
        dealt = "REPARTITION_BY_COL" in features._jdf.queryExecution().executedPlan().toString()
        two = TR.training_frame(features, sided_games(spark, sf_dir), splits=plan)
        return plan.active, dealt, rows(two), rows(TR.training_frame_from_processed(games, splits=plan))

    hot, plain = frames(SplitPolicy(min_rows=60, max_chunks=50, sample_per_chunk=4)), frames(DEFAULT_POLICY)
    assert hot[:2] == (True, False) and plain[:2] == (False, True)
    rounded = [[tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in f] for f in hot[2:] + plain[2:]]
    assert len(rounded[0]) > 500 and all(f == rounded[0] for f in rounded)


def test_folds(spark):
    frame = TR.training_frame_from_processed(season(spark))
    cutoffs = E.walk_forward_cutoffs(frame, 4)
    blocked = E.with_block(frame, cutoffs)
    seen = set()
    for number in range(1, 5):
        train, test = E.fold(blocked, number)
        assert train.agg(F.max("game_date")).first()[0] < test.agg(F.min("game_date")).first()[0]
        ids = {r.game_id for r in test.collect()}
        assert ids and not ids & seen
        seen |= ids
    first = {r.game_id for r in blocked.filter("block = 0").collect()}
    assert not first & seen and len(first | seen) == frame.count()
    assert blocked.groupBy("game_date").agg(F.countDistinct("block").alias("n")).filter("n > 1").isEmpty()
    assert exchanges(blocked) == exchanges(frame)


def test_fold_sizes_take_the_remainder_last(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1) + dt.timedelta(days=i),) for i in range(13)], "game_date date")
    blocks = E.with_block(df, E.walk_forward_cutoffs(df, 4))
    assert [r["count"] for r in blocks.groupBy("block").count().orderBy("block").collect()] == [2, 2, 2, 2, 5]


def test_fold_errors(spark):
    df = spark.createDataFrame([(day("2026-01-01"),)], "game_date date")
    for frame, n in ((df, 0), (df, 4), (df.filter("false"), 4)):
        with pytest.raises(ValueError):
            E.walk_forward_cutoffs(frame, n)


def test_baselines(spark):
    data = [(0.6, 0.4, 0.55, 0.60, 1), (0.3, 0.7, 0.62, 0.50, 0), (0.5, 0.5, 0.58, 0.58, 1), (0.2, 0.9, 0.45, 0.70, 1)]
    schema = "home_rolling_win_pct double, away_rolling_win_pct double, home_rolling_ts_pct double, away_rolling_ts_pct double, label int"
    frame = spark.createDataFrame(data, schema)
    assert tuple(E.baseline_accuracies(frame).first()) == (0.75, 0.75, 0.25)
    assert tuple(E.baseline_accuracies(frame.filter("false")).first()) == (0.0, 0.0, 0.0)
    odd = spark.createDataFrame([(None, 0.4), (0.5, None), (float("nan"), 0.5), (0.5, 0.5)], "h double, a double")
    assert [r[0] for r in odd.select(E.better_side("h", "a")).collect()] == [0, 0, 0, 1]


def scored(spark, pairs):
    return spark.createDataFrame([(None if p is None else float(p), int(y)) for p, y in pairs], "model_home_win_prob double, label int")


def bins(spark, pairs, n=10):
    return E.calibration_bins(scored(spark, pairs), n_bins=n).orderBy("bin").collect()


def test_calibration_hand_values(spark):
    worst = E.calibration_errors(E.calibration_bins(scored(spark, [(0.9, 0)] * 10))).first()
    assert (worst.n, worst.ece, worst.mce) == (10, pytest.approx(0.9), pytest.approx(0.9))
    level = E.calibration_errors(E.calibration_bins(scored(spark, [(0.5, i % 2) for i in range(8)]))).first()
    assert level.ece == 0.0
    got = bins(spark, [(0.45, 1), (0.5, 0), (0.55, 1)])
    assert [b["count"] for b in got] == [0, 0, 0, 0, 1, 2, 0, 0, 0, 0]
    assert got[0].mean_pred is None and got[0].actual_rate is None


def test_bin_edges_match_comparison(spark):
    import numpy as np

    values = [i / 1000 for i in range(1001)] + [0.1 + 0.2, 0.7 - 0.1, 1 / 3]
    for n in (1, 3, 7, 10, 20):
        edges = np.linspace(0, 1, n + 1)
        expected = [min(n - 1, int(np.searchsorted(edges, v, side="right")) - 1) for v in values]
        df = spark.createDataFrame([(v,) for v in values], "p double")
        assert [r[0] for r in df.select(E.bin_index("p", n)).collect()] == expected


def test_calibration_invariants(spark):
    pairs = [((i * 37 % 101) / 100, i % 3 == 0) for i in range(500)]
    table = E.calibration_bins(scored(spark, pairs))
    errors = E.calibration_errors(table).first()
    assert errors.n == 500 and errors.mce >= errors.ece
    row = E.evaluation_row(
        scored(spark, pairs).withColumns({c: F.lit(0.5) for c in ("home_rolling_win_pct", "away_rolling_win_pct", "home_rolling_ts_pct", "away_rolling_ts_pct")}), "m"
    ).first()
    assert row.ece == pytest.approx(errors.ece, abs=1e-6) and row.mce == pytest.approx(errors.mce, abs=1e-6)
    metrics = E.score_metrics(scored(spark, pairs)).first()
    assert row.accuracy == pytest.approx(metrics.accuracy, abs=1e-6)
    assert row.log_loss == pytest.approx(metrics.log_loss, abs=1e-6)
    assert row.brier == pytest.approx(metrics.brier, abs=1e-6)


def test_calibration_checks(spark):
    with pytest.raises(ValueError):
        E.calibration_bins(scored(spark, [(0.5, 1)]), n_bins=0)
    with pytest.raises(ValueError):
        E.check_probabilities(scored(spark, [(1.5, 1)]), "model_home_win_prob", "label")
    with pytest.raises(ValueError):
        E.check_probabilities(scored(spark, [(0.5, 1)]).filter("false"), "model_home_win_prob", "label")
    E.check_probabilities(scored(spark, [(0.5, 1)]), "model_home_win_prob", "label")


def test_log_loss_is_clipped(spark):
    got = E.score_metrics(scored(spark, [(1.0, 1), (0.0, 1)])).first()
    assert got.log_loss == pytest.approx(36.04365 / 2, abs=1e-4) and got.accuracy == 0.5 and got.brier == 0.5


def test_reliability_text(spark):
    lines = {r.bin: r.line for r in E.reliability_lines(E.calibration_bins(scored(spark, [(0.25, 1), (0.25, 0)]))).collect()}
    assert lines[2] == "0.20 to 0.30 | n=2 | predicted 0.2500 | happened 0.5000 | apart 0.2500"
    assert lines[0] == "0.00 to 0.10 | empty"


def test_invalid_scores_belong_to_no_bin(spark):
    df = scored(spark, [(0.25, 1), (-0.1, 1), (1.4, 0), (None, 1), (float("nan"), 1), (1.0, 1)])
    bins = {r.bin: r for r in E.calibration_bins(df).collect()}
    assert {b: r["count"] for b, r in bins.items() if r["count"]} == {2: 1, 9: 1}
    assert {r.invalid for r in bins.values()} == {4}
    errors = E.calibration_errors(E.calibration_bins(df)).first()
    assert errors.n == 2 and abs(errors.ece - 0.375) < 1e-12
    with pytest.raises(ValueError, match="4 of 6"):
        E.calibration_bins(df, strict=True)


def test_rows_without_a_game_pair_in_neither_path(spark):
    features, processed = pair(spark)
    gone = F.when(F.col("game_id") != "G3", F.col("game_id"))
    features, processed = features.withColumn("game_id", gone), processed.withColumn("game_id", gone)
    assert {r.game_id for r in TR.pair_home_away(processed).collect()} == {"G1", "G2", "G4"}
    assert [r.game_id for r in TR.dropped_games(processed).collect()] == [None]
    assert None not in {r.game_id for r in TR.training_frame_from_processed(processed).collect()}
    assert {r.game_id for r in TR.training_frame(features, processed).collect()} == {
        r.game_id for r in TR.training_frame_from_processed(processed).collect()
    }
    dates = [(r.game_date, r.game_id) for r in TR.chronological(processed.repartition(3)).select("game_date", "game_id").collect()]
    assert dates == sorted(dates, key=lambda x: (x[0], x[1] is not None, x[1] or ""))
