"""Training matrices, folds, baselines and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.operators.bootstrap import bootstrap_means, weight_sql
from tallyframe.operators.evaluate import (
    EPSILON,
    baseline_accuracies,
    baseline_picks,
    calibration_bins,
    calibration_errors,
    evaluation_row,
    evaluation_summary,
    fold_summary,
    reliability_lines,
    score_metrics,
    walk_forward_cutoffs,
    with_block,
)
from tallyframe.operators.training import (
    attach_lagged,
    chronological,
    dropped_games,
    dropped_sample,
    orientation,
    pair_home_away,
    training_frame,
    training_frame_from_processed,
    usable_games,
)
from tallyframe.operators.views import display_drivers
from tallyframe.operators.windows import drop_first_event, lagged, rolling_outputs, trailing
from tallyframe.schema import ROLLING_COLUMNS, feature_columns

from .base import SIDED, WINDOW, load, rolled_sql, sided_bound, sided_by_team, sided_games, six, six_sql
from .registry import query

SIDES = ["home", "away"]
INPUTS = [f"{s}_{c}" for s in SIDES for c in ROLLING_COLUMNS]
_DOUBLES = [c for c in INPUTS if not c.endswith("games_in_window")]

ORIENTED = """oriented AS (
  SELECT game_id, count(*) FILTER (WHERE is_home) AS n_home, count(*) FILTER (WHERE NOT is_home) AS n_away, max(CASE WHEN is_home THEN team_abbreviation END) AS home_team,
    max(CASE WHEN NOT is_home THEN team_abbreviation END) AS away_team, max(CASE WHEN is_home THEN win::INTEGER END) AS label
  FROM sided GROUP BY game_id)"""
_SIDE_COLUMNS = ", ".join(f"{s[0]}.{c} AS {s}_{c}" for s in SIDES for c in ROLLING_COLUMNS)
FRAME = f"""{SIDED}, {ORIENTED}, {rolled_sql('sided', 'prior', 'prior')},
frame AS (
  SELECT o.game_id, h.game_date, h.season, o.home_team, o.away_team, {_SIDE_COLUMNS}, o.label
  FROM oriented o JOIN prior h ON h.game_id = o.game_id AND h.team_abbreviation = o.home_team
    JOIN prior a ON a.game_id = o.game_id AND a.team_abbreviation = o.away_team
  WHERE n_home = 1 AND n_away = 1 AND h.games_in_window > 0 AND a.games_in_window > 0)"""


@query("orientation", f"WITH {SIDED}, {ORIENTED} SELECT game_id, n_home, n_away FROM oriented")
def oriented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orientation(sided_games(spark, sf_dir)).select("game_id", "n_home", "n_away")


@query(
    "pair_home_away",
    f"WITH {SIDED}, {ORIENTED} SELECT game_id, home_team, away_team, label FROM oriented WHERE n_home = 1 AND n_away = 1",
)
def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_home_away(sided_games(spark, sf_dir))


@query(
    "usable_semi",
    f"WITH {SIDED}, {ORIENTED} SELECT game_id, team_abbreviation, is_home, pts FROM sided SEMI JOIN (FROM oriented WHERE n_home = 1 AND n_away = 1) u USING (game_id)",
)
def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable_games(sided_games(spark, sf_dir)).select("game_id", "team_abbreviation", "is_home", "pts")


@query(
    "dropped_anti",
    f"WITH {SIDED}, {ORIENTED} SELECT game_id, n_home, n_away FROM oriented WHERE NOT (n_home = 1 AND n_away = 1)",
)
def dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_games(sided_games(spark, sf_dir))


@query(
    "dropped_sample",
    f"WITH {SIDED}, {ORIENTED} SELECT game_id, n_home, n_away FROM oriented WHERE NOT (n_home = 1 AND n_away = 1) ORDER BY game_id LIMIT 5",
)
def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_sample(sided_games(spark, sf_dir))


_FRAME_SQL = (
    f"WITH {FRAME} SELECT game_id::VARCHAR AS game_id, game_date, season, home_team, away_team, "
    f"home_games_in_window::INTEGER AS home_games_in_window, away_games_in_window::INTEGER AS away_games_in_window, {six_sql(_DOUBLES)}, label FROM frame"
)


@query("training_frame", _FRAME_SQL)
def training_from_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From two tables, as stored: lag the features, pair the games, attach."""
    games, plan = sided_by_team(spark, sf_dir)
    features = trailing(games, rolling_outputs(games.columns), window=WINDOW, splits=plan)
    return six(training_frame(features, sided_games(spark, sf_dir), splits=plan), *_DOUBLES)


@query("training_frame_fused", _FRAME_SQL)
def training_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from one window and one grouping."""
    return six(frame(spark, sf_dir), *_DOUBLES)


@query(
    "attach_lagged",
    f"""WITH {SIDED}, {ORIENTED}, l AS (SELECT game_id, team_abbreviation, lag(pts) OVER (PARTITION BY team_id ORDER BY game_date, game_id) AS p,
        lag(game_id) OVER (PARTITION BY team_id ORDER BY game_date, game_id) AS has FROM sided)
      SELECT o.game_id, home_team, away_team, label, h.p AS home_pts, a.p AS away_pts FROM oriented o
        JOIN l h ON h.game_id = o.game_id AND h.team_abbreviation = home_team JOIN l a ON a.game_id = o.game_id AND a.team_abbreviation = away_team
      WHERE n_home = 1 AND n_away = 1 AND h.has IS NOT NULL AND a.has IS NOT NULL""",
)
def lag_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = sided_games(spark, sf_dir)
    history = drop_first_event(lagged(games, ["pts", "game_id"], bound_by=sided_bound(spark, sf_dir)), "lag_game_id")
    out = attach_lagged(pair_home_away(games), history, ["pts"])
    return out.select("game_id", "home_team", "away_team", "label", "home_pts", "away_pts")


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    games, plan = sided_by_team(spark, sf_dir)
    return training_frame_from_processed(games, WINDOW, splits=plan)


# Scores for the checks below: a rolling share is a probability.
SCORED = f"""{FRAME},
scored AS (SELECT *, (coalesce(home_rolling_win_pct, 0.5::DOUBLE) + 1 - coalesce(away_rolling_win_pct, 0.5::DOUBLE)) / 2 AS model_home_win_prob FROM frame)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, a = F.coalesce("home_rolling_win_pct", F.lit(0.5)), F.coalesce("away_rolling_win_pct", F.lit(0.5))
    return frame(spark, sf_dir).withColumn("model_home_win_prob", (h + 1.0 - a) / 2.0)


_BLOCKS = """d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders),
r AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () // 5 AS per FROM d),
blocks AS (SELECT day, least(i // per, 4)::INTEGER AS block FROM r)"""


@query(
    "walk_forward_folds",
    f"WITH {_BLOCKS} SELECT o_orderkey AS game_id, day AS game_date, block FROM orders JOIN blocks ON o_orderdate::DATE = day",
)
def walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date")
    )
    return with_block(games, walk_forward_cutoffs(games, 4))


@query(
    "fold_summary",
    f"WITH {_BLOCKS} SELECT block, count(*) AS n_rows, min(day) AS first_date, max(day) AS last_date FROM orders JOIN blocks ON o_orderdate::DATE = day GROUP BY block",
)
def folds_summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_summary(walk_forward(spark, sf_dir))


_BASE_SQL = """1 AS always_home, coalesce(home_rolling_win_pct >= away_rolling_win_pct, false)::INTEGER AS better_win_pct,
  coalesce(home_rolling_ts_pct >= away_rolling_ts_pct, false)::INTEGER AS better_ts_pct"""


@query("baseline_picks", f"WITH {FRAME} SELECT game_id::VARCHAR AS game_id, label, {_BASE_SQL} FROM frame")
def picks_by_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline_picks(frame(spark, sf_dir))
    return out.select("game_id", "label", "always_home", "better_win_pct", "better_ts_pct")


@query(
    "baseline_accuracy",
    f"""WITH {FRAME}, b AS (SELECT label, {_BASE_SQL} FROM frame)
      SELECT round(coalesce(avg((always_home = label)::INTEGER), 0), 6) AS always_home, round(coalesce(avg((better_win_pct = label)::INTEGER), 0), 6) AS better_win_pct,
        round(coalesce(avg((better_ts_pct = label)::INTEGER), 0), 6) AS better_ts_pct FROM b""",
)
def baseline_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(baseline_accuracies(frame(spark, sf_dir)), "always_home", "better_win_pct", "better_ts_pct")


_BINS = """edges AS (SELECT i AS bin, i * 0.1::DOUBLE AS lower, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS upper FROM range(10) t(i)),
bins AS (SELECT bin::INTEGER AS bin, lower, upper, count(p) AS count, avg(p) AS mean_pred, avg(y) AS actual_rate
  FROM edges LEFT JOIN (SELECT model_home_win_prob AS p, label AS y FROM scored) s ON p >= lower AND (p < upper OR (bin = 9 AND p <= upper)) GROUP BY ALL)"""


@query(
    "calibration_bins",
    f"WITH {SCORED}, {_BINS} SELECT bin, lower, upper, count, round(mean_pred, 6) AS mean_pred, round(actual_rate, 6) AS actual_rate, 0::BIGINT AS invalid FROM bins",
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(calibration_bins(scored(spark, sf_dir)), "mean_pred", "actual_rate")


# Every fiftieth score below 0, above 1, missing or not a number.
_SPOILED = """spoiled AS (SELECT CASE game_id::BIGINT % 50 WHEN 0 THEN -0.1::DOUBLE WHEN 1 THEN 1.4::DOUBLE WHEN 2 THEN NULL WHEN 3 THEN 'nan'::DOUBLE ELSE model_home_win_prob END AS p, label AS y FROM scored),
edges AS (SELECT i AS bin, i * 0.1::DOUBLE AS lower, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS upper FROM range(10) t(i)),
ok AS (SELECT * FROM spoiled WHERE NOT isnan(p) AND p BETWEEN 0 AND 1), bad AS (SELECT (SELECT count(*) FROM spoiled) - (SELECT count(*) FROM ok) AS invalid)"""


@query(
    "calibration_bins_spoiled",
    f"""WITH {SCORED}, {_SPOILED} SELECT bin::INTEGER AS bin, lower, upper, count(p) AS count, round(avg(p), 6) AS mean_pred, round(avg(y), 6) AS actual_rate, any_value(invalid) AS invalid
      FROM edges CROSS JOIN bad LEFT JOIN ok ON p >= lower AND (p < upper OR (bin = 9 AND p <= upper)) GROUP BY bin, lower, upper""",
)
def calibration_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reliability table of scores of which some are invalid."""
    spoiled = (
        F.when(F.col("game_id").cast("long") % 50 == 0, -0.1)
        .when(F.col("game_id").cast("long") % 50 == 1, 1.4)
        .when(F.col("game_id").cast("long") % 50 == 2, F.lit(None).cast("double"))
        .when(F.col("game_id").cast("long") % 50 == 3, F.lit(float("nan")))
        .otherwise(F.col("model_home_win_prob"))
    )
    bins = calibration_bins(scored(spark, sf_dir).withColumn("model_home_win_prob", spoiled))
    return six(bins, "mean_pred", "actual_rate")


@query(
    "ece_mce",
    f"""WITH {SCORED}, {_BINS} SELECT sum(count)::BIGINT AS n, round(sum(abs(mean_pred - actual_rate) * count) / sum(count), 6) AS ece,
      round(max(abs(mean_pred - actual_rate)), 6) AS mce FROM bins""",
)
def ece_mce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(calibration_errors(calibration_bins(scored(spark, sf_dir))), "ece", "mce")


@query(
    "reliability_lines",
    f"""WITH {SCORED}, {_BINS} SELECT bin, printf('%.2f to %.2f', lower, upper) || CASE WHEN count > 0 THEN printf(' | n=%d | predicted %.4f | happened %.4f | apart %.4f', count,
      mean_pred, actual_rate, abs(mean_pred - actual_rate)) ELSE ' | empty' END AS line FROM bins""",
)
def reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability_lines(calibration_bins(scored(spark, sf_dir)))


_EPS = repr(EPSILON)
_SCORES_SQL = f"""count(*) AS n_test, round(avg((((model_home_win_prob >= 0.5)::INTEGER) = label)::INTEGER), 6) AS accuracy,
  round(avg(-(label * ln(greatest(least(model_home_win_prob, 1 - {_EPS}::DOUBLE), {_EPS}::DOUBLE)) + (1 - label) * ln(1 - greatest(least(model_home_win_prob, 1 - {_EPS}::DOUBLE), {_EPS}::DOUBLE)))), 6) AS log_loss,
  round(avg((model_home_win_prob - label) * (model_home_win_prob - label)), 6) AS brier"""


@query("log_loss_brier", f"WITH {SCORED} SELECT {_SCORES_SQL} FROM scored")
def log_loss_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(score_metrics(scored(spark, sf_dir)), "accuracy", "log_loss", "brier")


@query(
    "evaluation_summary",
    f"""WITH {SCORED}, {_BINS}, m AS (SELECT {_SCORES_SQL} FROM scored), e AS (SELECT round(sum(abs(mean_pred - actual_rate) * count) / sum(count), 6) AS ece,
        round(max(abs(mean_pred - actual_rate)), 6) AS mce FROM bins),
      b AS (SELECT round(avg((always_home = label)::INTEGER), 6) AS always_home, round(avg((better_win_pct = label)::INTEGER), 6) AS better_win_pct,
        round(avg((better_ts_pct = label)::INTEGER), 6) AS better_ts_pct FROM (SELECT label, {_BASE_SQL} FROM frame))
      SELECT 'rolling_share' AS model, *, greatest(always_home, better_win_pct, better_ts_pct) AS best_baseline,
        round(accuracy - greatest(always_home, better_win_pct, better_ts_pct), 6) AS minus_best_baseline FROM m, e, b""",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation_summary(evaluation_row(scored(spark, sf_dir), "rolling_share"))


REPLICATES = 200


@query(
    "bootstrap_accuracy",
    f"""WITH {SCORED}, v AS (SELECT game_id::BIGINT AS k, unnest(['accuracy', 'brier']) AS metric,
        unnest([((model_home_win_prob >= 0.5)::INTEGER = label)::INTEGER::DOUBLE, (model_home_win_prob - label) * (model_home_win_prob - label)]) AS x FROM scored),
      w AS (SELECT k, r, {weight_sql('k', 'r')} AS w FROM (SELECT DISTINCT k FROM v), range({REPLICATES}) AS t(r)),
      d AS (SELECT metric, r, sum(x * w) / sum(w) AS mean FROM v JOIN w USING (k) WHERE x IS NOT NULL GROUP BY metric, r HAVING sum(w) > 0),
      s AS (SELECT metric, quantile_cont(mean, 0.025) AS low, quantile_cont(mean, 0.975) AS high FROM d GROUP BY metric)
      SELECT metric, count(x) AS n, round(avg(x), 6) AS estimate, round(any_value(low), 6) AS low, round(any_value(high), 6) AS high FROM v LEFT JOIN s USING (metric) GROUP BY metric""",
)
def accuracy_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and Brier score with 95 % intervals over 200 Poisson replicates."""
    p = F.col("model_home_win_prob")
    rows = scored(spark, sf_dir).select(
        F.col("game_id").cast("long").alias("k"),
        ((p >= 0.5).cast("int") == F.col("label")).cast("int").alias("accuracy"),
        ((p - F.col("label")) * (p - F.col("label"))).alias("brier"),
    )
    return six(bootstrap_means(rows, F.col("k"), ["accuracy", "brier"], REPLICATES), "estimate", "low", "high")


_DRIVERS = " UNION ALL ".join(
    f"SELECT game_id::VARCHAR AS game_id, '{c.replace('rolling_', '')}' AS feature, round(home_{c}::DOUBLE, 6) AS home, round(away_{c}::DOUBLE, 6) AS away FROM frame"
    for c in ROLLING_COLUMNS
)


@query("display_drivers", f"WITH {FRAME} {_DRIVERS}")
def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(display_drivers(frame(spark, sf_dir), ROLLING_COLUMNS, ["game_id"]), "home", "away")


@query(
    "feature_columns",
    f"""WITH {FRAME}, long AS (SELECT unnest([{', '.join(f"'{c}'" for c in INPUTS)}]) AS input, unnest([{', '.join(f'{c}::DOUBLE' for c in INPUTS)}]) AS v FROM frame)
      SELECT input, count(*) AS n_rows, count(v) AS n_values, round(min(v), 6) AS low, round(max(v), 6) AS high FROM long GROUP BY input""",
)
def inputs_profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column that is an input of a model, with its values counted and bounded in one pass."""
    rows = frame(spark, sf_dir)
    value = lambda c: F.col(c).cast("double")
    stats = [
        F.struct(
            F.lit(c).alias("input"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(c).alias("n_values"),
            F.min(value(c)).alias("low"),
            F.max(value(c)).alias("high"),
        )
        for c in feature_columns(rows.columns)
    ]
    # A table without rows has no inputs to speak of.
    out = rows.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("x")).select("x.*").filter("n_rows > 0")
    return six(out, "low", "high")


@query(
    "chronological",
    f"""WITH {FRAME} SELECT game_date, count(*) AS n_games, min(game_id::VARCHAR) AS first_game, max(game_id::VARCHAR) AS last_game, true AS before_next FROM frame GROUP BY game_date""",
)
def in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix as a sink receives it: where each date begins and ends, and whether it ends before the next one begins."""
    placed = chronological(frame(spark, sf_dir)).select("game_date", "game_id", F.monotonically_increasing_id().alias("place"))
    dates = placed.groupBy("game_date").agg(
        F.count(F.lit(1)).alias("n_games"),
        F.min_by("game_id", "place").alias("first_game"),
        F.max_by("game_id", "place").alias("last_game"),
        F.min("place").alias("begins"),
        F.max("place").alias("ends"),
    )
    # One row a date, so the window is bounded by the calendar.
    following = F.lead("begins").over(Window.orderBy("game_date"))
    return dates.select(
        "game_date", "n_games", "first_game", "last_game", F.coalesce(F.col("ends") < following, F.lit(True)).alias("before_next")
    )
