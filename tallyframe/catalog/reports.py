"""Series, status, leaderboards, match-ups and other report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.series import (
    active_ratio,
    commentary,
    playoffs_only,
    series_summary,
    team_status,
)
from tallyframe.operators.views import (
    attach_pairs,
    explore,
    game_log_view,
    head_to_head,
    leaderboard_view,
    recent,
    scorecard_view,
    union_frames,
    zone_stats,
)
from tallyframe.operators.windows import (
    latest_per_entity,
    leaderboard_order,
    rolling_outputs,
    trailing,
    trajectories,
)
from tallyframe.schema import ROLLING_COLUMNS

from .base import GAMES, SIDED, customer_games, load, rolled_sql, sided_bound, sided_games, six, to_six
from .registry import query
from .rolling import rolled
from .training import FRAME, frame

_SERIES = """series AS (
  SELECT team_abbreviation, opponent_abbreviation, count(*) FILTER (WHERE coalesce(win, false)) AS wins, count(*) FILTER (WHERE NOT coalesce(win, false)) AS losses,
    count(game_id) AS games FROM games WHERE season_type = 'Playoffs' GROUP BY ALL),
states AS (SELECT *, CASE WHEN wins >= 4 THEN 'WON' WHEN losses >= 4 THEN 'LOST' ELSE 'ACTIVE' END AS state FROM series)"""
_STATUS = """status AS (
  SELECT t.team_abbreviation, CASE WHEN p.team_abbreviation IS NULL THEN 'DNP' WHEN l.team_abbreviation IS NOT NULL THEN 'ELIMINATED' ELSE 'ACTIVE' END AS status
  FROM (SELECT DISTINCT team_abbreviation FROM games) t
    LEFT JOIN (SELECT DISTINCT team_abbreviation FROM games WHERE season_type = 'Playoffs') p USING (team_abbreviation)
    LEFT JOIN (SELECT DISTINCT team_abbreviation FROM states WHERE state = 'LOST') l USING (team_abbreviation))"""
_LATEST = f"""{rolled_sql('games', 'current')},
latest AS (SELECT * FROM rolled QUALIFY row_number() OVER (PARTITION BY team_abbreviation ORDER BY game_date DESC, game_id DESC) = 1)"""


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rolled(spark, sf_dir).select("team_abbreviation", "game_date", "game_id", *ROLLING_COLUMNS)
    return latest_per_entity(rows)


@query("series_summary", f"WITH {GAMES}, {_SERIES} SELECT * FROM states")
def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_summary(customer_games(spark, sf_dir))


@query("team_status", f"WITH {GAMES}, {_SERIES}, {_STATUS} SELECT * FROM status")
def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_status(customer_games(spark, sf_dir))


@query(
    "active_ratio",
    f"""WITH {GAMES}, {_SERIES}, {_STATUS}, n AS (SELECT count(*) FILTER (WHERE status = 'ACTIVE') AS active, count(*) FILTER (WHERE status <> 'DNP') AS playoff_teams FROM status)
      SELECT active, playoff_teams, round(active::DOUBLE / playoff_teams, 6) AS ratio FROM n""",
)
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(active_ratio(team_status(customer_games(spark, sf_dir))), "ratio")


@query(
    "playoffs_only",
    f"WITH {GAMES} SELECT game_id, team_abbreviation, season FROM games WHERE season_type = 'Playoffs'",
)
def playoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playoffs_only(customer_games(spark, sf_dir)).select("game_id", "team_abbreviation", "season")


@query(
    "leaderboard",
    f"""WITH {GAMES}, {_SERIES}, {_STATUS}, {_LATEST}
      SELECT team_abbreviation AS team, CASE status WHEN 'ELIMINATED' THEN 'OUT' WHEN 'DNP' THEN 'DNP' ELSE 'ACTIVE' END AS status, games_in_window AS games,
        round(rolling_pts, 6) AS pts, round(rolling_efg_pct, 6) AS "eFG%", round(rolling_ts_pct, 6) AS "TS%", round(rolling_ast_to_tov, 6) AS "AST/TOV",
        round(rolling_win_pct, 6) AS "win%", round(rolling_pts_home, 6) AS "pts (home)", round(rolling_pts_away, 6) AS "pts (away)"
      FROM latest JOIN status USING (team_abbreviation)""",
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = leaderboard_view(_latest(spark, sf_dir), team_status(customer_games(spark, sf_dir)))
    numbers = ["pts", "eFG%", "TS%", "AST/TOV", "win%", "pts (home)", "pts (away)"]
    return board.select("team", "status", "games", *[to_six(c).alias(c) for c in numbers])


@query(
    "latest_snapshot",
    f"WITH {GAMES}, {_LATEST} SELECT team_abbreviation, games_in_window, round(rolling_ts_pct, 6) AS rolling_ts_pct FROM latest ORDER BY rolling_ts_pct DESC NULLS LAST, team_abbreviation",
)
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = leaderboard_order(_latest(spark, sf_dir), tie=["team_abbreviation"])
    return six(board.select("team_abbreviation", "games_in_window", "rolling_ts_pct"), "rolling_ts_pct")


@query(
    "default_leader",
    f"WITH {GAMES}, {_LATEST} SELECT team_abbreviation FROM latest ORDER BY round(rolling_ts_pct, 6) DESC NULLS LAST, team_abbreviation LIMIT 1",
)
def default_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = six(_latest(spark, sf_dir), "rolling_ts_pct")
    return leaderboard_order(latest, tie=["team_abbreviation"]).limit(1).select("team_abbreviation")


@query(
    "team_series_history",
    f"""WITH {GAMES}, {_SERIES}, {_LATEST}, top AS (SELECT team_abbreviation FROM latest ORDER BY round(rolling_ts_pct, 6) DESC NULLS LAST, team_abbreviation LIMIT 1)
      SELECT states.* FROM states SEMI JOIN top USING (team_abbreviation)""",
)
def leader_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of the team the report opens on."""
    return series_summary(
        customer_games(spark, sf_dir).join(default_leader(spark, sf_dir), "team_abbreviation", "left_semi")
    )




def _figure(value: str, digits: int, sign: str = "") -> str:
    ten = f"{10**digits}.0::DOUBLE"
    return f"coalesce(printf('%.{digits}f{sign}', floor({value} * {ten} + 0.5::DOUBLE) / {ten}), 'unknown')"


_COMMENTARY = f"""WITH {GAMES}, {_SERIES}, {_STATUS}, {_LATEST},
shown AS (SELECT team_abbreviation, games_in_window, round(rolling_ts_pct, 6) AS ts, rolling_win_pct, rolling_pts FROM latest)
SELECT * FROM (SELECT 1 AS priority, 'leader' AS kind, team_abbreviation AS team,
  printf('%s shoots best: %s true shooting in the last %d games, %s of them won, %s points a game', team_abbreviation, {_figure('ts', 3)}, games_in_window::BIGINT, {_figure('(rolling_win_pct * 100)', 1, '%%')}, {_figure('rolling_pts', 3)}) AS note
  FROM shown ORDER BY ts DESC NULLS LAST, team_abbreviation LIMIT 1)
UNION ALL SELECT 2, 'full_window', team_abbreviation, printf('%s has played all %d games of its window', team_abbreviation, games_in_window::BIGINT) FROM shown WHERE games_in_window = 10
UNION ALL SELECT 3, 'undefeated', team_abbreviation, printf('%s has won each of its last %d games', team_abbreviation, games_in_window::BIGINT) FROM shown WHERE games_in_window >= 4 AND rolling_win_pct = 1
UNION ALL SELECT 4, 'winless', team_abbreviation, printf('%s has lost each of its last %d games', team_abbreviation, games_in_window::BIGINT) FROM shown WHERE games_in_window >= 4 AND rolling_win_pct = 0
UNION ALL SELECT 5, 'eliminated', team_abbreviation, printf('%s is out after a lost series', team_abbreviation) FROM status WHERE status = 'ELIMINATED'
UNION ALL SELECT 6, 'still_active', NULL, printf('%d of the %d teams in the playoffs play on', count(*) FILTER (WHERE status = 'ACTIVE'), count(*) FILTER (WHERE status IN ('ACTIVE', 'ELIMINATED'))) FROM status HAVING count(*) FILTER (WHERE status = 'ACTIVE') > 0"""


@query("commentary", _COMMENTARY)
def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = six(_latest(spark, sf_dir), "rolling_ts_pct")
    return commentary(latest, team_status(customer_games(spark, sf_dir))).select("priority", "kind", "team", "note")


@query(
    "explore",
    f"WITH {GAMES} SELECT game_date, game_id, team_abbreviation, pts FROM games ORDER BY game_date DESC, game_id",
)
def explored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore(customer_games(spark, sf_dir)).select("game_date", "game_id", "team_abbreviation", "pts")


@query(
    "game_log_view",
    f"""WITH {GAMES} SELECT team_abbreviation, game_id, strftime(game_date, '%Y-%m-%d') AS game_date, opponent_abbreviation AS opp, is_home AS home,
      CASE WHEN win THEN 'W' WHEN NOT win THEN 'L' END AS win, pts, round(effective_fg_pct, 6) AS "eFG%", round(true_shooting_pct, 6) AS "TS%", round(assist_to_turnover, 6) AS "AST/TOV" FROM games""",
)
def game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(game_log_view(customer_games(spark, sf_dir)), "eFG%", "TS%", "AST/TOV")


@query(
    "recent_n",
    "SELECT o_orderkey, o_orderdate::DATE AS game_date FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20",
)
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("game_date"))
    return recent(rows, 20, ["game_date", "o_orderkey"])


_SCORED_BY_RULE = f"""{FRAME}, ruled AS (SELECT game_id::VARCHAR AS game_id, game_date, home_team, away_team, label, round(0.25 + home_rolling_win_pct / 2, 4) AS p FROM frame WHERE home_rolling_win_pct IS NOT NULL)"""


@query(
    "scorecard_view",
    f"""WITH {_SCORED_BY_RULE} SELECT game_id, strftime(game_date, '%Y-%m-%d') AS game_date, home_team, away_team, CASE WHEN p >= 0.5 THEN 'home' ELSE 'away' END AS model_pick,
      p AS model_home_win_prob, CASE WHEN label = 1 THEN 'home won' ELSE 'away won' END AS actual, CASE WHEN (p >= 0.5)::INTEGER = label THEN '✓' ELSE '✗' END AS result
      FROM ruled ORDER BY ruled.game_date DESC, game_id DESC LIMIT 20""",
)
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.round(F.col("home_rolling_win_pct") / 2.0 + 0.25, 4)
    scored = (
        frame(spark, sf_dir)
        .filter(F.col("home_rolling_win_pct").isNotNull())
        .withColumn("model_home_win_prob", p)
        .withColumn("model_pick", (F.col("model_home_win_prob") >= 0.5).cast("int"))
        .withColumn("correct", (F.col("model_pick") == F.col("label")).cast("int"))
    )
    return scorecard_view(scored)


# ---- match-ups ------------------------------------------------------------------

_H2H = ["games_in_window", "rolling_pts", "rolling_win_pct"]
_PAIRS = f"""{SIDED}, {rolled_sql('sided', 'current')},
latest AS (SELECT * FROM rolled QUALIFY row_number() OVER (PARTITION BY team_abbreviation ORDER BY game_date DESC, game_id DESC) = 1),
pairs AS (SELECT DISTINCT 'C' || o_custkey AS home_team, 'S' || l_suppkey AS away_team FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _sided_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = sided_games(spark, sf_dir)
    features = trailing(
        games, rolling_outputs(games.columns), window=10, bound_by=sided_bound(spark, sf_dir)
    )
    return latest_per_entity(features.select("team_abbreviation", "game_date", "game_id", *_H2H))


def requested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer and supplier that have met, as a fixture list.

    Repeats are dropped where a supplier's pairs lie, so that its newest row can join them there.
    """
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (
        lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("home_team"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("away_team"),
        )
        .repartition("away_team")
        .distinct()
    )


@query(
    "all_matchups",
    f"""WITH {_PAIRS} SELECT home_team, away_team, h.games_in_window AS home_games_in_window, a.games_in_window AS away_games_in_window,
      round(h.rolling_pts, 6) AS home_rolling_pts, round(a.rolling_pts, 6) AS away_rolling_pts, round(h.rolling_win_pct, 6) AS home_rolling_win_pct, round(a.rolling_win_pct, 6) AS away_rolling_win_pct
      FROM pairs JOIN latest h ON h.team_abbreviation = home_team JOIN latest a ON a.team_abbreviation = away_team""",
)
def matchups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = attach_pairs(requested_pairs(spark, sf_dir), _sided_latest(spark, sf_dir), _H2H)
    return six(out, *[f"{s}_{c}" for s in ("home", "away") for c in _H2H[1:]])


_H2H_NAMES = {"games_in_window": "games", "rolling_pts": "pts", "rolling_win_pct": "win%"}


@query(
    "head_to_head_pivot",
    "WITH "
    + _PAIRS
    + ", m AS (SELECT home_team, away_team, h, a FROM pairs JOIN latest h ON h.team_abbreviation = home_team JOIN latest a ON a.team_abbreviation = away_team) "
    + " UNION ALL ".join(
        f"SELECT home_team, away_team, '{name}' AS metric, round(h.{c}::DOUBLE, 6) AS home_value, round(a.{c}::DOUBLE, 6) AS away_value FROM m"
        for c, name in _H2H_NAMES.items()
    ),
)
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = head_to_head(requested_pairs(spark, sf_dir), _sided_latest(spark, sf_dir), _H2H)
    return six(out, "home_value", "away_value")


@query(
    "trajectories",
    f"""WITH {GAMES}, {rolled_sql('games', 'current')}, busiest AS (SELECT team_abbreviation FROM games GROUP BY 1 ORDER BY count(*) DESC, team_abbreviation LIMIT 2)
      SELECT team_abbreviation, game_date, game_id, round(rolling_ts_pct, 6) AS rolling_ts_pct, round(rolling_win_pct, 6) AS rolling_win_pct FROM rolled SEMI JOIN busiest USING (team_abbreviation)""",
)
def busiest_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two teams with most games, overlaid."""
    orders = load(spark, sf_dir, "orders")
    busiest = (
        orders.groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("team"))
        .count()
        .orderBy(F.col("count").desc(), "team")
        .limit(2)
    )
    teams = [r["team"] for r in busiest.collect()]
    out = trajectories(rolled(spark, sf_dir), teams, ["rolling_ts_pct", "rolling_win_pct"])
    return six(out, "rolling_ts_pct", "rolling_win_pct")


# ---- sets and counts --------------------------------------------------------------


@query(
    "zone_stats",
    "SELECT count(*) AS n_rows, count(DISTINCT o_orderdate::DATE) AS n_dates, min(o_orderdate)::DATE AS first_date, max(o_orderdate)::DATE AS last_date FROM orders",
)
def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_stats(load(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "union_frames",
    "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier",
)
def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return union_frames([customers, suppliers])


@query("distinct_dates", "SELECT DISTINCT o_orderdate::DATE AS game_date FROM orders")
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("game_date")).distinct()


@query("distinct_teams", f"WITH {GAMES} SELECT DISTINCT team_abbreviation FROM games")
def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_games(spark, sf_dir).select("team_abbreviation").distinct()


def _keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id"))
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"))
    return orders, lines


@query(
    "games_intersect",
    "SELECT o_orderkey AS game_id FROM orders INTERSECT SELECT l_orderkey FROM lineitem",
)
def games_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _keys(spark, sf_dir)
    return orders.intersect(lines)


@query(
    "games_except",
    "SELECT o_orderkey AS game_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
)
def games_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _keys(spark, sf_dir)
    return orders.subtract(lines)
