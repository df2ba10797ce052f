"""Totals, leaders and weighted averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.aggregate import (
    entity_event_totals,
    filter_played,
    join_team_advanced,
    join_top_players,
    team_advanced,
    team_game_stats,
    top_per_group,
    with_null_columns,
)

from .base import BOX, box_rows, six, six_sql
from .registry import query

_RATIOS = [
    "fg_pct", "fg3_pct", "ft_pct", "effective_fg_pct", "true_shooting_pct", "assist_to_turnover",
]
_TEAM_SQL = r"""team AS (
  SELECT game_id, team_id, max(matchup) AS matchup, max(wl) AS wl, sum(pts)::BIGINT AS pts, sum(reb)::BIGINT AS reb, sum(ast)::BIGINT AS ast,
    sum(tov)::BIGINT AS tov, sum(fgm) AS fgm, sum(fga) AS fga, sum(fg3m) AS fg3m, sum(fg3a) AS fg3a, sum(ftm) AS ftm, sum(fta) AS fta
  FROM box GROUP BY ALL),
stats AS (
  SELECT game_id, team_id, trim(regexp_replace(matchup, '^[A-Z]{2,4}\s+(vs\.|@)\s+', '')) AS opponent_abbreviation,
    CASE WHEN contains(matchup, 'vs.') THEN true WHEN contains(matchup, '@') THEN false END AS is_home,
    CASE wl WHEN 'W' THEN true WHEN 'L' THEN false END AS win, pts, reb, ast, tov,
    fgm::DOUBLE / nullif(fga, 0) AS fg_pct, fg3m::DOUBLE / nullif(fg3a, 0) AS fg3_pct, ftm::DOUBLE / nullif(fta, 0) AS ft_pct,
    (fgm + 0.5::DOUBLE * fg3m) / nullif(fga, 0) AS effective_fg_pct,
    pts::DOUBLE / nullif(2.0::DOUBLE * (fga + 0.44::DOUBLE * fta), 0) AS true_shooting_pct, ast::DOUBLE / nullif(tov, 0) AS assist_to_turnover
  FROM team)"""
_LEADERS_SQL = """leaders AS (
  SELECT game_id, team_id,
    first(player_name ORDER BY pts DESC NULLS LAST, player_name) AS top_scorer,
    first(player_name ORDER BY reb DESC NULLS LAST, player_name) AS top_rebounder,
    first(player_name ORDER BY ast DESC NULLS LAST, player_name) AS top_playmaker
  FROM box WHERE player_name IS NOT NULL GROUP BY ALL)"""
_STAT_COLUMNS = "game_id, team_id, opponent_abbreviation, is_home, win, pts, reb, ast, tov"
KEYS = ["game_id", "team_id"]


@query(
    "team_game_agg",
    f"WITH {BOX}, {_TEAM_SQL} SELECT {_STAT_COLUMNS}, {six_sql(_RATIOS)} FROM stats",
)
def team_game_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(team_game_stats(box_rows(spark, sf_dir), keys=KEYS), *_RATIOS)


@query(
    "team_game_with_leaders",
    f"WITH {BOX}, {_TEAM_SQL}, {_LEADERS_SQL} SELECT {_STAT_COLUMNS}, {six_sql(_RATIOS)}, top_scorer, top_rebounder, top_playmaker "
    "FROM stats LEFT JOIN leaders USING (game_id, team_id)",
)
def team_game_with_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and all three leaders from one scan and one shuffle."""
    return six(team_game_stats(box_rows(spark, sf_dir), with_leaders=True, keys=KEYS), *_RATIOS)


@query(
    "join_top_players",
    f"WITH {BOX}, {_LEADERS_SQL}, t AS (SELECT game_id, team_id, sum(pts)::BIGINT AS pts FROM box GROUP BY ALL) "
    "SELECT game_id, team_id, pts, top_scorer, top_rebounder, top_playmaker FROM t LEFT JOIN leaders USING (game_id, team_id)",
)
def leaders_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = box_rows(spark, sf_dir)
    return join_top_players(entity_event_totals(rows, KEYS, {"pts": "pts"}), rows)


@query(
    "top_per_group",
    f"WITH {BOX} SELECT game_id, first(player_name ORDER BY pts DESC NULLS LAST, player_name) AS top_scorer "
    "FROM box WHERE player_name IS NOT NULL GROUP BY game_id",
)
def top_of_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_group(box_rows(spark, sf_dir), "pts", ["game_id"], "top_scorer")


@query(
    "first_non_null",
    f"WITH {BOX} SELECT team_id, max(wl) AS wl, max(matchup) AS matchup FROM box GROUP BY team_id",
)
def first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_event_totals(box_rows(spark, sf_dir), ["team_id"], {}, constants=["wl", "matchup"])


_ADVANCED_SQL = r"""played AS (
  SELECT *, try_cast(regexp_extract(min, '^(\d+)', 1) AS DOUBLE) AS w FROM box WHERE try_cast(regexp_extract(min, '^(\d+)', 1) AS DOUBLE) > 0),
adv AS (
  SELECT game_id, team_id, sum(off_rating * w) / nullif(sum(w), 0) AS off_rating, sum(def_rating * w) / nullif(sum(w), 0) AS def_rating,
    sum(off_rating * w) / nullif(sum(w), 0) - sum(def_rating * w) / nullif(sum(w), 0) AS net_rating, max(pace) AS pace
  FROM played GROUP BY ALL)"""
_RATINGS = ["off_rating", "def_rating", "net_rating"]


@query(
    "weighted_avg",
    f"WITH {BOX}, {_ADVANCED_SQL} SELECT game_id, team_id, {six_sql(_RATINGS)}, pace FROM adv",
)
def weighted_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(team_advanced(box_rows(spark, sf_dir)), *_RATINGS)


@query(
    "join_team_advanced",
    f"WITH {BOX}, {_ADVANCED_SQL}, t AS (SELECT game_id, team_id, sum(pts)::BIGINT AS pts FROM box GROUP BY ALL) "
    f"SELECT game_id, team_id, pts, {six_sql(_RATINGS)}, pace FROM t LEFT JOIN adv USING (game_id, team_id)",
)
def advanced_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = box_rows(spark, sf_dir)
    totals = entity_event_totals(rows, KEYS, {"pts": "pts"})
    return six(join_team_advanced(totals, team_advanced(rows)), *_RATINGS)


@query(
    "filter_played",
    f"WITH {BOX} SELECT min, count(*) AS n FROM box WHERE try_cast(regexp_extract(min, '^(\\d+)', 1) AS DOUBLE) > 0 GROUP BY min",
)
def played_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_played(box_rows(spark, sf_dir)).groupBy("min").agg(F.count(F.lit(1)).alias("n"))


@query(
    "with_null_columns",
    "SELECT l_suppkey AS team_id, sum(l_quantity::BIGINT)::BIGINT AS reb, NULL::DOUBLE AS off_rating, "
    "NULL::DOUBLE AS def_rating, NULL::DOUBLE AS net_rating, NULL::DOUBLE AS pace FROM lineitem GROUP BY 1",
)
def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_null_columns(entity_event_totals(box_rows(spark, sf_dir), ["team_id"], {"reb": "reb"}))
