"""Parsing and coercion, row by row over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.scalars import (
    coerce_numeric,
    effective_fg_pct,
    full_name,
    is_home,
    minutes_played,
    nulls_for_nan,
    opponent,
    rename_by_map,
    rename_lower,
    safe_div,
    season_start_year,
    true_shooting_pct,
    won,
)
from tallyframe.schema import PLAYER_GAME, conform
from tallyframe.sources.landing import stamp

from .base import BOX, box_rows, load, six, six_sql
from .registry import query

_RATIO_NAMES = ["fg_pct", "effective_fg_pct", "true_shooting_pct", "assist_to_turnover"]


@query(
    "safe_div_ratios",
    f"""WITH {BOX}, r AS (SELECT game_id, team_id, pts, fgm::DOUBLE / nullif(fga, 0) AS fg_pct, (fgm + 0.5::DOUBLE*fg3m) / nullif(fga, 0) AS effective_fg_pct,
      pts::DOUBLE / nullif(2.0::DOUBLE * (fga + 0.44::DOUBLE*fta), 0) AS true_shooting_pct, ast::DOUBLE / nullif(tov, 0) AS assist_to_turnover FROM box)
    SELECT game_id, team_id, pts, {six_sql(_RATIO_NAMES)} FROM r""",
)
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = box_rows(spark, sf_dir).select(
        "game_id",
        "team_id",
        "pts",
        safe_div("fgm", "fga").alias("fg_pct"),
        effective_fg_pct("fgm", "fg3m", "fga").alias("effective_fg_pct"),
        true_shooting_pct("pts", "fga", "fta").alias("true_shooting_pct"),
        safe_div("ast", "tov").alias("assist_to_turnover"),
    )
    return six(out, *_RATIO_NAMES)


@query(
    "matchup_parse",
    rf"""WITH {BOX} SELECT game_id, team_id, matchup, trim(regexp_replace(matchup, '^[A-Z]{{2,4}}\s+(vs\.|@)\s+', '')) AS opponent,
      CASE WHEN contains(matchup, 'vs.') THEN true WHEN contains(matchup, '@') THEN false END AS is_home,
      CASE wl WHEN 'W' THEN true WHEN 'L' THEN false END AS win FROM box""",
)
def matchup_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return box_rows(spark, sf_dir).select(
        "game_id",
        "team_id",
        "matchup",
        opponent("matchup").alias("opponent"),
        is_home("matchup").alias("is_home"),
        won("wl").alias("win"),
    )


@query(
    "minutes_parse",
    rf"WITH {BOX} SELECT game_id, team_id, min AS clock, try_cast(regexp_extract(min, '^(\d+)', 1) AS DOUBLE) AS minutes FROM box",
)
def minutes_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return box_rows(spark, sf_dir).select(
        "game_id", "team_id", F.col("min").alias("clock"), minutes_played("min").alias("minutes")
    )


_CONFORM_SQL = """SELECT l_orderkey::VARCHAR AS game_id, l_shipdate::DATE AS game_date, year(l_shipdate)::INTEGER AS season, 'Playoffs' AS season_type,
  l_suppkey::INTEGER AS team_id, NULL::VARCHAR AS team_abbreviation, NULL::VARCHAR AS team_city, NULL::VARCHAR AS matchup, l_returnflag AS wl,
  l_partkey::INTEGER AS player_id, NULL::VARCHAR AS player_name, NULL::VARCHAR AS start_position, NULL::VARCHAR AS min,
  try_cast(floor(l_extendedprice) AS INTEGER) AS pts, try_cast(l_quantity AS INTEGER) AS reb,
  CASE WHEN l_linenumber <> 7 THEN l_linenumber::INTEGER END AS ast, NULL::INTEGER AS stl, NULL::INTEGER AS blk, l_linenumber::INTEGER AS tov, NULL::INTEGER AS pf,
  NULL::INTEGER AS fgm, NULL::INTEGER AS fga, NULL::INTEGER AS fg3m, NULL::INTEGER AS fg3a, NULL::INTEGER AS ftm, NULL::INTEGER AS fta,
  NULL::INTEGER AS plus_minus FROM lineitem"""


@query("rename_conform", _CONFORM_SQL)
def rename_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload headings, text numbers, one unparseable value: to declared rows."""
    payload = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("GAME_ID"),
        F.col("l_shipdate").alias("GAME_DATE"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-"), F.lit("99")).alias("SEASON"),
        F.col("l_suppkey").alias("TEAM_ID"),
        F.col("l_returnflag").alias("WL"),
        F.col("l_partkey").alias("PLAYER_ID"),
        F.floor("l_extendedprice").cast("double").alias("PTS"),
        F.col("l_quantity").cast("string").alias("REB"),
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_linenumber").cast("string")).alias("AST"),
        F.col("l_linenumber").alias("TO"),
        F.col("l_tax").alias("UNKNOWN_EXTRA"),
    )
    rows = stamp(
        rename_lower(payload), season=season_start_year("season"), season_type=F.lit("Playoffs")
    )
    numbers = {c: coerce_numeric(c, "int") for c in ("pts", "reb", "ast", "tov", "team_id", "player_id")}
    return conform(rows.withColumns(numbers), PLAYER_GAME)


@query(
    "rename_map",
    "SELECT l_suppkey AS team_id, l_partkey AS player_id, l_discount AS off_rating, l_tax AS def_rating, l_quantity AS pace FROM lineitem",
)
def rename_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("teamId"),
        F.col("l_partkey").alias("personId"),
        F.col("l_discount").alias("offensiveRating"),
        F.col("l_tax").alias("defensiveRating"),
        F.col("l_quantity").alias("pace"),
    )
    return rename_by_map(payload)


@query(
    "full_name",
    """SELECT c_custkey, nullif(trim(CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE coalesce(CASE WHEN c_nationkey % 5 > 0 THEN trim(' ' || c_mktsegment || ' ') END, '') END
      || ' ' || CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE c_name END), '') AS full_name FROM customer""",
)
def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    first = F.when(nation % 3 == 0, "  ").when(
        nation % 5 > 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "))
    )
    last = F.when(nation % 4 != 0, F.col("c_name"))
    return load(spark, sf_dir, "customer").select("c_custkey", full_name(first, last).alias("full_name"))


@query(
    "coerce_numeric",
    """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
      CASE WHEN event_type <> 'error' THEN value END AS value, CASE WHEN event_type = 'view' THEN NULL ELSE user_id::INTEGER END AS user_number FROM events""",
)
def coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that may not parse, NaN standing for missing, whole floats."""
    dirty = load(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", F.col("event_type"))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .alias("user_number"),
    )
    return nulls_for_nan(dirty).select(
        "event_id", coerce_numeric("k", "int").alias("k"), "value", coerce_numeric("user_number", "int").alias("user_number")
    )
