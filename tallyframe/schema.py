"""Declared table schemas and the projection that makes a frame match one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampType()


def table(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    """Schema of nullable columns in order."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names, order and types of the persisted tables.
PLAYER_GAME = table(
    [
        ("game_id", STRING),
        ("game_date", DATE),
        ("season", INT),
        ("season_type", STRING),
        ("team_id", INT),
        ("team_abbreviation", STRING),
        ("team_city", STRING),
        ("matchup", STRING),
        ("wl", STRING),
        ("player_id", INT),
        ("player_name", STRING),
        ("start_position", STRING),
        ("min", STRING),
        ("pts", INT),
        ("reb", INT),
        ("ast", INT),
        ("stl", INT),
        ("blk", INT),
        ("tov", INT),
        ("pf", INT),
        ("fgm", INT),
        ("fga", INT),
        ("fg3m", INT),
        ("fg3a", INT),
        ("ftm", INT),
        ("fta", INT),
        ("plus_minus", INT),
    ]
)
PLAYER_GAME_ADVANCED = table(
    [
        ("game_id", STRING),
        ("game_date", DATE),
        ("season", INT),
        ("season_type", STRING),
        ("team_id", INT),
        ("team_abbreviation", STRING),
        ("player_id", INT),
        ("player_name", STRING),
        ("min", STRING),
        ("e_off_rating", DOUBLE),
        ("off_rating", DOUBLE),
        ("e_def_rating", DOUBLE),
        ("def_rating", DOUBLE),
        ("e_net_rating", DOUBLE),
        ("net_rating", DOUBLE),
        ("ast_pct", DOUBLE),
        ("ast_tov", DOUBLE),
        ("ast_ratio", DOUBLE),
        ("oreb_pct", DOUBLE),
        ("dreb_pct", DOUBLE),
        ("reb_pct", DOUBLE),
        ("tm_tov_pct", DOUBLE),
        ("efg_pct", DOUBLE),
        ("ts_pct", DOUBLE),
        ("usg_pct", DOUBLE),
        ("e_usg_pct", DOUBLE),
        ("pace", DOUBLE),
        ("e_pace", DOUBLE),
        ("pie", DOUBLE),
    ]
)
ODDS = table(
    [
        ("game_id", STRING),
        ("game_date", DATE),
        ("commence_time", TIMESTAMP),
        ("home_team", STRING),
        ("away_team", STRING),
        ("sportsbook", STRING),
        ("market_type", STRING),
        ("outcome_name", STRING),
        ("price", INT),
        ("point", DOUBLE),
        ("fetched_at", TIMESTAMP),
    ]
)
TEAM_GAME = table(
    [
        ("season", INT),
        ("game_date", DATE),
        ("game_id", STRING),
        ("season_type", STRING),
        ("team_id", INT),
        ("team_abbreviation", STRING),
        ("opponent_abbreviation", STRING),
        ("is_home", BOOLEAN),
        ("win", BOOLEAN),
        ("pts", LONG),
        ("reb", LONG),
        ("ast", LONG),
        ("tov", LONG),
        ("fg_pct", DOUBLE),
        ("fg3_pct", DOUBLE),
        ("ft_pct", DOUBLE),
        ("effective_fg_pct", DOUBLE),
        ("true_shooting_pct", DOUBLE),
        ("assist_to_turnover", DOUBLE),
        ("top_scorer", STRING),
        ("top_rebounder", STRING),
        ("top_playmaker", STRING),
        ("off_rating", DOUBLE),
        ("def_rating", DOUBLE),
        ("net_rating", DOUBLE),
        ("pace", DOUBLE),
    ]
)
ROLLING = table(
    [
        ("season", INT),
        ("game_date", DATE),
        ("game_id", STRING),
        ("team_id", INT),
        ("team_abbreviation", STRING),
        ("games_in_window", INT),
        ("rolling_pts", DOUBLE),
        ("rolling_efg_pct", DOUBLE),
        ("rolling_ts_pct", DOUBLE),
        ("rolling_ast_to_tov", DOUBLE),
        ("rolling_win_pct", DOUBLE),
        ("rolling_pts_home", DOUBLE),
        ("rolling_pts_away", DOUBLE),
        ("rolling_ortg", DOUBLE),
        ("rolling_drtg", DOUBLE),
        ("rolling_net_rtg", DOUBLE),
        ("rolling_pace", DOUBLE),
    ]
)
ADVANCED_COLUMNS = ["off_rating", "def_rating", "net_rating", "pace"]
ROLLING_COLUMNS = [f.name for f in ROLLING.fields[5:]]
TRAINING_IDS = ["game_id", "game_date", "season", "home_team", "away_team"]
TRAINING_COLUMNS = (
    TRAINING_IDS
    + [f"home_{c}" for c in ROLLING_COLUMNS]
    + [f"away_{c}" for c in ROLLING_COLUMNS]
    + ["label"]
)
PICKS = table(
    [
        ("pick_id", STRING),
        ("published_at", TIMESTAMP),
        ("game_date", DATE),
        ("commence_time", TIMESTAMP),
        ("home_team_abbr", STRING),
        ("away_team_abbr", STRING),
        ("home_team_full", STRING),
        ("away_team_full", STRING),
        ("model_version", STRING),
        ("model_prob_home_win", DOUBLE),
        ("model_features", T.MapType(STRING, DOUBLE)),
        ("market", table([
            ("sportsbook", STRING),
            ("home_odds_american", INT),
            ("away_odds_american", INT),
            ("home_implied_prob", DOUBLE),
            ("away_implied_prob", DOUBLE),
            ("fair_home_prob", DOUBLE),
            ("fair_away_prob", DOUBLE),
            ("vig_percent", DOUBLE),
        ])),
        ("pick_side", STRING),
        ("pick_american_odds", INT),
        ("expected_value", DOUBLE),
        ("kelly_fraction_half", DOUBLE),
        ("disagreement_pp", DOUBLE),
        ("no_bet_reason", STRING),
        ("kelly_was_capped", BOOLEAN),
        ("max_disagreement_pp_used", DOUBLE),
        ("max_kelly_fraction_used", DOUBLE),
        ("notes", STRING),
    ]
)


def _fit(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    source = df.schema[field.name].dataType
    column = F.col(f"`{field.name}`")
    if source == field.dataType:
        return column
    if isinstance(field.dataType, (T.IntegerType, T.LongType)) and isinstance(source, T.StringType):
        # "5.0" in a payload is the integer 5, as it is for a float source.
        column = column.try_cast("double")
    if isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
        return column.cast(field.dataType).alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones NULL, extras dropped,
    values that do not parse NULL."""
    return df.select([_fit(df, field) for field in schema.fields])


def training_schema() -> T.StructType:
    """Schema of the one-row-per-game training matrix."""
    sided = []
    for side in ("home", "away"):
        for field in ROLLING.fields[5:]:
            sided.append(T.StructField(f"{side}_{field.name}", field.dataType, True))
    ids = table([("game_id", STRING), ("game_date", DATE), ("season", INT), ("home_team", STRING), ("away_team", STRING)])
    return T.StructType(ids.fields + sided + [T.StructField("label", T.IntegerType(), True)])


def feature_columns(columns: list[str]) -> list[str]:
    """Model inputs: everything that is neither identifier nor label."""
    return [c for c in columns if c not in TRAINING_IDS and c != "label"]
