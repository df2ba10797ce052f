"""Parsing, coercion and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text conventions of the source feeds.
HOME_MARK = "vs."
AWAY_MARK = "@"
OWN_CODE_PREFIX = r"^[A-Z]{2,4}\s+(vs\.|@)\s+"
LEADING_MINUTES = r"^(\d+)"
PAYLOAD_ALIASES = {"to": "tov"}
ADVANCED_PAYLOAD_NAMES = {
    "teamId": "team_id",
    "teamTricode": "team_abbreviation",
    "teamCity": "team_city",
    "personId": "player_id",
    "minutes": "min",
    "estimatedOffensiveRating": "e_off_rating",
    "offensiveRating": "off_rating",
    "estimatedDefensiveRating": "e_def_rating",
    "defensiveRating": "def_rating",
    "estimatedNetRating": "e_net_rating",
    "netRating": "net_rating",
    "assistPercentage": "ast_pct",
    "assistToTurnover": "ast_tov",
    "assistRatio": "ast_ratio",
    "offensiveReboundPercentage": "oreb_pct",
    "defensiveReboundPercentage": "dreb_pct",
    "reboundPercentage": "reb_pct",
    "effectiveFieldGoalPercentage": "efg_pct",
    "trueShootingPercentage": "ts_pct",
    "usagePercentage": "usg_pct",
    "estimatedUsagePercentage": "e_usg_pct",
    "pace": "pace",
    "estimatedPace": "e_pace",
    "PIE": "pie",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL where the denominator is NULL or zero; never raises under ANSI."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def effective_fg_pct(fgm: Column | str, fg3m: Column | str, fga: Column | str) -> Column:
    """Field goals per attempt with a made three worth one and a half."""
    return safe_div(_col(fgm).cast("double") + F.lit(0.5) * _col(fg3m).cast("double"), fga)


def true_shooting_pct(pts: Column | str, fga: Column | str, fta: Column | str) -> Column:
    """Points per two shooting possessions, a free throw counting 0.44 of one."""
    return safe_div(pts, F.lit(2.0) * (_col(fga).cast("double") + F.lit(0.44) * _col(fta).cast("double")))


def is_home(matchup: Column | str) -> Column:
    """True, False, or NULL where the text names neither side."""
    text = _col(matchup)
    return F.when(text.contains(HOME_MARK), True).when(text.contains(AWAY_MARK), False)


def opponent(matchup: Column | str) -> Column:
    """The other side's code; text without the expected prefix stays as it is."""
    return F.trim(F.regexp_replace(_col(matchup), OWN_CODE_PREFIX, ""))


def won(result: Column | str) -> Column:
    text = _col(result)
    return F.when(text == "W", True).when(text == "L", False)


def minutes_played(clock: Column | str) -> Column:
    """Whole minutes of an ``MM:SS`` text; NULL where it holds no leading digits."""
    return F.regexp_extract(_col(clock), LEADING_MINUTES, 1).try_cast("double")


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name, tolerant of a missing part; NULL when both are blank."""
    joined = F.trim(F.concat_ws(" ", F.trim(_col(first)), F.trim(_col(last))))
    return F.nullif(joined, F.lit(""))


def season_start_year(season: Column | str) -> Column:
    """``2025-26`` gives 2025."""
    return F.split(_col(season), "-").getItem(0).try_cast("int")


def nan_to_null(c: Column | str) -> Column:
    column = _col(c)
    return F.when(~F.isnan(column), column)


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Every floating column with NaN read as missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: nan_to_null(F.col(f"`{name}`")) for name in floats}) if floats else df


def coerce_numeric(c: Column | str, to: str = "double") -> Column:
    """Numbers parse, everything else (and NaN) is NULL; 5.0 narrows to 5."""
    number = nan_to_null(_col(c).try_cast("double"))
    return number if to == "double" else number.try_cast(to)


def rename_lower(df: DataFrame) -> DataFrame:
    """Lower-case every column name, then apply the feed's aliases."""
    return df.withColumnsRenamed(
        {c: PAYLOAD_ALIASES.get(c.lower(), c.lower()) for c in df.columns}
    )


def rename_by_map(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    names = ADVANCED_PAYLOAD_NAMES if names is None else names
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def wall_clock(c: Column | str, zone: str) -> Column:
    """The local date and time of an instant in ``zone``, whatever the session's
    own time zone is."""
    return F.convert_timezone(None, F.lit(zone), _col(c).cast("timestamp_ntz"))


def iso_utc(c: Column | str) -> Column:
    """ISO-8601 UTC text; microseconds appear only when there are any."""
    ts = wall_clock(c, "UTC")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(base, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))
