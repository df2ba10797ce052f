"""Row-level records to one row per entity and event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import (
    effective_fg_pct,
    is_home,
    minutes_played,
    opponent,
    safe_div,
    true_shooting_pct,
    won,
)
from tallyframe.schema import ADVANCED_COLUMNS

TEAM_GAME_KEYS = ["season", "game_date", "game_id", "season_type", "team_id", "team_abbreviation"]
JOIN_KEYS = ["game_id", "team_id"]
# Counting statistics summed per team, and who leads in what.
SUMMED = ["pts", "reb", "ast", "tov", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta"]
LEADERS = {"top_scorer": "pts", "top_rebounder": "reb", "top_playmaker": "ast"}


def top_name(stat: Column | str, name: Column | str) -> Column:
    """Name with the highest ``stat`` as an aggregate: missing statistics rank
    last, ties go to the alphabetically first name, unnamed rows do not count."""
    value = F.col(stat) if isinstance(stat, str) else stat
    label = F.col(name) if isinstance(name, str) else name
    rank = F.struct(value.isNull(), -value, label)
    return F.min_by(label, F.when(label.isNotNull(), rank))


def entity_event_totals(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    constants: Sequence[str] = (),
    leaders: Mapping[str, tuple[str, str]] | None = None,
    more: Sequence[Column] = (),
) -> DataFrame:
    """Sums, repeated constants, per-group leaders and ``more`` aggregates in one shuffle.

    Everything is an aggregate with partial results, so each task sends one row
    per group however many rows the group has. A constant is the largest
    non-missing value, which does not depend on row order.
    """
    columns = [F.max(c).alias(c) for c in constants]
    columns += [F.sum(source).alias(out) for out, source in sums.items()]
    for out, (stat, name) in (leaders or {}).items():
        columns.append(top_name(stat, name).alias(out))
    return df.groupBy(*keys).agg(*columns, *more)


def team_game_stats(
    df: DataFrame, with_leaders: bool = False, keys: Sequence[str] = tuple(TEAM_GAME_KEYS), shared: Sequence[str] = ()
) -> DataFrame:
    """Player-game rows to team-game rows: totals, shooting ratios, orientation,
    result and, if asked for, the three leaders.

    With fewer ``keys`` (game and team) the game's own attributes can be joined
    afterwards, when every group is down to one row. Attributes named in ``shared`` are
    taken along, and ``mixed`` says of a group that its rows differ in them.
    """
    leaders = {out: (stat, "player_name") for out, stat in LEADERS.items()} if with_leaders else {}
    ends = [end(F.struct(*shared)).alias(name) for name, end in (("__low", F.min), ("__high", F.max))] if shared else []
    totals = entity_event_totals(
        df, keys, {c: c for c in SUMMED}, constants=["matchup", "wl"], leaders=leaders, more=ends
    )
    taken = [*[F.col(f"__high.{c}").alias(c) for c in shared], (~F.col("__low").eqNullSafe(F.col("__high"))).alias("mixed")]
    return totals.select(
        *keys,
        *(taken if shared else []),
        opponent("matchup").alias("opponent_abbreviation"),
        is_home("matchup").alias("is_home"),
        won("wl").alias("win"),
        "pts",
        "reb",
        "ast",
        "tov",
        safe_div("fgm", "fga").alias("fg_pct"),
        safe_div("fg3m", "fg3a").alias("fg3_pct"),
        safe_div("ftm", "fta").alias("ft_pct"),
        effective_fg_pct("fgm", "fg3m", "fga").alias("effective_fg_pct"),
        true_shooting_pct("pts", "fga", "fta").alias("true_shooting_pct"),
        safe_div("ast", "tov").alias("assist_to_turnover"),
        *leaders,
    )


def top_per_group(
    df: DataFrame, stat: str, keys: Sequence[str], out: str, name: str = "player_name"
) -> DataFrame:
    """One row per group that has at least one named row: its leader."""
    return (
        df.filter(F.col(name).isNotNull()).groupBy(*keys).agg(top_name(stat, name).alias(out))
    )


def join_top_players(team_game: DataFrame, rows: DataFrame) -> DataFrame:
    """Attach the three leaders to totals computed elsewhere; they come from one
    aggregate, so one join serves all three."""
    tops = rows.groupBy(*JOIN_KEYS).agg(
        *[top_name(stat, "player_name").alias(out) for out, stat in LEADERS.items()]
    )
    return team_game.join(tops, JOIN_KEYS, "left")


def weighted_averages(
    df: DataFrame,
    keys: Sequence[str],
    weight: Column,
    values: Mapping[str, str],
    maxima: Sequence[str] = (),
) -> DataFrame:
    """Weighted means over rows with positive weight.

    The divisor is the weight of every such row, also of those where the value
    is missing.
    """
    active = df.withColumn("__w", weight).filter(F.col("__w") > 0)
    sums = [F.sum(F.col(src) * F.col("__w")).alias(f"__s_{out}") for out, src in values.items()]
    grouped = active.groupBy(*keys).agg(
        F.sum("__w").alias("__w"), *sums, *[F.max(c).alias(c) for c in maxima]
    )
    return grouped.select(
        *keys, *[safe_div(f"__s_{out}", "__w").alias(out) for out in values], *maxima
    )


def filter_played(df: DataFrame, clock: str = "min") -> DataFrame:
    """Rows of players who were on the floor."""
    return df.filter(minutes_played(clock) > 0)


def team_advanced(rows: DataFrame) -> DataFrame:
    """Per-player ratings to team ratings, weighted by minutes; pace is the value
    every player of the team repeats."""
    rated = weighted_averages(
        rows,
        JOIN_KEYS,
        minutes_played("min"),
        {"off_rating": "off_rating", "def_rating": "def_rating"},
        maxima=["pace"],
    )
    return rated.select(
        *JOIN_KEYS,
        "off_rating",
        "def_rating",
        (F.col("off_rating") - F.col("def_rating")).alias("net_rating"),
        "pace",
    )


def join_team_advanced(team_game: DataFrame, advanced: DataFrame) -> DataFrame:
    """Attach team ratings; games without any keep NULLs."""
    return team_game.join(advanced, JOIN_KEYS, "left")


def with_null_columns(df: DataFrame, names: Sequence[str] = tuple(ADVANCED_COLUMNS)) -> DataFrame:
    """Missing rating columns as NULL doubles; present ones are kept."""
    missing = {c: F.lit(None).cast("double") for c in names if c not in df.columns}
    return df.withColumns(missing) if missing else df
