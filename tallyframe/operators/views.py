"""Report projections over processed rows, features and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import leaderboard_order

# Report headings.
SNAPSHOT_HEADINGS = {
    "games_in_window": "games",
    "rolling_pts": "pts",
    "rolling_efg_pct": "eFG%",
    "rolling_ts_pct": "TS%",
    "rolling_ast_to_tov": "AST/TOV",
    "rolling_win_pct": "win%",
    "rolling_pts_home": "pts (home)",
    "rolling_pts_away": "pts (away)",
}


def explore(processed: DataFrame, team: str | None = None) -> DataFrame:
    """Processed rows, newest first, optionally of one team."""
    rows = processed if team is None else processed.filter(F.col("team_abbreviation") == team)
    return rows.orderBy(F.col("game_date").desc(), "game_id")


def game_log_view(processed: DataFrame, team: str | None = None) -> DataFrame:
    """Game-by-game results under report headings."""
    rows = processed if team is None else processed.filter(F.col("team_abbreviation") == team)
    return rows.select(
        "team_abbreviation",
        "game_id",
        F.date_format("game_date", "yyyy-MM-dd").alias("game_date"),
        F.col("opponent_abbreviation").alias("opp"),
        F.col("is_home").alias("home"),
        F.when(F.col("win"), "W").when(~F.col("win"), "L").alias("win"),
        "pts",
        F.col("effective_fg_pct").alias("eFG%"),
        F.col("true_shooting_pct").alias("TS%"),
        F.col("assist_to_turnover").alias("AST/TOV"),
    )


def leaderboard_view(latest: DataFrame, status: DataFrame) -> DataFrame:
    """Latest rolling row per team with its display status, best TS% first."""
    shown = F.when(F.col("status") == "ELIMINATED", "OUT").when(F.col("status") == "DNP", "DNP").otherwise("ACTIVE")
    board = leaderboard_order(latest.join(status, "team_abbreviation", "left"), tie=["team_abbreviation"])
    return board.select(
        F.col("team_abbreviation").alias("team"),
        shown.alias("status"),
        *[F.col(c).alias(h) for c, h in SNAPSHOT_HEADINGS.items()],
    )


def recent(df: DataFrame, n: int = 20, order: Sequence[str] = ("game_date", "game_id")) -> DataFrame:
    """The newest ``n`` rows."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def scorecard_view(scored: DataFrame, n: int = 20) -> DataFrame:
    """Newest scored games with words for pick, outcome and hit."""
    side = F.when(F.col("model_pick") == 1, "home").otherwise("away")
    actual = F.when(F.col("label") == 1, "home won").otherwise("away won")
    return recent(scored, n).select(
        "game_id",
        F.date_format("game_date", "yyyy-MM-dd").alias("game_date"),
        "home_team",
        "away_team",
        side.alias("model_pick"),
        "model_home_win_prob",
        actual.alias("actual"),
        F.when(F.col("correct") == 1, "✓").otherwise("✗").alias("result"),
    )


def _stacked(pairs: dict[str, Sequence[Column]], names: Sequence[str]) -> Column:
    rows = [
        F.struct(F.lit(label).alias(names[0]), *[c.cast("double").alias(n) for c, n in zip(cols, names[1:], strict=True)])
        for label, cols in pairs.items()
    ]
    return F.explode(F.array(*rows)).alias("__r")


def display_drivers(wide: DataFrame, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Wide ``home_*``/``away_*`` inputs to ``(feature, home, away)`` rows."""
    pairs = {
        c.replace("rolling_", "", 1): (F.col(f"home_{c}"), F.col(f"away_{c}")) for c in columns
    }
    return wide.select(*ids, _stacked(pairs, ["feature", "home", "away"])).select(*ids, "__r.*")


def attach_pairs(
    pairs: DataFrame, latest: DataFrame, columns: Sequence[str], entity: str = "team_abbreviation"
) -> DataFrame:
    """Requested ``(home_team, away_team)`` match-ups with both snapshots.

    The pairs are given, so two equi-joins do; nothing is crossed. A team never
    meets itself, and an unknown team drops the pair. Away teams come first: pairs
    dealt by them already are not moved again before their columns are wide.
    """
    out = pairs.filter(F.col("home_team") != F.col("away_team"))
    rest = [c for c in pairs.columns if c not in ("home_team", "away_team")]
    for side in ("away", "home"):
        sided = latest.select(
            F.col(entity).alias(f"{side}_team"), *[F.col(c).alias(f"{side}_{c}") for c in columns]
        )
        out = out.join(sided, f"{side}_team")
    return out.select("away_team", "home_team", *rest, *[f"{side}_{c}" for side in ("home", "away") for c in columns])


def head_to_head(
    pairs: DataFrame, latest: DataFrame, columns: Sequence[str], entity: str = "team_abbreviation"
) -> DataFrame:
    """Each requested pair as one row per metric: home value beside away value."""
    wide = attach_pairs(pairs, latest, columns, entity)
    metrics = {
        SNAPSHOT_HEADINGS.get(c, c): (F.col(f"home_{c}"), F.col(f"away_{c}")) for c in columns
    }
    return wide.select(
        "home_team", "away_team", _stacked(metrics, ["metric", "home_value", "away_value"])
    ).select("home_team", "away_team", "__r.*")


def head_to_head_table(
    latest: DataFrame,
    team_a: str,
    team_b: str,
    columns: Sequence[str],
    entity: str = "team_abbreviation",
) -> DataFrame:
    """Two teams side by side: one column per team, one row per metric."""
    long = (
        latest.filter(F.col(entity).isin(team_a, team_b))
        .select(entity, *[F.col(c).cast("double").alias(SNAPSHOT_HEADINGS.get(c, c)) for c in columns])
        .unpivot(entity, [f"`{SNAPSHOT_HEADINGS.get(c, c)}`" for c in columns], "metric", "value")
    )
    return long.groupBy("metric").pivot(entity, [team_a, team_b]).agg(F.max("value"))


def zone_stats(df: DataFrame, date: str = "game_date") -> DataFrame:
    """One row: rows, distinct dates, first and last date."""
    day = F.to_date(date)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(day).alias("n_dates"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
    )


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing in some is NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def distinct_games(odds: DataFrame) -> DataFrame:
    return odds.select("game_id", "home_team", "away_team").distinct()
