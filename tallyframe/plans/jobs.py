"""The daily run, the full rebuild, training and pick publication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.aggregate import (
    JOIN_KEYS,
    TEAM_GAME_KEYS,
    join_team_advanced,
    team_advanced,
    team_game_stats,
    with_null_columns,
)
from tallyframe.operators.decisions import (
    DEFAULT_DECISIONS,
    DecisionPolicy,
    anchor_market,
    attach_latest,
    build_picks,
    team_code,
)
from tallyframe.operators.models import FittedModel, predict
from tallyframe.operators.training import training_frame_from_processed
from tallyframe.operators.windows import DEFAULT_WINDOW, rolling_features
from tallyframe.schema import (
    PLAYER_GAME,
    PLAYER_GAME_ADVANCED,
    ROLLING,
    TEAM_GAME,
)
from tallyframe.session import cut_lineage
from tallyframe.sources.zones import (
    read_odds_for_date,
    read_zone,
    read_zone_or_empty,
    stage_then_promote,
    write_features,
    write_processed,
    write_zone,
    zone_audit,
    zone_has_rows,
)


FEW_SEASONS = 4


@dataclass(frozen=True)
class Zones:
    """Where the tables live, under any Hadoop file system root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/box_scores"

    @property
    def raw_advanced(self) -> str:
        return f"{self.root}/raw/box_scores_advanced"

    @property
    def odds(self) -> str:
        return f"{self.root}/raw/odds"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed/team_game_stats"

    @property
    def features(self) -> str:
        return f"{self.root}/features/rolling_team_stats"

    @property
    def tails(self) -> str:
        return f"{self.root}/features/team_tails"

    def staging(self, run_date: str) -> str:
        return f"{self.root}/staging/team_game_stats/run_date={run_date}"


def processed_rows(rows: DataFrame, advanced: DataFrame | None) -> DataFrame:
    """Player rows to full team-game rows, ratings included where there are any."""
    totals = team_game_stats(rows, with_leaders=True)
    if advanced is None:
        return with_null_columns(totals)
    return join_team_advanced(totals, team_advanced(advanced))


def _write_processed_rows(raw: DataFrame, advanced: DataFrame | None, path: str) -> None:
    """Write :func:`processed_rows`, totals dealt by game and team, where ratings meet them.

    Season, date, season type and code are then the same on all rows of a group; the
    write counts the groups where they are not, and is repeated by all keys if there are any.
    """
    seen = Observation()
    attributes = [c for c in TEAM_GAME_KEYS if c not in JOIN_KEYS]
    totals = team_game_stats(raw, with_leaders=True, keys=JOIN_KEYS, shared=attributes)
    plain = totals.observe(seen, F.count_if("mixed").alias("mixed")).filter("not mixed").drop("mixed")
    met = with_null_columns(plain) if advanced is None else join_team_advanced(plain, team_advanced(advanced))
    write_processed(met, path)
    if seen.get["mixed"]:
        write_processed(processed_rows(raw, advanced), path)


def _advanced(spark: SparkSession, zones: Zones) -> DataFrame | None:
    if not zone_has_rows(spark, zones.raw_advanced, PLAYER_GAME_ADVANCED):
        return None
    return read_zone(spark, zones.raw_advanced, PLAYER_GAME_ADVANCED)


def rebuild(spark: SparkSession, zones: Zones, window: int = DEFAULT_WINDOW) -> DataFrame:
    """Derive processed, features and the newest season's tail from everything landed; returns the audit."""
    raw = read_zone(spark, zones.raw, PLAYER_GAME)
    _write_processed_rows(raw, _advanced(spark, zones), zones.processed)
    processed = read_zone(spark, zones.processed, TEAM_GAME)
    # Seasons are directories. While they are few, the tasks of the windows write a file for each themselves.
    seasons = {r[0] for r in processed.select("season").distinct().collect()} - {None}
    write_features(rolling_features(processed, window), zones.features, gathered=len(seasons) <= FEW_SEASONS)
    if seasons:
        newest = max(seasons)
        earlier = processed.filter(F.col("season") < newest)
        write_zone(_before(last_games(earlier, window), newest), zones.tails, TAIL, TAIL_PARTITIONS)
    return audit(spark, zones)


def run_daily(
    spark: SparkSession, zones: Zones, day: dt.date | str, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """One landed date through staging into processed, then the features from its
    season on, and the tails that the date's teams carry into later seasons. A date
    without games changes nothing.

    Only the date's season and later ones are read, and the tail before that season:
    a team that is new there has no rows in the tail and needs none."""
    on_day = F.col("game_date") == F.lit(str(day)).cast("date")
    raw = read_zone(spark, zones.raw, PLAYER_GAME).filter(on_day)
    if not raw.isEmpty():
        advanced = _advanced(spark, zones)
        totals = processed_rows(raw, None if advanced is None else advanced.filter(on_day))
        stage_then_promote(totals, zones.staging(str(day)), zones.processed)
        season = raw.agg(F.min("season")).first()[0]
        processed = read_zone(spark, zones.processed, TEAM_GAME)
        tail = carried_in(spark, zones, season, window)
        write_features(features_since_season(processed, season, tail, window), zones.features)
        renew_tails(spark, zones, season, raw.select(F.col("team_id").cast("int")).distinct(), window)
    return audit(spark, zones)


def features_for_day(
    processed: DataFrame, day: dt.date | str, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """Rolling features of one date from the rows that can matter for it: the
    teams that played that day and their games up to it. Equal to the same rows
    of a full rebuild."""
    target = F.lit(str(day)).cast("date")
    playing = processed.filter(F.col("game_date") == target).select("team_id").distinct()
    history = processed.filter(F.col("game_date") <= target).join(playing, "team_id", "left_semi")
    return rolling_features(history, window).filter(F.col("game_date") == target)


TAIL = T.StructType([*TEAM_GAME.fields, T.StructField("before_season", T.IntegerType())])
TAIL_PARTITIONS = ("before_season",)


def last_games(rows: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """The last ``window`` games of each team. A task keeps no more of a team before the shuffle."""
    newest_first = Window.partitionBy("team_id").orderBy(F.col("game_date").desc(), F.col("game_id").desc())
    return rows.withColumn("__n", F.row_number().over(newest_first)).filter(F.col("__n") <= window).drop("__n")


def _before(tail: DataFrame, season: int) -> DataFrame:
    return tail.withColumn("before_season", F.lit(season).cast("int"))


def carried_in(spark: SparkSession, zones: Zones, season: int, window: int = DEFAULT_WINDOW) -> DataFrame:
    """The last games of each team before ``season``, from the tail zone.

    A season whose tail is not stored yet gets it from the tail before the last
    earlier season and that season's games, so a new season reads one old one. Zones
    written before there were tails are filled in this way once, season by season.
    """
    stored = read_zone_or_empty(spark, zones.tails, TAIL)
    processed = read_zone(spark, zones.processed, TEAM_GAME)
    missing = []
    at = season
    while stored.filter(F.col("before_season") == at).isEmpty():
        earlier = processed.filter(F.col("season") < at)
        if earlier.isEmpty():
            break
        last = earlier.agg(F.max("season")).first()[0]
        missing.append((at, last))
        at = last
    for at, last in reversed(missing):
        _write_tail(spark, zones, at, last, window)
    found = read_zone_or_empty(spark, zones.tails, TAIL)
    return found.filter(F.col("before_season") == season).select(*TEAM_GAME.names)


def _write_tail(spark: SparkSession, zones: Zones, season: int, last: int, window: int, teams: DataFrame | None = None) -> None:
    """Store the tail before ``season``, of some teams only or of all; ``last`` is the season before it."""
    stored = read_zone_or_empty(spark, zones.tails, TAIL)
    of_last = read_zone(spark, zones.processed, TEAM_GAME).filter(F.col("season") == last)
    older = stored.filter(F.col("before_season") == last).select(*TEAM_GAME.names)
    rows = of_last.unionByName(older)
    if teams is None:
        tail = last_games(rows, window)
    else:
        others = stored.filter(F.col("before_season") == season).join(teams, "team_id", "left_anti")
        tail = last_games(rows.join(teams, "team_id", "left_semi"), window).unionByName(others.select(*TEAM_GAME.names))
    # The partition may be read and replaced at once, so it is finished first.
    write_zone(cut_lineage(_before(tail, season)), zones.tails, TAIL, TAIL_PARTITIONS)


def renew_tails(spark: SparkSession, zones: Zones, season: int, teams: DataFrame, window: int = DEFAULT_WINDOW) -> None:
    """After games of ``season`` have changed, the stored tails of later seasons for these teams."""
    stored = read_zone_or_empty(spark, zones.tails, TAIL)
    later = sorted(r[0] for r in stored.filter(F.col("before_season") > season).select("before_season").distinct().collect())
    if not later:
        return
    processed = read_zone(spark, zones.processed, TEAM_GAME)
    for at in later:
        span = (F.col("season") >= season) & (F.col("season") < at)
        _write_tail(spark, zones, at, processed.filter(span).agg(F.max("season")).first()[0], window, teams)


def features_since_season(
    processed: DataFrame, season: int, tail: DataFrame, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """Rolling features of ``season`` and later, equal to those of a full rebuild.

    Features are stored by season, and a new or late game can change only rows
    after it. Earlier seasons are not read: ``tail`` has each team's last games
    before ``season``.
    """
    current = processed.filter(F.col("season") >= season)
    return rolling_features(current.unionByName(tail), window).filter(F.col("season") >= season)


def audit(spark: SparkSession, zones: Zones) -> DataFrame:
    return zone_audit(
        {
            "raw": read_zone_or_empty(spark, zones.raw, PLAYER_GAME),
            "processed": read_zone_or_empty(spark, zones.processed, TEAM_GAME),
            "features": read_zone_or_empty(spark, zones.features, ROLLING),
        }
    )


def training_matrix(spark: SparkSession, zones: Zones, window: int = DEFAULT_WINDOW) -> DataFrame:
    return training_frame_from_processed(read_zone(spark, zones.processed, TEAM_GAME), window)


def picks_for_date(
    spark: SparkSession,
    zones: Zones,
    day: dt.date | str,
    model: FittedModel,
    model_version: str,
    published_at: Column | None = None,
    policy: DecisionPolicy = DEFAULT_DECISIONS,
    as_of: bool = True,
    season: int | None = None,
    window: int = DEFAULT_WINDOW,
    code: Callable[[Column], Column] = team_code,
) -> tuple[DataFrame, DataFrame]:
    """``(picks, rejects)`` for all games of one date in one plan.

    ``as_of`` uses only features dated before the game; without it each team's
    newest row is taken whatever its date, which is right for games to come and
    looks ahead for games gone by. With the ``season`` of the date, features of that
    season are read and no older ones: a team that has not played in it yet enters
    with the newest row of its tail. ``code`` turns the feed's team names into the
    codes of the features, NULL for a name it does not know.
    """
    odds = read_odds_for_date(spark, zones.odds, day)
    features = read_zone(spark, zones.features, ROLLING)
    if as_of:
        # All games share the date, so what was known before it is each team's newest
        # row of earlier dates. A season is named by the year it starts in.
        target = F.lit(str(day)).cast("date")
        if season is None:
            features = features.filter((F.col("season") <= F.year(target)) & (F.col("game_date") < target))
        else:
            entering = rolling_features(carried_in(spark, zones, season, window), window)
            own = features.filter((F.col("season") == season) & (F.col("game_date") < target))
            features = own.unionByName(last_games(entering, 1).select(*own.columns))
    codes = [code(F.col(c)) for c in ("outcome_name", "home_team", "away_team")]
    games = attach_latest(anchor_market(odds, policy.anchor, *codes), features)
    scored = predict(model, games, "model_prob_home_win").withColumn(
        "model_prob_home_win", F.bround("model_prob_home_win", 4)
    )
    return build_picks(scored, model_version, published_at, policy)

