"""One row per game with both sides' statistics as they stood before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.schema import ROLLING_COLUMNS, conform, training_schema

from .skew import DEFAULT_POLICY, SplitPlan, SplitPolicy
from .windows import BOX_ORDER, DEFAULT_WINDOW, drop_first_event, lagged, rolling_outputs, trailing


def _sides() -> dict[str, Column]:
    return {"home": F.col("is_home"), "away": ~F.col("is_home")}


def orientation(processed: DataFrame, game: str = "game_id") -> DataFrame:
    """Home and away row counts per game, with the two teams and the label.

    One grouped pass replaces the self-join of home rows with away rows. The
    team and label columns mean something only where both counts are 1.
    """
    return processed.groupBy(game).agg(
        F.count_if("is_home").alias("n_home"),
        F.count_if(~F.col("is_home")).alias("n_away"),
        F.max(F.when(F.col("is_home"), F.col("team_abbreviation"))).alias("home_team"),
        F.max(F.when(~F.col("is_home"), F.col("team_abbreviation"))).alias("away_team"),
        F.max(F.when(F.col("is_home"), F.col("win").cast("int"))).alias("label"),
    )


def is_usable() -> Column:
    """Exactly one home row and one away row."""
    return (F.col("n_home") == 1) & (F.col("n_away") == 1)


def pair_home_away(processed: DataFrame, game: str = "game_id") -> DataFrame:
    """Usable games as ``(game, home_team, away_team, label)``; rows without a game are no game."""
    return orientation(processed, game).filter(is_usable() & F.col(game).isNotNull()).drop("n_home", "n_away")


def usable_games(processed: DataFrame, game: str = "game_id") -> DataFrame:
    """Rows of the games that have a proper home and away side."""
    ok = orientation(processed, game).filter(is_usable()).select(game)
    return processed.join(ok, game, "left_semi")


def dropped_games(processed: DataFrame, game: str = "game_id") -> DataFrame:
    """Games without exactly one row per side (neutral site or corrupt)."""
    return (
        orientation(processed, game)
        .filter(~is_usable() | F.col(game).isNull())
        .select(game, "n_home", "n_away")
    )


def dropped_sample(processed: DataFrame, game: str = "game_id", n: int = 5) -> DataFrame:
    """The first ``n`` dropped games, for the log line."""
    return dropped_games(processed, game).orderBy(game).limit(n)


def attach_lagged(games: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Join each side's lagged columns; a game without history on either side
    disappears. ``history`` carries ``lag_*`` columns per game and team, ``games``
    one row per game.

    History moves once, by game alone, and serves both sides: the away rows of a
    game are handed to its home rows where they lie. Repeated history rows pair
    up as in a join.
    """
    lags = [f"lag_{c}" for c in columns]
    known = history.select("game_id", "game_date", "season", "team_abbreviation", *lags)
    # Sides are marked before the window: a filter on the marks infers nothing about the structs.
    marks = {f"__{side}": F.col("team_abbreviation") == F.col(f"{side}_team") for side in ("home", "away")}
    met = games.join(known, "game_id").withColumns(marks).filter(F.col("__home") | F.col("__away"))
    guests = F.collect_list(F.when(F.col("__away"), F.struct(*lags))).over(Window.partitionBy("game_id"))
    rest = [c for c in games.columns if c not in ("game_id", "away_team", "home_team")]
    kept = ["game_id", "away_team", "home_team", *rest, "game_date", "season"]
    return (
        met.withColumn("__guests", guests)
        .filter("__home")
        .select(*kept, *lags, F.explode("__guests").alias("__guest"))
        .select(
            *kept,
            *[F.col(f"lag_{c}").alias(f"home_{c}") for c in columns],
            *[F.col(f"__guest.lag_{c}").alias(f"away_{c}") for c in columns],
        )
    )


def training_frame(
    features: DataFrame,
    processed: DataFrame,
    policy: SplitPolicy = DEFAULT_POLICY,
    bound_by: DataFrame | None = None,
    splits: SplitPlan | None = None,
) -> DataFrame:
    """Training matrix from a features zone and a processed zone.

    Features include the game itself, so each team's columns are lagged by one
    game before anything is joined. Missing rating columns count as NULL. A game
    without a result has no label and is left out. ``splits`` reuses the cuts the
    features were made with.
    """
    absent = [c for c in ROLLING_COLUMNS if c not in features.columns]
    features = features.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else features
    entity = ["team_id"] if "team_id" in features.columns else ["team_abbreviation"]
    history = drop_first_event(
        lagged(features, ROLLING_COLUMNS, entity, BOX_ORDER, policy=policy, splits=splits, bound_by=bound_by)
    )
    decided = pair_home_away(processed).filter(F.col("label").isNotNull())
    return conform(attach_lagged(decided, history, ROLLING_COLUMNS), training_schema())


def training_frame_from_processed(
    processed: DataFrame,
    window: int = DEFAULT_WINDOW,
    policy: SplitPolicy = DEFAULT_POLICY,
    bound_by: DataFrame | None = None,
    splits: SplitPlan | None = None,
) -> DataFrame:
    """The same matrix straight from team-game rows in two shuffles.

    A frame ending before the current row equals rolling and then lagging; the
    two sides are then folded together per game.
    """
    rolled = trailing(
        processed,
        rolling_outputs(processed.columns),
        window=window,
        include_current=False,
        policy=policy,
        splits=splits,
        bound_by=bound_by,
    )
    values = [c for c in ROLLING_COLUMNS if c in rolled.columns]
    carried = ["game_date", "season", "team_abbreviation", "win", *values]
    sides = {side: F.max(F.when(which, F.struct(*carried))).alias(side) for side, which in _sides().items()}
    paired = (
        rolled.groupBy("game_id")
        .agg(
            F.count_if("is_home").alias("n_home"),
            F.count_if(~F.col("is_home")).alias("n_away"),
            *sides.values(),
        )
        .filter(is_usable() & F.col("game_id").isNotNull())
        .filter((F.col("home.games_in_window") > 0) & (F.col("away.games_in_window") > 0))
        .filter(F.col("home.win").isNotNull())
    )
    flat = paired.select(
        "game_id",
        "home.game_date",
        "home.season",
        F.col("home.team_abbreviation").alias("home_team"),
        F.col("away.team_abbreviation").alias("away_team"),
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in sides for c in values],
        F.col("home.win").cast("int").alias("label"),
    )
    return conform(flat, training_schema())


def chronological(df: DataFrame) -> DataFrame:
    """Rows by date, then game, for a sink that shows them; a range exchange, never needed in between."""
    return df.orderBy("game_date", "game_id")
