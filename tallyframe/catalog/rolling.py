"""Windows, latest rows and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.season_axis import season_deltas
from tallyframe.operators.windows import (
    asof_join,
    drop_first_event,
    lagged,
    latest_per_entity,
    rolling_outputs,
    trailing,
)
from tallyframe.schema import ROLLING_COLUMNS

from .base import GAMES, SIDED, WINDOW, customer_bound, customer_games, load, nearest, rolled_sql, sided_bound, sided_games, six, six_sql
from .registry import query

IDS = ["season", "game_date", "game_id", "team_id", "team_abbreviation"]
DOUBLES = ROLLING_COLUMNS[1:]
_IDS_SQL = ", ".join(IDS)


def rolled(spark: SparkSession, sf_dir: str, include_current: bool = True) -> DataFrame:
    games = customer_games(spark, sf_dir)
    out = trailing(
        games,
        rolling_outputs(games.columns),
        window=WINDOW,
        include_current=include_current,
        bound_by=customer_bound(spark, sf_dir),
    )
    return out.select(*IDS, "is_home", "win", *ROLLING_COLUMNS)


@query(
    "rolling_features",
    f"WITH {GAMES}, {rolled_sql('games', 'current')} SELECT {_IDS_SQL}, games_in_window, {six_sql(DOUBLES)} FROM rolled",
)
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: all twelve rolling statistics in one shuffle by entity."""
    return six(rolled(spark, sf_dir).select(*IDS, *ROLLING_COLUMNS), *DOUBLES)


_ORDER_WINDOW = (
    f"WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)"
)


def _orders_rolled(spark, sf_dir, outputs, *columns) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    out = trailing(orders, outputs, ["o_custkey"], ["o_orderdate", "o_orderkey"], WINDOW)
    return out.select("o_orderkey", "o_custkey", *columns)


@query(
    "rolling_avg",
    f"SELECT o_orderkey, o_custkey, round(avg(round(o_totalprice*100)::BIGINT) OVER w, 6) AS rolling_cents FROM orders {_ORDER_WINDOW}",
)
def rolling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = nearest(F.col("o_totalprice") * 100)
    out = _orders_rolled(spark, sf_dir, {"rolling_cents": F.avg(cents)}, "rolling_cents")
    return six(out, "rolling_cents")


@query(
    "rolling_count",
    f"SELECT o_orderkey, o_custkey, (count(o_orderkey) OVER w)::INTEGER AS games_in_window FROM orders {_ORDER_WINDOW}",
)
def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _orders_rolled(spark, sf_dir, {"games_in_window": F.count("o_orderkey")}, "games_in_window")
    return out.withColumn("games_in_window", F.col("games_in_window").cast("int"))


@query(
    "rolling_conditional",
    f"""SELECT o_orderkey, o_custkey, round(avg(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice*100)::BIGINT END) OVER w, 6) AS cents_home,
      round(avg(CASE WHEN o_orderstatus = 'O' THEN round(o_totalprice*100)::BIGINT END) OVER w, 6) AS cents_away FROM orders {_ORDER_WINDOW}""",
)
def rolling_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = nearest(F.col("o_totalprice") * 100)
    outputs = {
        "cents_home": F.avg(F.when(F.col("o_orderstatus") == "F", cents)),
        "cents_away": F.avg(F.when(F.col("o_orderstatus") == "O", cents)),
    }
    return six(_orders_rolled(spark, sf_dir, outputs, *outputs), *outputs)


@query(
    "rolling_win_pct",
    f"""SELECT o_orderkey, o_custkey, round(avg(CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 1 WHEN substr(o_orderpriority, 1, 1) = '5' THEN 0 END) OVER w, 6)
      AS win_pct FROM orders {_ORDER_WINDOW}""",
)
def rolling_win_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    won = F.when(priority.isin("1", "2"), 1).when(priority == "5", 0)
    return six(_orders_rolled(spark, sf_dir, {"win_pct": F.avg(won)}, "win_pct"), "win_pct")


@query(
    "player_trailing_events",
    """SELECT event_id, user_id, round(avg(round(value*100)::BIGINT) OVER w, 6) AS rolling_cents, count(*) OVER w AS n FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def events_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over another entity/event table."""
    events = load(spark, sf_dir, "events")
    outputs = {
        "rolling_cents": F.avg(nearest(F.col("value") * 100)),
        "n": F.count(F.lit(1)),
    }
    out = trailing(events, outputs, ["user_id"], ["ts", "event_id"], WINDOW)
    return six(out.select("event_id", "user_id", *outputs), "rolling_cents")


_LAGGED = ["games_in_window", "rolling_pts", "rolling_win_pct"]
_LAG_SQL = ", ".join(f"lag({c}) OVER e AS lag_{c}" for c in _LAGGED)


@query(
    "lag_features",
    f"""WITH {GAMES}, {rolled_sql('games', 'current')}, l AS (SELECT {_IDS_SQL}, {_LAG_SQL} FROM rolled WINDOW e AS (PARTITION BY team_id ORDER BY game_date, game_id))
      SELECT {_IDS_SQL}, lag_games_in_window, round(lag_rolling_pts, 6) AS lag_rolling_pts, round(lag_rolling_win_pct, 6) AS lag_rolling_win_pct FROM l""",
)
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling, then one event back: same shuffle, a second window on top."""
    out = lagged(rolled(spark, sf_dir), _LAGGED, bound_by=customer_bound(spark, sf_dir))
    return six(out.select(*IDS, *[f"lag_{c}" for c in _LAGGED]), "lag_rolling_pts", "lag_rolling_win_pct")


@query(
    "prior_frame",
    f"WITH {GAMES}, {rolled_sql('games', 'prior')} SELECT {_IDS_SQL}, games_in_window, {six_sql(DOUBLES)} FROM rolled",
)
def prior_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known entering the event, in a single window."""
    return six(rolled(spark, sf_dir, include_current=False).select(*IDS, *ROLLING_COLUMNS), *DOUBLES)


@query(
    "drop_first_event",
    f"""WITH {GAMES}, n AS (SELECT game_id, team_id, row_number() OVER (PARTITION BY team_id ORDER BY game_date, game_id) AS rn FROM games)
      SELECT game_id, team_id FROM n WHERE rn > 1""",
)
def without_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = customer_games(spark, sf_dir).select("game_id", "team_id", "game_date").withColumn("games_in_window", F.lit(1))
    history = lagged(games, ["games_in_window"], bound_by=customer_bound(spark, sf_dir))
    return drop_first_event(history).select("game_id", "team_id")


@query(
    "latest_per_entity",
    f"""WITH {GAMES}, {rolled_sql('games', 'current')}, r AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY game_date DESC, game_id DESC) AS rn FROM rolled)
      SELECT {_IDS_SQL}, games_in_window, {six_sql(DOUBLES)} FROM r WHERE rn = 1""",
)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rolled(spark, sf_dir).select(*IDS, *ROLLING_COLUMNS)
    return six(latest_per_entity(rows), *DOUBLES)


_ASOF = ["game_date", "games_in_window", "rolling_pts", "rolling_win_pct"]


@query(
    "asof_features",
    f"""WITH {SIDED}, {rolled_sql('sided', 'current')},
      main AS (SELECT l_orderkey, arg_max(l_suppkey, (l_extendedprice, l_suppkey)) AS s FROM lineitem GROUP BY 1),
      games0 AS (SELECT o_orderkey AS event_key, o_orderdate::DATE AS event_date, 'S' || s AS away FROM orders LEFT JOIN main ON l_orderkey = o_orderkey),
      f AS (SELECT team_abbreviation, game_date, arg_max(struct_pack(g := games_in_window, p := rolling_pts, w := rolling_win_pct), game_id) AS v
            FROM rolled GROUP BY ALL)
      SELECT event_key, event_date, away, f.game_date AS away_game_date, v.g AS away_games_in_window,
        round(v.p, 6) AS away_rolling_pts, round(v.w, 6) AS away_rolling_win_pct
      FROM games0 ASOF LEFT JOIN f ON games0.away = f.team_abbreviation AND games0.event_date > f.game_date""",
)
def asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its main supplier's newest features dated before it."""
    games = sided_games(spark, sf_dir)
    bound = sided_bound(spark, sf_dir)
    features = trailing(games, rolling_outputs(games.columns), window=WINDOW, bound_by=bound)
    away = games.filter((F.col("team_id") < 0)).select("game_id", F.col("team_abbreviation").alias("away"))
    events = (
        load(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("event_key"), F.to_date("o_orderdate").alias("event_date"))
        .join(away.withColumnRenamed("game_id", "event_key"), "event_key", "left")
    )
    out = asof_join(
        events,
        features,
        entity="team_abbreviation",
        left_entity="away",
        left_time="event_date",
        right_order=["game_date", "game_id"],
        values=_ASOF,
        prefix="away_",
        # One row per order on either side, so twice the lines covers both.
        bound_by=bound.unionByName(bound).select(
            F.concat(F.lit("S"), (-F.col("team_id") - 1).cast("string")).alias("team_abbreviation")
        ),
    )
    return six(out, "away_rolling_pts", "away_rolling_win_pct")


# A short season, three weeks without games in another, and one season missing.
_PLAYED = "season <> 1993 AND NOT (season = 1995 AND game_date > DATE '1995-06-10') AND NOT (season = 1996 AND game_date BETWEEN DATE '1996-03-04' AND DATE '1996-03-24')"


@query(
    "season_delta",
    f"""WITH {GAMES}, played AS (SELECT season, game_date::DATE AS day, is_home, pts, win FROM games WHERE {_PLAYED}),
      firsts AS (SELECT season, min(day) AS first FROM played GROUP BY season),
      weekly AS (SELECT is_home, season, ((day - first) // 7)::INTEGER AS season_week, count(*) AS n_games, avg(pts) AS avg_pts FROM played JOIN firsts USING (season) GROUP BY ALL),
      before AS (SELECT is_home, (season + 1)::INTEGER AS season, season_week, n_games AS prev_n_games, avg_pts AS prev_avg_pts FROM weekly)
      SELECT is_home, season, season_week, n_games, prev_n_games, n_games - prev_n_games AS delta_n_games,
        round(avg_pts, 6) AS avg_pts, round(prev_avg_pts, 6) AS prev_avg_pts, round(avg_pts - prev_avg_pts, 6) AS delta_avg_pts
      FROM weekly FULL JOIN before USING (is_home, season, season_week) WHERE season IN (SELECT season FROM played)""",
)
def seasons_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games and points of each week beside the same week of the season before."""
    games = customer_games(spark, sf_dir).withColumn("game_date", F.to_date("game_date")).filter(_PLAYED)
    out = season_deltas(games, {"n_games": F.count(F.lit(1)), "avg_pts": F.avg("pts")}, ["is_home"])
    return six(out, "avg_pts", "prev_avg_pts", "delta_avg_pts")
