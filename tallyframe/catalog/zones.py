"""Write paths: each query writes zones under the shared scratch folder and
returns what reading them back gives."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.scalars import rename_lower
from tallyframe.operators.models import FittedModel, Part
from tallyframe.operators.odds_history import closing_line
from tallyframe.operators.windows import rolling_features
from tallyframe.plans.jobs import Zones, features_for_day, picks_for_date, rebuild, run_daily
from tallyframe.schema import (
    DATE,
    INT,
    LONG,
    ODDS,
    PLAYER_GAME,
    PLAYER_GAME_ADVANCED,
    ROLLING,
    ROLLING_COLUMNS,
    STRING,
    TEAM_GAME,
    conform,
    table,
)
from tallyframe.session import scratch_path
from tallyframe.sources.landing import (
    attach_matchup,
    gathered_box_scores,
    land_advanced,
    land_box_scores,
    land_odds,
    parse_odds_rejects,
    read_rejects,
)
from tallyframe.sources.picks_sink import publish_picks, read_picks
from tallyframe.sources.zones import (
    GAME_PARTITIONS,
    missing_dates,
    read_csv_zone,
    read_odds_for_date,
    read_zone,
    read_zone_or_empty,
    stage_then_promote,
    write_features,
    write_processed,
    write_zone,
    zone_audit,
    zone_freshness,
    zone_has_rows,
)
from tallyframe.streaming.incremental import incremental_team_game, incremental_totals

from .base import GAMES, ODDS_SQL, customer_games, load, nearest, odds_games, rolled_sql, six, six_sql
from .market import DECIDED, PICK_COLUMNS, code_of, decided_sql, decisions, flat_picks
from .registry import query
from .rolling import DOUBLES, rolled

_PROCESSED = f"""WITH {GAMES} SELECT season, date_trunc('quarter', game_date)::DATE AS game_date, game_id::VARCHAR AS game_id, season_type, team_id::INTEGER AS team_id, team_abbreviation, opponent_abbreviation, is_home, win,
  pts, reb, ast, tov, round(effective_fg_pct, 6) AS effective_fg_pct, round(off_rating, 6) AS off_rating, pace FROM games"""
_PROCESSED_COLUMNS = [
    "season", "game_date", "game_id", "season_type", "team_id", "team_abbreviation", "opponent_abbreviation", "is_home", "win",
    "pts", "reb", "ast", "tov", "effective_fg_pct", "off_rating", "pace",
]


def _by_quarter(date: Column | str = "game_date") -> Column:
    """Dates of these queries: the tables span thousands of days of about six rows, and
    a directory for each would only measure the file system (175 s for 15,000 rows)."""
    return F.trunc(date, "quarter")


@query("write_processed", _PROCESSED)
def processed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written partitioned, a second time over itself, and read back: a replay
    changes nothing."""
    path = scratch_path(spark, "processed")
    games = customer_games(spark, sf_dir).withColumn("game_date", _by_quarter())
    for _ in range(2):
        write_processed(games, path)
    return six(read_zone(spark, path, TEAM_GAME).select(*_PROCESSED_COLUMNS), "effective_fg_pct", "off_rating")


@query("stage_then_promote", _PROCESSED)
def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through a staging zone in which an earlier attempt left rows of other
    partitions; an empty run afterwards leaves the zone intact."""
    path, staging = scratch_path(spark, "promoted"), scratch_path(spark, "staging")
    games = customer_games(spark, sf_dir).withColumn("game_date", _by_quarter())
    write_processed(games.withColumn("season", F.col("season") + 100).filter("game_id % 50 = 0"), staging)
    stage_then_promote(games, staging, path)
    write_processed(games.filter("game_id is null"), path)
    return six(read_zone(spark, path, TEAM_GAME).select(*_PROCESSED_COLUMNS), "effective_fg_pct", "off_rating")


@query(
    "write_features",
    f"WITH {GAMES}, {rolled_sql('games', 'current')} SELECT season, game_date, game_id::VARCHAR AS game_id, team_id::INTEGER AS team_id, team_abbreviation, "
    f"games_in_window::INTEGER AS games_in_window, {six_sql(DOUBLES)} FROM rolled",
)
def features_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_features(rolled(spark, sf_dir), scratch_path(spark, "features"))
    return six(read_zone(spark, path, ROLLING), *DOUBLES)


@query(
    "missing_dates",
    """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), s AS (SELECT min(day) AS lo, max(day) AS hi FROM d),
      w AS (SELECT unnest(generate_series(lo, DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS day, hi FROM s)
      SELECT w.day AS missing_date, CASE WHEN w.day > hi THEN 'tail' ELSE 'hole' END AS kind FROM w ANTI JOIN d USING (day)""",
)
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_dates(load(spark, sf_dir, "orders"), end="2001-12-31", column="o_orderdate")


@query(
    "zone_audit",
    "SELECT 'orders' AS zone, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events",
)
def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_audit({name: load(spark, sf_dir, name) for name in ("orders", "lineitem", "events")})


@query(
    "zone_freshness",
    """SELECT count(DISTINCT date_trunc('quarter', o_orderdate)) AS n_files, true AS is_fresh, (SELECT count(*) FROM orders) AS n_rows FROM orders""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File count and age of a zone just written with a file for each quarter, and its rows."""
    path = scratch_path(spark, "fresh")
    before = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=5)
    quarters = load(spark, sf_dir, "orders").withColumn("quarter", F.trunc("o_orderdate", "quarter"))
    quarters.repartition("quarter").write.partitionBy("quarter").parquet(path)
    seen = zone_freshness(spark, path).withColumn("is_fresh", F.col("newest") >= F.lit(before))
    return seen.select("n_files", "is_fresh", F.lit(spark.read.parquet(path).count()).alias("n_rows"))


@query(
    "guarded_writes",
    """WITH t(target, zone) AS (VALUES ('lake/raw/x', 'processed'), ('lake/raw/x', 'features'), ('lake/processed/x', 'features'), ('lake/raw_copy/x', 'processed'), ('lake/raw_copy/x', 'features'))
      SELECT target, zone, target NOT LIKE '%raw_copy%' AS refused, CASE WHEN target LIKE '%raw_copy%' THEN (SELECT count(*) FROM orders) ELSE 0 END AS n_rows FROM t""",
)
def guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes aimed at a zone below the one they may replace are refused and leave no
    row there; a directory that is only named alike is written."""
    games = customer_games(spark, sf_dir).withColumn("game_date", _by_quarter())
    features = rolling_features(games).select(*ROLLING.names)
    out = None
    for target, zone in [
        ("lake/raw/x", "processed"),
        ("lake/raw/x", "features"),
        ("lake/processed/x", "features"),
        ("lake/raw_copy/x", "processed"),
        ("lake/raw_copy/x", "features"),
    ]:
        path = f"{scratch_path(spark, 'guard')}/{target}"
        write, rows, schema = (write_processed, games, TEAM_GAME) if zone == "processed" else (write_features, features, ROLLING)
        try:
            write(rows, path)
            refused = False
        except ValueError:
            refused = True
        seen = read_zone_or_empty(spark, path, schema).agg(F.count(F.lit(1)).alias("n_rows"))
        one = seen.select(F.lit(target).alias("target"), F.lit(zone).alias("zone"), F.lit(refused).alias("refused"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "zone_has_rows",
    """WITH n AS (SELECT count(*) AS n FROM orders), s AS (SELECT count(*) AS n FROM orders WHERE year(o_orderdate) = 1996)
      SELECT 'written' AS zone, n > 0 AS has_rows, n AS n_rows FROM n UNION ALL SELECT 'one_season', n > 0, n FROM s
      UNION ALL SELECT 'no_rows', false, 0 UNION ALL SELECT 'never_written', false, 0""",
)
def probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with all games, with one season, with nothing left, and one that does not exist;
    loading any of them gives a frame, if need be an empty one."""
    games = customer_games(spark, sf_dir).withColumn("game_date", _by_quarter())
    kept = {"written": F.lit(True), "one_season": F.col("season") == 1996, "no_rows": F.lit(False)}
    paths = {name: scratch_path(spark, name) for name in (*kept, "never_written")}
    for name, condition in kept.items():
        write_processed(games.filter(condition), paths[name])
    out = None
    for name, path in paths.items():
        loaded = read_zone_or_empty(spark, path, TEAM_GAME).agg(F.count(F.lit(1)).alias("n_rows"))
        one = loaded.select(F.lit(name).alias("zone"), F.lit(zone_has_rows(spark, path, TEAM_GAME)).alias("has_rows"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


# ---- landing ----------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feed-shaped payloads from lineitem and orders."""
    li = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    players = li.select(
        F.col("l_orderkey").alias("GAME_ID"),
        F.col("l_suppkey").alias("TEAM_ID"),
        F.col("l_partkey").alias("PLAYER_ID"),
        F.floor("l_extendedprice").cast("double").alias("PTS"),
        F.col("l_quantity").alias("REB"),
        F.col("l_linenumber").alias("TO"),
    )
    ratings = li.select(
        F.col("l_orderkey").alias("gameId"),
        F.col("l_suppkey").alias("teamId"),
        F.col("l_partkey").alias("personId"),
        F.lit(" Part ").alias("firstName"),
        F.col("l_partkey").cast("string").alias("familyName"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(":00")).alias("minutes"),
        (F.col("l_discount") * 1000).alias("offensiveRating"),
        F.col("l_quantity").alias("pace"),
    )
    log = (
        # A line of the log repeats for each player of a team; whoever joins the log folds it.
        li.select("l_orderkey", "l_suppkey")
        .join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("l_orderkey").alias("GAME_ID"),
            F.col("l_suppkey").alias("TEAM_ID"),
            _by_quarter("o_orderdate").alias("GAME_DATE"),
            F.when(F.col("o_orderstatus") == "F", "AAA vs. BBB").otherwise("AAA @ BBB").alias("MATCHUP"),
            F.when(F.col("o_orderpriority") < "3", "W").otherwise("L").alias("WL"),
        )
    )
    return players, ratings, log


@query(
    "land_box_scores",
    """SELECT l_orderkey::VARCHAR AS game_id, date_trunc('quarter', o_orderdate)::DATE AS game_date, 2025 AS season, 'Playoffs' AS season_type, l_suppkey::INTEGER AS team_id,
      CASE WHEN o_orderstatus = 'F' THEN 'AAA vs. BBB' ELSE 'AAA @ BBB' END AS matchup, CASE WHEN o_orderpriority < '3' THEN 'W' ELSE 'L' END AS wl, l_partkey::INTEGER AS player_id,
      floor(l_extendedprice)::INTEGER AS pts, l_quantity::INTEGER AS reb, l_linenumber::INTEGER AS tov FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def landed_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    players, _, log = _payloads(spark, sf_dir)
    path = land_box_scores(players, log, scratch_path(spark, "raw-box"), "2025-26", "Playoffs")
    return read_zone(spark, path, PLAYER_GAME).select(
        "game_id", "game_date", "season", "season_type", "team_id", "matchup", "wl", "player_id", "pts", "reb", "tov"
    )


@query(
    "land_advanced",
    """SELECT l_orderkey::VARCHAR AS game_id, date_trunc('quarter', o_orderdate)::DATE AS game_date, 2025 AS season, l_suppkey::INTEGER AS team_id, l_partkey::INTEGER AS player_id,
      'Part ' || l_partkey AS player_name, l_quantity::INTEGER || ':00' AS min, round(l_discount * 1000, 6) AS off_rating, NULL::DOUBLE AS def_rating, l_quantity AS pace
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def landed_advanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings, log = _payloads(spark, sf_dir)
    path = land_advanced(ratings, log, scratch_path(spark, "raw-advanced"), "2025-26", "Playoffs")
    out = read_zone(spark, path, PLAYER_GAME_ADVANCED).select(
        "game_id", "game_date", "season", "team_id", "player_id", "player_name", "min", "off_rating", "def_rating", "pace"
    )
    return six(out, "off_rating")


def _quarterly_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds documents whose games start at noon of their quarter's first day."""
    quarter = _by_quarter(F.to_date(F.substring("commence_time", 1, 10)))
    return odds_games(spark, sf_dir).withColumn("commence_time", F.date_format(quarter, "yyyy-MM-dd'T'12:00:00'Z'"))


def _write_documents(games: DataFrame, path: str) -> str:
    """Odds documents as compressed JSON lines, in files small enough to be read side by side."""
    games.write.option("compression", "gzip").option("maxRecordsPerFile", 100_000).json(path)
    return path


@query(
    "land_odds",
    f"""WITH {ODDS_SQL} SELECT game_id, date_trunc('quarter', o_orderdate)::DATE AS game_date, home_team, away_team, sportsbook, market_type, outcome_name, price, point
      FROM odds JOIN (SELECT o_orderkey::VARCHAR AS game_id, o_orderdate FROM orders) o USING (game_id)""",
)
def landed_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files landed, flattened, written by date and read back."""
    source = _write_documents(_quarterly_odds(spark, sf_dir), scratch_path(spark, "odds-json"))
    path = land_odds(spark, source, scratch_path(spark, "odds"))
    return read_zone(spark, path, ODDS).select(
        "game_id", "game_date", "home_team", "away_team", "sportsbook", "market_type", "outcome_name", "price", "point"
    )


_FETCHES = ["1993-02-01 09:00:00", "1995-06-15 09:00:00", "1995-06-15 13:00:00", "1997-01-01 12:00:00", "2003-01-01 00:00:00"]


@query(
    "closing_line",
    f"""WITH {ODDS_SQL}, q AS (SELECT o_orderkey, o_orderkey::VARCHAR AS game_id, date_trunc('quarter', o_orderdate) + INTERVAL 12 HOUR AS start FROM orders),
      f(k, t) AS (VALUES {', '.join(f"({k}, TIMESTAMP '{t}')" for k, t in enumerate(_FETCHES))}),
      seen AS (SELECT game_id, max(k) AS k, max(t) AS t FROM q JOIN f ON t < start AND o_orderkey % (k + 2) <> 1 GROUP BY game_id)
      SELECT game_id, sportsbook, market_type, outcome_name, (price + k)::INTEGER AS price, point, t::DATE AS fetched_on FROM odds JOIN seen USING (game_id)""",
)
def closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five fetches of moving prices, two on one day, the last after every start; each lists other games."""
    path = scratch_path(spark, "odds-history")
    for k, time in enumerate(_FETCHES):
        moved = F.transform(
            "bookmakers",
            lambda b: b.withField(
                "markets",
                F.transform(
                    b["markets"],
                    lambda m: m.withField("outcomes", F.transform(m["outcomes"], lambda o: o.withField("price", o["price"] + k))),
                ),
            ),
        )
        listed = _quarterly_odds(spark, sf_dir).filter(F.col("id").cast("long") % (k + 2) != 1)
        source = _write_documents(listed.withColumn("bookmakers", moved), scratch_path(spark, "odds-json"))
        land_odds(spark, source, path, F.lit(time).cast("timestamp"))
    prices = ["game_id", "sportsbook", "market_type", "outcome_name", "price", "point", "fetched_at", "commence_time"]
    return closing_line(read_zone(spark, path, ODDS).select(*prices)).select(
        "game_id", "sportsbook", "market_type", "outcome_name", F.col("price").cast("int").alias("price"), "point",
        F.to_date("fetched_at").alias("fetched_on"),
    )


@query(
    "read_odds_for_date",
    f"""WITH {ODDS_SQL}, q AS (SELECT o_orderkey::VARCHAR AS game_id, date_trunc('quarter', o_orderdate) AS d FROM orders)
      SELECT game_id, sportsbook, outcome_name, price FROM odds JOIN q USING (game_id) WHERE d = (SELECT min(d) FROM q)""",
)
def odds_on_first_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest date of a written odds zone; only its directory is read."""
    source = _write_documents(_quarterly_odds(spark, sf_dir), scratch_path(spark, "odds-json"))
    path = land_odds(spark, source, scratch_path(spark, "odds"))
    first = read_zone(spark, path, ODDS).agg(F.min("game_date").alias("d")).first()["d"]
    return read_odds_for_date(spark, path, first).select("game_id", "sportsbook", "outcome_name", "price")


@query(
    "attach_matchup",
    """SELECT l_orderkey::VARCHAR AS game_id, l_suppkey::INTEGER AS team_id, l_partkey AS player_id, date_trunc('quarter', o_orderdate)::DATE AS game_date,
      CASE WHEN o_orderstatus = 'F' THEN 'AAA vs. BBB' ELSE 'AAA @ BBB' END AS matchup, CASE WHEN o_orderpriority < '3' THEN 'W' ELSE 'L' END AS wl
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def matchup_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player rows with what the game log knows about their team's game."""
    players, _, log = _payloads(spark, sf_dir)
    return attach_matchup(rename_lower(players), log).select(
        "game_id", "team_id", "player_id", "game_date", "matchup", "wl"
    )


@query(
    "read_csv_zone",
    """SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS game_id, o_orderdate::DATE AS game_date, year(o_orderdate)::INTEGER AS season, o_orderpriority AS season_type,
      o_custkey::INTEGER AS team_id FROM orders""",
)
def from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as CSV with a header, read with declared types: ids keep zeros."""
    path = scratch_path(spark, "csv")
    load(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderpriority").alias("season_type"),
        F.col("o_custkey").cast("int").alias("team_id"),
    ).write.option("header", True).csv(path)
    return read_csv_zone(spark, path, T.StructType(PLAYER_GAME.fields[:5]))


def _landed(spark: SparkSession, sf_dir: str) -> Zones:
    zones = Zones(scratch_path(spark, "zones"))
    players, ratings, log = _payloads(spark, sf_dir)
    land_box_scores(players, log, zones.raw, "2025-26", "Playoffs")
    land_advanced(ratings, log, zones.raw_advanced, "2025-26", "Playoffs")
    return zones


_TEAM = """team AS (SELECT l_orderkey::VARCHAR AS game_id, l_suppkey::INTEGER AS team_id, sum(floor(l_extendedprice)::BIGINT)::BIGINT AS pts, sum(l_quantity::BIGINT)::BIGINT AS reb,
    sum(l_discount * 1000 * l_quantity) / sum(l_quantity) AS off_rating, max(l_quantity) AS pace FROM lineitem GROUP BY ALL),
dated AS (SELECT team.*, date_trunc('quarter', o_orderdate)::DATE AS game_date, o_orderstatus = 'F' AS is_home, o_orderpriority < '3' AS win FROM team JOIN orders ON o_orderkey = game_id::BIGINT)"""


_FEATURES = """2025 AS season, game_id, game_date, team_id, NULL::VARCHAR AS team_abbreviation, (count(*) OVER w)::INTEGER AS games_in_window, round(avg(pts) OVER w, 6) AS rolling_pts,
      NULL::DOUBLE AS rolling_efg_pct, NULL::DOUBLE AS rolling_ts_pct, NULL::DOUBLE AS rolling_ast_to_tov, round(avg(win::INTEGER) OVER w, 6) AS rolling_win_pct,
      round(avg(CASE WHEN is_home THEN pts END) OVER w, 6) AS rolling_pts_home, round(avg(CASE WHEN NOT is_home THEN pts END) OVER w, 6) AS rolling_pts_away,
      round(avg(off_rating) OVER w, 6) AS rolling_ortg, NULL::DOUBLE AS rolling_drtg, NULL::DOUBLE AS rolling_net_rtg, round(avg(pace) OVER w, 6) AS rolling_pace"""
_BY_TEAM = "WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query("rebuild", f"WITH {_TEAM} SELECT {_FEATURES} FROM dated {_BY_TEAM}")
def rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads through raw, processed and features zones."""
    zones = _landed(spark, sf_dir)
    rebuild(spark, zones)
    return six(read_zone(spark, zones.features, ROLLING), *ROLLING_COLUMNS[1:])


@query(
    "run_daily",
    f"WITH {_TEAM}, last AS (SELECT * FROM dated WHERE game_date = (SELECT max(game_date) FROM dated)) SELECT {_FEATURES} FROM last {_BY_TEAM}",
)
def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest date through staging into processed and features; its feature rows."""
    zones = _landed(spark, sf_dir)
    newest = read_zone(spark, zones.raw, PLAYER_GAME).agg(F.max("game_date")).first()[0]
    run_daily(spark, zones, newest)
    return six(read_zone(spark, zones.features, ROLLING), *ROLLING_COLUMNS[1:])


@query(
    "incremental_features",
    f"""WITH {GAMES}, stored AS (SELECT * REPLACE (game_id::VARCHAR AS game_id) FROM games), {rolled_sql('stored', 'current')}, last AS (SELECT max(game_date) AS d FROM games)
      SELECT game_id, team_id::INTEGER AS team_id, games_in_window::INTEGER AS games_in_window, {six_sql(DOUBLES)} FROM rolled, last WHERE game_date = last.d""",
)
def newest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's features from the teams that played; equals the full rebuild, where ids
    are text: games of one day follow each other in the order of their texts."""
    games = conform(customer_games(spark, sf_dir), TEAM_GAME)
    newest = load(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    out = features_for_day(games, newest)
    return six(out.select("game_id", "team_id", "games_in_window", *DOUBLES), *DOUBLES)


@query(
    "publish_picks",
    f"""WITH {DECIDED} SELECT {PICK_COLUMNS.replace('game_date', "date_trunc('quarter', game_date)::DATE AS game_date")}, pick_side AS doc_side, home_odds AS doc_home_odds, fair_home_prob AS doc_fair, date_trunc('quarter', game_date)::DATE AS doc_folder FROM picks""",
)
def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks written as JSON text and typed rows by date, read back and put side by side."""
    docs, rows = scratch_path(spark, "picks-json"), scratch_path(spark, "picks")
    publish_picks(decisions(spark, sf_dir)[0].withColumn("game_date", _by_quarter()), docs, rows)
    parts = "pick_id string, pick_side string, market struct<home_odds_american: int, fair_home_prob: double>"
    text = spark.read.option("wholetext", False).text(docs)
    read = text.select(F.from_json("value", parts).alias("pick"), F.col("game_date").alias("doc_folder")).select(
        "pick.pick_id",
        F.col("pick.pick_side").alias("doc_side"),
        F.col("pick.market.home_odds_american").alias("doc_home_odds"),
        F.col("pick.market.fair_home_prob").alias("doc_fair"),
        "doc_folder",
    )
    return flat_picks(read_picks(spark, rows)).join(read, "pick_id", "full")

# A stored model of two inputs: fillers, centres, spreads and weights, the intercept last.
_LINE = Part(
    outer=1,
    inner=0,
    median=np.array([0.5, 120_000.0, 0.5]),
    center=np.array([0.5, 120_000.0, 0.5]),
    spread=np.array([0.25, 60_000.0, 0.25]),
    coefficients=np.array([0.3, -0.1, -0.2, 0.3]),
)
_DAY_MODEL = FittedModel(["home_rolling_win_pct", "home_rolling_pts", "away_rolling_win_pct"], [_LINE])
_DAY_PROBS = f"""{GAMES}, dated AS (SELECT * REPLACE (date_trunc('quarter', game_date)::DATE AS game_date, game_id::VARCHAR AS game_id) FROM games),
{rolled_sql('dated', 'current')}, day AS (SELECT max(game_date) AS d FROM dated),
latest AS (SELECT rolled.* FROM rolled, day WHERE game_date < d QUALIFY row_number() OVER (PARTITION BY team_abbreviation ORDER BY game_date DESC, game_id DESC) = 1),
probs AS (SELECT dated.game_id, NULL::BOOLEAN AS home_won, h.team_id IS NOT NULL AND a.team_id IS NOT NULL AS known,
    round_even(1 / (1 + exp(-((coalesce(h.rolling_win_pct, 0.5::DOUBLE) - 0.5::DOUBLE) / 0.25::DOUBLE * 0.3::DOUBLE - (coalesce(h.rolling_pts, 120000) - 120000) / 60000 * 0.1::DOUBLE
      - (coalesce(a.rolling_win_pct, 0.5::DOUBLE) - 0.5::DOUBLE) / 0.25::DOUBLE * 0.2::DOUBLE + 0.3::DOUBLE))), 4) AS p
  FROM dated JOIN day ON game_date = d JOIN orders ON o_orderkey::VARCHAR = dated.game_id LEFT JOIN latest h ON h.team_abbreviation = dated.team_abbreviation
    LEFT JOIN latest a ON a.team_abbreviation = CASE o_orderstatus WHEN 'F' THEN 'C7' WHEN 'O' THEN 'C8' END)"""


def _day_code(name: Column) -> Column:
    """The two known statuses play as customers 7 and 8."""
    return F.when(name == "Status F", "C7").when(name == "Status O", "C8").otherwise(code_of(name))


@query(
    "picks_for_date",
    f"""WITH {decided_sql(_DAY_PROBS)} SELECT {PICK_COLUMNS.replace('game_date', '(SELECT d FROM day) AS game_date')}, NULL::VARCHAR AS reject_reason FROM picks
      UNION ALL BY NAME SELECT game_id AS pick_id, (SELECT d FROM day) AS game_date, home_team_full, away_team_full, reject_reason FROM staked WHERE reject_reason IS NOT NULL""",
)
def picks_of_newest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed odds of the newest date against stored features, by a stored model: picks, and games without one.

    Teams that have not played in the season yet enter with the newest row of its tail.
    """
    zones = Zones(scratch_path(spark, "zones"))
    source = _write_documents(_quarterly_odds(spark, sf_dir), scratch_path(spark, "odds-json"))
    land_odds(spark, source, zones.odds)
    write_processed(customer_games(spark, sf_dir).withColumn("game_date", _by_quarter()), zones.processed)
    processed = read_zone(spark, zones.processed, TEAM_GAME)
    write_features(rolling_features(processed), zones.features)
    newest = processed.agg(F.max(F.struct("game_date", "season")).alias("x")).first()["x"]
    made, left = picks_for_date(
        spark, zones, newest.game_date, _DAY_MODEL, "catalog", season=newest.season, code=_day_code
    )
    named = left.withColumnRenamed("game_id", "pick_id").select(
        "pick_id", "game_date", "home_team_full", "away_team_full", "reject_reason"
    )
    return flat_picks(made).unionByName(named, allowMissingColumns=True)


# ---- rejects ----------------------------------------------------------------------


@query(
    "landing_rejects",
    "SELECT l_orderkey::VARCHAR AS game_id, l_suppkey::INTEGER AS team_id, l_partkey::INTEGER AS player_id, 2025 AS season, 'not_in_game_log' AS reject_reason FROM lineitem WHERE l_orderkey % 10 = 0",
)
def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player rows of games the log does not know, landed in two deliveries of one season."""
    players, _, log = _payloads(spark, sf_dir)
    path = scratch_path(spark, "raw-partial")
    known = log.filter("GAME_ID % 10 <> 0")
    # The second delivery is landed twice: a replay leaves one copy.
    for half in (0, 1, 1):
        land_box_scores(players.filter(F.col("GAME_ID") % 2 == half), known, path, "2025-26", "Playoffs")
    return read_rejects(spark, path, PLAYER_GAME).select("game_id", "team_id", "player_id", "season", "reject_reason")


@query(
    "odds_rejects",
    """SELECT CASE WHEN o_orderkey % 20 = 2 THEN 'no_start_time' ELSE 'no_game_id' END AS reject_reason, count(*) AS n_documents FROM orders
      WHERE o_orderkey % 20 IN (0, 2, 3) GROUP BY 1""",
)
def odds_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut short, not JSON at all, without a start time, or empty (no reject)."""
    kind = F.col("id").cast("long") % 20
    games = odds_games(spark, sf_dir).withColumn("commence_time", F.when(kind == 2, "soon").otherwise(F.col("commence_time")))
    body = F.to_json(F.struct(*games.columns))
    text = games.select(
        F.when(kind == 0, F.substring(body, 1, 9)).when(kind == 1, "[]").when(kind == 3, "[x").otherwise(body).alias("body")
    )
    return parse_odds_rejects(text, "body").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_documents"))


# ---- streaming ------------------------------------------------------------------

_EVENT_ROWS = table(
    [("event_id", LONG), ("user_id", LONG), ("event_type", STRING), ("cents", LONG), ("season", INT), ("game_date", DATE)]
)
_EVENT_TOTALS = table([("user_id", LONG), ("n_events", LONG), ("cents", LONG), ("season", INT), ("game_date", DATE)])


@query(
    "incremental_daily_totals",
    """SELECT user_id, count(*) AS n_events, sum(round(value*100)::BIGINT)::BIGINT AS cents, year(ts)::INTEGER AS season, ts::DATE AS game_date
      FROM events GROUP BY ALL""",
)
def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events landed by day in two deliveries that share every day, streamed to
    daily totals per user: late files are folded into days already written."""
    raw, out, state = (scratch_path(spark, n) for n in ("events-raw", "events-out", "events-state"))
    events = load(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        nearest(F.col("value") * 100).alias("cents"),
        F.year("ts").alias("season"),
        F.to_date("ts").alias("game_date"),
    )

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id", "season", "game_date").agg(
            F.count(F.lit(1)).alias("n_events"), F.sum("cents").alias("cents")
        )

    late = F.col("event_type").isin("error", "signup")
    for delivery in (events.filter(~late), events.filter(late)):
        conform(delivery, _EVENT_ROWS).write.mode("append").partitionBy(*GAME_PARTITIONS).parquet(raw)
        incremental_totals(spark, raw, out, state, _EVENT_ROWS, _EVENT_TOTALS, totals).awaitTermination()
    return read_zone(spark, out, _EVENT_TOTALS)



@query(
    "incremental_team_game",
    f"""WITH {_TEAM} SELECT 2025 AS season, game_id, game_date, team_id, pts, reb, round(off_rating, 6) AS off_rating, pace FROM dated""",
)
def streamed_team_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box scores in two deliveries that share days and games, ratings after them:
    what arrives late reaches rows already written."""
    raw, rated, out, state = (scratch_path(spark, n) for n in ("box-raw", "ratings-raw", "team-out", "team-state"))
    players, ratings, log = _payloads(spark, sf_dir)
    for late in (0, 1):
        box = gathered_box_scores(players.filter(F.col("PLAYER_ID") % 2 == late), log, "2025-26", "Playoffs")
        box.write.mode("append").partitionBy(*GAME_PARTITIONS).parquet(raw)
        incremental_team_game(spark, raw, out, state, rated, files_per_batch=100_000)
    land_advanced(ratings, log, rated, "2025-26", "Playoffs")
    incremental_team_game(spark, raw, out, state, rated, files_per_batch=100_000)
    return six(
        read_zone(spark, out, TEAM_GAME).select(
            "season", "game_id", "game_date", "team_id", "pts", "reb", "off_rating", "pace"
        ),
        "off_rating",
    )
