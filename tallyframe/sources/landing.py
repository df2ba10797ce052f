"""Landed feed payloads to raw zones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.scalars import (
    coerce_numeric,
    full_name,
    rename_by_map,
    rename_lower,
    season_start_year,
    wall_clock,
)
from tallyframe.schema import ODDS, PLAYER_GAME, PLAYER_GAME_ADVANCED, conform

from .zones import DATE_PARTITIONS, GAME_PARTITIONS, ODDS_PARTITIONS, ODDS_SNAPSHOTS, RECORDS_PER_FILE, by_partition, read_zone_or_empty, write_zone

LEAGUE_ZONE = "US/Eastern"
SNAPSHOT = "'s'yyyyMMdd'T'HHmmssSSS"

# Shape of the odds payload.
ODDS_PAYLOAD = T.ArrayType(
    T.StructType()
    .add("id", "string")
    .add("commence_time", "string")
    .add("home_team", "string")
    .add("away_team", "string")
    .add(
        "bookmakers",
        T.ArrayType(
            T.StructType()
            .add("key", "string")
            .add(
                "markets",
                T.ArrayType(
                    T.StructType()
                    .add("key", "string")
                    .add(
                        "outcomes",
                        T.ArrayType(
                            T.StructType()
                            .add("name", "string")
                            .add("price", "double")
                            .add("point", "double")
                        ),
                    )
                ),
            )
        ),
    )
)
ODDS_GAME = ODDS_PAYLOAD.elementType


def stamp(df: DataFrame, **values: Column) -> DataFrame:
    """Set run columns such as season and season type."""
    return df.withColumns(values)


def attach_matchup(rows: DataFrame, game_log: DataFrame) -> DataFrame:
    """Player rows with their team's ``matchup``, ``wl`` and the game's date.

    The log has one row per team and game; repeated rows are folded first, so
    the join cannot multiply player rows.
    """
    return _matched(rows, game_log).withColumn("game_id", F.col("game_id").cast("string"))


def _matched(rows: DataFrame, game_log: DataFrame) -> DataFrame:
    """As :func:`attach_matchup`; whole-number ids that both sides have in one type meet, and
    move on, as numbers, which are narrower than their texts.

    Both sides are dealt by game alone, and teams are told apart there: rows of a game stay side
    by side, where what they share compresses away, and a log that lies by game does not move.
    """
    log = rename_lower(game_log)
    kinds = {df.schema["game_id"].dataType for df in (rows, log)}
    numbers = len(kinds) == 1 and isinstance(next(iter(kinds)), T.IntegralType)
    game = F.col("game_id") if numbers else F.col("game_id").cast("string")
    sides = log.groupBy(game.alias("__game"), coerce_numeric("team_id", "int").alias("__team")).agg(
        F.max("matchup").alias("matchup"),
        F.max("wl").alias("wl"),
        F.max(F.to_date("game_date")).alias("game_date"),
    )
    bare = rows.drop("matchup", "wl", "game_date")
    keyed = bare.withColumns(
        {"game_id": game, "team_id": coerce_numeric("team_id", "int")}
    )
    # Written as two bounds, so that the team is no key of the join.
    same_team = (F.col("team_id") >= F.col("__team")) & (F.col("team_id") <= F.col("__team"))
    met = keyed.join(sides, (F.col("game_id") == F.col("__game")) & same_team, "left")
    rest = [c for c in keyed.columns if c not in ("game_id", "team_id")]
    return met.select("game_id", "team_id", *rest, "matchup", "wl", "game_date")


def _typed(rows: DataFrame, schema: T.StructType, kinds: dict[type, str]) -> DataFrame:
    """The columns of ``schema`` that a feed has, numbers as declared."""
    found = [f for f in schema.fields if f.name in rows.columns]
    return rows.select(
        *[
            coerce_numeric(f.name, kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else F.col(f.name)
            for f in found
        ]
    )


def box_score_rows(payload: DataFrame, game_log: DataFrame) -> DataFrame:
    """Upper-case player payload as typed rows, without the columns the feed does not fill;
    whole-number game ids become text when rows are declared."""
    return _typed(_matched(rename_lower(payload), game_log), PLAYER_GAME, {T.IntegerType: "int"})


def advanced_rows(payload: DataFrame, game_log: DataFrame) -> DataFrame:
    """Camel-case ratings payload as typed rows, as :func:`box_score_rows`; the date comes from the log."""
    named = payload.withColumn("player_name", full_name("firstName", "familyName"))
    renamed = rename_by_map(named).withColumnsRenamed({"gameId": "game_id"})
    kinds = {T.IntegerType: "int", T.DoubleType: "double"}
    return _typed(_matched(renamed, game_log), PLAYER_GAME_ADVANCED, kinds)


def declare(rows: DataFrame, schema: T.StructType, season: str, season_type: str) -> DataFrame:
    """Typed rows with the run's season and every declared column."""
    return conform(stamp(rows, season=season_start_year(F.lit(season)), season_type=F.lit(season_type)), schema)


def gathered_box_scores(payload: DataFrame, game_log: DataFrame, season: str, season_type: str) -> DataFrame:
    """As :func:`normalize_box_scores`, brought together by date. Only what the feed fills
    is moved; the run's constants and missing columns are added after the shuffle."""
    moved = by_partition(box_score_rows(payload, game_log), DATE_PARTITIONS)
    return declare(moved, PLAYER_GAME, season, season_type)


def normalize_box_scores(
    payload: DataFrame, game_log: DataFrame, season: str, season_type: str
) -> DataFrame:
    """Upper-case player payload to declared player-game rows."""
    return declare(box_score_rows(payload, game_log), PLAYER_GAME, season, season_type)


def normalize_advanced(
    payload: DataFrame, game_log: DataFrame, season: str, season_type: str
) -> DataFrame:
    """Camel-case ratings payload to declared rows; the date comes from the log."""
    return declare(advanced_rows(payload, game_log), PLAYER_GAME_ADVANCED, season, season_type)


def game_reject_reason(day: dt.date | str | None = None) -> Column:
    """Why a player row cannot be landed: its game has no date, or another than ``day``; NULL when it can."""
    reason = F.when(F.col("game_date").isNull(), "not_in_game_log")
    return reason if day is None else reason.when(F.col("game_date") != F.lit(str(day)).cast("date"), "other_date")


REJECT_FIELDS = [
    T.StructField("reject_reason", T.StringType()),
    T.StructField("reject_key", T.StringType()),
    T.StructField("copies", T.LongType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("landed_on", T.DateType()),
]
DOCUMENT = T.StructType([T.StructField("document", T.StringType())])


def reject_schema(rows: T.StructType) -> T.StructType:
    """Columns of a rejects zone for rows of a feed."""
    return T.StructType([*rows.fields, *REJECT_FIELDS])


def read_rejects(spark: SparkSession, path: str, rows: T.StructType = DOCUMENT) -> DataFrame:
    """The rejects of a zone; none where nothing was ever rejected."""
    return read_zone_or_empty(spark, rejects_path(path), reject_schema(rows))


def write_rejects(rejects: DataFrame, path: str, rows: T.StructType, delivery: str = "") -> str:
    """Add rejects to their own zone under the time they were first landed.

    ``rejects`` has the columns of ``rows`` and ``reject_reason``. A reject is known by
    a hash of the delivery, the reason and its content: landed again it adds nothing,
    and rows that repeat inside a delivery are one row with their number in ``copies``.
    None is ever replaced.
    """
    content = F.sha2(F.concat_ws("\n", F.lit(delivery), "reject_reason", F.to_json(F.struct(*rows.names))), 256)
    landed = F.current_timestamp()
    firsts = [F.any_value(c).alias(c) for c in (*rows.names, "reject_reason")]
    keyed = rejects.withColumn("reject_key", content).groupBy("reject_key").agg(*firsts, F.count(F.lit(1)).alias("copies"))
    known = read_zone_or_empty(rejects.sparkSession, path, reject_schema(rows)).select("reject_key")
    fresh = keyed.join(known, "reject_key", "left_anti").withColumns({"landed_at": landed, "landed_on": F.to_date(landed)})
    (
        by_partition(fresh.select(*reject_schema(rows).names), ("landed_on",))
        .write.mode("append")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("landed_on")
        .parquet(path)
    )
    return path


def rejects_path(path: str) -> str:
    """Where the rejects of a zone go unless told otherwise."""
    return f"{path.rstrip('/')}_rejects"


def land(
    judged: DataFrame,
    path: str,
    schema: T.StructType,
    partitions: tuple[str, ...],
    to_rows: Callable[[DataFrame], DataFrame],
    to_rejects: Callable[[DataFrame], DataFrame],
    reject_rows: T.StructType,
    rejects: str | None = None,
    delivery: str = "",
    gathered: bool = False,
) -> str:
    """Write the rows of ``judged`` without a ``reject_reason``, then those with one to the rejects zone.

    The write itself counts the rejects, so the payload is read once, and a second
    time for its rejects only if there are any. Both writes may be repeated. With
    ``gathered`` the result of ``to_rows`` has been brought together by partition already.
    """
    seen = Observation()
    watched = judged.observe(seen, F.count("reject_reason").alias("rejected"))
    write_zone(to_rows(watched.filter("reject_reason is null")), path, schema, partitions, gathered=gathered)
    if seen.get["rejected"]:
        bad = to_rejects(judged.filter("reject_reason is not null"))
        write_rejects(bad, rejects or rejects_path(path), reject_rows, delivery)
    return path


def land_box_scores(
    payload: DataFrame,
    game_log: DataFrame,
    path: str,
    season: str,
    season_type: str,
    day: dt.date | str | None = None,
    rejects: str | None = None,
    delivery: str = "",
) -> str:
    """Normalise and write player rows: one date when ``day`` is given, else every
    date of the payload. Both replace exactly the dates they hold. Rows of games the
    log does not know, and with ``day`` those of other dates, go to the rejects zone."""
    rows = box_score_rows(payload, game_log)
    return _land_games(rows, path, PLAYER_GAME, season, season_type, day, rejects, delivery)


def land_advanced(
    payload: DataFrame,
    game_log: DataFrame,
    path: str,
    season: str,
    season_type: str,
    day: dt.date | str | None = None,
    rejects: str | None = None,
    delivery: str = "",
) -> str:
    """As :func:`land_box_scores` for the ratings feed."""
    rows = advanced_rows(payload, game_log)
    return _land_games(rows, path, PLAYER_GAME_ADVANCED, season, season_type, day, rejects, delivery)


def _land_games(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    season: str,
    season_type: str,
    day: dt.date | str | None,
    rejects: str | None,
    delivery: str,
) -> str:
    judged = rows.withColumn("reject_reason", game_reject_reason(day))
    rejected = T.StructType([*schema.fields, REJECT_FIELDS[0]])

    def good(df: DataFrame) -> DataFrame:
        # A landing has one season: its rows move narrow and by date, and are declared after the shuffle.
        return declare(by_partition(df.drop("reject_reason"), DATE_PARTITIONS), schema, season, season_type)

    def bad(df: DataFrame) -> DataFrame:
        return declare(df, rejected, season, season_type)

    return land(judged, path, schema, GAME_PARTITIONS, good, bad, schema, rejects, delivery, gathered=True)


def stored_games(games: DataFrame) -> DataFrame:
    """Game structs with their stored columns, one row each, books still nested.

    The game date is the league's local date of the UTC start.
    """
    start = F.try_to_timestamp("commence_time")
    return games.select(
        F.col("id").alias("game_id"),
        F.to_date(wall_clock(start, LEAGUE_ZONE)).alias("game_date"),
        start.alias("commence_time"),
        "home_team",
        "away_team",
        "bookmakers",
    )


def inline_books(games: DataFrame, fetched_at: Column) -> DataFrame:
    """Rows of :func:`stored_games` to one row per book, market and outcome.

    The leaves are gathered inside the generator: named below it, Catalyst would infer
    filters on them and gather three times. A game without books gives no rows.
    """

    def market_leaves(book: Column, market: Column) -> Column:
        return F.transform(
            F.coalesce(market["outcomes"], F.array()),
            lambda o: F.struct(
                book["key"].alias("sportsbook"),
                market["key"].alias("market_type"),
                o["name"].alias("outcome_name"),
                o["price"].alias("price"),
                o["point"].alias("point"),
            ),
        )

    def book_leaves(book: Column) -> Column:
        return F.flatten(F.transform(F.coalesce(book["markets"], F.array()), lambda m: market_leaves(book, m)))

    outer = [c for c in games.columns if c != "bookmakers"]
    leaves = games.select(*outer, F.inline(F.flatten(F.transform("bookmakers", book_leaves))))
    return conform(leaves.withColumn("fetched_at", fetched_at), ODDS)


def flatten_odds(games: DataFrame, fetched_at: Column) -> DataFrame:
    """Game structs to one row per book, market and outcome; a game's own columns are
    computed once, below the generator."""
    return inline_books(stored_games(games), fetched_at)


def outcome_rows(games: DataFrame, fetched_at: Column) -> DataFrame:
    """The rows of :func:`flatten_odds` by one compiled generator a level, for games that are not written
    but read on at once; no lambda is interpreted for each price.

    The first generator is outer, so that Catalyst infers no filter on the books and
    computes them once. A game without books gives no rows.
    """
    stored = stored_games(games)
    outer = [c for c in stored.columns if c != "bookmakers"]
    books = stored.select(*outer, F.explode_outer("bookmakers").alias("__book"))
    markets = books.select(*outer, F.col("__book.key").alias("sportsbook"), F.explode("__book.markets").alias("__market"))
    outcomes = markets.select(
        *outer, "sportsbook", F.col("__market.key").alias("market_type"), F.explode("__market.outcomes").alias("__outcome")
    )
    leaves = outcomes.select(
        *outer,
        "sportsbook",
        "market_type",
        F.col("__outcome.name").alias("outcome_name"),
        F.col("__outcome.price").alias("price"),
        F.col("__outcome.point").alias("point"),
    )
    return conform(leaves.withColumn("fetched_at", fetched_at), ODDS)


def odds_reject_reason() -> Column:
    """Why a parsed game cannot be stored; NULL when it can."""
    return (
        F.when(F.col("id").isNull(), "no_game_id")
        .when(F.try_to_timestamp("commence_time").isNull(), "no_start_time")
    )


def _parsed(payload: DataFrame, text: str) -> DataFrame:
    """Games of a JSON text column, an unreadable document as one game of NULLs, with the text."""
    return payload.select(
        F.col(text).alias("document"),
        F.when(F.ltrim(text).startswith("["), F.from_json(text, ODDS_PAYLOAD))
        .otherwise(F.array(F.from_json(text, ODDS_GAME)))
        .alias("games"),
    )


def parse_odds(payload: DataFrame, text: str, fetched_at: Column) -> DataFrame:
    """JSON text column (array of games, or one game) to long odds rows.

    The outer generator keeps Catalyst from inferring a filter on the parsed
    array, which would parse every document twice; a document without games
    falls out when the books are inlined. See :func:`parse_odds_rejects` for games
    that cannot be stored.
    """
    games = _parsed(payload, text).select(F.inline_outer("games"))
    return flatten_odds(games.filter(odds_reject_reason().isNull()), fetched_at)


def parse_odds_rejects(payload: DataFrame, text: str) -> DataFrame:
    """``(document, reject_reason)`` of documents, or games in them, that :func:`parse_odds` leaves out.

    An empty array holds no game and is no reject.
    """
    parsed = _parsed(payload, text).filter(F.coalesce(F.size("games"), F.lit(1)) != 0)
    games = parsed.select("document", F.inline_outer("games"))
    return (
        games.withColumn("reject_reason", odds_reject_reason())
        .filter("reject_reason is not null")
        .select("document", "reject_reason")
    )


def land_odds(
    spark: SparkSession,
    source: str,
    path: str,
    fetched_at: Column | None = None,
    multi_line: bool = False,
    rejects: str | None = None,
    delivery: str = "",
) -> str:
    """Landed odds JSON files to the odds zone, every row stamped with one fetch
    time. Snapshots lie side by side under their date: a fetch replaces only what was
    landed with the same fetch time, so a later one with fewer games removes none.
    Lines that do not parse, and games without an id or a start time, go to the
    rejects zone.

    A line holds one game or an array of games; ``multi_line`` is for responses
    stored with line breaks inside, one response per file.
    """
    broken = "unparsed_line"
    games = (
        spark.read.option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", broken)
        .schema(T.StructType([*ODDS_GAME.fields, T.StructField(broken, T.StringType())]))
        .json(source)
        .withColumn("reject_reason", F.when(F.col(broken).isNotNull(), "not_json").otherwise(odds_reject_reason()))
    )
    document = F.coalesce(F.col(broken), F.to_json(F.struct(*ODDS_GAME.names)))
    stamp_time = F.current_timestamp() if fetched_at is None else fetched_at

    def rows(good: DataFrame) -> DataFrame:
        # All rows of a game share its date and fetch: it moves as one row and is inlined after the shuffle.
        moved = by_partition(stored_games(good), DATE_PARTITIONS)
        return inline_books(moved, stamp_time).withColumn("snapshot", F.date_format("fetched_at", SNAPSHOT))

    return land(
        games,
        path,
        ODDS_SNAPSHOTS,
        ODDS_PARTITIONS,
        rows,
        lambda bad: bad.select(document.alias("document"), "reject_reason"),
        DOCUMENT,
        rejects,
        delivery,
        gathered=True,
    )
