import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.catalog import QUERIES, SQL
from tallyframe.functions.scalars import iso_utc
from tallyframe.operators.odds_history import closing_line, current_prices
from tallyframe.operators.windows import rolling_features
from tallyframe.plans.jobs import Zones, audit, carried_in, features_since_season, last_games, rebuild, renew_tails, run_daily, training_matrix
from tallyframe.schema import ODDS, PLAYER_GAME, PLAYER_GAME_ADVANCED, ROLLING, ROLLING_COLUMNS, TEAM_GAME, conform
from tallyframe.sources import landing as L
from tallyframe.sources import zones as Z
from tallyframe.sources.landing import land_box_scores, land_odds, rejects_path
from tallyframe.streaming.incremental import incremental_team_game, touched_partitions

from .conftest import day, exchanges, rows


def team_rows(spark, dates, pts=100):
    data = [(2025, d, f"g{d}{t}", "Playoffs", t, f"T{t}", pts + t) for d in dates for t in (1, 2)]
    df = spark.createDataFrame(data, "season int, game_date string, game_id string, season_type string, team_id int, team_abbreviation string, pts long")
    return conform(df.withColumn("game_date", F.to_date("game_date")), TEAM_GAME)


def test_replay_backfill_and_empty_day(spark, tmp_path):
    path = str(tmp_path / "processed/team")
    Z.write_processed(team_rows(spark, ["2026-05-01", "2026-05-02"]), path)
    Z.write_processed(team_rows(spark, ["2026-05-02"], 200), path)
    got = rows(Z.read_zone(spark, path, TEAM_GAME), "game_date", "team_id", "pts")
    assert got == [(day("2026-05-01"), 1, 101), (day("2026-05-01"), 2, 102), (day("2026-05-02"), 1, 201), (day("2026-05-02"), 2, 202)]
    Z.write_processed(team_rows(spark, ["2026-05-02"]).filter("false"), path)
    assert rows(Z.read_zone(spark, path, TEAM_GAME), "game_date", "team_id", "pts") == got
    Z.write_processed(team_rows(spark, ["2026-04-01"]), path)
    assert Z.read_zone(spark, path, TEAM_GAME).count() == 6


def test_first_run_without_rows_reads_as_empty(spark, tmp_path):
    path = str(tmp_path / "processed/none")
    Z.write_processed(team_rows(spark, ["2026-05-02"]).filter("false"), path)
    assert Z.read_zone_or_empty(spark, path, TEAM_GAME).columns == TEAM_GAME.names
    assert not Z.zone_has_rows(spark, path, TEAM_GAME)
    assert not Z.zone_has_rows(spark, str(tmp_path / "missing"), TEAM_GAME)


def test_path_guards(spark, tmp_path):
    df = team_rows(spark, ["2026-05-01"])
    with pytest.raises(ValueError):
        Z.write_processed(df, f"{tmp_path}/raw/x")
    for bad in ("raw", "processed"):
        with pytest.raises(ValueError):
            Z.write_features(df, f"{tmp_path}/{bad}/x")
    Z.write_processed(df, f"{tmp_path}/rawish/x")


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "odds")
    text = spark.createDataFrame([(json.dumps(payload()),)], "body string")
    odds = L.parse_odds(text, "body", F.lit("2026-06-03 20:30:00").cast("timestamp"))
    Z.write_zone(odds, path, ODDS, Z.DATE_PARTITIONS)
    one = Z.read_odds_for_date(spark, path, "2026-06-03")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(game_date" in plan
    assert one.count() == 18 and {r.game_id for r in one.collect()} == {"a"}


def test_missing_dates(spark):
    df = spark.createDataFrame([("2026-05-01",), ("2026-05-02",), ("2026-05-05",)], "game_date string")
    got = rows(Z.missing_dates(df, end="2026-05-07"))
    assert got == [(day("2026-05-03"), "hole"), (day("2026-05-04"), "hole"), (day("2026-05-06"), "tail"), (day("2026-05-07"), "tail")]
    assert Z.missing_dates(df, end="2026-05-07", interior=False).count() == 2
    assert Z.missing_dates(df, end="2026-05-05", interior=False).isEmpty()
    cold = Z.missing_dates(df.filter("false"), end="2026-04-20", cold_start="2026-04-18")
    assert rows(cold) == [(dt.date(2026, 4, d), "tail") for d in (18, 19, 20)]


# ---- landing ----------------------------------------------------------------------


def outcome(name, price, point=None):
    return {"name": name, "price": price, **({"point": point} if point is not None else {})}


def payload():
    home, away = "Oklahoma City Thunder", "Indiana Pacers"

    def book(key, full):
        markets = [{"key": "h2h", "outcomes": [outcome(home, -260), outcome(away, 215)]}]
        if full:
            markets.append({"key": "spreads", "outcomes": [outcome(home, -108, -6.5), outcome(away, -102, 6.5)]})
            markets.append({"key": "totals", "outcomes": [outcome("Over", -110, 222.5), outcome("Under", -110, 222.5)]})
        return {"key": key, "title": key.title(), "markets": markets}

    return [
        {"id": "a", "sport_key": "x", "commence_time": "2026-06-04T00:30:00Z", "home_team": home, "away_team": away, "bookmakers": [book(b, True) for b in ("pinnacle", "b", "c")]},
        {"id": "b", "sport_key": "x", "commence_time": "2026-06-06T23:00:00Z", "home_team": away, "away_team": home, "bookmakers": [book(b, False) for b in ("pinnacle", "b")]},
        {"id": "off", "sport_key": "x", "commence_time": "2026-06-06T23:00:00Z", "home_team": away, "away_team": home, "bookmakers": []},
    ]


def test_odds_flatten(spark):
    stamp = F.lit("2026-06-03 20:30:00").cast("timestamp")
    for text in ([json.dumps(payload())], [json.dumps(g) for g in payload()]):
        df = spark.createDataFrame([(t,) for t in text], "body string")
        out = L.parse_odds(df, "body", stamp)
        assert out.schema.names == ODDS.names
        assert rows(out.groupBy("game_id").count()) == [("a", 18), ("b", 4)]
        assert rows(out.select("game_id", "game_date").distinct()) == [("a", day("2026-06-03")), ("b", day("2026-06-06"))]
        assert out.filter((F.col("market_type") == "h2h") != F.col("point").isNull()).isEmpty()
    empty = L.parse_odds(spark.createDataFrame([("[]",)], "body string"), "body", stamp)
    assert empty.count() == 0 and empty.schema.names == ODDS.names


def test_odds_files(spark, tmp_path):
    stamp = F.lit("2026-06-03 20:30:00").cast("timestamp")
    (tmp_path / "one.json").write_text(json.dumps(payload()))
    (tmp_path / "pretty.json").write_text(json.dumps(payload(), indent=2))
    for name, multi in (("one", False), ("pretty", True)):
        path = L.land_odds(spark, str(tmp_path / f"{name}.json"), str(tmp_path / f"zone-{name}"), stamp, multi)
        back = Z.read_zone(spark, path, ODDS)
        assert back.count() == 22 and back.select("game_date").distinct().count() == 2
        # The instant survives the round trip.
        assert back.select(F.date_format("commence_time", "yyyy-MM-dd HH:mm")).distinct().count() == 2
        assert ("2026-06-04 00:30",) in rows(back.select(F.date_format("commence_time", "yyyy-MM-dd HH:mm")).distinct())


def feed(spark, dates):
    log, box, adv = [], [], []
    for d in dates:
        game = "00" + d.replace("-", "")
        for team, code, other, mark, wl in ((1, "BOS", "NYK", "vs.", "W"), (2, "NYK", "BOS", "@", "L")):
            log.append((game, team, code, f"{code} {mark} {other}", wl, d))
            for p in range(2):
                box.append((game, team, code, team * 10 + p, f"P{team}{p}", "20:00", 20.0 + p, 5.0, 4.0, 2.0, 8.0, 15.0, 1.0, 3.0, 3.0, 4.0))
                adv.append((game, team, code, team * 10 + p, " Jay ", f"P{p}", "20:00", 110.0 + p, 100.0, 99.0))
    return (
        spark.createDataFrame(box, "GAME_ID string, TEAM_ID long, TEAM_ABBREVIATION string, PLAYER_ID long, PLAYER_NAME string, MIN string, PTS double, REB double, AST double, TO double, FGM double, FGA double, FG3M double, FG3A double, FTM double, FTA double"),
        spark.createDataFrame(adv, "gameId string, teamId long, teamTricode string, personId long, firstName string, familyName string, minutes string, offensiveRating double, defensiveRating double, pace double"),
        spark.createDataFrame(log, "GAME_ID string, TEAM_ID long, TEAM_ABBREVIATION string, MATCHUP string, WL string, GAME_DATE string"),
    )


def test_landing(spark, tmp_path):
    box, adv, log = feed(spark, ["2026-04-28", "2026-04-29"])
    path = L.land_box_scores(box, log, str(tmp_path / "raw/box"), "2025-26", "Playoffs")
    out = Z.read_zone(spark, path, PLAYER_GAME)
    assert out.count() == 8 and out.filter("tov is null or matchup is null or wl is null").isEmpty()
    assert rows(out.select("season", "game_date").distinct()) == [(2025, day("2026-04-28")), (2025, day("2026-04-29"))]
    assert out.filter("game_id = '0020260428'").count() == 4  # leading zeros kept
    L.land_box_scores(box.withColumn("PTS", F.lit(1.0)), log, path, "2025-26", "Playoffs", "2026-04-29")
    assert rows(Z.read_zone(spark, path, PLAYER_GAME).groupBy("game_date").agg(F.max("pts"))) == [(day("2026-04-28"), 21), (day("2026-04-29"), 1)]
    rated = Z.read_zone(spark, L.land_advanced(adv, log, str(tmp_path / "raw/adv"), "2025-26", "Playoffs"), PLAYER_GAME_ADVANCED)
    first = rated.filter("player_id = 10").first()
    assert (first.player_name, first.off_rating, first.pace, first.min) == ("Jay P0", 110.0, 99.0, "20:00")


def test_csv_keeps_ids(spark, tmp_path):
    (tmp_path / "x.csv").write_text("game_id,game_date,season\n0042500101,2026-04-28,2025\n")
    schema = type(PLAYER_GAME)(PLAYER_GAME.fields[:3])
    assert rows(Z.read_csv_zone(spark, str(tmp_path / "x.csv"), schema)) == [("0042500101", day("2026-04-28"), 2025)]


def landed(spark, root, dates, advanced=True):
    zones = Zones(root)
    box, adv, log = feed(spark, dates)
    L.land_box_scores(box, log, zones.raw, "2025-26", "Playoffs")
    if advanced:
        L.land_advanced(adv, log, zones.raw_advanced, "2025-26", "Playoffs")
    return zones


DATES = ["2026-04-28", "2026-04-29", "2026-04-30"]


def test_rebuild_and_daily_agree(spark, tmp_path):
    once = landed(spark, str(tmp_path / "a"), DATES)
    assert rows(rebuild(spark, once)) == [("features", 6), ("processed", 6), ("raw", 12)]
    daily = landed(spark, str(tmp_path / "b"), DATES)
    for d in [*DATES, "2026-05-09", DATES[1]]:
        run_daily(spark, daily, d)
    for zone, schema in (("processed", TEAM_GAME), ("features", ROLLING)):
        a = Z.read_zone(spark, getattr(once, zone), schema)
        b = Z.read_zone(spark, getattr(daily, zone), schema)
        assert rows(a) == rows(b)
    row = Z.read_zone(spark, once.processed, TEAM_GAME).filter("team_id = 1").first()
    assert (row.pts, row.is_home, row.win, row.top_scorer, row.off_rating) == (41, True, True, "P11", 110.5)
    assert training_matrix(spark, once).count() == 2


def test_rebuild_moves_each_feed_once(spark, tmp_path, monkeypatch):
    """One shuffle for box scores, one for ratings; by all keys only where a game lies under two dates."""
    from tallyframe.plans import jobs

    zones = landed(spark, str(tmp_path / "m"), DATES)
    moves, write = [], jobs.write_processed
    monkeypatch.setattr(jobs, "write_processed", lambda df, path: moves.append(exchanges(df)) or write(df, path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rebuild(spark, zones)
        assert moves == [2]
        again = Z.read_zone(spark, zones.raw, PLAYER_GAME).filter(F.col("game_date") == day(DATES[0])).withColumn("game_date", F.lit(day("2026-05-03")))
        conform(spark.createDataFrame(again.collect(), PLAYER_GAME), PLAYER_GAME).write.mode("append").partitionBy("season", "game_date").parquet(zones.raw)
        rebuild(spark, zones)
        assert len(moves) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wanted = jobs.processed_rows(Z.read_zone(spark, zones.raw, PLAYER_GAME), Z.read_zone(spark, zones.raw_advanced, PLAYER_GAME_ADVANCED))
    got = Z.read_zone(spark, zones.processed, TEAM_GAME)
    assert rows(got) == rows(conform(wanted, TEAM_GAME)) and got.count() == 8
    assert rows(Z.read_zone(spark, zones.features, ROLLING), *ROLLING.names) == rows(rolling_features(got), *ROLLING.names)


def test_a_log_that_lies_by_game_does_not_move(spark):
    """Numbers meet as numbers; teams are told apart without being a key, and unknown ones keep their rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        box = spark.createDataFrame(
            [(1, 7, 70, 5), (1, 7, 71, 6), (1, 8, 80, 7), (1, None, 90, 8), (2, 7, 70, 9), (None, 7, 70, 1)], "GAME_ID long, TEAM_ID int, PLAYER_ID int, PTS int"
        )
        log = spark.createDataFrame(
            [(1, 7, "2026-05-01", "A vs. B", "W"), (1, 7, "2026-05-01", "A vs. B", "W"), (1, 8, "2026-05-01", "B @ A", "L"), (3, 7, "2026-05-02", "A @ C", "L")],
            "GAME_ID long, TEAM_ID int, GAME_DATE string, MATCHUP string, WL string",
        )
        got = L.box_score_rows(box, log.repartition("GAME_ID"))
        assert exchanges(got) == 2
        out = L.normalize_box_scores(box, log, "2025-26", "Playoffs")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(out, "pts", "game_id", "team_id", "wl", "game_date") == [
        (1, None, 7, None, None), (5, "1", 7, "W", day("2026-05-01")), (6, "1", 7, "W", day("2026-05-01")),
        (7, "1", 8, "L", day("2026-05-01")), (8, "1", None, None, None), (9, "2", 7, None, None),
    ]


def test_rebuild_without_ratings(spark, tmp_path):
    zones = landed(spark, str(tmp_path / "c"), DATES[:1], advanced=False)
    rebuild(spark, zones)
    assert rows(Z.read_zone(spark, zones.processed, TEAM_GAME), "team_id", "pace") == [(1, None), (2, None)]
    assert rows(audit(spark, Zones(str(tmp_path / "nothing")))) == [("features", 0), ("processed", 0), ("raw", 0)]


def test_stream_keeps_earlier_rows_of_a_date(spark, tmp_path):
    zones = landed(spark, str(tmp_path / "d"), DATES[:2])
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    incremental_team_game(spark, zones.raw, out, state, zones.raw_advanced, files_per_batch=1)
    assert Z.read_zone(spark, out, TEAM_GAME).count() == 4
    # A second file for a date already written.
    late = Z.read_zone(spark, zones.raw, PLAYER_GAME).filter(F.col("game_date") == day(DATES[0])).withColumns(
        {"game_id": F.lit("late"), "pts": F.lit(7)}
    )
    conform(spark.createDataFrame(late.collect(), PLAYER_GAME), PLAYER_GAME).write.mode("append").partitionBy("season", "game_date").parquet(zones.raw)
    for _ in range(2):
        incremental_team_game(spark, zones.raw, out, state, zones.raw_advanced)
    got = rows(Z.read_zone(spark, out, TEAM_GAME), "game_date", "game_id", "team_id", "pts")
    assert len(got) == 6 and (day(DATES[0]), "late", 1, 14) in got
    assert (day(DATES[0]), "0020260428", 1, 41) in got


def test_freshness(spark, tmp_path):
    path = str(tmp_path / "processed/f")
    Z.write_processed(team_rows(spark, ["2026-05-01"]), path)
    row = Z.zone_freshness(spark, path).first()
    assert row.newest is not None and row.n_files >= 1


def test_touched_partitions_prune_and_keep_null(spark, tmp_path):
    path = str(tmp_path / "processed/t")
    Z.write_processed(team_rows(spark, ["2026-05-01", "2026-05-02", "2026-05-03"]), path)
    full = Z.read_zone(spark, path, TEAM_GAME)
    batch = full.filter(F.col("game_date") <= day("2026-05-02")).limit(100)
    touched = touched_partitions(batch, full, ("season", "game_date"))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "(season#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert touched.count() == 4
    assert touched_partitions(batch.filter("false"), full, ("season", "game_date")).isEmpty()
    undated = full.withColumn("game_date", F.when(F.col("game_date") != day("2026-05-03"), F.col("game_date")))
    whole = touched_partitions(undated, undated, ("season", "game_date"))
    assert whole.count() == undated.count() == 6
    assert touched_partitions(undated.filter("game_date is null"), undated, ("season", "game_date")).count() == 2


def test_unknown_games_are_kept_as_rejects(spark, tmp_path):
    path = str(tmp_path / "raw/box")
    payload = lambda game: spark.createDataFrame(
        [(game, 1, 5, 10), ("g1", 1, 5, 10)], "GAME_ID string, TEAM_ID int, PLAYER_ID int, PTS int"
    )
    log = spark.createDataFrame([("g1", 1, "2026-05-01", "AAA vs. BBB", "W")], "GAME_ID string, TEAM_ID int, GAME_DATE string, MATCHUP string, WL string")
    for game in ("x1", "x2"):
        land_box_scores(payload(game), log, path, "2025-26", "Playoffs", day="2026-05-01")
    assert [r.game_id for r in Z.read_zone(spark, path, PLAYER_GAME).collect()] == ["g1"]
    lost = L.read_rejects(spark, path, PLAYER_GAME)
    assert sorted(r.game_id for r in lost.collect()) == ["x1", "x2"]
    assert {r.reject_reason for r in lost.collect()} == {"not_in_game_log"}


def test_broken_odds_are_kept_as_rejects(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "raw/odds")
    source.mkdir()
    good = {"id": "a", "commence_time": "2026-06-04T00:30:00Z", "home_team": "H", "away_team": "A",
            "bookmakers": [{"key": "b", "markets": [{"key": "h2h", "outcomes": [{"name": "H", "price": -110}]}, {"key": "x"}]}, {"key": "c"}]}
    late = {**good, "id": "b", "commence_time": "soon"}
    (source / "x.json").write_text(json.dumps(good) + "\n" + '{"id": \n' + json.dumps(late) + "\n" + json.dumps([good]) + "\n")
    land_odds(spark, str(source), path)
    assert Z.read_zone(spark, path, ODDS).count() == 2
    assert rows(L.read_rejects(spark, path), "reject_reason") == [("no_start_time",), ("not_json",)]


def test_staging_of_an_earlier_attempt_is_not_promoted(spark, tmp_path):
    path, staging = str(tmp_path / "processed/p"), str(tmp_path / "staging/p")
    wrong = team_rows(spark, ["2026-05-01"]).withColumn("season", F.lit(1999))
    Z.write_processed(wrong, staging)
    Z.stage_then_promote(team_rows(spark, ["2026-05-01"]), staging, path)
    assert {r.season for r in Z.read_zone(spark, path, TEAM_GAME).collect()} == {2025}


def test_only_a_missing_zone_is_empty(spark, tmp_path):
    from pyspark.errors import AnalysisException

    assert not Z.zone_has_rows(spark, str(tmp_path / "nothing"), TEAM_GAME)
    with pytest.raises(AnalysisException) as caught:
        spark.read.json(str(tmp_path / "absent")).select("x")
    assert Z.path_is_missing(caught.value)
    with pytest.raises(AnalysisException) as caught:
        spark.range(1).select("x")
    assert not Z.path_is_missing(caught.value)


def test_csv_header_names_the_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,extra,a\n2,z,01\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.IntegerType())])
    assert [tuple(r) for r in Z.read_csv_zone(spark, str(tmp_path / "x.csv"), schema).collect()] == [("01", 2, None)]


def test_late_ratings_reach_the_zone(spark, tmp_path):
    zones = landed(spark, str(tmp_path / "d"), DATES[:1])
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    later = str(tmp_path / "later")
    incremental_team_game(spark, zones.raw, out, state, later)
    assert Z.read_zone(spark, out, TEAM_GAME).filter("off_rating is not null").isEmpty()
    Z.read_zone(spark, zones.raw_advanced, PLAYER_GAME_ADVANCED).write.partitionBy("season", "game_date").parquet(later)
    incremental_team_game(spark, zones.raw, out, state, later)
    assert not Z.read_zone(spark, out, TEAM_GAME).filter("off_rating is not null").isEmpty()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tallyframe.session import checkpoint_root

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(getConf=lambda: {}, master="spark://host:7077", applicationId="x"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)


def test_a_day_is_written_by_few_tasks(spark, tmp_path):
    path = str(tmp_path / "processed/few")
    frame = team_rows(spark, [f"2026-05-{d:02d}" for d in range(1, 11)]).repartition(8)
    Z.write_processed(frame, path)
    assert Z.zone_freshness(spark, path).first().n_files == 10


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(json.dumps(payload()),)], "body string")
        out = L.parse_odds(df, "body", F.lit("2026-06-03T20:30:00Z").cast("timestamp"))
        got = rows(out.select("game_id", "game_date", iso_utc("commence_time"), iso_utc("fetched_at")).distinct())
        assert got == [
            ("a", day("2026-06-03"), "2026-06-04T00:30:00+00:00", "2026-06-03T20:30:00+00:00"),
            ("b", day("2026-06-06"), "2026-06-06T23:00:00+00:00", "2026-06-03T20:30:00+00:00"),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def season_games(spark, seasons, skip=(), late=()):
    """Two games a season for each of three teams, but for (season, team) in ``skip``; ``late`` adds more."""
    data = [
        (s, f"g{s}{t}{k}", dt.date(s, 1 + k, 1), t, 100 + 7 * t + 3 * k + s % 10, k == 0, t == 1)
        for s in seasons
        for t in (1, 2, 3)
        for k in range(2)
        if (s, t) not in skip
    ] + list(late)
    df = spark.createDataFrame(data, "season int, game_id string, game_date date, team_id int, pts int, is_home boolean, win boolean")
    return conform(df, TEAM_GAME)


def test_tails_carry_last_games_from_season_to_season(spark, tmp_path):
    zones = Zones(str(tmp_path / "t"))
    seasons = [2000, 2001, 2005, 2024]
    games = season_games(spark, seasons, skip={(2005, 2), (2000, 3), (2001, 3), (2005, 3)})
    Z.write_processed(games, zones.processed)
    for season in seasons:
        want = last_games(games.filter(F.col("season") < season), 5)
        assert rows(carried_in(spark, zones, season, 5), "game_id", "team_id") == rows(want, "game_id", "team_id")
    # A late game of an old season changes its own team's tails only.
    late = [(2001, "late", dt.date(2001, 6, 1), 1, 50, True, False)]
    games = games.unionByName(season_games(spark, [], late=late))
    Z.write_processed(games.filter("season = 2001"), zones.processed)
    renew_tails(spark, zones, 2001, spark.createDataFrame([(1,)], "team_id int"), 5)
    for season in seasons:
        want = last_games(games.filter(F.col("season") < season), 5)
        assert rows(carried_in(spark, zones, season, 5), "game_id", "team_id") == rows(want, "game_id", "team_id")


def test_a_new_team_reads_no_old_season(spark, tmp_path):
    zones = Zones(str(tmp_path / "t"))
    games = season_games(spark, [2000, 2001, 2024], skip={(2000, 3), (2001, 3)})
    Z.write_processed(games, zones.processed)
    carried_in(spark, zones, 2024, 5)
    for old in (2000, 2001):
        for f in (tmp_path / "t").rglob(f"season={old}/**/*.parquet"):
            f.write_bytes(b"not a parquet file")
    processed = Z.read_zone(spark, zones.processed, TEAM_GAME)
    got = features_since_season(processed, 2024, carried_in(spark, zones, 2024, 5), 5)
    want = rolling_features(games, 5).filter("season = 2024")
    assert rows(got, "game_id", *ROLLING_COLUMNS) == rows(want, "game_id", *ROLLING_COLUMNS)
    assert {r.team_id for r in got.collect()} == {1, 2, 3}


def odds_file(folder, name, games):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"id": g, "commence_time": start, "home_team": "H", "away_team": "A",
                    "bookmakers": [{"key": b, "markets": [{"key": "h2h", "outcomes": [{"name": n, "price": p} for n in sides]}]} for b, p, sides in books]})
        for g, start, books in games
    ]
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_closing_line_of_several_fetches(spark, tmp_path):
    path = str(tmp_path / "raw/odds")
    start, both = "2026-06-04T18:00:00Z", ("H", "A")
    fetches = [
        ("2026-06-04 08:00:00", [("a", start, [("x", -110, both), ("y", -120, both)]), ("b", start, [("x", 105, both)])]),
        ("2026-06-04 12:00:00", [("a", start, [("x", -115, both)])]),
        ("2026-06-04 17:59:59", [("a", start, [("x", -118, ("H",))])]),
        ("2026-06-04 18:00:00", [("a", start, [("x", -300, both)]), ("c", start, [("x", 150, both)])]),
    ]
    for i, (time, games) in enumerate([*fetches, fetches[1]]):
        land_odds(spark, odds_file(tmp_path / f"in{i}", "f.json", games), path, F.lit(time).cast("timestamp"))
    zone = Z.read_zone(spark, path, ODDS)
    # The replay of one fetch replaced itself, and no fetch removed another's games.
    assert zone.count() == 6 + 2 + 1 + 4
    key = ("game_id", "sportsbook", "outcome_name", "price")
    assert rows(closing_line(zone), *key) == [("a", "x", "H", -118), ("a", "y", "A", -120), ("a", "y", "H", -120), ("b", "x", "A", 105), ("b", "x", "H", 105)]
    assert [r for r in rows(current_prices(zone), *key) if r[0] != "b"] == [
        ("a", "x", "A", -300), ("a", "x", "H", -300), ("a", "y", "A", -120), ("a", "y", "H", -120), ("c", "x", "A", 150), ("c", "x", "H", 150)
    ]
    assert closing_line(zone.withColumn("commence_time", F.lit(None).cast("timestamp"))).isEmpty()


def test_newest_prices_move_once(spark):
    """A market of unknown game, a repeated row and one never fetched; all in one shuffle, by game."""
    kinds = "game_id string, sportsbook string, market_type string, outcome_name string, price double, fetched_at timestamp"
    at = [dt.datetime(2026, 6, 4, h) for h in (8, 12)]
    odds = spark.createDataFrame(
        [("a", "x", "h2h", "H", 1.0, at[0]), ("a", "x", "h2h", "H", 2.0, at[1]), ("a", "x", "h2h", "H", 2.0, at[1]), ("a", "x", "h2h", "A", 3.0, None),
         ("a", "x", "totals", "Over", 4.0, None), (None, "x", "h2h", "H", 5.0, at[0]), (None, "x", "h2h", "H", 6.0, at[1]), (None, None, "h2h", "H", 7.0, at[0])],
        kinds,
    )
    newest = current_prices(odds)
    assert sorted(r.price for r in newest.collect()) == [2.0, 2.0, 4.0, 6.0, 7.0] and newest.columns == odds.columns
    ran = newest._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("Exchange hashpartitioning") - ran.count("ReusedExchange") == 1 and "Sort [" not in ran


def test_rejects_are_landed_once(spark, tmp_path):
    path = str(tmp_path / "raw/box")
    payload = spark.createDataFrame(
        [("x1", 1, 5, 10), ("x1", 1, 5, 10), ("x1", 1, 6, None), ("g1", 1, 5, 10), ("g2", 1, 5, 7)], "GAME_ID string, TEAM_ID int, PLAYER_ID int, PTS int"
    )
    log = spark.createDataFrame([("g1", 1, "2026-05-01", "A vs. B", "W"), ("g2", 1, "2026-05-02", "A @ B", "L")], "GAME_ID string, TEAM_ID int, GAME_DATE string, MATCHUP string, WL string")
    assert L.read_rejects(spark, path, PLAYER_GAME).isEmpty()
    land_box_scores(payload.filter("GAME_ID = 'g1'"), log, path, "2025-26", "Playoffs")
    assert L.read_rejects(spark, path, PLAYER_GAME).isEmpty()
    for _ in range(3):
        land_box_scores(payload, log, path, "2025-26", "Playoffs", day="2026-05-01")
    lost = L.read_rejects(spark, path, PLAYER_GAME)
    assert rows(lost, "game_id", "player_id", "reject_reason", "copies") == [
        ("g2", 5, "other_date", 1), ("x1", 5, "not_in_game_log", 2), ("x1", 6, "not_in_game_log", 1)
    ]
    land_box_scores(payload, log, path, "2025-26", "Playoffs", day="2026-05-01", delivery="another")
    assert L.read_rejects(spark, path, PLAYER_GAME).count() == 6
    assert [r.game_id for r in Z.read_zone(spark, path, PLAYER_GAME).collect()] == ["g1"]


def test_incremental_features_order_games_of_a_day_as_their_stored_ids(spark, tmp_path):
    """Twelve games of one team on one day: ids are text in the zones, for the SQL twin too."""
    duckdb = pytest.importorskip("duckdb")
    at = dt.datetime(1998, 1, 1)
    orders = [(k, 7, "F", 10.0, at, "1-URGENT") for k in range(1, 15)]
    lines = [(k, 1, 1, 1, float(k), 100.0 * k, 0.05, 0.02, "R", "F", at) for k in range(1, 15)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for name in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    cursor = con.execute(SQL["incremental_features"])
    columns = [d[0] for d in cursor.description]
    mine = [tuple(r) for r in QUERIES["incremental_features"](spark, str(tmp_path)).select(*columns).collect()]
    assert sorted(mine, key=str) == sorted(cursor.fetchall(), key=str)
    assert len(mine) == 14


def test_odds_move_as_games_and_are_inlined_after_the_shuffle(spark, tmp_path, monkeypatch):
    """One row a game is brought to its date's directory, not one per price; the leaves are gathered once."""
    body = {
        "id": "g1", "commence_time": "2026-01-02T02:00:00Z", "home_team": "H", "away_team": "A",
        "bookmakers": [{"key": b, "markets": [{"key": "h2h", "outcomes": [{"name": "H", "price": -110.0}, {"name": "A", "price": 105.0}]}]} for b in "pq"],
    }
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(body) + "\n" + json.dumps({**body, "id": "g2", "bookmakers": []}) + "\n")
    moved = []

    def seen(df, partitions):
        moved.append(df)
        return Z.by_partition(df, partitions)

    monkeypatch.setattr(L, "by_partition", seen)
    path = land_odds(spark, str(tmp_path / "in"), str(tmp_path / "odds"))
    assert [df.count() for df in moved] == [2]
    landed = Z.read_zone(spark, path, ODDS)
    assert rows(landed, "game_id", "game_date", "sportsbook", "outcome_name", "price") == sorted(
        ("g1", day("2026-01-01"), b, n, p) for b in "pq" for n, p in (("H", -110), ("A", 105))
    )
    games = spark.read.schema(L.ODDS_GAME).json(str(tmp_path / "in"))
    plan = L.flatten_odds(games, F.current_timestamp())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bookmakers") < 6 and plan.count("flatten(transform(bookmakers") == 1
    below = plan.split("Generate")[1]
    assert "US/Eastern" in below


def test_odds_documents_are_written_compressed(spark, sf_dir, tmp_path):
    from tallyframe.catalog.base import odds_games
    from tallyframe.catalog.zones import _write_documents

    path = _write_documents(odds_games(spark, sf_dir), str(tmp_path / "docs"))
    files = [p.name for p in (tmp_path / "docs").iterdir() if p.name.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.read.schema(L.ODDS_GAME).json(path).count() == odds_games(spark, sf_dir).count()


def test_landing_moves_only_what_the_feed_fills(spark, tmp_path, monkeypatch):
    """Run constants and missing columns are added after the shuffle; rejects keep them too."""
    moved = []

    def seen(df, partitions):
        moved.append(df.columns)
        return Z.by_partition(df, partitions)

    monkeypatch.setattr(L, "by_partition", seen)
    players = spark.createDataFrame([(1, 7, 70, 5.0), (2, 7, 71, 6.0)], "GAME_ID long, TEAM_ID long, PLAYER_ID long, PTS double")
    log = spark.createDataFrame([(1, 7, day("2026-01-02"), "A vs. B", "W")] * 2, "GAME_ID long, TEAM_ID long, GAME_DATE date, MATCHUP string, WL string")
    path = land_box_scores(players, log, str(tmp_path / "box"), "2025-26", "Playoffs")
    assert sorted(moved[0]) == ["game_date", "game_id", "matchup", "player_id", "pts", "team_id", "wl"]
    landed = Z.read_zone(spark, path, PLAYER_GAME)
    assert rows(landed, "game_id", "season", "season_type", "player_id", "pts", "wl", "ast") == [("1", 2025, "Playoffs", 70, 5, "W", None)]
    bad = L.read_rejects(spark, path, PLAYER_GAME)
    assert rows(bad, "game_id", "season", "season_type", "reject_reason") == [("2", 2025, "Playoffs", "not_in_game_log")]


def test_stored_rows_stay_where_they_are_read(spark):
    """Keys of touched partitions are broadcast even where their size is not known."""
    full = spark.range(100).selectExpr("id", "cast(id % 5 as int) season", "date'2026-01-01' + cast(id % 7 as int) game_date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = touched_partitions(full.filter("id < 3"), full, ("season", "game_date"))
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == full.filter("(id % 35) < 3").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
