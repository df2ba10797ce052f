import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.catalog import QUERIES, SQL
from tallyframe.operators import series as S
from tallyframe.operators import views as V

from .conftest import rows


def games(spark):
    data = []

    def play(a, b, results, kind="Playoffs"):
        for i, a_won in enumerate(results):
            data.append((a, b, f"{a}{b}{i}", a_won, kind))
            data.append((b, a, f"{a}{b}{i}", not a_won, kind))

    play("NYK", "ATL", [True, False, True, False, True, True])
    play("OKC", "PHX", [True] * 4)
    play("NYK", "IND", [True, False])
    play("SAS", "DEN", [True, False, True, True, True], "Regular Season")
    return spark.createDataFrame(data, "team_abbreviation string, opponent_abbreviation string, game_id string, win boolean, season_type string")


def test_series_and_status(spark):
    series = {(r.team_abbreviation, r.opponent_abbreviation): (r.wins, r.losses, r.games, r.state) for r in S.series_summary(games(spark)).collect()}
    assert series[("NYK", "ATL")] == (4, 2, 6, "WON")
    assert series[("ATL", "NYK")] == (2, 4, 6, "LOST")
    assert series[("NYK", "IND")] == (1, 1, 2, "ACTIVE")
    assert ("SAS", "DEN") not in series
    status = dict(rows(S.team_status(games(spark))))
    assert status == {"NYK": "ACTIVE", "ATL": "ELIMINATED", "OKC": "ACTIVE", "PHX": "ELIMINATED", "IND": "ACTIVE", "SAS": "DNP", "DEN": "DNP"}
    assert tuple(S.active_ratio(S.team_status(games(spark))).first()) == (3, 5, 0.6)
    assert rows(S.team_series_history(games(spark), "NYK"), "opponent_abbreviation", "state") == [("ATL", "WON"), ("IND", "ACTIVE")]


def test_without_season_type_everything_counts(spark):
    plain = games(spark).drop("season_type")
    assert ("DEN", "ELIMINATED") in rows(S.team_status(plain))
    assert S.playoffs_only(plain).count() == plain.count()


def test_missing_result_counts_as_lost(spark):
    df = spark.createDataFrame([("A", "B", f"g{i}", None) for i in range(4)], "team_abbreviation string, opponent_abbreviation string, game_id string, win boolean")
    assert rows(S.series_summary(df), "losses", "state") == [(4, "LOST")]


def latest(spark):
    return spark.createDataFrame(
        [("OKC", 10, 118.0, 0.6, 0.62, 1.0), ("NYK", 10, 110.0, 0.55, 0.6, 0.6), ("PHX", 4, 100.0, 0.5, 0.5, 0.0), ("IND", 2, 105.0, 0.5, None, 1.0)],
        "team_abbreviation string, games_in_window int, rolling_pts double, rolling_efg_pct double, rolling_ts_pct double, rolling_win_pct double",
    )


def test_commentary(spark):
    notes = S.commentary(latest(spark), S.team_status(games(spark)))
    assert rows(notes, "priority", "kind", "team") == sorted(
        [(1, "leader", "OKC"), (2, "full_window", "NYK"), (2, "full_window", "OKC"), (3, "undefeated", "OKC"),
         (4, "winless", "PHX"), (5, "eliminated", "ATL"), (5, "eliminated", "PHX"), (6, "still_active", None)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    text = {(r.kind, r.team): r.note for r in notes.collect()}
    assert text["leader", "OKC"] == "OKC shoots best: 0.620 true shooting in the last 10 games, 100.0% of them won, 118.000 points a game"
    assert text["winless", "PHX"] == "PHX has lost each of its last 4 games"
    assert text["eliminated", "ATL"] == "ATL is out after a lost series"
    assert text["still_active", None] == "3 of the 5 teams in the playoffs play on"


def test_leaderboard(spark):
    board = latest(spark).withColumns({c: F.lit(1.0) for c in ("rolling_ast_to_tov", "rolling_pts_home", "rolling_pts_away")})
    out = V.leaderboard_view(board, S.team_status(games(spark)))
    assert [tuple(r) for r in out.select("team", "status", "TS%").collect()] == [
        ("OKC", "ACTIVE", 0.62), ("NYK", "ACTIVE", 0.6), ("PHX", "OUT", 0.5), ("IND", "ACTIVE", None)
    ]


def test_head_to_head(spark):
    pairs = spark.createDataFrame([("OKC", "NYK"), ("OKC", "OKC"), ("OKC", "???")], "home_team string, away_team string")
    out = V.head_to_head(pairs, latest(spark), ["games_in_window", "rolling_pts"])
    assert rows(out) == [("OKC", "NYK", "games", 10.0, 10.0), ("OKC", "NYK", "pts", 118.0, 110.0)]
    table = V.head_to_head_table(latest(spark), "OKC", "PHX", ["games_in_window", "rolling_pts"])
    assert rows(table, "metric", "OKC", "PHX") == [("games", 10.0, 4.0), ("pts", 118.0, 100.0)]


def test_views(spark):
    processed = games(spark).withColumns(
        {"game_date": F.to_date(F.lit("2026-05-01")), "is_home": F.lit(True), "pts": F.lit(100), "effective_fg_pct": F.lit(0.5), "true_shooting_pct": F.lit(0.5), "assist_to_turnover": F.lit(2.0)}
    )
    log = V.game_log_view(processed, "ATL")
    assert [r.win for r in log.orderBy("game_id").collect()] == ["L", "W", "L", "W", "L", "L"]
    assert V.explore(processed, "ATL").count() == 6 and V.explore(processed).count() == processed.count()
    scored = spark.createDataFrame(
        [(f"g{i}", "A", "B", i % 2, 0.6, 1) for i in range(25)], "game_id string, home_team string, away_team string, label int, model_home_win_prob double, model_pick int"
    ).withColumns({"game_date": F.date_add(F.to_date(F.lit("2026-01-01")), F.substring("game_id", 2, 2).cast("int")), "correct": (F.col("label") == F.col("model_pick")).cast("int")})
    card = V.scorecard_view(scored).collect()
    assert len(card) == 20 and card[0].game_id == "g24"
    assert (card[0].model_pick, card[0].actual, card[0].result) == ("home", "away won", "✗")
    wide = spark.createDataFrame([("g", 1.0, 2.0)], "game_id string, home_rolling_pts double, away_rolling_pts double")
    assert rows(V.display_drivers(wide, ["rolling_pts"], ["game_id"])) == [("g", "pts", 1.0, 2.0)]
    stacked = V.union_frames([spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3,)], "a int")])
    assert rows(stacked) == [(1, 2), (3, None)]


def test_leader_without_results_and_with_half_a_thousandth(spark):
    """Missing shares are named unknown, not null, and a half is rounded away from zero."""
    odd = spark.createDataFrame(
        [("QQQ", 1, 0.25, 0.5, 0.8125, None)],
        "team_abbreviation string, games_in_window int, rolling_pts double, rolling_efg_pct double, rolling_ts_pct double, rolling_win_pct double",
    )
    note = S.commentary(odd, S.team_status(games(spark))).filter("kind = 'leader'").first().note
    assert note == "QQQ shoots best: 0.813 true shooting in the last 1 games, unknown of them won, 0.250 points a game"


@pytest.mark.parametrize("priority, aces, others", [("3-MEDIUM", 13, 3), ("1-URGENT", 4, 1)])
def test_commentary_equals_its_sql_at_odd_leaders(spark, tmp_path, priority, aces, others):
    """A leader without a decided game, and one whose share ends in half a thousandth."""
    duckdb = pytest.importorskip("duckdb")
    at = dt.datetime(1998, 1, 1)
    orders = [(1, 7, "F", 10.0, at, priority)]
    lines = [(1, 1, 1, 1, 5.0, 100.0, aces / 100, others / 100, "R", "F", at)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for table in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    theirs = con.execute(SQL["commentary"]).fetchall()
    mine = [tuple(r) for r in QUERIES["commentary"](spark, str(tmp_path)).select("priority", "kind", "team", "note").collect()]
    assert sorted(mine, key=str) == sorted(theirs, key=str) and len(mine) > 0
    assert all(r[3] is not None and "null" not in r[3] for r in mine)
