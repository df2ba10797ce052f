import pytest

from tallyframe.operators import aggregate as A
from tallyframe.schema import PLAYER_GAME, PLAYER_GAME_ADVANCED, TEAM_GAME, conform

from .conftest import exchanges, rows

BASE = "game_id string, game_date string, season int, season_type string, team_id int, team_abbreviation string, matchup string, wl string, player_name string"
STATS = "pts int, reb int, ast int, tov int, fgm int, fga int, fg3m int, fg3a int, ftm int, fta int"


def players(spark):
    bos = ("001", "2026-04-28", 2025, "Playoffs", 1, "BOS", "BOS vs. NYK", "W")
    nyk = ("001", "2026-04-28", 2025, "Playoffs", 2, "NYK", "NYK @ BOS", "L")
    data = [
        (*bos, "Tatum", 30, 8, 5, 2, 11, 22, 4, 9, 4, 5),
        (*bos, "Brown", 24, 6, 7, 1, 9, 18, 2, 6, 4, 5),
        (*bos, None, 99, 50, 50, 0, 0, 0, 0, 0, 0, 0),
        (*bos, "White", None, 8, 1, 1, 1, 2, 0, 1, 0, 0),
        (*nyk, "Brunson", 25, 3, 9, 0, 10, 20, 3, 8, 2, 2),
        (*nyk, "Anunoby", 25, 3, 2, 0, 9, 15, 3, 5, 4, 4),
        (*nyk[:6], None, None, "Towns", 18, 15, 2, 0, 8, 14, 1, 3, 1, 2),
    ]
    return conform(spark.createDataFrame(data, f"{BASE}, {STATS}"), PLAYER_GAME)


def test_totals_by_hand(spark):
    out = {r.team_abbreviation: r for r in A.team_game_stats(players(spark), with_leaders=True).collect()}
    bos, nyk = out["BOS"], out["NYK"]
    assert (bos.pts, bos.reb, bos.ast, bos.tov) == (153, 72, 63, 4)
    assert (bos.is_home, bos.win, bos.opponent_abbreviation) == (True, True, "NYK")
    assert (nyk.is_home, nyk.win, nyk.opponent_abbreviation) == (False, False, "BOS")
    assert bos.fg_pct == pytest.approx(21 / 42)
    assert bos.effective_fg_pct == pytest.approx((21 + 0.5 * 6) / 42)
    assert bos.true_shooting_pct == pytest.approx(153 / (2 * (42 + 0.44 * 10)))
    assert bos.assist_to_turnover == pytest.approx(63 / 4)
    assert nyk.assist_to_turnover is None  # no turnovers


def test_leaders(spark):
    out = {r.team_abbreviation: r for r in A.team_game_stats(players(spark), with_leaders=True).collect()}
    bos, nyk = out["BOS"], out["NYK"]
    # The unnamed row has the highest numbers and is skipped; a missing stat ranks last.
    assert (bos.top_scorer, bos.top_rebounder, bos.top_playmaker) == ("Tatum", "Tatum", "Brown")
    # Equal points: alphabetical.
    assert (nyk.top_scorer, nyk.top_rebounder, nyk.top_playmaker) == ("Anunoby", "Towns", "Brunson")


def test_all_missing_stat_still_has_a_leader(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (2, 3, None)], "g int, pts int, player_name string")
    assert rows(A.top_per_group(df, "pts", ["g"], "top")) == [(1, "a")]


def test_joined_leaders_equal_single_pass(spark):
    df = players(spark)
    once = A.team_game_stats(df, with_leaders=True)
    joined = A.join_top_players(A.team_game_stats(df), df)
    columns = ["game_id", "team_id", "top_scorer", "top_rebounder", "top_playmaker"]
    assert rows(once, *columns) == rows(joined, *columns)
    assert exchanges(once) == 1


def test_empty_input_keeps_columns(spark):
    out = A.with_null_columns(A.team_game_stats(spark.createDataFrame([], PLAYER_GAME), with_leaders=True))
    assert out.count() == 0
    assert set(out.columns) == set(TEAM_GAME.names)


def test_minutes_weighted(spark):
    data = [
        ("1", 1, "30:00", 120.0, 105.0, 99.5),
        ("1", 1, "18:00", 100.0, 115.0, 99.5),
        ("1", 1, "0:00", 999.0, 999.0, 99.5),
        ("1", 1, "", 999.0, 999.0, 99.5),
        ("1", 1, None, 999.0, 999.0, 120.0),
        ("2", 1, "10:00", None, 100.0, 90.0),
        ("2", 1, "10:00", 110.0, 100.0, 90.0),
        ("3", 1, "0:00", 1.0, 1.0, 1.0),
    ]
    adv = conform(
        spark.createDataFrame(data, "game_id string, team_id int, min string, off_rating double, def_rating double, pace double"),
        PLAYER_GAME_ADVANCED,
    )
    out = {r.game_id: r for r in A.team_advanced(adv).collect()}
    assert set(out) == {"1", "2"}
    assert (out["1"].off_rating, out["1"].def_rating, out["1"].net_rating, out["1"].pace) == pytest.approx(
        (112.5, 108.75, 3.75, 99.5)
    )
    # The missing rating's minutes stay in the divisor.
    assert out["2"].off_rating == pytest.approx(55.0)
    assert A.filter_played(adv).count() == 4


def test_advanced_join_keeps_unmatched(spark):
    totals = spark.createDataFrame([("1", 1, 9), ("2", 1, 8)], "game_id string, team_id int, pts int")
    adv = spark.createDataFrame([("1", 1, 112.5, 108.75, 3.75, 99.5)], "game_id string, team_id int, off_rating double, def_rating double, net_rating double, pace double")
    assert rows(A.join_team_advanced(totals, adv), "game_id", "off_rating") == [("1", 112.5), ("2", None)]
