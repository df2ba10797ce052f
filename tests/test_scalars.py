import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import scalars as S
from tallyframe.schema import (
    DOUBLE,
    INT,
    PLAYER_GAME,
    ROLLING,
    TEAM_GAME,
    TRAINING_COLUMNS,
    conform,
    feature_columns,
    table,
)

from .conftest import rows


def one(spark, **columns):
    return tuple(spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first())


def test_schema_sizes():
    assert len(PLAYER_GAME) == 27
    assert len(TEAM_GAME) == 26
    assert len(ROLLING) == 17
    assert len(TRAINING_COLUMNS) == 30
    assert len(feature_columns(TRAINING_COLUMNS)) == 24


def test_safe_div_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(S.safe_div("n", "d")).collect()] == [0.5, None, None, None]


def test_shooting_ratios(spark):
    df = spark.createDataFrame([(94, 33, 72, 14, 16)], "pts int, fgm int, fga int, fg3m int, fta int")
    efg, ts = df.select(S.effective_fg_pct("fgm", "fg3m", "fga"), S.true_shooting_pct("pts", "fga", "fta")).first()
    assert efg == pytest.approx(0.555556, abs=1e-6)
    assert ts == pytest.approx(0.594636, abs=1e-6)


@pytest.mark.parametrize(
    "text, home, other",
    [
        ("BOS vs. NYK", True, "NYK"),
        ("NYK @ BOS", False, "BOS"),
        ("something else", None, "something else"),
        (None, None, None),
    ],
)
def test_matchup(spark, text, home, other):
    df = spark.createDataFrame([(text,)], "m string")
    assert tuple(df.select(S.is_home("m"), S.opponent("m")).first()) == (home, other)


def test_result_is_three_valued(spark):
    df = spark.createDataFrame([("W",), ("L",), ("x",), (None,)], "r string")
    assert [r[0] for r in df.select(S.won("r")).collect()] == [True, False, None, None]


def test_minutes_survive_dirty_text(spark):
    df = spark.createDataFrame([("38:12",), ("0:00",), ("",), ("DNP",), (None,), ("7",)], "m string")
    assert [r[0] for r in df.select(S.minutes_played("m")).collect()] == [38.0, 0.0, None, None, None, 7.0]


def test_full_name(spark):
    df = spark.createDataFrame(
        [("Jayson", "Tatum"), (" A ", None), (None, "B"), ("", " "), (None, None)], "f string, l string"
    )
    assert [r[0] for r in df.select(S.full_name("f", "l")).collect()] == ["Jayson Tatum", "A", "B", None, None]


def test_season_start_year(spark):
    assert one(spark, y=S.season_start_year(F.lit("2025-26"))) == (2025,)
    assert one(spark, y=S.season_start_year(F.lit("bad"))) == (None,)


def test_coerce_and_nan(spark):
    df = spark.createDataFrame([("5.0",), ("7",), ("x",), ("",), (None,), ("NaN",)], "t string")
    assert [r[0] for r in df.select(S.coerce_numeric("t", "int")).collect()] == [5, 7, None, None, None, None]
    nan = spark.createDataFrame([(math.nan,), (1.5,), (None,)], "v double")
    assert [r[0] for r in S.nulls_for_nan(nan).collect()] == [None, 1.5, None]


def test_renames(spark):
    payload = spark.createDataFrame([(1, 2, 3)], "GAME_ID int, TO int, Pts int")
    assert S.rename_lower(payload).columns == ["game_id", "tov", "pts"]
    camel = spark.createDataFrame([(1, 2.0, 3)], "teamId int, offensiveRating double, other int")
    assert S.rename_by_map(camel).columns == ["team_id", "off_rating", "other"]


def test_conform_pads_drops_orders_and_casts(spark):
    df = spark.createDataFrame([("5.0", "x", 1)], "b string, c string, extra int")
    out = conform(df, table([("a", DOUBLE), ("b", INT), ("c", INT)]))
    assert out.columns == ["a", "b", "c"]
    assert tuple(out.first()) == (None, 5, None)
    assert [f.dataType for f in out.schema] == [T.DoubleType(), T.IntegerType(), T.IntegerType()]


def test_iso_utc(spark):
    df = spark.sql("SELECT timestamp'2026-06-04 00:40:00' a, timestamp'2026-06-02 00:24:15.463448' b")
    assert rows(df.select(S.iso_utc("a"), S.iso_utc("b"))) == [
        ("2026-06-04T00:40:00+00:00", "2026-06-02T00:24:15.463448+00:00")
    ]
