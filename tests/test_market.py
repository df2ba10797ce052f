import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyframe.functions import market as M


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "odds, expected", [(-110, 110 / 210), (-250, 250 / 350), (220, 100 / 320), (100, 0.5), (-100, 0.5), (0, None)]
)
def test_implied(spark, odds, expected):
    got = value(spark, M.implied_prob(F.lit(odds)))
    assert got == (pytest.approx(expected) if expected is not None else None)


@pytest.mark.parametrize("odds, expected", [(-110, 1 + 100 / 110), (220, 3.2), (0, None)])
def test_decimal(spark, odds, expected):
    got = value(spark, M.decimal_odds(F.lit(odds)))
    assert got == (pytest.approx(expected) if expected is not None else None)


def test_strict_raises(spark):
    with pytest.raises(PySparkException):
        value(spark, M.implied_prob(F.lit(0), strict=True))
    with pytest.raises(PySparkException):
        value(spark, M.expected_value(F.lit(1.5), F.lit(-110), strict=True))


def test_devig(spark):
    even = value(spark, M.devig_two_way(F.lit(-110), F.lit(-110)))
    assert (even.fair_home, even.fair_away) == (pytest.approx(0.5), pytest.approx(0.5))
    fair = value(spark, M.devig_two_way(F.lit(-260), F.lit(215)))
    assert fair.fair_home == pytest.approx(0.69466, abs=1e-4)
    assert fair.fair_home + fair.fair_away == pytest.approx(1.0)
    assert value(spark, M.devig_two_way(F.lit(200), F.lit(200))) is None


def test_expected_value(spark):
    assert value(spark, M.expected_value(F.lit(0.6), F.lit(-110))) == pytest.approx(0.6 * 100 / 110 - 0.4)
    assert value(spark, M.expected_value(F.lit(0.4), F.lit(220))) == pytest.approx(0.28)
    assert value(spark, M.expected_value(F.lit(110 / 210), F.lit(-110))) == pytest.approx(0.0, abs=1e-12)
    assert value(spark, M.expected_value(F.lit(1.2), F.lit(-110))) is None


def test_kelly(spark):
    assert value(spark, M.kelly_fraction(F.lit(0.6), F.lit(-110))) == pytest.approx(0.16)
    assert value(spark, M.kelly_fraction(F.lit(0.3), F.lit(-110))) == 0.0
    assert value(spark, M.kelly_fraction(F.lit(0.6), F.lit(-110), 0.25)) == pytest.approx(0.04)
    assert value(spark, M.kelly_fraction(F.lit(-0.1), F.lit(-110))) is None
    assert value(spark, M.kelly_fraction(F.lit(0.6), F.lit(0))) is None
    with pytest.raises(ValueError):
        M.kelly_fraction(F.lit(0.6), F.lit(-110), -1)


def test_vig(spark):
    assert value(spark, M.vig_percent(F.lit(-110), F.lit(-110))) == pytest.approx(4.7619, abs=1e-4)
