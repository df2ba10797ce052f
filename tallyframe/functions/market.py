"""Prices, probabilities and stakes as column expressions.

Invalid input gives NULL, so one bad row never fails a job; callers that need
the reason use :mod:`tallyframe.operators.decisions`, which keeps a reject table.
``strict=True`` raises on the offending row instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col


def _guard(valid: Column, value: Column, strict: bool, message: str) -> Column:
    out = F.when(valid, value)
    return out.otherwise(F.raise_error(F.lit(message)).cast("double")) if strict else out


def implied_prob(odds: Column | str, strict: bool = False) -> Column:
    """Probability a price implies, bookmaker margin included. Price 0 is invalid."""
    o = _col(odds).cast("double")
    value = F.when(o < 0, F.abs(o) / (F.abs(o) + 100.0)).otherwise(F.lit(100.0) / (o + 100.0))
    return _guard(o != 0, value, strict, "American odds cannot be 0")


def decimal_odds(odds: Column | str, strict: bool = False) -> Column:
    """Payout per unit stake, the stake included."""
    o = _col(odds).cast("double")
    value = F.when(o < 0, F.lit(1.0) + F.lit(100.0) / F.abs(o)).otherwise(F.lit(1.0) + o / 100.0)
    return _guard(o != 0, value, strict, "American odds cannot be 0")


def overround(home: Column | str, away: Column | str) -> Column:
    """Sum of the two implied probabilities."""
    return implied_prob(home) + implied_prob(away)


def devig_two_way(home: Column | str, away: Column | str, strict: bool = False) -> Column:
    """``struct(fair_home, fair_away)``; invalid unless the book keeps a margin."""
    total = overround(home, away)
    fair = F.struct(
        (implied_prob(home) / total).alias("fair_home"),
        (implied_prob(away) / total).alias("fair_away"),
    )
    if strict:
        fair = F.when(F.assert_true(total > 1.0, "market has no margin").isNull(), fair)
    return F.when(total > 1.0, fair)


def vig_percent(home: Column | str, away: Column | str) -> Column:
    """Bookmaker margin in percent."""
    return (overround(home, away) - 1.0) * 100.0


def net_odds(odds: Column | str, strict: bool = False) -> Column:
    """Profit per unit stake when the bet wins."""
    return decimal_odds(odds, strict) - 1.0


def expected_value_at(prob: Column | str, net: Column | str, strict: bool = False) -> Column:
    """Expected profit per unit stake at given net odds.

    With the net odds in a column of their own, several expressions can share
    them; repeating the price formula instead makes generated code too long for
    the JVM to compile.
    """
    p, b = _col(prob), _col(net)
    return _guard(p.between(0.0, 1.0), p * b - (F.lit(1.0) - p), strict, "probability must be in [0, 1]")


def kelly_at(prob: Column | str, net: Column | str, scale: float = 1.0, strict: bool = False) -> Column:
    """Scaled growth-optimal stake at given net odds, never below zero."""
    if scale < 0:
        raise ValueError(f"scale must be >= 0, got {scale}")
    p, b = _col(prob), _col(net)
    edge = p * (b + 1.0) - 1.0
    # Net odds are positive, so the edge alone decides the sign.
    stake = F.when(edge <= 0, F.lit(0.0)).otherwise(edge / b * F.lit(float(scale)))
    return _guard(p.between(0.0, 1.0), stake, strict, "probability must be in [0, 1]")


def expected_value(prob: Column | str, odds: Column | str, strict: bool = False) -> Column:
    """Expected profit per unit stake."""
    return expected_value_at(prob, net_odds(odds, strict), strict)


def kelly_fraction(prob: Column | str, odds: Column | str, scale: float = 1.0, strict: bool = False) -> Column:
    """Scaled growth-optimal stake, never below zero."""
    return kelly_at(prob, net_odds(odds, strict), scale, strict)


def disagreement_pp(prob: Column | str, fair: Column | str) -> Column:
    """Distance of model and market in percentage points."""
    return F.abs(_col(prob) - _col(fair)) * 100.0
