"""Weeks of a season as a common axis, and seasons compared along it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_season_week(rows: DataFrame, season: str = "season", date: str = "game_date") -> DataFrame:
    """Add ``season_week``: whole weeks since the season's first date, from 0.

    Weeks in which nobody plays keep their number. A row without a season or a date has
    none. Only a first date per season is joined, summed before the shuffle.
    """
    firsts = rows.groupBy(F.col(season).alias("__season")).agg(F.min(F.to_date(date)).alias("__first"))
    met = rows.join(firsts, F.col(season) == F.col("__season"), "left")
    week = F.floor(F.datediff(F.to_date(date), F.col("__first")) / 7).cast("int")
    return met.withColumn("season_week", week).drop("__season", "__first")


def season_deltas(
    rows: DataFrame,
    outputs: dict[str, Column],
    by: Sequence[str] = (),
    season: str = "season",
    date: str = "game_date",
) -> DataFrame:
    """Weekly statistics beside the same week of the season before, per ``by``.

    ``outputs`` maps names to aggregates. Returns ``by``, the season, ``season_week``
    and for each output its value, ``prev_`` value and ``delta_``. Weeks are aligned by
    number. A week that only one of two following seasons has is kept with nulls on the
    other side, as long as the later season exists at all; a season without one
    directly before it has no previous values.
    """
    keys = [*by, season, "season_week"]
    weekly = with_season_week(rows, season, date).filter("season_week is not null").groupBy(*keys).agg(
        *[agg.alias(name) for name, agg in outputs.items()]
    )
    before = weekly.select(
        *by, (F.col(season) + 1).cast(weekly.schema[season].dataType).alias(season), "season_week",
        *[F.col(name).alias(f"prev_{name}") for name in outputs],
    )
    seasons = rows.filter(F.col(date).isNotNull()).select(season).distinct()
    met = weekly.join(before, keys, "full").join(seasons, season, "left_semi")
    return met.select(
        *keys,
        *[c for name in outputs for c in (F.col(name), F.col(f"prev_{name}"), (F.col(name) - F.col(f"prev_{name}")).alias(f"delta_{name}"))],
    )
