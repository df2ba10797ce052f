"""Walk-forward folds, baselines, calibration and scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import nan_to_null

BASELINES = ("always_home", "better_win_pct", "better_ts_pct")
EPSILON = float(np.finfo(np.float64).eps)


# ---- folds -----------------------------------------------------------------


def walk_forward_cutoffs(frame: DataFrame, n_splits: int = 4, date: str = "game_date") -> list[dt.date]:
    """First test date of every fold.

    Distinct dates are ranked in Spark and cut into ``n_splits + 1`` runs of equal
    length, the last one taking the rest; only the ``n_splits`` cuts come back.
    """
    if n_splits < 1:
        raise ValueError(f"a walk forward takes at least one split, not {n_splits}")
    days = frame.select(F.to_date(date).alias("day")).filter("day is not null").distinct()
    ranked = days.select(
        "day",
        (F.row_number().over(Window.orderBy("day")) - 1).alias("place"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    ).withColumn("run", F.expr(f"n div {n_splits + 1}"))
    first_of_run = (F.col("place") > 0) & (F.col("place") % F.col("run") == 0)
    cuts = ranked.filter((F.col("run") > 0) & first_of_run & (F.col("place") <= F.col("run") * n_splits))
    found = [r["day"] for r in cuts.select("day").orderBy("day").collect()]
    if len(found) < n_splits:
        raise ValueError(f"{n_splits} folds take {n_splits + 1} different dates; the frame has too few")
    return found


def with_block(frame: DataFrame, cutoffs: Sequence[dt.date], date: str = "game_date") -> DataFrame:
    """Add ``block``: 0 is only ever trained on, block j is tested in fold j.

    A date belongs to one block, so no day is split between train and test. This
    is a projection: no join, no shuffle.
    """
    day = F.to_date(date)
    block = F.lit(0)
    for cutoff in cutoffs:
        block = block + (day >= F.lit(cutoff)).cast("int")
    return frame.withColumn("block", block)


def fold(frame: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one fold of a frame carrying ``block``."""
    return frame.filter(F.col("block") < number), frame.filter(F.col("block") == number)


def fold_summary(frame: DataFrame, date: str = "game_date") -> DataFrame:
    """Rows and date range per block."""
    return frame.groupBy("block").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.to_date(date)).alias("first_date"),
        F.max(F.to_date(date)).alias("last_date"),
    )


# ---- baselines -------------------------------------------------------------


def always_home() -> Column:
    return F.lit(1)


def better_side(home: Column | str, away: Column | str) -> Column:
    """1 where home is at least level; a missing side means away."""
    h = F.col(home) if isinstance(home, str) else home
    a = F.col(away) if isinstance(away, str) else away
    return F.coalesce(nan_to_null(h) >= nan_to_null(a), F.lit(False)).cast("int")


def baseline_picks(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {
            "always_home": always_home(),
            "better_win_pct": better_side("home_rolling_win_pct", "away_rolling_win_pct"),
            "better_ts_pct": better_side("home_rolling_ts_pct", "away_rolling_ts_pct"),
        }
    )


def _hit_rate(pick: str, label: str = "label") -> Column:
    return F.coalesce(F.avg((F.col(pick) == F.col(label)).cast("double")), F.lit(0.0))


def baseline_accuracies(frame: DataFrame) -> DataFrame:
    """One row: hit rate of each baseline, 0.0 on an empty frame."""
    return baseline_picks(frame).agg(*[_hit_rate(b).alias(b) for b in BASELINES])


# ---- calibration -----------------------------------------------------------


def bin_index(prob: Column | str, n_bins: int) -> Column:
    """Bin by comparing with the edges themselves: lower edge inside, upper edge
    outside, 1.0 in the last bin.

    ``floor(p * n)`` alone misplaces values such as 0.3, whose product rounds
    across the edge; one step either way puts them right.
    """
    p = F.col(prob) if isinstance(prob, str) else prob
    edges = F.array(*[F.lit(float(e)) for e in np.linspace(0.0, 1.0, n_bins + 1)])
    guess = F.least(F.floor(p * n_bins).cast("int"), F.lit(n_bins - 1))
    lower = F.get(edges, guess)
    upper = F.get(edges, guess + 1)
    return (
        F.when(p < lower, guess - 1)
        .when((p >= upper) & (guess < n_bins - 1), guess + 1)
        .otherwise(guess)
    )


def valid_score(prob: Column | str, label: Column | str) -> Column:
    """A score in [0, 1] with a label; never NULL."""
    p = (F.col(prob) if isinstance(prob, str) else prob).cast("double")
    y = F.col(label) if isinstance(label, str) else label
    return F.coalesce(~F.isnan(p) & p.between(0.0, 1.0) & y.isNotNull(), F.lit(False))


def calibration_bins(
    scored: DataFrame,
    prob: str = "model_home_win_prob",
    label: str = "label",
    n_bins: int = 10,
    strict: bool = False,
) -> DataFrame:
    """Reliability table: one row per bin, empty bins with NULL means.

    Rows without a label or with a score outside [0, 1] belong to no bin; every row
    of the table says how many there are (``invalid``). ``strict`` raises instead.
    The grouping has ``n_bins`` groups and partial aggregates, so every task sends
    at most ``n_bins`` rows.
    """
    if n_bins < 1:
        raise ValueError(f"at least one bin is needed, not {n_bins}")
    if strict:
        check_probabilities(scored, prob, label)
    edges = [float(e) for e in np.linspace(0.0, 1.0, n_bins + 1)]
    fine = valid_score(prob, label)
    grouped = (
        scored.select(F.col(prob).cast("double").alias("p"), F.col(label).cast("double").alias("y"), fine.alias("ok"))
        .groupBy(F.when(F.col("ok"), bin_index("p", n_bins)).otherwise(-1).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("p").alias("mean_pred"),
            F.avg("y").alias("actual_rate"),
        )
    )
    frame = scored.sparkSession.createDataFrame(
        [(-1, None, None), *((i, edges[i], edges[i + 1]) for i in range(n_bins))], "bin int, lower double, upper double"
    )
    # At most n_bins + 1 rows from here on, so the window holds them all.
    table = frame.join(F.broadcast(grouped), "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
    return (
        table.withColumn("invalid", F.max(F.when(F.col("bin") == -1, F.col("count"))).over(Window.partitionBy()))
        .filter("bin >= 0")
        .select("bin", "lower", "upper", "count", "mean_pred", "actual_rate", "invalid")
    )


def calibration_errors(bins: DataFrame) -> DataFrame:
    """One row: expected and maximum calibration error over the bins."""
    gap = F.abs(F.col("mean_pred") - F.col("actual_rate"))
    return bins.agg(
        F.sum("count").alias("n"),
        F.coalesce(F.sum(gap * F.col("count")) / F.sum("count"), F.lit(0.0)).alias("ece"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("mce"),
    )


def check_probabilities(scored: DataFrame, prob: str, label: str) -> None:
    """Raise for a frame without rows, or with a row that cannot be binned."""
    row = scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~valid_score(prob, label)).alias("bad")
    ).first()
    if row["n"] == 0:
        raise ValueError("nothing to check: the frame has no rows")
    if row["bad"]:
        raise ValueError(f"{row['bad']} of {row['n']} rows lack a label or a score between 0 and 1")


def reliability_lines(bins: DataFrame) -> DataFrame:
    """The reliability table as text, one line per bin."""
    span = F.format_string("%.2f to %.2f", "lower", "upper")
    gap = F.abs(F.col("mean_pred") - F.col("actual_rate"))
    full = F.format_string(
        "%s | n=%d | predicted %.4f | happened %.4f | apart %.4f", span, "count", "mean_pred", "actual_rate", gap
    )
    return bins.select("bin", F.when(F.col("count") > 0, full).otherwise(F.concat(span, F.lit(" | empty"))).alias("line"))


# ---- scores ----------------------------------------------------------------


def score_metrics(
    scored: DataFrame, prob: str = "model_home_win_prob", label: str = "label"
) -> DataFrame:
    """One row: n, accuracy at 0.5, log loss (clipped) and Brier score of the valid rows."""
    scored = scored.filter(valid_score(prob, label))
    p = F.col(prob).cast("double")
    y = F.col(label).cast("double")
    clipped = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    return scored.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(((p >= 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"),
        F.avg(-(y * F.ln(clipped) + (1.0 - y) * F.ln(1.0 - clipped))).alias("log_loss"),
        F.avg((p - y) * (p - y)).alias("brier"),
    )


def evaluation_row(scored: DataFrame, model: str, places: int = 6, n_bins: int = 10) -> DataFrame:
    """Scores, calibration errors and baselines of one model's valid held-out rows.

    One pass over the rows: per-bin sums first, then one row from the bins.
    """
    p = F.col("model_home_win_prob").cast("double")
    y = F.col("label").cast("double")
    clipped = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    parts = {
        "accuracy": ((p >= 0.5).cast("int") == F.col("label")).cast("double"),
        "log_loss": -(y * F.ln(clipped) + (1.0 - y) * F.ln(1.0 - clipped)),
        "brier": (p - y) * (p - y),
        **{b: (F.col(b) == F.col("label")).cast("double") for b in BASELINES},
    }
    per_bin = (
        baseline_picks(scored.filter(valid_score("model_home_win_prob", "label")))
        .groupBy(bin_index(p, n_bins).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(p).alias("sum_p"),
            F.sum(y).alias("sum_y"),
            *[F.sum(v).alias(k) for k, v in parts.items()],
        )
    )
    total = F.sum("n")
    gap = F.abs(F.col("sum_p") - F.col("sum_y"))
    numbers = {k: F.sum(k) / total for k in parts}
    numbers["ece"] = F.sum(gap) / total
    numbers["mce"] = F.max(gap / F.col("n"))
    return per_bin.agg(
        F.lit(model).alias("model"),
        F.coalesce(total, F.lit(0)).alias("n_test"),
        *[F.round(F.coalesce(v, F.lit(0.0)), places).alias(k) for k, v in numbers.items()],
    )


def evaluation_summary(rows: DataFrame, places: int = 6) -> DataFrame:
    """Per-model rows with the best baseline and each model's lead over it."""
    best = F.greatest(*BASELINES)
    return rows.withColumn("best_baseline", best).withColumn(
        "minus_best_baseline", F.round(F.col("accuracy") - best, places)
    )
