"""Model queries. Scores have no SQL twin; what they are made of has: medians, folds, the
solved equations of the linear model, leaf values, pools, and the stored model's scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.evaluate import walk_forward_cutoffs, with_block
from tallyframe.operators.folds import fold_sizes, stratified_folds
from tallyframe.operators.models import (
    ModelSpec,
    design,
    evaluate_all,
    fit,
    fit_sets,
    load_model,
    oof_scored_frame,
    persist_model,
    predict_matchups,
    probability_expression,
    save_model,
    score_games,
)
from tallyframe.operators.passes import BoostSpec, Fits, calibrator_pools, exact_medians, filled, probability, read_batch
from tallyframe.operators.training import chronological, training_frame_from_processed
from tallyframe.operators.windows import latest_per_entity, rolling_outputs, trailing
from tallyframe.schema import ROLLING_COLUMNS
from tallyframe.session import cut_lineage, scratch_path

from .base import WINDOW, sided_by_team, six
from .registry import query
from .reports import requested_pairs
from .training import FRAME, INPUTS, SCORED, frame, scored

LOGREG = ModelSpec("logreg")
BOOSTED = ModelSpec("boosted")


@query("oof_logreg")
def oof_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of four folds, each with its own calibrated fits."""
    return chronological(oof_scored_frame(frame(spark, sf_dir), LOGREG))


@query("evaluate_models")
def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both learners on the same folds beside the baselines."""
    return evaluate_all(frame(spark, sf_dir), [LOGREG, BOOSTED])


@query("score_games")
def games_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on all rows, save, load, score: the row count is kept."""
    rows = cut_lineage(frame(spark, sf_dir))
    model = load_model(spark, persist_model(rows, scratch_path(spark, "model"), LOGREG))
    return score_games(model, rows).select(
        "game_id", "game_date", "label", "model_home_win_prob", "model_pick", "correct"
    )


@query("predict_matchups")
def matchups_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of customer and supplier that has met, from their newest rows.

    What the model learns from and the newest rows come from one shuffle by team: both
    are asked for the same columns and stored together.
    """
    games, plan = sided_by_team(spark, sf_dir)
    features = trailing(games, rolling_outputs(games.columns), window=WINDOW, splits=plan)
    newest = latest_per_entity(
        features.select("team_abbreviation", "season", "game_date", "game_id", *ROLLING_COLUMNS)
    )
    rows = training_frame_from_processed(games, WINDOW, splits=plan)
    taught = rows.withColumn("newest", F.lit(False))
    known = newest.drop("game_date", "game_id").withColumn("newest", F.lit(True))
    both = cut_lineage(taught.unionByName(known, allowMissingColumns=True))
    model = fit(both.filter("not newest").select(*rows.columns), LOGREG)
    latest = both.filter("newest").select("team_abbreviation", *ROLLING_COLUMNS)
    out = predict_matchups(model, requested_pairs(spark, sf_dir), latest, ROLLING_COLUMNS)
    return out.select("home_team", "away_team", F.col("home_win_prob"), "predicted_home_win")


# ---- what the models are made of ------------------------------------------------------

SPLITS = 4
FOLDS = LOGREG.calibration_folds
_NAMES = [*INPUTS, "never_seen"]

# Walk-forward blocks of the frame's own dates, and its inputs as rows; one input never has a value.
_SETS = f"""{FRAME},
days AS (SELECT DISTINCT game_date AS day FROM frame),
placed AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () // {SPLITS + 1} AS per FROM days),
dealt AS (SELECT frame.*, NULL::DOUBLE AS never_seen, least(i // per, {SPLITS}) AS block FROM frame JOIN placed ON game_date = day WHERE label IS NOT NULL),
sets AS (SELECT j::INTEGER AS outer_fold, dealt.* FROM dealt, range(1, {SPLITS + 1}) AS t(j) WHERE block < j),
long AS (SELECT outer_fold, label, unnest([{', '.join(f'{c}::DOUBLE' for c in _NAMES)}]) AS v, unnest([{', '.join(f"'{c}'" for c in _NAMES)}]) AS input FROM sets),
medians AS (SELECT outer_fold, input, median(v) AS median FROM long GROUP BY outer_fold, input)"""


def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = cut_lineage(frame(spark, sf_dir)).withColumn("never_seen", F.lit(None).cast("double"))
    return with_block(games, walk_forward_cutoffs(games, SPLITS))


def _rows(spark: SparkSession, kinds: str, rows: list[tuple]) -> DataFrame:
    """Parameters of models, whose number does not depend on the rows."""
    return spark.createDataFrame(rows, kinds)


@query("imputer_medians", f"WITH {_SETS} SELECT outer_fold, input, round(median, 6) AS median FROM medians")
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median of every input in every walk-forward training set."""
    fits = Fits(SPLITS, 1)
    rows = design(_blocked(spark, sf_dir), ModelSpec("logreg", calibrate=False), _NAMES, SPLITS)
    found = exact_medians(rows, fits, len(_NAMES))
    out = [
        (j, c, None if np.isnan(m) else float(m))
        for (j, _), own in zip(fits.members, found)
        for c, m in zip(_NAMES, own)
    ]
    return six(_rows(spark, "outer_fold int, input string, median double", out), "median")


@query(
    "inner_folds",
    f"""WITH {_SETS}, n AS (SELECT outer_fold, label, count(*) AS n FROM sets GROUP BY ALL)
      SELECT outer_fold, i::INTEGER AS inner_fold, label, n // {FOLDS} + (i < n % {FOLDS})::INTEGER AS n_rows FROM n, range({FOLDS}) AS t(i) WHERE n // {FOLDS} + (i < n % {FOLDS})::INTEGER > 0""",
)
def inner_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each label in each calibration fold: they differ by one at most."""
    return fold_sizes(stratified_folds(_blocked(spark, sf_dir), FOLDS, SPLITS), SPLITS)


@query(
    "logreg_gradient",
    f"""WITH {_SETS}, whole AS (SELECT outer_fold, input, coalesce(v, median, 0) AS v FROM long JOIN medians USING (outer_fold, input))
      SELECT outer_fold, input, count(*) AS n_rows, round(avg(v), 6) AS center, round(CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END, 6) AS spread, 0.0::DOUBLE AS gradient
      FROM whole GROUP BY outer_fold, input
      UNION ALL SELECT outer_fold, 'intercept', count(*), 0, 1, 0 FROM sets GROUP BY outer_fold""",
)
def gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Penalised gradient at the stored coefficients, by plain aggregates: zero everywhere, to three decimals."""
    blocked = _blocked(spark, sf_dir).filter("label is not null")
    models = fit_sets(blocked, ModelSpec("logreg", calibrate=False), _NAMES, SPLITS)
    out = None
    for j, model in models.items():
        part = model.parts[0]
        scaled = {}
        for c, m, center, spread in zip(_NAMES, part.median, part.center, part.spread):
            value = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(np.nan_to_num(m))))
            scaled[c] = (value - float(center)) / float(spread)
        scaled["intercept"] = F.lit(1.0)
        error = probability_expression(model) - F.col("label")
        # One aggregate an input, all in one pass.
        summed = blocked.filter(F.col("block") < j).withColumn("__error", error).agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(z * F.col("__error")) for z in scaled.values()]).alias("g")
        )
        terms = [
            F.struct(
                F.lit(c).alias("input"), F.lit(float(center)).alias("center"), F.lit(float(spread)).alias("spread"),
                F.lit(0.0 if c == "intercept" else float(w)).alias("pull"),
            )
            for c, center, spread, w in zip(scaled, [*part.center, 0.0], [*part.spread, 1.0], part.coefficients)
        ]
        rows = summed.select(F.lit(j).alias("outer_fold"), "n", F.explode(F.arrays_zip("g", F.array(*terms).alias("t"))).alias("x"))
        one = rows.select(
            "outer_fold", F.col("x.t.input").alias("input"), F.col("n").alias("n_rows"), F.col("x.t.center").alias("center"),
            F.col("x.t.spread").alias("spread"), (F.round(F.col("x.g") + F.col("x.t.pull"), 3) + 0.0).alias("gradient"),
        )
        out = one if out is None else out.unionByName(one)
    return six(out, "center", "spread")


LEAF_ROUNDS = 5


@query(
    "boosted_leaves",
    f"""WITH {_SETS}, n AS (SELECT label, count(*) AS n FROM sets WHERE outer_fold = {SPLITS} GROUP BY label)
      SELECT i::INTEGER AS inner_fold, k::INTEGER AS tree, sum(n - n // {FOLDS} - (i < n % {FOLDS})::INTEGER)::BIGINT AS n_rows, 0.0::DOUBLE AS apart
      FROM n, range({FOLDS}) AS t(i), range({LEAF_ROUNDS}) AS u(k) GROUP BY i, k""",
)
def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf values of the first rounds recomputed by sums over each row's stored leaf.

    The last training set is the one looked at, so it is the only one fitted.
    ``apart`` is the largest distance from the model's own values, to six decimals.
    """
    spec = ModelSpec("boosted", boosting_rounds=LEAF_ROUNDS)
    last = _blocked(spark, sf_dir).filter(F.col("block") < SPLITS).withColumn("block", F.lit(0))
    parts = fit_sets(last, spec, _NAMES, 1)[1].parts
    rows = design(last, spec, _NAMES, 1)
    step = BoostSpec().step

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows, pull and curvature of a batch by fit, tree and leaf."""
        for raw in batches:
            if not raw.num_rows:
                continue
            batch = read_batch(raw)
            for part in parts:
                mine = batch.training((1, part.inner))
                whole = filled(batch.x[mine], part.median)
                margin = np.full(len(mine), part.trees.base)
                for k in range(LEAF_ROUNDS):
                    leaf, own = part.trees.leaf(k, whole), part.trees.value[k]
                    p = probability(margin)
                    n, pull, curve = (np.bincount(leaf, weights=w, minlength=len(own)) for w in (None, p - batch.label[mine], p * (1 - p)))
                    met = np.flatnonzero(n)
                    ids = [pa.array(np.full(len(met), v), pa.int32()) for v in (part.inner, k)]
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array(met, pa.int64()), pa.array(n[met], pa.int64()), *(pa.array(v[met]) for v in (pull, curve, own))],
                        names=["inner_fold", "tree", "leaf", "n", "pull", "curve", "stored"],
                    )
                    margin = margin + own[leaf]

    kinds = "inner_fold int, tree int, leaf long, n long, pull double, curve double, stored double"
    by_leaf = rows.mapInArrow(assign, kinds).groupBy("inner_fold", "tree", "leaf").agg(
        F.sum("n").alias("n"),
        (F.sum("pull") * -step / F.sum("curve")).alias("again"),
        F.max("stored").alias("high"),
        F.min("stored").alias("low"),
    )
    worst = F.greatest(F.max(F.abs(F.col("again") - F.col("high"))), F.max(F.abs(F.col("again") - F.col("low"))))
    return by_leaf.groupBy("inner_fold", "tree").agg(F.sum("n").alias("n_rows"), (F.round(worst, 6) + 0.0).alias("apart"))


@query(
    "calibrator_pools",
    f"""WITH {SCORED}, points AS (SELECT label AS fit, floor(home_games_in_window * 2.5::DOUBLE + model_home_win_prob * 75 + 0.000001) / 100 AS s, season % 2 AS y FROM scored WHERE label IS NOT NULL),
      p AS (SELECT fit, s, count(*) AS n, sum(y) AS hits FROM points WHERE s BETWEEN 0 AND 1 GROUP BY fit, s),
      c AS (SELECT fit, s, n, sum(n) OVER w AS cn, sum(hits) OVER w AS ch, hits FROM p WINDOW w AS (PARTITION BY fit ORDER BY s)),
      seg AS (SELECT a.fit, a.s AS a, b.s AS b, (b.ch - a.ch + a.hits)::DOUBLE / (b.cn - a.cn + a.n) AS rate FROM c a JOIN c b ON a.fit = b.fit AND a.s <= b.s),
      low AS (SELECT seg.fit, a, p.s, min(rate) AS rate FROM seg JOIN p ON p.fit = seg.fit AND p.s BETWEEN seg.a AND seg.b GROUP BY ALL),
      value AS (SELECT fit, s, max(rate) AS rate FROM low GROUP BY fit, s)
      SELECT fit::BIGINT AS fit, round(min(s), 6) AS lo, round(max(s), 6) AS hi, sum(n)::DOUBLE AS weight, round(rate, 6) AS rate FROM value JOIN p USING (fit, s) GROUP BY fit, value.rate""",
)
def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pools of two calibrators at once; SQL finds them by the largest mean to the left of the smallest to the right."""
    points = scored(spark, sf_dir).filter("label is not null").select(
        F.col("label").cast("long").alias("fit"),
        (F.floor(F.col("home_games_in_window") * 2.5 + F.col("model_home_win_prob") * 75 + 0.000001) / 100).alias("score"),
        (F.col("season") % 2).alias("label"),
    )
    return six(calibrator_pools(points), "lo", "hi", "rate")


@query("stored_model", f"WITH {FRAME} SELECT game_id::VARCHAR AS game_id, label, true AS same_score, true AS same_pick FROM frame")
def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table of a calibrated model evaluated as one SQL expression, beside the scores of the fitted model."""
    rows = cut_lineage(frame(spark, sf_dir))
    spec = LOGREG
    model = fit(rows, spec)
    path = scratch_path(spark, "model")
    save_model(spark, model, path)
    both = score_games(model, rows).withColumn("again", probability_expression(load_model(spark, path)))
    return both.select(
        "game_id",
        "label",
        (F.abs(F.bround("again", 4) - F.col("model_home_win_prob")) < 1.1e-4).alias("same_score"),
        ((F.col("again") >= 0.5).cast("int") == F.col("model_pick")).alias("same_pick"),
    )
