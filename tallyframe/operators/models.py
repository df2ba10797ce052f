"""Win-probability models, evaluated without looking ahead: all fits of a walk forward in the same passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.schema import feature_columns
from tallyframe.session import cut_lineage
from tallyframe.sources.zones import path_is_missing

from .evaluate import evaluation_row, evaluation_summary, walk_forward_cutoffs, with_block
from .folds import stratified_folds
from .passes import (
    BoostSpec,
    Fits,
    Trees,
    boosted_trees,
    calibrator_pools,
    exact_medians,
    filled,
    moments,
    newton_logistic,
    probability,
    read_batch,
)
from .views import attach_pairs

MODELS = ("logreg", "boosted")
PRIMARY_MODEL = "boosted"
CALIBRATION_FOLDS = 5
GRID = 6


@dataclass(frozen=True)
class ModelSpec:
    """Which learner, how much work it may do, and into how many inner folds calibration deals its rows."""

    name: str = PRIMARY_MODEL
    calibrate: bool = True
    calibration_folds: int = CALIBRATION_FOLDS
    max_iter: int = 1000
    boosting_rounds: int = 100
    boosting_depth: int = 4

    def __post_init__(self) -> None:
        if self.name not in MODELS:
            raise ValueError(f"unknown model {self.name!r} (use one of {MODELS})")


@dataclass
class Part:
    """One fit: what fills missing inputs, then a line through scaled inputs or trees, then the calibrator's corners."""

    outer: int
    inner: int
    median: np.ndarray
    center: np.ndarray
    spread: np.ndarray
    coefficients: np.ndarray | None = None
    trees: Trees | None = None
    corner_score: np.ndarray | None = None
    corner_rate: np.ndarray | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Probabilities before calibration."""
        whole = filled(x, self.median)
        if self.trees is not None:
            return probability(self.trees.margin(whole))
        return probability((whole - self.center) / self.spread @ self.coefficients[:-1] + self.coefficients[-1])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities: lines between the corners of the pools, flat outside them."""
        out = self.raw(x)
        if self.corner_score is None or not len(self.corner_score):
            return out
        return np.interp(np.round(out, GRID), self.corner_score, self.corner_rate)


@dataclass
class FittedModel:
    """The fits of one training set; their outputs are averaged."""

    inputs: list[str]
    parts: list[Part]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sum(p.score(x) for p in self.parts) / len(self.parts)


# ---- fitting ------------------------------------------------------------------------


def _inputs(columns: Sequence[str]) -> Column:
    """Inputs as one array of doubles, NaN where missing."""
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in columns])


def design(blocked: DataFrame, spec: ModelSpec, inputs: Sequence[str], outers: int) -> DataFrame:
    """The stored matrix that every pass reads: ``label``, ``block``, ``inner`` folds and inputs ``x``."""
    folds = spec.calibration_folds if spec.calibrate else 1
    narrow = blocked.select(
        "game_id", F.col("label").cast("int").alias("label"), F.col("block").cast("int").alias("block"), _inputs(inputs).alias("x")
    )
    # A fold of one would hold every row out; without calibration nothing is.
    return cut_lineage(stratified_folds(narrow, folds, outers).select("label", "block", "inner", "x"))


def fit_sets(blocked: DataFrame, spec: ModelSpec, inputs: Sequence[str], outers: int) -> dict[int, FittedModel]:
    """A model for each training set: set j is the labelled rows with ``block < j``.

    Every step is a pass for all sets and inner folds together: exact medians, means
    and deviations, Newton steps or levels of trees, then one job for all calibrators.
    With calibration each inner fold fits on the other rows and calibrates on its own.
    """
    rows = design(blocked, spec, inputs, outers)
    fits = Fits(outers, spec.calibration_folds if spec.calibrate else 1)
    median = exact_medians(rows, fits, len(inputs))
    center, spread, counts = moments(rows, fits, median)
    parts = [Part(j, i, median[f], center[f], spread[f]) for f, (j, i) in enumerate(fits.members)]
    if spec.name == "logreg":
        solved = newton_logistic(rows, fits, median, center, spread, spec.max_iter)
        for part, values in zip(parts, solved):
            part.coefficients = values
    else:
        boost = BoostSpec(rounds=spec.boosting_rounds, depth=spec.boosting_depth)
        for part, trees in zip(parts, boosted_trees(rows, fits, median, counts, boost, cut_lineage)):
            part.trees = trees
    if spec.calibrate:
        pools = calibrator_pools(held_out_scores(rows, fits, parts)).orderBy("fit", "lo").collect()
        for f, part in enumerate(parts):
            own = [r for r in pools if r["fit"] == f]
            score = np.array([s for r in own for s in (r["lo"], r["hi"])])
            rate = np.array([r["rate"] for r in own for _ in (0, 1)])
            part.corner_score, at = np.unique(score, return_index=True)
            part.corner_rate = rate[at] if len(at) else rate
    return {j: FittedModel(list(inputs), [p for p in parts if p.outer == j]) for j in range(1, outers + 1)}


def held_out_scores(rows: DataFrame, fits: Fits, parts: Sequence[Part]) -> DataFrame:
    """``fit``, ``score`` and ``label`` of every row by each fit that held it out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            batch = read_batch(raw)
            for f, (member, part) in enumerate(zip(fits.members, parts)):
                mine = batch.held_out(member)
                if len(mine):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), f)), pa.array(part.raw(batch.x[mine])), pa.array(batch.label[mine])],
                        names=["fit", "score", "label"],
                    )

    return rows.mapInArrow(run, "fit long, score double, label double")


def fit(train: DataFrame, spec: ModelSpec, inputs: Sequence[str] | None = None) -> FittedModel:
    """Fit on exactly the rows given; rows without a label teach nothing."""
    wanted = list(inputs) if inputs is not None else feature_columns(train.columns)
    return fit_sets(train.drop("block").withColumn("block", F.lit(0)), spec, wanted, 1)[1]


# ---- scoring ------------------------------------------------------------------------


def _with_scores(df: DataFrame, inputs: Sequence[str], models: dict[int | None, FittedModel], out: str, block: str | None) -> DataFrame:
    """Rows plus a probability by the model of their block, or by the only one; other columns pass as Arrow."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    read = df.select(*[F.col(f"`{c}`") for c in keep], _inputs(inputs).alias("__x"))
    schema = T.StructType(read.schema.fields[:-1] + [T.StructField(out, T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            n = raw.num_rows
            x = raw.column(len(keep)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 1))
            made = np.full(n, np.nan)
            if n and block is None:
                made = models[None].score(x)
            elif n:
                number = raw.column(keep.index(block)).to_numpy(zero_copy_only=False)
                for j, model in models.items():
                    mine = np.flatnonzero(number == j)
                    if len(mine):
                        made[mine] = model.score(x[mine])
            yield pa.RecordBatch.from_arrays([*raw.columns[:-1], pa.array(made, pa.float64())], names=names)

    return read.mapInArrow(run, schema)


def predict(model: FittedModel, df: DataFrame, out: str = "model_home_win_prob") -> DataFrame:
    """Rows plus the home win probability, unrounded; null and NaN inputs are filled with the fits' medians."""
    return _with_scores(df, model.inputs, {None: model}, out, None)


def probability_expression(model: FittedModel) -> Column:
    """A logistic model without or with calibration as one expression over its input columns.

    Corners of the pools are searched as an array literal, so the expression has the
    same size whatever their number.
    """
    total = F.lit(0.0)
    for part in model.parts:
        margin = F.lit(float(part.coefficients[-1]))
        for c, m, mean, spread, w in zip(model.inputs, part.median, part.center, part.spread, part.coefficients):
            value = F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(float(np.nan_to_num(m))))
            margin = margin + (value - F.lit(float(mean))) / F.lit(float(spread)) * F.lit(float(w))
        raw = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        total = total + (raw if part.corner_score is None or not len(part.corner_score) else _between(raw, part))
    return total / F.lit(float(len(model.parts)))


def _between(raw: Column, part: Part) -> Column:
    """The line between the two corners around a score on the grid."""
    corners = F.array(
        *[F.struct(F.lit(float(s)).alias("s"), F.lit(float(r)).alias("r")) for s, r in zip(part.corner_score, part.corner_rate)]
    )
    # One step holds the score, so that it is computed once.
    one = F.transform(F.array(F.bround(raw, GRID)), lambda p: _line(p, corners))
    return F.get(one, F.lit(0))


def _line(p: Column, corners: Column) -> Column:
    nothing = F.lit(None).cast("struct<s:double,r:double>")
    low = F.aggregate(corners, nothing, lambda acc, c: F.when(c["s"] <= p, c).otherwise(acc))
    high = F.aggregate(F.reverse(corners), nothing, lambda acc, c: F.when(c["s"] >= p, c).otherwise(acc))
    slope = (high["r"] - low["r"]) / F.nullif(high["s"] - low["s"], F.lit(0.0))
    return (
        F.when(low.isNull(), high["r"])
        .when(high.isNull() | (high["s"] == low["s"]), low["r"])
        .otherwise(low["r"] + (p - low["s"]) * slope)
    )


def with_pick(scored: DataFrame, places: int | None = 4) -> DataFrame:
    """Add pick and hit. The pick uses the full probability; the stored one is
    rounded half to even."""
    pick = (F.col("model_home_win_prob") >= 0.5).cast("int")
    out = scored.withColumn("model_pick", pick).withColumn(
        "correct", (F.col("model_pick") == F.col("label")).cast("int")
    )
    if places is None:
        return out
    return out.withColumn("model_home_win_prob", F.bround("model_home_win_prob", places))


def walk_forward_scores(
    frame: DataFrame,
    spec: ModelSpec,
    n_splits: int = 4,
    inputs: Sequence[str] | None = None,
    prepared: bool = False,
) -> DataFrame:
    """Every test row of every fold, scored by a model that saw only earlier
    dates. The first block is never tested, hence absent.

    All folds are fitted in the same passes and scored in one job. ``prepared`` says
    that ``frame`` is already stored, so reading it repeatedly recomputes nothing.
    """
    stored = frame if prepared else cut_lineage(frame)
    blocked = with_block(stored, walk_forward_cutoffs(stored, n_splits))
    wanted = list(inputs) if inputs is not None else feature_columns(frame.columns)
    models = fit_sets(blocked, spec, wanted, n_splits)
    tested = blocked.filter(F.col("block") > 0)
    return _with_scores(tested, wanted, models, "model_home_win_prob", "block").withColumnRenamed("block", "fold")


def oof_scored_frame(frame: DataFrame, spec: ModelSpec, n_splits: int = 4, prepared: bool = False) -> DataFrame:
    """Held-out scorecard rows: ids, label, rounded probability, pick, hit."""
    meta = [c for c in ("game_id", "game_date", "home_team", "away_team", "label") if c in frame.columns]
    scored = with_pick(walk_forward_scores(frame, spec, n_splits, prepared=prepared))
    return scored.select(*meta, "model_home_win_prob", "model_pick", "correct")


def evaluate_walk_forward(frame: DataFrame, spec: ModelSpec, n_splits: int = 4, prepared: bool = False) -> DataFrame:
    """One row of held-out metrics beside the baselines on the same rows."""
    scored = walk_forward_scores(frame, spec, n_splits, prepared=prepared)
    return evaluation_row(scored, spec.name)


def evaluate_all(frame: DataFrame, specs: Sequence[ModelSpec], n_splits: int = 4) -> DataFrame:
    """All models on identical folds, with the best baseline and the lead over it."""
    stored = cut_lineage(frame)
    rows = [evaluate_walk_forward(stored, s, n_splits, prepared=True) for s in specs]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return evaluation_summary(out)


TABLE = T.StructType(
    [
        T.StructField("inner", T.IntegerType()),
        T.StructField("inputs", T.ArrayType(T.StringType())),
        *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("median", "center", "spread", "coefficients")),
        T.StructField("base", T.DoubleType()),
        T.StructField("feature", T.ArrayType(T.ArrayType(T.IntegerType()))),
        *(T.StructField(n, T.ArrayType(T.ArrayType(T.DoubleType()))) for n in ("threshold", "value")),
        *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("corner_score", "corner_rate")),
    ]
)


def model_table(spark: SparkSession, model: FittedModel) -> DataFrame:
    """A model as rows, one a fit: plain numbers that any engine can evaluate."""

    def values(x: np.ndarray | None) -> list | None:
        return None if x is None else x.tolist()

    rows = [
        (
            p.inner, model.inputs, values(p.median), values(p.center), values(p.spread), values(p.coefficients),
            None if p.trees is None else p.trees.base,
            *((None,) * 3 if p.trees is None else (values(p.trees.feature), values(p.trees.threshold), values(p.trees.value))),
            values(p.corner_score), values(p.corner_rate),
        )
        for p in model.parts
    ]
    return spark.createDataFrame(rows, TABLE)


def save_model(spark: SparkSession, model: FittedModel, path: str) -> str:
    """Save a fitted model's table under ``path``."""
    model_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def persist_model(frame: DataFrame, path: str, spec: ModelSpec = ModelSpec()) -> str:
    """Fit on all rows and save the model's table under ``path``."""
    return save_model(frame.sparkSession, fit(frame, spec), path)


def load_model(spark: SparkSession, path: str) -> FittedModel | None:
    """The saved model, or None where there is none. It has one row per inner fold."""
    try:
        rows = spark.read.schema(TABLE).parquet(path).orderBy("inner").collect()
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return None
    if not rows:
        return None

    def array(x: list | None) -> np.ndarray | None:
        return None if x is None else np.array(x)

    parts = [
        Part(
            1, r["inner"], array(r["median"]), array(r["center"]), array(r["spread"]), array(r["coefficients"]),
            None if r["feature"] is None else Trees(r["base"], array(r["feature"]), array(r["threshold"]), array(r["value"])),
            array(r["corner_score"]), array(r["corner_rate"]),
        )
        for r in rows
    ]
    return FittedModel(list(rows[0]["inputs"]), parts)


def predict_matchups(
    model: FittedModel, pairs: DataFrame, latest: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Requested pairs scored from both teams' newest rows, rounded to 4 places.
    The predicted winner uses the full probability."""
    scored = predict(model, attach_pairs(pairs, latest, columns), "home_win_prob")
    return scored.withColumn("predicted_home_win", F.col("home_win_prob") >= 0.5).withColumn(
        "home_win_prob", F.bround("home_win_prob", 4)
    )


def score_games(model: FittedModel, frame: DataFrame) -> DataFrame:
    """Training-frame rows with probability, pick and hit; no row is lost."""
    return with_pick(predict(model, frame))
