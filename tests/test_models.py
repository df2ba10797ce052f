import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import evaluate as E
from tallyframe.operators import folds as FO
from tallyframe.operators import models as M
from tallyframe.operators import passes as P
from tallyframe.schema import ROLLING_COLUMNS, conform, training_schema

from .conftest import exchanges, rows

FAST = M.ModelSpec("logreg", calibration_folds=2, max_iter=50)


@pytest.fixture(scope="module")
def frame(spark):
    """Label is a threshold on home points; three games a day; one column is all missing."""
    rng = random.Random(0)
    data = []
    for i in range(240):
        pts = rng.uniform(95, 115)
        data.append((f"g{i:03d}", dt.date(2026, 1, 1) + dt.timedelta(days=i // 3), 2025, "A", "B", pts, 0.0, None if i % 7 else 1.0, int(pts >= 105)))
    df = spark.createDataFrame(data, "game_id string, game_date date, season int, home_team string, away_team string, home_rolling_pts double, away_rolling_pts double, away_rolling_pace double, label int")
    out = conform(df, training_schema()).withColumns({"home_rolling_win_pct": F.lit(0.5), "away_rolling_win_pct": F.lit(0.5)})
    return out.cache()


def test_logreg_matches_the_closed_objective(spark, frame):
    """Coefficients solve sum(log loss) + |w|^2 / 2 on standardised inputs."""
    inputs = ["home_rolling_pts", "away_rolling_pace"]
    part = M.fit(frame, M.ModelSpec("logreg", calibrate=False), inputs).parts[0]
    pdf = frame.select(*inputs, "label").toPandas()
    x = pdf[inputs].to_numpy(float)
    median = np.nanmedian(x, axis=0)
    x = np.where(np.isnan(x), median, x)
    spread = np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    assert part.median == pytest.approx(median) and part.center == pytest.approx(x.mean(axis=0)) and part.spread == pytest.approx(spread)
    x, y = (x - x.mean(axis=0)) / spread, pdf.label.to_numpy(float)
    w = np.zeros(x.shape[1] + 1)
    full, penalty = np.c_[x, np.ones(len(x))], np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(full @ w)))
        w = w - np.linalg.solve(full.T @ (full * (p * (1 - p))[:, None]) + penalty + 1e-12 * np.eye(len(w)), full.T @ (p - y) + penalty @ w)
    assert part.coefficients == pytest.approx(w, abs=1e-6)


@pytest.mark.parametrize("folds", [1, 3])
def test_medians_are_exact_in_every_fit(spark, folds):
    rng = random.Random(5)
    odd = [None, float("nan"), 0.0, -0.0, -1e300, 1e300, 5e-324, -2.5, 1e-9]
    data = []
    for i in range(301):
        x = [rng.choice(odd) if rng.random() < 0.3 else rng.gauss(0, 10 ** rng.randint(-5, 5)), rng.choice([1.0, 2.0, 2.0]), None, None if i else 7.0]
        data.append((f"g{i}", i % 3, rng.choice([0, 1, None]), *x))
    df = spark.createDataFrame(data, "game_id string, block int, label int, a double, b double, c double, d double").repartition(3)
    rows_ = M.design(df, M.ModelSpec("logreg", calibrate=folds > 1, calibration_folds=folds), ["a", "b", "c", "d"], 3)
    fits = P.Fits(3, folds)
    got = P.exact_medians(rows_, fits, 4)
    stored = rows_.collect()
    for f, (j, i) in enumerate(fits.members):
        mine = [r for r in stored if r.inner[j - 1] >= 0 and r.inner[j - 1] != i]
        assert mine and all(r.block < j and r.label is not None for r in mine)
        for c in range(4):
            values = [r.x[c] for r in mine if not np.isnan(r.x[c])]
            assert got[f, c] == np.median(values) if values else np.isnan(got[f, c])


def test_folds_are_stratified_in_every_outer_set(spark):
    rng = random.Random(1)
    data = [(f"g{i}", rng.randint(0, 4), rng.choice([0, 0, 0, 1, None])) for i in range(500)] + [("g1", 0, 1), (None, 0, 1)]
    df = spark.createDataFrame(data, "game_id string, block int, label int")
    sizes = FO.fold_sizes(FO.stratified_folds(df.repartition(5), 5, 4), 4).collect()
    for j in range(1, 5):
        for label in (0, 1):
            want = sum(b < j and y == label for _, b, y in data)
            own = {r.inner_fold: r.n_rows for r in sizes if r.outer_fold == j and r.label == label}
            assert [own.get(i, 0) for i in range(5)] == [want // 5 + (i < want % 5) for i in range(5)]
    assert FO.stratified_folds(df.limit(0), 5, 4).collect() == []


def pools_by_hand(points):
    """Isotonic fit as the largest mean to the left of the smallest mean to the right, point by point."""
    ps = sorted(points)
    fit = [max(min(np.average([p[1] for p in ps[a : b + 1]], weights=[p[2] for p in ps[a : b + 1]]) for b in range(i, len(ps))) for a in range(i + 1)) for i in range(len(ps))]
    out = []
    for p, v in zip(ps, fit):
        if out and abs(out[-1][3] - v) < 1e-12:
            out[-1] = (out[-1][0], p[0], out[-1][2] + p[2], v)
        else:
            out.append((p[0], p[0], p[2], v))
    return out


def test_pools_equal_brute_force_and_merge_in_any_grouping(spark):
    rng = random.Random(8)
    data = [(f, round(rng.random(), 2), float(rng.random() < 0.3 + 0.4 * (f == 1))) for f in range(3) for _ in range(150)]
    bad = [(0, None, 1.0), (0, 1.5, 1.0), (0, float("nan"), 0.0), (0, 0.5, None), (7, None, None)]
    got = P.calibrator_pools(spark.createDataFrame(data + bad, "fit long, score double, label double").repartition(4)).collect()
    assert {r.fit for r in got} == {0, 1, 2}
    for f in range(3):
        points = {}
        for _, s, y in (d for d in data if d[0] == f):
            n, hits = points.get(s, (0, 0.0))
            points[s] = (n + 1, hits + y)
        want = pools_by_hand([(s, hits / n, n) for s, (n, hits) in points.items()])
        own = sorted((r.lo, r.hi, r.weight, r.rate) for r in got if r.fit == f)
        assert [o[:3] for o in own] == [w[:3] for w in want]
        assert [o[3] for o in own] == pytest.approx([w[3] for w in want])
        table = np.array([(s, s, n, hits) for s, (n, hits) in sorted(points.items())])
        for cut in (1, 17, 50):
            halves = np.vstack([P.pool(table[:cut]), P.pool(table[cut:])])
            assert P.pool(halves).tolist() == P.pool(table).tolist()


def test_boosting_equals_growing_trees_by_hand(spark):
    """Same splits and leaves as a direct search over all thresholds, tree after tree."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (160, 3)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 7) ^ (rng.random(160) < 0.15)).astype(int)
    data = [(f"g{i}", *map(float, r), int(l)) for i, (r, l) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "game_id string, a double, b double, c double, label int").repartition(3)
    spec = M.ModelSpec("boosted", calibrate=False, boosting_rounds=12, boosting_depth=3)
    part = M.fit(df, spec, ["a", "b", "c"]).parts[0]

    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))

    def grow(rows_, depth, g, h, out):
        if depth:
            whole = g[rows_].sum() ** 2 / h[rows_].sum()
            best = (1e-9, None)
            for c in range(3):
                for t in np.unique(x[:, c])[:-1]:
                    left, right = rows_[x[rows_, c] <= t], rows_[x[rows_, c] > t]
                    if min(len(left), len(right)) < 5:
                        continue
                    gain = g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum() - whole
                    if gain > best[0] + 1e-12:
                        best = (gain, (left, right))
            if best[1]:
                for side in best[1]:
                    grow(side, depth - 1, g, h, out)
                return
        out[rows_] = -0.1 * g[rows_].sum() / h[rows_].sum()

    for _ in range(12):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 3, p - y, p * (1 - p), step)
        margin = margin + step
    assert part.trees.margin(x) == pytest.approx(margin, abs=1e-9)


def test_boosting_stops_when_held_out_rows_gain_nothing(spark):
    rng = random.Random(2)
    data = [(f"g{i}", rng.random(), rng.randint(0, 1)) for i in range(200)]
    df = spark.createDataFrame(data, "game_id string, a double, label int")
    model = M.fit(df, M.ModelSpec("boosted", calibration_folds=2, boosting_rounds=60, boosting_depth=2), ["a"])
    assert all(len(p.trees.feature) < 30 for p in model.parts)


def test_a_logistic_model_is_one_expression(spark, frame):
    model = M.fit(frame, FAST, ["home_rolling_pts", "away_rolling_pace", "away_rolling_pts"])
    both = M.predict(model, frame.withColumn("MODEL_home_win_prob", F.lit("x"))).withColumn("again", M.probability_expression(model))
    assert all(r.model_home_win_prob == pytest.approx(r.again, abs=1e-12) for r in both.collect())


def test_walk_forward_beats_always_home(spark, frame):
    scored = M.oof_scored_frame(frame, FAST, n_splits=2).cache()
    metrics = E.score_metrics(scored).first()
    home = scored.agg(F.avg("label")).first()[0]
    assert metrics.accuracy > 0.8 and metrics.accuracy > home
    blocked = E.with_block(frame, E.walk_forward_cutoffs(frame, 2))
    assert scored.count() == blocked.filter("block > 0").count()
    assert scored.filter("correct <> cast(model_pick = label as int)").isEmpty()
    assert scored.filter("model_home_win_prob not between 0 and 1").isEmpty()


def test_same_seed_same_scores(spark, frame):
    one, two = (M.oof_scored_frame(frame, FAST, n_splits=1) for _ in range(2))
    assert rows(one, "game_id", "model_home_win_prob") == rows(two, "game_id", "model_home_win_prob")


def test_boosted_and_summary(spark, frame):
    boosted = M.ModelSpec("boosted", boosting_rounds=2, boosting_depth=2, calibration_folds=2)
    table = {r.model: r for r in M.evaluate_all(frame, [FAST, boosted], n_splits=1).collect()}
    assert set(table) == {"logreg", "boosted"}
    for r in table.values():
        assert r.accuracy > 0.8 and r.mce >= r.ece
        assert r.best_baseline == max(r.always_home, r.better_win_pct, r.better_ts_pct)
        assert r.minus_best_baseline == pytest.approx(r.accuracy - r.best_baseline, abs=1e-6)
    with pytest.raises(ValueError):
        M.ModelSpec("other")


def test_calibration_is_monotone_in_each_fold(spark, frame):
    model = M.fit(frame, FAST)
    assert len(model.parts) == 2
    for p in model.parts:
        assert list(p.corner_rate) == sorted(p.corner_rate) and len(p.corner_score) == len(set(p.corner_score))


def test_folds_do_not_depend_on_row_order(spark, frame):
    plain = frame.select("game_id", "label", F.lit(0).alias("block"))
    a, b = (FO.stratified_folds(x, 5).select("game_id", F.col("inner")[0]) for x in (plain, plain.repartition(7)))
    assert rows(a) == rows(b) and {r[1] for r in a.collect()} == set(range(5))


def test_save_load_score_and_matchups(spark, frame, tmp_path):
    path = str(tmp_path / "model")
    assert M.load_model(spark, path) is None
    M.persist_model(frame, path, FAST)
    model = M.load_model(spark, path)
    scored = M.score_games(model, frame)
    assert scored.count() == frame.count()
    direct = M.score_games(M.fit(frame, FAST), frame)
    for kind in (FAST, M.ModelSpec("boosted", boosting_rounds=3, calibration_folds=2)):
        M.persist_model(frame, f"{path}-{kind.name}", kind)
        one, two = (M.predict(m, frame) for m in (M.fit(frame, kind), M.load_model(spark, f"{path}-{kind.name}")))
        assert rows(one, "game_id", "model_home_win_prob") == rows(two, "game_id", "model_home_win_prob")
    assert rows(scored, "game_id", "model_home_win_prob") == rows(direct, "game_id", "model_home_win_prob")
    latest = spark.createDataFrame([("X", 114.0), ("Y", 96.0)], "team_abbreviation string, rolling_pts double")
    latest = latest.withColumns({c: F.lit(None).cast("double") for c in ROLLING_COLUMNS if c != "rolling_pts"})
    pairs = spark.createDataFrame([("X", "Y"), ("Y", "X"), ("X", "X")], "home_team string, away_team string")
    out = {r.home_team: r for r in M.predict_matchups(model, pairs, latest, ROLLING_COLUMNS).collect()}
    assert out["X"].predicted_home_win and not out["Y"].predicted_home_win and len(out) == 2


def test_registered_queries_use_the_default_specs():
    from tallyframe.catalog import models as registered

    assert registered.LOGREG == M.ModelSpec("logreg")
    assert registered.BOOSTED == M.ModelSpec("boosted")


def test_cut_points_are_exact_quantiles(spark):
    n = 60_000
    df = spark.range(n).select(
        F.col("id").cast("string").alias("game_id"), F.lit(0).alias("block"), (F.col("id") % 2).cast("int").alias("label"),
        (F.rand(3) * 1000).alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit(None).cast("double").alias("c"),
    )
    rows_ = M.design(df, M.ModelSpec("boosted", calibration_folds=3), ["a", "b", "c"], 1)
    x = np.array([r.x for r in rows_.select("x").collect()])
    cuts = P.bin_edges(rows_, 1, 3)[0]
    places = [-(-n * i // P.BINS) - 1 for i in range(1, P.BINS)]
    assert cuts[0].tolist() == np.sort(x[:, 0])[places].tolist()
    assert cuts[1].tolist() == list(range(7)) and cuts[2].tolist() == []


@pytest.mark.parametrize("step", ["medians", "moments"])
def test_a_row_is_summed_once_a_set_not_once_a_fit(spark, frame, monkeypatch, step):
    """20 fits of four sets send the sums of four."""
    blocked = E.with_block(frame, E.walk_forward_cutoffs(frame, 4))
    rows_ = M.design(blocked, M.ModelSpec("logreg"), ["home_rolling_pts", "away_rolling_pace"], 4)
    batch = P.read_batch(rows_.toArrow().combine_chunks().to_batches()[0])
    sent = []

    def spy(rows, partial, finish=None):
        sent.append(len(list(partial(batch))))
        raise InterruptedError

    monkeypatch.setattr(P, "summed", spy)
    fits = P.Fits(4, 5)
    with pytest.raises(InterruptedError):
        P.exact_medians(rows_, fits, 2) if step == "medians" else P.moments(rows_, fits, np.zeros((20, 2)))
    assert sent == [8 if step == "medians" else 4]


def test_places_in_a_level_are_those_of_the_tree():
    rng = np.random.default_rng(4)
    bins, depth = rng.integers(0, P.BINS, (3, 500)).astype(np.uint8), 4
    feature, cut = rng.integers(-1, 3, 15), rng.integers(0, P.BINS, 15)
    every = np.arange(500)
    assert P.place_in_level(bins, feature, cut, depth).tolist() == P._leaf(lambda f, node: bins[f, every] > cut[node], feature, 500).tolist()


def test_queries_fit_no_model_twice_and_no_set_in_vain(spark, sf_dir, monkeypatch):
    from tallyframe.catalog import models as registered

    asked = []
    real = M.fit_sets
    monkeypatch.setattr(M, "fit_sets", lambda blocked, spec, inputs, outers: asked.append(outers) or real(blocked, spec, inputs, outers))
    assert registered.stored(spark, sf_dir).filter("not (same_score and same_pick)").isEmpty()
    assert asked == [1]
    monkeypatch.setattr(registered, "fit_sets", lambda blocked, spec, inputs, outers: asked.append(outers) or real(blocked, spec, inputs, outers))
    assert registered.leaves(spark, sf_dir).filter("apart <> 0").isEmpty()
    assert asked == [1, 1]


def test_dealt_pairs_move_once_they_are_wide(spark):
    """Pairs that lie by away team meet its row there: one shuffle for them, one of wide rows, one of each side's rows."""
    from tallyframe.operators.views import attach_pairs

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "team_abbreviation string, v double")
        pairs = spark.createDataFrame([("A", "B"), ("A", "B"), ("C", "B"), ("A", "A"), ("A", "Z")], "home_team string, away_team string")
        out = attach_pairs(pairs.repartition("away_team").distinct(), latest, ["v"])
        assert rows(out) == [("B", "A", 1.0, 2.0), ("B", "C", 3.0, 2.0)] and out.columns == ["away_team", "home_team", "home_v", "away_v"]
        assert exchanges(out) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
