"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn over one feature at a time, so that their sum is
one lookup table per feature; then over chosen pairs of features on what is left.
A score is the sum of the looked-up values, put through the logistic function.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import append_columns

FEATURES = (
    "log_chars log_words word_length upper lower digit space newline stop comma bang bar symbol high "
    "distinct_words repeated_next distinct_lines line_words capital_words alpha_words"
).split()

_CLASSES = {  # character classes by share of bytes; fixed values
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\x0b\f\r",
    "newline": b"\n",
    "stop": b".;:?",
    "comma": b",'\"()-",
    "bang": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "high": bytes(range(128, 256)),
}


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for i, members in enumerate(_CLASSES.values(), 1):
        table[list(members)] = i
    return table


def text_features(text: str | None, table: np.ndarray) -> list[float]:
    """Numbers of a whole text in the order of ``FEATURES``; a null text is an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(data), 1)
    shares = np.bincount(table[np.frombuffer(data, dtype=np.uint8)], minlength=len(_CLASSES) + 1)[1:] / n
    raw = data.split()
    words = data.lower().split()
    n_words = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n_words,
        *shares.tolist(),
        len(set(words)) / n_words,
        sum(map(operator.eq, words, words[1:])) / n_words,
        len(set(lines)) / n_lines,
        len(words) / n_lines,
        sum(map(bytes.isupper, raw)) / n_words,
        sum(map(bytes.isalpha, raw)) / n_words,
    ]


def _start_features():
    table = _class_table()
    return lambda texts: [[text_features(t, table) for t in texts]]


_FEATURES = ("features", T.ArrayType(T.DoubleType()))


# ---- the model ----------------------------------------------------------------


@dataclass(frozen=True)
class GamSpec:
    """Sizes of the model. ``max_rows`` bounds the labelled rows it is fitted on."""

    bins: int = 32
    rounds: int = 300
    rate: float = 0.1
    leaves: int = 3
    pairs: int = 8
    pair_bins: int = 8
    pair_rounds: int = 100
    min_hessian: float = 3.0
    ridge: float = 1.0
    max_rows: int = 50_000


@dataclass
class Gam:
    """Borders of the bins, one table per feature and one per pair."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        fine = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for p in self.pairs for j in p}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            out += table[fine[a], fine[b]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _borders(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: float, h: float, spec: GamSpec) -> float:
    return g / (h + spec.ridge)


def _tree(g: np.ndarray, h: np.ndarray, spec: GamSpec, leaves: int) -> tuple[np.ndarray, float]:
    """Values per bin of the best tree over one ordered feature, and its gain."""
    parts, gain = [(0, len(g))], 0.0
    cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    while len(parts) < leaves:
        best = None
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            cuts = np.arange(lo + 1, hi)
            gl, hl = cg[cuts] - cg[lo], ch[cuts] - ch[lo]
            gr, hr = cg[hi] - cg[cuts], ch[hi] - ch[cuts]
            ok = (hl >= spec.min_hessian) & (hr >= spec.min_hessian)
            if not ok.any():
                continue
            whole = (cg[hi] - cg[lo]) ** 2 / (ch[hi] - ch[lo] + spec.ridge)
            won = np.where(ok, gl**2 / (hl + spec.ridge) + gr**2 / (hr + spec.ridge) - whole, -np.inf)
            at = int(np.argmax(won))
            if best is None or won[at] > best[0]:
                best = (float(won[at]), k, int(cuts[at]))
        if best is None or best[0] <= 0:
            break
        gain += best[0]
        lo, hi = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(lo, best[2]), (best[2], hi)]
    values = np.zeros(len(g))
    for lo, hi in parts:
        values[lo:hi] = _leaf(cg[hi] - cg[lo], ch[hi] - ch[lo], spec)
    return values, gain


def _pair_tree(g: np.ndarray, h: np.ndarray, spec: GamSpec) -> tuple[np.ndarray, float]:
    """Values of the best two-level tree: one cut of a feature, then one of the other on each side."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, gg.shape[0]):
            values, gain = np.zeros_like(gg), 0.0
            for side in (slice(0, cut), slice(cut, gg.shape[0])):
                own, won = _tree(gg[side].sum(0), hh[side].sum(0), spec, 2)
                values[side] = own
                gain += won + gg[side].sum() ** 2 / (hh[side].sum() + spec.ridge)
            gain -= gg.sum() ** 2 / (hh.sum() + spec.ridge)
            if gain > best[0]:
                best = (gain, values.T if flip else values)
    return best[1], best[0]


def fit_gam(x: np.ndarray, y: np.ndarray, spec: GamSpec) -> Gam:
    """Cyclic boosting on logistic loss; the order of rows does not matter."""
    base = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Gam(float(np.log(base / (1 - base))), [], [])
    if not len(y) or y.min() == y.max():
        model.edges = [np.zeros(0)] * x.shape[1]
        model.tables = [np.zeros(1)] * x.shape[1]
        return model
    model.edges = [_borders(x[:, j], spec.bins) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    codes = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    logits = np.full(len(y), model.intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(spec.rounds):
        for j, code in enumerate(codes):
            size = len(model.tables[j])
            if size < 2:
                continue
            g, h = gradient()
            values, _ = _tree(np.bincount(code, g, size), np.bincount(code, h, size), spec, spec.leaves)
            model.tables[j] += spec.rate * values
            logits += spec.rate * values[code]

    model.coarse = [_borders(x[:, j], spec.pair_bins) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]
    g, h = gradient()

    def cells(a: int, b: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], w, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    gains = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            if sizes[a] > 1 and sizes[b] > 1:
                gains.append((-_pair_tree(cells(a, b, g), cells(a, b, h), spec)[1], a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains)[: spec.pairs]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(spec.pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = gradient()
            values, gain = _pair_tree(cells(a, b, g), cells(a, b, h), spec)
            if gain > 0:
                model.pair_tables[k] += spec.rate * values
                logits += spec.rate * values[coarse[a], coarse[b]]
    return model


# ---- on tables ----------------------------------------------------------------


def held_out(id_col: Column) -> Column:
    """Every fifth document by the checksum of its id is never learned from."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def labelled_sample(labels: DataFrame, label: str, spec: GamSpec, id_col: str) -> DataFrame:
    """Id and label of rows that may be learned from: all of them, or a hash sample of about ``spec.max_rows``."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(label).alias("label"))
    )
    n = known.count()
    if n > spec.max_rows:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(spec.max_rows / n * (1 << 32)))
    return known


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    spec: GamSpec | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Gam:
    """The model learned from labelled documents that are not held out.

    Their ids, bounded by ``spec.max_rows``, are broadcast to the documents, so no
    text is shuffled; 20 numbers of each reach the driver. Rows of labels that are
    null, neither 0 nor 1, or without a document teach nothing; of several labels of
    one id the larger counts. Without labels of both kinds every score is the share
    of label 1 (one half if there are none).
    """
    spec = spec or GamSpec()
    sample = F.broadcast(labelled_sample(labels, label, spec, id_col))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    learn = append_columns(source.join(sample, "id"), "text", [_FEATURES], _start_features, ["id", "label"])
    rows = learn.collect()
    rows.sort(key=lambda r: (r["id"], r["features"]))
    x = np.array([r["features"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit_gam(x, np.array([r["label"] for r in rows], dtype=float), spec)


def score_quality(
    docs: DataFrame, model: Gam, text_col: str = "text", name: str = "score", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) and the model's score, 0 to 1, of every row of ``docs``.

    Scores depend on the whole text alone; a null or empty one has a score like any
    other. Repeated rows stay; an empty table gives an empty table. A column named
    like the score is replaced. Nothing is shuffled: the lookup tables, a few
    kilobytes, travel with the function.
    """

    def start():
        table = _class_table()

        def compute(texts: list) -> list[list]:
            x = np.array([text_features(t, table) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            return [model.scores(x).tolist()]

        return compute

    return append_columns(docs, text_col, [(name, T.DoubleType())], start, keep)
