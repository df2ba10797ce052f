"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models on the words of a text.
Each model after the first also sees the log odds that the models before it give;
it is trained on out-of-fold ones, so that it learns from predictions as good as
those it will meet.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import cut_lineage

from .arrow import append_columns
from .quality import held_out

WORD = re.compile(r"[^\W\d_]+")
PREFIX = 6
CLIP = 30.0

#: Categories in the order of the chain, as conditions on a row of labels: the narrow
#: ones first, so that the last, which decides, is told what they say.
CATEGORIES = {
    "toxic_prose": "toxic = 1 and quality = 1",
    "toxic_junk": "toxic = 1 and quality = 0",
    "toxic": "toxic = 1",
}


@dataclass(frozen=True)
class ChainSpec:
    """Sizes of the model. ``max_rows`` bounds the labelled rows it is fitted on, ``max_terms`` its words."""

    max_rows: int = 30_000
    max_terms: int = 4096
    min_documents: int = 3
    min_score: float = 3.5
    folds: int = 3
    steps: int = 200
    ridge: float = 1.0


def terms_of(text: str | None) -> set[str]:
    """Distinct lower-cased words of a whole text, and beginnings of longer ones."""
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:PREFIX] + "~" for w in words if len(w) > PREFIX}


@dataclass
class Linear:
    """Weights of words, of the log odds of earlier categories, and a constant."""

    words: np.ndarray
    earlier: np.ndarray
    constant: float

    def logits(self, row: np.ndarray, col: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.words[col], n) + earlier @ self.earlier + self.constant


@dataclass
class Chain:
    """The words of the model and one linear model per category, in order."""

    names: list[str]
    terms: dict[str, int] = field(default_factory=dict)
    models: list[Linear] = field(default_factory=list)

    def probabilities(self, found: list[list[int]]) -> np.ndarray:
        """A column per category for rows given as numbers of their words."""
        row, col = _coordinates(found)
        logits = np.zeros((len(found), 0))
        for m in self.models:
            own = np.clip(m.logits(row, col, len(found), logits), -CLIP, CLIP)
            logits = np.hstack([logits, own[:, None]])
        return 1 / (1 + np.exp(-logits))


def _coordinates(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    col = np.fromiter((i for f in found for i in f), dtype=np.int64, count=len(row))
    return row, col


def fit_linear(
    row: np.ndarray, col: np.ndarray, earlier: np.ndarray, y: np.ndarray, n_terms: int, spec: ChainSpec
) -> Linear:
    """Ridge logistic regression by full-batch steps scaled per weight."""
    n, k = len(y), earlier.shape[1]
    if not n or y.min() == y.max():
        return Linear(np.zeros(n_terms), np.zeros(k), -CLIP if not n or y.max() == 0 else CLIP)
    w = np.zeros(n_terms + k + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    memory = np.full(len(w), 1e-8)
    for _ in range(spec.steps):
        z = np.bincount(row, w[col], n) + earlier @ w[n_terms:-1] + w[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -CLIP, CLIP))) - y
        g = np.concatenate([np.bincount(col, gap[row], n_terms), gap @ earlier, [gap.sum()]])
        g[:-1] += spec.ridge * w[:-1]
        memory += g * g
        w -= 0.5 * g / np.sqrt(memory)
    return Linear(w[:n_terms], w[n_terms:-1], float(w[-1]))


def fit_chain(
    found: list[list[int]], y: np.ndarray, fold: np.ndarray, terms: dict[str, int], names: list[str], spec: ChainSpec
) -> Chain:
    """One model per category; what a model sees of earlier ones is out of fold."""
    chain = Chain(names, terms)
    row, col = _coordinates(found)
    outside = np.zeros((len(found), 0))
    for c in range(len(names)):
        chain.models.append(fit_linear(row, col, outside, y[:, c], len(terms), spec))
        logits = np.zeros(len(found))
        for k in range(spec.folds):
            away, here = fold != k, fold == k
            number = np.cumsum(away) - 1
            use = away[row]
            part = fit_linear(number[row[use]], col[use], outside[away], y[away, c], len(terms), spec)
            logits[here] = part.logits(row, col, len(found), outside)[here]
        outside = np.hstack([outside, np.clip(logits, -CLIP, CLIP)[:, None]])
    return chain


# ---- on tables ----------------------------------------------------------------


def labelled_sample(labels: DataFrame, categories: dict[str, str], spec: ChainSpec, id_col: str) -> DataFrame:
    """Id, a 0/1 column per category and a fold of labelled rows that are not held out.

    All of them, or a hash sample of about ``spec.max_rows``. Rows with a null in a
    label are left out; of several rows of one id a category holds if any says so.
    """
    known = labels.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    for condition in categories.values():
        known = known.filter(F.expr(condition).isNotNull())
    rows = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        *[F.max(F.expr(condition).cast("int")).alias(f"y{i}") for i, condition in enumerate(categories.values())]
    )
    n = rows.count()
    if n > spec.max_rows:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(spec.max_rows / n * (1 << 32)))
    return rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(spec.folds)).cast("int"))


def choose_terms(learn: DataFrame, targets: list[str], spec: ChainSpec) -> dict[str, int]:
    """Words whose share among documents of some category stands out, the strongest ``max_terms``."""
    sums = [F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in targets]
    whole = learn.agg(F.count("*").alias("n"), *sums).first()
    shares = {t: whole[t] / whole["n"] for t in targets if 0 < whole[t] < whole["n"]}
    if not shares:
        return {}
    scores = [F.abs(F.col(t) - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p)) for t, p in shares.items()]
    counted = (
        learn.select(F.explode("terms").alias("term"), *targets)
        .groupBy("term")
        .agg(F.count("*").alias("n"), *sums)
        .filter(F.col("n") >= spec.min_documents)
        .withColumn("score", F.greatest(*scores) if len(scores) > 1 else scores[0])
        .filter(F.col("score") >= spec.min_score)
    )
    best = counted.orderBy(F.desc("score"), "term").limit(spec.max_terms).collect()
    return {r["term"]: i for i, r in enumerate(best)}


def _find(terms: dict[str, int], text: str | None) -> list[int]:
    return sorted(terms[t] for t in terms_of(text) if t in terms)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str] | None = None,
    spec: ChainSpec | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """The chain learned from labelled documents.

    The labelled ids, bounded by ``spec.max_rows``, are broadcast to the documents,
    so no text is shuffled. Words are counted in Spark; their best ``max_terms`` and
    the word numbers of the labelled documents reach the driver.
    """
    categories, spec = categories or CATEGORIES, spec or ChainSpec()
    names = list(categories)
    sample = F.broadcast(labelled_sample(labels, categories, spec, id_col))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    targets = [f"y{i}" for i in range(len(names))]

    def start():
        return lambda texts: [[list(terms_of(t)) for t in texts]]

    learn = cut_lineage(
        append_columns(
            source.join(sample, "id"), "text", [("terms", T.ArrayType(T.StringType()))], start, ["id", *targets, "fold"]
        )
    )
    terms = choose_terms(learn, targets, spec)

    def pick():
        return lambda rows: [[sorted(terms[t] for t in r if t in terms) for r in rows]]

    numbered = append_columns(learn, "terms", [("found", T.ArrayType(T.IntegerType()))], pick, ["id", *targets, "fold"])
    rows = numbered.collect()
    rows.sort(key=lambda r: (r["id"], r["found"]))
    y = np.array([[r[t] for t in targets] for r in rows], dtype=float).reshape(len(rows), len(names))
    fold = np.array([r["fold"] for r in rows], dtype=int)
    return fit_chain([r["found"] for r in rows], y, fold, terms, names, spec)


def score_toxicity(
    docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (the id by default) and a probability per category for every row of ``docs``.

    The whole text counts. A null or empty text has the probabilities of a text
    without known words. Repeated rows stay; an empty table gives an empty table.
    Columns named like a category are replaced. Nothing is shuffled; the model, of
    at most ``max_terms`` words, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def start():
        model = shared.value
        terms = model.terms

        def compute(texts: list) -> list[list]:
            return model.probabilities([_find(terms, t) for t in texts]).T.tolist()

        return compute

    fields = [(name, T.DoubleType()) for name in chain.names]
    return append_columns(docs, text_col, fields, start, keep or [id_col])
