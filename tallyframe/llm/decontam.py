"""Benchmark decontamination by spaced seeds.

A seed is the hash of some words under a fixed mask, so that words at the ignored
positions may be replaced. Documents and benchmark items are joined on seeds, and
around each hit the two texts are laid over each other and compared word by word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import cut_lineage

from .arrow import append_columns
from .store import bit_table, in_table

WORD = re.compile(r"\w+")
WORD_CACHE = 500_000
MULTIPLIER = 0x9E3779B97F4A7C15

# Two masks of six words. Tried out on every placing of up to two replaced words
# in 13: one of the masks always finds a place without them.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8


@dataclass(frozen=True)
class SeedSpec:
    """An overlap is ``window`` aligned words of which at most ``replaced`` differ.

    An item of fewer words has to be found whole and exactly. ``filter_bits``
    fixes the size of the filter that keeps other seeds from being shuffled: a
    larger benchmark fills it up and lets more through, no seed is lost.
    """

    window: int = 13
    replaced: int = 2
    filter_bits: int = 1 << 24


class Tokens:
    """Hashes of the lower-cased words of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def _mix(parts: list[np.ndarray], tag: int) -> np.ndarray:
    h = np.full(len(parts[0]), tag, dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(MULTIPLIER)
        h ^= h >> np.uint64(31)
    return h


def seeds(
    words: np.ndarray, short: tuple[int, ...] = (), masks: tuple[tuple[int, ...], ...] = MASKS
) -> list[tuple[np.ndarray, int]]:
    """Seed hashes by position and their number of words: each mask, then whole runs of the ``short`` lengths."""
    out = []
    for tag, mask in enumerate(masks):
        n = len(words) - SPAN + 1
        if n > 0:
            out.append((_mix([words[o : o + n] for o in mask], tag), SPAN))
    for length in short:
        n = len(words) - length + 1
        if n > 0:
            out.append((_mix([words[o : o + n] for o in range(length)], 1000 + length), length))
    return out


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per distinct word sequence: the smallest id, the words, how many ids have it, and its seeds."""

    def start():
        tokens = Tokens()

        def compute(texts: list) -> list[list]:
            words, found = [], []
            for t in texts:
                w = tokens(t)
                words.append(w.view(np.int64))
                own = seeds(w) if len(w) >= window else seeds(w, (len(w),), masks=()) if len(w) else []
                found.append([(int(h), p) for hs, _ in own for p, h in enumerate(hs.view(np.int64))])
            return [words, found]

        return compute

    seed = T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType())])
    fields = [("words", T.ArrayType(T.LongType())), ("seeds", T.ArrayType(seed))]
    source = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").alias("text"))
    built = append_columns(source.filter("item is not null"), "text", fields, start, ["item"])
    return built.filter(F.size("words") > 0).groupBy("words").agg(F.min("item").alias("item"), F.first("seeds").alias("seeds"))


def document_segments(
    docs: DataFrame, id_col: str, text_col: str, filter_bytes: np.ndarray, short: tuple[int, ...], reach: int
) -> DataFrame:
    """Stretches of documents around seeds that pass the filter.

    A stretch takes in ``reach`` words on both sides; stretches that overlap are
    one, so a document never sends more words than it has.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_bytes)
    part = T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("words", T.ArrayType(T.LongType())),
            T.StructField(
                "hits",
                T.ArrayType(
                    T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType())])
                ),
            ),
        ]
    )

    def start():
        tokens, table = Tokens(), shared.value

        def one(text: str | None) -> list[dict]:
            w = tokens(text)
            at, seed, size = [], [], []
            for hashes, length in seeds(w, short):
                signed = hashes.view(np.int64)
                ok = np.flatnonzero(in_table(table, signed))
                at.append(ok)
                seed.append(signed[ok])
                size.append(np.full(len(ok), length))
            if not at or not (found := np.concatenate(at)).size:
                return []
            order = np.argsort(found, kind="stable")
            found, values = found[order], np.concatenate(seed)[order]
            lo = np.maximum(found - reach, 0)
            hi = np.minimum(found + np.concatenate(size)[order] + reach, len(w))
            cuts = np.flatnonzero(lo[1:] > np.maximum.accumulate(hi)[:-1]) + 1
            out = []
            for group in np.split(np.arange(len(found)), cuts):
                a, b = int(lo[group[0]]), int(hi[group].max())
                hits = [(int(s), int(p) - a) for s, p in zip(values[group], found[group])]
                out.append({"start": a, "words": w[a:b].view(np.int64).tolist(), "hits": hits})
            return out

        return lambda texts: [[one(t) for t in texts]]

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    made = append_columns(source.filter("doc is not null"), "text", [("parts", T.ArrayType(part))], start, ["doc"])
    return made.filter(F.size("parts") > 0).select("doc", F.inline("parts"))


def longest_overlap(doc: np.ndarray, item: np.ndarray, shift: int, spec: SeedSpec) -> tuple[int, int] | None:
    """First word and length of the stretch of the item, laid at ``shift``, whose windows are good.

    From the first good window to the last; words in between may be replaced more often.
    """
    lo, hi = max(-shift, 0), min(len(doc) - shift, len(item))
    window = min(spec.window, len(item))
    if hi - lo < window:
        return None
    allowed = spec.replaced if len(item) >= spec.window else 0
    missed = np.concatenate([[0], np.cumsum(doc[shift + lo : shift + hi] != item[lo:hi])])
    good = np.flatnonzero(missed[window:] - missed[:-window] <= allowed)
    if not good.size:
        return None
    return shift + lo + int(good[0]), int(good[-1] - good[0]) + window


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    spec: SeedSpec | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that overlap a benchmark item: id, ``item``, ``start`` and ``words``.

    One row per document and distinct item text found in it: the smallest id of
    that text, the document's word number where the overlap begins, and the number
    of words from its first good window to its last. A null or empty text on either
    side overlaps nothing, as does a null id. Repeated documents give one row.
    Items of equal words count once. Either table may be empty. Other columns are
    ignored.

    The benchmark may have any size: only its filter of fixed size is broadcast, and
    its seeds and words are joined. Documents send only stretches around seeds that
    pass the filter.
    """
    spec = spec or SeedSpec()
    items = cut_lineage(benchmark_items(benchmark, item_col, item_text_col, spec.window))
    lengths = items.select(F.size("words").alias("n"))
    longest = lengths.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    short = tuple(sorted(r[0] for r in lengths.filter(F.col("n") < spec.window).distinct().collect()))
    segments = cut_lineage(
        document_segments(docs, id_col, text_col, bit_table(items.select(F.explode("seeds.seed").alias("seed")), F.col("seed"), spec.filter_bits), short, longest)
    )
    # A stretch is known by its words: texts of one id are kept apart, and a phrase that
    # many documents hold is laid over each item once.
    known = [F.xxhash64("words").alias("s1"), F.xxhash64(F.lit("second"), "words").alias("s2")]
    stretches = cut_lineage(segments.select(*known, "words", "hits").dropDuplicates(["s1", "s2"]))
    hits = stretches.select("s1", "s2", F.inline("hits"))
    lookup = items.select("item", F.inline("seeds")).withColumnRenamed("at", "item_at")
    laid = (
        hits.join(lookup, "seed")
        .select("s1", "s2", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    met = laid.join(stretches.select("s1", "s2", F.col("words").alias("doc_words")), ["s1", "s2"]).join(
        items.select("item", F.col("words").alias("item_words")), "item"
    )

    def start():
        def compute(rows: list) -> list[list]:
            return [
                [
                    None if (x := longest_overlap(np.array(r["doc"]), np.array(r["item"]), r["shift"], spec)) is None
                    else {"start": x[0], "words": x[1]}
                    for r in rows
                ]
            ]

        return compute

    found = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType())])
    laid_over = met.select(
        "s1",
        "s2",
        F.col("item").alias("which"),
        F.struct(F.col("doc_words").alias("doc"), F.col("item_words").alias("item"), "shift").alias("pair"),
    )
    checked = append_columns(laid_over, "pair", [("found", found)], start, ["s1", "s2", "which"])
    places = segments.select("doc", "start", *known)
    return (
        places.join(cut_lineage(checked.filter("found is not null")), ["s1", "s2"])
        .groupBy(F.col("doc").alias(id_col), F.col("which").alias("item"))
        .agg(
            F.max(F.struct(F.col("found.words").alias("words"), (-F.col("start") - F.col("found.start")).alias("back"))).alias("best")
        )
        .select(id_col, "item", (-F.col("best.back")).cast("long").alias("start"), F.col("best.words").cast("long").alias("words"))
    )
