"""Substring dedup by suffix automata of reference shards.

Two equal windows of words have the same anchor: the smallest hash among their
shingles, at the same offset. Neighbouring windows of one anchor are a stretch. Only
stretches whose anchor occurs twice can hold a repeated window, and only these are
looked at. The distinct stretches, with how often each occurs, are the reference. It
is cut into shards by anchor, so that all places of a window meet in one shard; of
each shard a task builds the suffix automaton with occurrence counts and streams the
shard's stretches through it for matching statistics: positions where the longest
match has a window's length and more than one occurrence end a repeated window.

Broadcasting every shard to all documents would take work that grows with the square
of the corpus; sending to a shard only what can match there finds the same windows.
A stretch that is the only kind of its anchor needs no automaton: it occurs twice as a
whole. An anchor with very many different stretches (the edge of a passage found
everywhere) would outgrow a shard: its windows are counted one by one, by 128-bit hashes.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import append_columns
from .store import bit_table, in_table, written

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MULTIPLIER = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class SubstringSpec:
    """Words of a window, words of a shingle, and what bounds a task.

    ``shard_words`` is what a shard's stretches hold on average; an anchor with more
    than ``anchor_stretches`` different stretches is counted window by window. The
    bit tables that tell candidates from others have 16 bits a key, at most
    ``filter_bits`` in all; beyond that they let more through, and lose none.
    """

    window: int = 35
    shingle: int = 8
    shard_words: int = 150_000
    anchor_stretches: int = 64
    filter_bits: int = 1 << 28

    def __post_init__(self) -> None:
        if not 0 < self.shingle <= self.window or self.window - self.shingle > 62:
            raise ValueError("a shingle is at most as long as a window, and a window has at most 63 shingles")


def powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class WordHashes:
    """Hashes of the words of a text at ASCII white space, all words of a piece at once.

    A word's hash is a polynomial of its bytes: differences of running sums, moved to
    the word's first byte by the inverse of the base, then mixed. Texts go in pieces
    that end between words, so the tables of powers stay small unless a word is longer.
    """

    def __init__(self, base: int = BASES[0], piece: int = 1 << 19):
        self.base, self.piece = base, piece
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.up, self.down = powers(self.base, size), powers(pow(self.base, -1, 1 << 64), size)

    def _piece(self, b: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(b) >= len(self.up):
            self._grow(2 * len(b))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
        start, end = edge[::2], edge[1::2]
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[: len(b)], out=sums[1:])
        h = (sums[end] - sums[start]) * self.down[start]
        h = (h ^ (h >> np.uint64(31))) * MULTIPLIER
        return start, end, h ^ (h >> np.uint64(29))

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and hash of every word."""
        b = np.frombuffer(data, dtype=np.uint8)
        space = (b == 32) | ((b >= 9) & (b <= 13))
        if len(b) <= self.piece:
            return self._piece(b, space)
        gaps = np.flatnonzero(space)
        parts, at = [], 0
        while at < len(b):
            k = np.searchsorted(gaps, at + self.piece)
            to = int(gaps[k]) + 1 if k < len(gaps) else len(b)
            start, end, h = self._piece(b[at:to], space[at:to])
            parts.append((start + at, end + at, h))
            at = to
        return tuple(np.concatenate(x) for x in zip(*parts))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words."""
    n = len(words) - length + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        h = (h ^ words[i : i + n]) * MULTIPLIER
        h ^= h >> np.uint64(29)
    return h * MULTIPLIER


def stretches(words: np.ndarray, spec: SubstringSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and last window of every stretch of a text, in order.

    Of equal smallest shingles the leftmost is the anchor.
    """
    none = np.empty(0, dtype=np.int64)
    if len(words) < spec.window:
        return none.view(np.uint64), none, none
    h = run_hashes(words, spec.shingle)
    inside = np.lib.stride_tricks.sliding_window_view(h, spec.window - spec.shingle + 1)
    anchor = np.arange(len(inside)) + inside.argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], len(anchor)) - 1
    return h[anchor[first]], first, last


class RunHashes:
    """Hashes of runs of words of any length, by running sums as for the bytes of words."""

    def __init__(self, base: int):
        self.base = base
        self.up, self.down = powers(base, 1 << 12), powers(pow(base, -1, 1 << 64), 1 << 12)

    def __call__(self, words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(words) > len(self.up):
            size = 2 * len(words)
            self.up, self.down = powers(self.base, size), powers(pow(self.base, -1, 1 << 64), size)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * self.up[: len(words)], dtype=np.uint64)])
        h = (sums[end] - sums[first]) * self.down[first] + (end - first).astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * MULTIPLIER
        return h ^ (h >> np.uint64(29))


def halves(words: list[bytes]) -> tuple[int, int]:
    """A 128-bit hash of words as two signed numbers."""
    return struct.unpack(">qq", xxhash.xxh3_128_digest(b" ".join(words)))


def _bits(count: int, spec: SubstringSpec) -> int:
    return min(max(1 << (16 * count).bit_length(), 1 << 16), spec.filter_bits)


def anchor_counts(docs: DataFrame, text: Column, spec: SubstringSpec) -> DataFrame:
    """Every anchor hash and how many stretches have it (``a``, ``n``), summed in each batch first."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [stretches(hashes(t)[2], spec)[0] for t in batch.column(0).to_pylist()]
            if found:
                a, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n)], names=["a", "n"])

    return docs.select(text.cast("binary")).mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def candidate_stretches(docs: DataFrame, ident: Column, text: Column, repeated: DataFrame, spec: SubstringSpec) -> DataFrame:
    """Stretches whose anchor may be among ``repeated`` (``a``), without their words.

    ``a``, 128-bit hash ``c1``, ``c2`` of its words, ``id``, ``row`` (hash of the text),
    and ``lo`` and ``last``, the first and last window.
    """
    table = bit_table(repeated, F.col("a"), _bits(repeated.count(), spec))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    source = docs.select(ident.alias("id"), F.xxhash64(text).alias("row"), text.cast("binary").alias("data"))
    numbers = ("a", "c1", "c2", "lo", "last")
    schema = T.StructType(source.schema.fields[:2] + [T.StructField(n, T.LongType()) for n in numbers])

    def run(batches):
        words = [WordHashes(base) for base in BASES]
        runs = [RunHashes(base) for base in BASES]
        for batch in batches:
            whose, found = [], []
            for i, data in enumerate(batch.column(2).to_pylist()):
                own = words[0](data)[2]
                a, lo, last = stretches(own, spec)
                a = a.view(np.int64)
                ok = np.flatnonzero(in_table(shared.value, a))
                if len(ok):
                    lo, last = lo[ok], last[ok]
                    c1 = runs[0](own, lo, last + spec.window)
                    c2 = runs[1](words[1](data)[2], lo, last + spec.window)
                    whose.append(np.full(len(ok), i))
                    found.append((a[ok], c1.view(np.int64), c2.view(np.int64), lo, last))
            if found:
                take = pa.array(np.concatenate(whose))
                made = [pa.array(np.concatenate(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *made], names=schema.names)

    return source.mapInArrow(run, schema)


def distinct_stretches(occurrences: DataFrame, spec: SubstringSpec) -> DataFrame:
    """Distinct stretches of anchors found twice, with ``n`` occurrences, one place, and the anchor's ``kinds``."""
    place = F.struct("row", "lo", "last", "id")
    distinct = written(
        occurrences.groupBy("a", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("place")), "substring-distinct"
    )
    anchors = written(
        distinct.groupBy("a").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1").drop("total"),
        "substring-anchors",
    )
    return written(distinct.join(anchors, "a").select("a", "c1", "c2", "n", "kinds", "place.*"), "substring-places")


def wholly_repeated(places: DataFrame) -> DataFrame:
    """Stretches that are the only kind of their anchor: as they occur twice, so does each of their windows."""
    windows = F.col("last") - F.col("lo") + 1
    return places.select("c1", "c2", F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (64 - windows).cast("int")).alias("mask"))


def reference(docs: DataFrame, ident: Column, text: Column, places: DataFrame, spec: SubstringSpec) -> DataFrame:
    """Distinct stretches with their words: ``a``, ``c1``, ``c2``, ``n``, ``words`` and ``heavy``.

    Each stretch's words are read from its one place. Texts without such a place are
    told by a bit table and not shuffled.
    """
    places = places.withColumn("heavy", F.col("kinds") > spec.anchor_stretches)
    rows = places.select("row").distinct()
    table = bit_table(rows, F.col("row"), _bits(rows.count(), spec))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def holds_place(row: pd.Series) -> pd.Series:
        return pd.Series(in_table(shared.value, row.to_numpy()))

    texts = docs.select(F.xxhash64(text).alias("row"), ident.alias("id"), text.alias("text")).filter(holds_place("row"))
    grouped = places.groupBy("row", "id").agg(F.collect_list(F.struct("a", "c1", "c2", "n", "heavy", "lo", "last")).alias("found"))
    same = (texts["row"] == grouped["row"]) & texts["id"].eqNullSafe(grouped["id"])
    # Of equal rows, either serves: the words are the same, and one is kept below.
    met = grouped.join(texts, same).select(F.struct(F.col("text").cast("binary").alias("text"), "found").alias("job"))
    stretch = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("a", "c1", "c2", "n")]
        + [T.StructField("heavy", T.BooleanType()), T.StructField("words", T.BinaryType())]
    )

    def start():
        def one(job: dict) -> list[dict]:
            words = job["text"].split()
            return [
                {k: f[k] for k in ("a", "c1", "c2", "n", "heavy")}
                | {"words": b" ".join(words[f["lo"] : f["last"] + spec.window])}
                for f in job["found"]
            ]

        return lambda jobs: [[one(j) for j in jobs]]

    made = append_columns(met, "job", [("made", T.ArrayType(stretch))], start, [])
    return made.select(F.inline("made")).dropDuplicates(["a", "c1", "c2"])


class Automaton:
    """Suffix automaton of several word sequences, with how often every state's strings occur."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, words: list, times: int) -> None:
        """One more sequence, which occurs ``times`` times. The usual step is written out, as it runs for every word."""
        after, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for w in words:
            q = after[last].get(w)
            if q is None:
                new = len(length)
                length.append(length[last] + 1)
                after.append({})
                link.append(0)
                count.append(0)
                p = last
                while p >= 0 and w not in after[p]:
                    after[p][w] = new
                    p = link[p]
                if p >= 0:
                    q = after[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._copy(p, q, w)
                last = new
            else:
                last = q if length[q] == length[last] + 1 else self._copy(last, q, w)
            count[last] += times

    def _copy(self, p: int, q: int, w) -> int:
        """The state of the strings of ``q`` up to those that end in ``p`` and ``w``."""
        new = len(self.length)
        self.length.append(self.length[p] + 1)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def finish(self) -> None:
        """Counts go from longer strings to the suffixes they end in."""
        for s in np.argsort(-np.array(self.length), kind="stable").tolist():
            if s:
                self.count[self.link[s]] += self.count[s]

    def repeated_ends(self, words: list, least: int) -> list[int]:
        """Positions after which a string of ``least`` words that occurs more than once ends.

        Matching statistics: state and length of the longest match ending at each
        position; as soon as it has ``least`` words it is shortened to just these.
        """
        after, link, length, count = self.next, self.link, self.length, self.count
        out = []
        state = matched = 0
        for i, w in enumerate(words, 1):
            step = after[state].get(w)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = after[state].get(w)
            if step is None:
                matched = 0
                continue
            state = step
            matched += 1
            while length[link[state]] >= least:
                state = link[state]
                matched = length[state]
            if matched >= least and count[state] > 1:
                out.append(i)
        return out


def _window_mask(ends: list[int], window: int) -> int:
    mask = 0
    for e in ends:
        mask |= 1 << (e - window)
    return mask


def shard_repeats(shard: pa.Table, window: int) -> pa.Table:
    """``c1``, ``c2`` and a bit per repeated window of every stretch of a shard that has one."""
    number: dict[bytes, int] = {}
    texts = [[number.setdefault(w, len(number)) for w in t.split(b" ")] for t in shard["words"].to_pylist()]
    automaton = Automaton()
    for words, n in zip(texts, shard["n"].to_pylist()):
        automaton.add(words, n)
    automaton.finish()
    masks = [_window_mask(automaton.repeated_ends(words, window), window) for words in texts]
    keep = pa.array([i for i, m in enumerate(masks) if m], pa.int64())
    found = pa.array([m for m in masks if m], pa.int64())
    return pa.table({"c1": shard["c1"].take(keep), "c2": shard["c2"].take(keep), "mask": found})


def repeated_in_shards(ref: DataFrame, spec: SubstringSpec) -> DataFrame:
    """Repeated windows of light anchors, by automata."""
    words = ref.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-words // spec.shard_words))
    window = spec.window
    dealt = ref.select("c1", "c2", "n", "words", F.pmod(F.xxhash64("a"), F.lit(shards)).alias("shard"))

    def of(shard: pa.Table) -> pa.Table:
        return shard_repeats(shard, window)

    return dealt.groupBy("shard").applyInArrow(of, "c1 long, c2 long, mask long")


def repeated_one_by_one(ref: DataFrame, spec: SubstringSpec) -> DataFrame:
    """Repeated windows of heavy anchors, each window a row of hashes."""
    part = T.StructType([T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType()), T.StructField("at", T.IntegerType())])

    def start():
        def one(data: bytes) -> list[dict]:
            words = data.split(b" ")
            pairs = [halves(words[i : i + spec.window]) for i in range(len(words) - spec.window + 1)]
            return [{"w1": a, "w2": b, "at": i} for i, (a, b) in enumerate(pairs)]

        return lambda texts: [[one(t) for t in texts]]

    made = append_columns(ref, "words", [("found", T.ArrayType(part))], start, ["c1", "c2", "n"])
    windows = written(made.select("c1", "c2", "n", F.inline("found")), "substring-windows")
    again = written(
        windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).filter("total > 1").select("w1", "w2"), "substring-again"
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))
    return windows.join(again, ["w1", "w2"]).groupBy("c1", "c2").agg(F.bit_or(bit).alias("mask"))


def repeated_spans(docs: DataFrame, ident: Column, text: Column, spec: SubstringSpec) -> DataFrame:
    """``id``, ``row`` and the repeated windows of every text that has some, as first window and bits."""
    repeated = written(anchor_counts(docs, text, spec).filter("n > 1").select("a"), "substring-repeated")
    occurrences = written(candidate_stretches(docs, ident, text, repeated, spec), "substring-occurrences")
    places = distinct_stretches(occurrences, spec)
    ref = written(
        reference(docs, ident, text, places.filter("kinds > 1"), spec).withColumn("size", F.size(F.split(F.col("words").cast("string"), " "))),
        "substring-reference",
    )
    found = written(
        wholly_repeated(places.filter("kinds = 1"))
        .unionByName(repeated_in_shards(ref.filter("not heavy"), spec))
        .unionByName(repeated_one_by_one(ref.filter("heavy"), spec)),
        "substring-found",
    )
    return (
        occurrences.join(found, ["c1", "c2"])
        .groupBy("id", "row")
        .agg(F.collect_set(F.struct("lo", "mask")).alias("windows"))
    )


def removed_words(n: int, windows: list[dict], window: int) -> np.ndarray:
    """Which of ``n`` words lie in a repeated window."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for w in windows:
        at, mask = w["lo"], w["mask"]
        while mask:
            if mask & 1:
                edge[at] += 1
                edge[at + window] -= 1
            mask >>= 1
            at += 1
    return np.cumsum(edge[:-1]) > 0


def drop_repeated_passages(
    docs: DataFrame, spec: SubstringSpec | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts without the words of any window that starts in another place too.

    One row per row of ``docs``: the id, ``n_words``, ``n_removed``, ``spans`` (array of
    ``start`` and ``end``, the maximal runs of removed words) and ``text``, the other
    words joined by one space. Windows are judged on the input. Another place may be in
    the same text, overlapping or not. A null text, or one without words, comes back
    empty; one with fewer words than a window loses nothing. Rows are documents: two
    equal rows are copies of each other, and rows of one id with different texts are
    apart. Null ids stay. An empty table gives an empty one. Other columns are left
    out, whatever their names.
    """
    spec = spec or SubstringSpec()
    ident = F.col(f"`{id_col}`")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    spans = repeated_spans(docs, ident, text, spec)
    texts = docs.select(ident.alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
    same = (texts["row"] == spans["row"]) & texts["id"].eqNullSafe(spans["id"])
    job = F.struct(F.col("text").cast("binary").alias("text"), "windows").alias("job")
    met = texts.join(spans, same, "left").select(texts["id"], job)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    window = spec.window

    def start():
        def one(job: dict) -> tuple:
            words = job["text"].split()
            if not job["windows"]:
                return len(words), 0, [], b" ".join(words).decode("utf-8", "replace")
            gone = removed_words(len(words), job["windows"], window)
            turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
            runs = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
            left = [0, *turns, len(words)]
            kept = b" ".join(w for a, b in zip(left[::2], left[1::2]) for w in words[a:b])
            return len(words), int(gone.sum()), runs, kept.decode("utf-8", "replace")

        return lambda jobs: list(zip(*map(one, jobs))) if jobs else [[], [], [], []]

    fields = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("spans", T.ArrayType(span)), ("text", T.StringType())]
    made = append_columns(met, "job", fields, start, ["id"])
    return made.select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", "text")
