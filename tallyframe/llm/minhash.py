"""Near-duplicate texts: one-permutation MinHash, optimal densification, banded buckets, star edges.

Every link is confirmed on whole shingle sets. Buckets give star-shaped candidates,
each member with the bucket's smallest document. What a star may miss is made up
for afterwards: buckets whose members are still in several components are looked at
again, the members outside a bucket's largest component against all others in it,
inside tasks that return only the links they find.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import append_columns
from .components import connected_components
from .store import bit_table, in_table, written

WORD_CACHE = 500_000
MULTIPLIER = 0x9E3779B97F4A7C15
PROBES = 64


@dataclass(frozen=True)
class MinHashSpec:
    """Shingle width, link rule ``100 * common >= percent * union``, and bands of rows.

    With 32 bands of 5 rows a pair at 0.8 shares no bucket with probability
    (1 - 0.8 ** 5) ** 32, three in a million. ``chunk`` bounds the shingles a task
    holds on one side when it looks at a bucket again; ``filter_bits`` fixes the size
    of the table by which documents without candidates are told apart.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    chunk: int = 1_000_000
    filter_bits: int = 1 << 24

    @property
    def bins(self) -> int:
        return self.bands * self.rows


class Shingler:
    """Sets of hashed word shingles. Words are split at ASCII white space, A-Z in lower case."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def word_hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes; a text of fewer words is one shingle, one without words none."""
        w = self.word_hashes(text)
        width = min(self.words, len(w))
        if not width:
            return w
        h = np.full(len(w) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            h = (h ^ w[i : len(w) - width + 1 + i]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return np.unique(h)


class Sketcher:
    """One hash value per bin of the one permutation; empty bins borrow from random full ones."""

    def __init__(self, spec: MinHashSpec):
        self.spec = spec
        self.probe = np.random.default_rng(7).integers(0, spec.bins, (PROBES, spec.bins))

    def signature(self, sorted_hashes: np.ndarray) -> np.ndarray:
        bins = self.spec.bins
        bin_of = ((sorted_hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        full, first = np.unique(bin_of.astype(np.int64), return_index=True)
        out = np.zeros(bins, dtype=np.uint64)
        has = np.zeros(bins, dtype=bool)
        out[full], has[full] = sorted_hashes[first], True
        todo = np.flatnonzero(~has)
        for attempt in self.probe:
            if not len(todo):
                break
            lender = attempt[todo]
            ok = has[lender]
            out[todo[ok]] = out[lender[ok]]
            todo = todo[~ok]
        if len(todo):  # very small sets: the next full bin on the right
            at = np.searchsorted(full, todo) % len(full)
            out[todo] = out[full[at]]
        return out

    def bands(self, sorted_hashes: np.ndarray) -> np.ndarray:
        rows = self.signature(sorted_hashes).reshape(self.spec.bands, self.spec.rows)
        h = np.arange(1, self.spec.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for r in range(self.spec.rows):
            h = (h ^ rows[:, r]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(31)
        return h.view(np.int64)


def sketch(docs: DataFrame, spec: MinHashSpec, id_col: str, text_col: str) -> DataFrame:
    """Id, size of the shingle set, its 128-bit hash and its band keys, for every row."""

    def start():
        shingler, sketcher = Shingler(spec.words), Sketcher(spec)

        def compute(texts: list) -> list[list]:
            sizes, hi, lo, bands = [], [], [], []
            for t in texts:
                s = shingler.shingles(t)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                sizes.append(len(s))
                hi.append(int.from_bytes(digest[:8], "big", signed=True))
                lo.append(int.from_bytes(digest[8:], "big", signed=True))
                bands.append(sketcher.bands(s) if len(s) else [])
            return [sizes, hi, lo, bands]

        return compute

    fields = [
        ("n_shingles", T.LongType()),
        ("s1", T.LongType()),
        ("s2", T.LongType()),
        ("bands", T.ArrayType(T.LongType())),
    ]
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return append_columns(source, "text", fields, start, ["id"])


def shingle_sets(docs: DataFrame, spec: MinHashSpec, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """Id and full shingle set of the documents whose ids are in ``wanted``.

    A bit table of fixed size keeps other texts from being worked on, so no text is
    shuffled; the ids it lets through wrongly are sorted out afterwards.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(wanted, F.xxhash64("id"), spec.filter_bits))

    def start():
        shingler, table = Shingler(spec.words), shared.value

        def compute(rows: list) -> list[list]:
            asked = in_table(table, np.array([r["h"] for r in rows], dtype=np.int64))
            return [[shingler.shingles(r["text"]).view(np.int64) if ok else None for r, ok in zip(rows, asked)]]

        return compute

    key = F.col(f"`{id_col}`").cast("long")
    source = docs.select(
        key.alias("id"), F.struct(F.xxhash64(key).alias("h"), F.col(f"`{text_col}`").alias("text")).alias("row")
    ).filter("id is not null")
    made = append_columns(source, "row", [("shingles", T.ArrayType(T.LongType()))], start, ["id"])
    return made.filter("shingles is not null").join(wanted, "id", "left_semi")


def similarity(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b``, ``common`` and ``total`` (union) of candidate pairs, counted on the full sets."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    met = pairs.join(second, "b").join(first, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return met.select("a", "b", common.alias("common"), F.size("set_a").alias("na"), F.size("set_b").alias("nb")).select(
        "a", "b", "common", (F.col("na") + F.col("nb") - F.col("common")).alias("total")
    )


def near_duplicates(
    docs: DataFrame,
    spec: MinHashSpec | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included; ``kept`` says that it is the row's own. Null or empty texts, and
    texts of white space only, link with nothing. Rows that share an id stand each
    for its own text; where that id is the smallest of two texts, these count as
    linked. A null id links with nothing, has no component and is kept. Repeated rows stay. An empty table gives an empty table. Other
    columns are ignored.

    Equal sets are one node before anything is paired, so a group of copies of any
    size is one node. Sketches are stored: about 300 bytes a document. Whole sets are
    made only for documents that share a bucket with another.
    """
    spec = spec or MinHashSpec()
    sketches = written(sketch(docs, spec, id_col, text_col), "sketches")
    named = sketches.filter("id is not null")
    nodes = written(named.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min("id").alias("rep")), "sets")
    # A node's bands are those of any of its rows; ids repeated with other texts add theirs.
    rep_rows = (
        named.select("id", "s1", "s2", "n_shingles", "bands")
        .join(nodes.select(F.col("rep").alias("id"), "s1", "s2"), ["id", "s1", "s2"])
        .dropDuplicates(["id", "s1", "s2"])
    )
    entries = written(rep_rows.select("id", F.col("n_shingles").alias("n"), "bands"), "bands").select(
        F.explode("bands").alias("key"), "id", "n"
    )
    centres = (
        entries.groupBy("key")
        .agg(F.min("id").alias("centre"), F.max("id").alias("last"))
        .filter("centre < last")
        .select("key", "centre")
    )
    members = written(entries.join(centres, "key"), "members")
    stars = written(
        members.filter("centre <> id").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), "stars"
    )
    wanted = stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id"))).distinct()
    sets = written(shingle_sets(docs, spec, id_col, text_col, wanted), "shingles")
    linked = F.col("common") * 100 >= F.col("total") * spec.percent
    links = written(similarity(stars, sets).filter(linked).select("a", "b"), "links")
    labels = connected_components(links)

    more = written(_across_components(members, labels, sets, spec), "more-links")
    if not more.isEmpty():
        stitched = labels.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = connected_components(stitched.unionByName(more))

    of_node = nodes.join(labels, nodes["rep"] == labels["node"], "left").select(
        "s1", "s2", F.coalesce("component", "rep").alias("of_set")
    )
    placed = named.select("id", "n_shingles", "s1", "s2").join(of_node, ["s1", "s2"], "left")
    nameless = sketches.filter("id is null").select("id", "n_shingles", F.lit(None).cast("long").alias("of_set"))
    return (
        placed.select("id", "n_shingles", F.coalesce("of_set", "id").alias("of_set"))
        .unionByName(nameless)
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.col("of_set").alias("component_id"),
            F.coalesce(F.col("id") == F.col("of_set"), F.lit(True)).alias("kept"),
        )
    )


def _across_components(members: DataFrame, labels: DataFrame, sets: DataFrame, spec: MinHashSpec) -> DataFrame:
    """Links between members of one bucket that are in different components.

    In each bucket with several components the members outside its largest one are
    laid against all members, in chunks of at most about ``spec.chunk`` shingles a
    side. A task sees one pair of chunks and returns the links it finds, so no
    candidate pair is ever a row.
    """
    labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    of_component = labelled.groupBy("key", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    mixed = (
        of_component.groupBy("key")
        .agg(
            F.count("*").alias("components"),
            F.max(F.struct("rows", "component", "n")).alias("largest"),
            F.sum("n").alias("n_all"),
        )
        .filter("components > 1")
        .select(
            "key",
            F.col("largest.component").alias("largest"),
            F.ceil((F.col("n_all") - F.col("largest.n")) / spec.chunk).cast("int").alias("out_chunks"),
            F.ceil(F.col("n_all") / spec.chunk).cast("int").alias("all_chunks"),
        )
    )
    rest = labelled.join(mixed, "key")
    # Some ids have several sets (repeated ids); each is laid against the others.
    mix = F.xxhash64("id", "key")
    outside = rest.filter("component <> largest").select(
        "key",
        F.pmod(mix, F.col("out_chunks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_chunks") - F.lit(1).cast("long"))).alias("j"),
        F.lit(0).alias("side"),
        "id",
        "component",
    )
    everyone = rest.select(
        "key",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_chunks") - F.lit(1).cast("long"))).alias("i"),
        F.pmod(mix, F.col("all_chunks")).alias("j"),
        F.lit(1).alias("side"),
        "id",
        "component",
    )
    cells = (
        outside.unionByName(everyone)
        .join(sets, "id")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side")
        .select("key", "i", "j", "side", "id", "component", "shingles")
    )
    percent = spec.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, found = None, []
        for batch in batches:
            place = list(zip(*(batch.column(k).to_pylist() for k in range(6))))
            shingles = batch.column(6)
            for row, (key, i, j, side, doc, component) in enumerate(place):
                if cell is None or cell.place != (key, i, j):
                    cell = _Cell((key, i, j), percent)
                values = np.sort(shingles[row].values.to_numpy(zero_copy_only=False))
                if side == 0:
                    cell.add(doc, component, values)
                else:
                    found += cell.links(doc, component, values)
            if found:
                links, found = sorted(set(found)), []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
                )

    return cells.mapInArrow(run, "a long, b long").distinct()


class _Cell:
    """Sets of one chunk outside the largest component, indexed by shingle."""

    def __init__(self, place: tuple, percent: int):
        self.place, self.percent = place, percent
        self.docs: list[tuple[int, int]] = []
        self.sets: list[np.ndarray] = []
        self.index: tuple[np.ndarray, ...] | None = None

    def add(self, doc: int, component: int, shingles: np.ndarray) -> None:
        self.docs.append((doc, component))
        self.sets.append(shingles)

    def links(self, doc: int, component: int, shingles: np.ndarray) -> list[tuple[int, int]]:
        """Documents of the chunk in other components that are linked to this one."""
        if not self.sets:  # no text outside the largest component fell into this chunk
            return []
        if self.index is None:
            values = np.concatenate(self.sets)
            owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            order = np.argsort(values, kind="stable")
            self.index = values[order], owner[order], np.array([len(s) for s in self.sets])
            self.components = np.array([c for _, c in self.docs])
        values, owner, sizes = self.index
        lo, hi = np.searchsorted(values, shingles, "left"), np.searchsorted(values, shingles, "right")
        spans = hi - lo
        total = int(spans.sum())
        if not total:
            return []
        # Positions of all matches: each span from its start on.
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(total)
        common = np.bincount(owner[at], minlength=len(sizes))
        near = common * 100 >= (sizes + len(shingles) - common) * self.percent
        hits = np.flatnonzero(near & (self.components != component))
        return [(min(doc, self.docs[h][0]), max(doc, self.docs[h][0])) for h in hits]
