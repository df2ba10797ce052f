"""One pass over the rows for many fits: numpy sums inside tasks, merged by key in a shuffle.

A learner here is a series of such passes. A task sums its rows into one array of
fixed size per key before anything is shuffled, arrays of a key are added in one
task, and only what ``finish`` makes of the sum reaches the driver: its size depends
on the number of fits and inputs, never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Partial = Callable[["Batch"], Iterator[tuple[int, np.ndarray]]]
Finish = Callable[[int, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fits:
    """Which training sets are learned from: set j without the inner fold i, or all of it where i is -1."""

    outers: int
    folds: int

    @property
    def members(self) -> list[tuple[int, int]]:
        inner = range(self.folds) if self.folds > 1 else [-1]
        return [(j, i) for j in range(1, self.outers + 1) for i in inner]

    def __len__(self) -> int:
        return len(self.members)


@dataclass
class Batch:
    """Rows of a stored matrix as arrays: inputs with NaN where missing, label, block and inner folds."""

    raw: pa.RecordBatch
    x: np.ndarray
    label: np.ndarray
    block: np.ndarray
    inner: np.ndarray

    def within(self, outer: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of an outer set, and the inner fold of each."""
        held = self.inner[:, outer - 1]
        mine = np.flatnonzero(held >= 0)
        return mine, held[mine]

    def training(self, fit: tuple[int, int]) -> np.ndarray:
        """Row numbers that a fit learns from."""
        mine = self.inner[:, fit[0] - 1]
        return np.flatnonzero((mine >= 0) & (mine != fit[1]))

    def held_out(self, fit: tuple[int, int]) -> np.ndarray:
        mine = self.inner[:, fit[0] - 1]
        return np.flatnonzero((mine >= 0) & (mine == fit[1]))


def read_batch(raw: pa.RecordBatch) -> Batch:
    """A batch of ``label``, ``block``, ``inner`` and ``x`` (and possibly more); arrays are of equal length."""
    n = raw.num_rows

    def matrix(name: str) -> np.ndarray:
        flat = raw.column(name).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(n, -1) if n else flat.reshape(0, 1)

    label = raw.column("label").to_numpy(zero_copy_only=False).astype(float)
    return Batch(raw, matrix("x"), label, raw.column("block").to_numpy(zero_copy_only=False), matrix("inner"))


def summed(rows: DataFrame, partial: Partial, finish: Finish | None = None) -> dict[int, np.ndarray]:
    """Sum over all rows of the arrays that ``partial`` makes of each batch, by key.

    A task sends one array a key, and a merging task holds one sum a key. Arrays of a
    key are added in the order of their bytes, so that the result does not depend on
    which task was first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for raw in batches:
            if raw.num_rows:
                for key, values in partial(read_batch(raw)):
                    acc[key] = values if key not in acc else acc[key] + values
        if acc:
            parts = [v.astype(float).tobytes() for v in acc.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int64()), pa.array(parts, pa.binary())], names=["key", "part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for raw in batches:
            for key, part in zip(raw.column(0).to_pylist(), raw.column(1).to_pylist()):
                values = np.frombuffer(part)
                acc[key] = acc[key] + values if key in acc else values
        if acc:
            made = [np.asarray(v if finish is None else finish(k, v), dtype=float).tobytes() for k, v in acc.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int64()), pa.array(made, pa.binary())], names=["key", "part"])

    kind = "key long, part binary"
    met = rows.mapInArrow(run, kind).repartition("key").sortWithinPartitions("key", "part")
    return {r["key"]: np.frombuffer(bytes(r["part"])) for r in met.mapInArrow(merge, kind).collect()}


# ---- exact medians -----------------------------------------------------------------

SELECT_BITS = 11


def ordered_codes(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the numbers; -0.0 is 0.0."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def number_of(code: int) -> float:
    bits = code if code >= 0 else code ^ 0x7FFFFFFFFFFFFFFF
    return float(np.array([bits], dtype=np.int64).view(np.float64)[0])


def exact_medians(rows: DataFrame, fits: Fits, width: int) -> np.ndarray:
    """Median of every input over every fit's training rows, NaN where it has no value.

    An even number of values has two middle ranks, which are followed apart.
    """
    found = exact_ranks(rows, fits, width, lambda n: [(n - 1) // 2, n // 2])
    middle = [np.nan if not values else (values[0] + values[1]) / 2 for values in found]
    return np.array(middle).reshape(len(fits), width)


def exact_ranks(
    rows: DataFrame, fits: Fits, width: int, wanted: Callable[[int], list[int]], select_bits: int = SELECT_BITS
) -> list[list[float]]:
    """Values at the ranks that ``wanted`` names for n values, by fit and input; none where there is no value.

    Exact selection: the range of possible codes is cut into equal parts, the parts
    are counted, and the one with the wanted rank becomes the range, for all fits, inputs
    and ranks in the same pass: as many passes as ``select_bits`` goes into 64, whatever the
    number of rows. A value is counted once for each outer set, by its inner fold; a fit's counts are those
    of the other folds. Fits of a set that look at the same range share its counts.
    """
    members, folds = fits.members, max(fits.folds, 1)
    parts = 1 << select_bits
    low: list[list[int]] = [[0] for _ in range(len(members) * width)]
    rank: list[list[int] | None] = [None] * len(low)
    bits = 64
    while bits:
        shift = max(bits - select_bits, 0)
        # Ranges looked at: by input the sorted starts, and the sets that count each.
        starts: list[list[int]] = []
        places: list[tuple[int, int, int]] = []
        at_start: list[dict[int, list[tuple[int, int]]]] = []
        for c in range(width):
            seen: dict[int, set[int]] = {}
            for f, (j, _) in enumerate(members):
                if rank[f * width + c] != []:
                    for start in low[f * width + c]:
                        seen.setdefault(start, set()).add(j)
            starts.append(sorted(seen))
            at_start.append({})
            for k, start in enumerate(starts[c]):
                for j in sorted(seen[start]):
                    at_start[c].setdefault(k, []).append((j, len(places)))
                    places.append((j, c, start))

        def partial(batch: Batch, starts=starts, at_start=at_start, shift=shift, whole=bits == 64) -> Iterator[tuple[int, np.ndarray]]:
            code = np.ascontiguousarray(ordered_codes(batch.x.T)).view(np.uint64) ^ np.uint64(1 << 63)
            has = ~np.isnan(batch.x.T)
            for c in range(width):
                if not starts[c]:
                    continue
                first = np.array(starts[c], dtype=np.uint64)
                keep = has[c]
                if not whole:
                    last = first[-1] + np.uint64((parts << shift) - 1)
                    keep = keep & (code[c] >= first[0]) & (code[c] <= last)
                near = np.flatnonzero(keep)
                values = code[c][near]
                k = np.searchsorted(first, values, side="right") - 1 if len(first) > 1 else np.zeros(len(near), np.int64)
                at = ((values - first[k]) >> np.uint64(shift)).astype(np.int64)
                inside = at < parts
                if not inside.all():
                    near, k, at = near[inside], k[inside], at[inside]
                for n, sets in at_start[c].items():
                    here = np.flatnonzero(k == n) if len(first) > 1 else slice(None)
                    own, part = batch.inner[near[here]], at[here]
                    if not len(part):
                        continue
                    for j, key in sets:
                        held = own[:, j - 1].astype(np.int64)
                        taught = held >= 0
                        if folds == 1:
                            held = np.zeros_like(held)
                        if taught.any():
                            yield key, np.bincount(held[taught] * parts + part[taught], minlength=folds * parts)

        def finish(key: int, total: np.ndarray, places=places, low=low, rank=rank) -> np.ndarray:
            j, c, start = places[key]
            by_fold = total.reshape(folds, parts)
            out: list[float] = []
            for f, (outer, i) in enumerate(members):
                if outer != j or rank[f * width + c] == []:
                    continue
                counts = by_fold[np.arange(folds) != i].sum(axis=0)
                upto = np.cumsum(counts)
                ranks = rank[f * width + c]
                if ranks is None:
                    ranks = wanted(int(upto[-1])) if upto[-1] else []
                    starts_of = [start] * len(ranks)
                else:
                    starts_of = low[f * width + c]
                for t, (r, own) in enumerate(zip(ranks, starts_of)):
                    if own == start:
                        b = int(np.searchsorted(upto, r, side="right"))
                        out += [f, t, b, r - (upto[b - 1] if b else 0)]
            return np.array(out)

        found = summed(rows, partial, finish)
        next_low: list[dict[int, int]] = [{} for _ in low]
        next_rank: list[dict[int, int]] = [{} for _ in low]
        for key, got in found.items():
            _, c, start = places[key]
            for f, t, b, left in got.reshape(-1, 4).astype(np.int64).tolist():
                next_low[f * width + c][t] = start + (b << shift)
                next_rank[f * width + c][t] = left
        low = [[x[t] for t in sorted(x)] for x in next_low]
        rank = [[x[t] for t in sorted(x)] for x in next_rank]
        bits = shift
    return [[number_of(start - (1 << 63)) for start in x] for x in low]


# ---- centre and spread -------------------------------------------------------------


def filled(x: np.ndarray, median: np.ndarray) -> np.ndarray:
    """Missing inputs replaced by medians; an input without any value is 0."""
    return np.where(np.isnan(x), np.nan_to_num(median, nan=0.0), x)


def moments(rows: DataFrame, fits: Fits, median: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, population deviations (1 where an input does not vary) and per fit the rows and positives."""
    members, folds = fits.members, max(fits.folds, 1)
    at = np.nan_to_num(median, nan=0.0)
    # Rows are summed once for each outer set, by inner fold, as distances from its first fit's medians.
    near = {j: at[f] for f, (j, _) in reversed(list(enumerate(members)))}

    def partial(batch: Batch) -> Iterator[tuple[int, np.ndarray]]:
        has = ~np.isnan(batch.x)
        for j in near:
            mine, held = batch.within(j)
            if not len(mine):
                continue
            there = has[mine]
            away = np.where(there, batch.x[mine] - near[j], 0.0)
            values = np.column_stack([np.ones(len(mine)), batch.label[mine], there, away, away**2])
            own = held[:, None] == np.arange(folds) if folds > 1 else np.ones((len(mine), 1))
            yield j, (own.astype(float).T @ values).ravel()

    width = median.shape[1]
    found = summed(rows, partial)
    total = np.zeros((len(members), 2 + 2 * width))
    for f, (j, i) in enumerate(members):
        if j in found:
            own = found[j].reshape(folds, -1)[np.arange(folds) != i].sum(axis=0)
            n_there, first, second = own[2:].reshape(3, width)
            moved = at[f] - near[j]
            total[f] = np.concatenate([own[:2], first - n_there * moved, second - 2 * moved * first + n_there * moved**2])
    n = np.maximum(total[:, :1], 1)
    first, second = total[:, 2 : 2 + width] / n, total[:, 2 + width :] / n
    spread = np.sqrt(np.maximum(second - first**2, 0))
    return at + first, np.where(spread > 1e-12 * np.maximum(np.abs(at + first), 1), spread, 1.0), total[:, :2]


# ---- logistic regression -----------------------------------------------------------


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


def newton_logistic(
    rows: DataFrame,
    fits: Fits,
    median: np.ndarray,
    center: np.ndarray,
    spread: np.ndarray,
    max_iter: int,
    tol: float = 1e-9,
) -> np.ndarray:
    """Coefficients, intercept last, that minimise summed log loss plus half the squared coefficients.

    Each step is one pass: loss, gradient and second derivatives at all fits' current
    points, as one array a fit; the step itself solves a system as wide as the inputs.
    Rows of an outer set are scaled once, by its first fit; sums are turned into each fit's own scale afterwards.
    A step that raises the objective is halved. Stops when every gradient is below
    ``tol`` times the number of rows.
    """
    members, width = fits.members, median.shape[1]
    ridge = np.append(np.ones(width), 0.0)
    now = np.zeros((len(members), width + 1))
    best = np.full(len(members), np.inf)
    good = now.copy()
    active = set(range(len(members)))
    lead = {j: f for f, (j, _) in reversed(list(enumerate(members)))}
    # A fit's scaled inputs and its one are a linear map of those of its set's first fit.
    turn = []
    for f, (j, _) in enumerate(members):
        a = np.diag(np.append(spread[lead[j]] / spread[f], 1.0))
        a[:-1, -1] = (center[lead[j]] - center[f]) / spread[f]
        turn.append(a)
    filler = np.nan_to_num(median, nan=0.0)
    for _ in range(max_iter):
        points = now.copy()
        wanted = sorted(active)

        def partial(batch: Batch) -> Iterator[tuple[int, np.ndarray]]:
            for j, first in lead.items():
                own = [f for f in wanted if members[f][0] == j]
                mine, held = batch.within(j) if own else ([], None)
                if not len(mine):
                    continue
                z = np.ones((len(mine), width + 1))
                z[:, :-1] = (batch.x[mine] - center[first]) / spread[first]
                y, absent = batch.label[mine], np.isnan(z[:, :-1])
                holes = [(c, np.flatnonzero(absent[:, c])) for c in np.flatnonzero(absent.any(axis=0))]
                for f in own:
                    for c, at in holes:
                        z[at, c] = (filler[f, c] - center[first, c]) / spread[first, c]
                    taught = (held != members[f][1]).astype(float)
                    margin = z @ (points[f] @ turn[f])
                    p = probability(margin)
                    loss = taught @ (np.logaddexp(0, margin) - y * margin)
                    second = z.T @ (z * (p * (1 - p) * taught)[:, None])
                    yield f, np.concatenate([[taught.sum(), loss], z.T @ ((p - y) * taught), second.ravel()])

        found = summed(rows, partial)
        for f in wanted:
            values = found.get(f)
            if values is None:
                active.discard(f)
                continue
            n, loss = values[0], values[1] + (ridge * points[f] ** 2).sum() / 2
            if loss > best[f] + 1e-9 * max(1.0, abs(best[f])):
                now[f] = (good[f] + points[f]) / 2
                continue
            best[f], good[f] = loss, points[f]
            gradient = turn[f] @ values[2 : 3 + width] + ridge * points[f]
            if np.abs(gradient).max() <= tol * max(n, 1):
                active.discard(f)
                continue
            second = turn[f] @ values[3 + width :].reshape(width + 1, width + 1) @ turn[f].T + np.diag(ridge + 1e-10)
            now[f] = points[f] - np.linalg.solve(second, gradient)
        if not active:
            break
    return good


# ---- boosted trees -----------------------------------------------------------------

BINS = 32
EDGE_BITS = 8  # 31 ranges of 256 parts at most are counted at once
STORE_EVERY = 10


@dataclass(frozen=True)
class BoostSpec:
    """Rounds, depth and step, and the fewest rows and least curvature on each side of a split.

    A fit that holds rows out stops when their loss has not improved for ``patience``
    rounds, and keeps its trees up to the best one.
    """

    rounds: int = 100
    patience: int = 10
    depth: int = 4
    step: float = 0.1
    min_rows: int = 5
    min_curvature: float = 1e-3


@dataclass
class Trees:
    """Full binary trees of one fit in heap order; feature -1 sends every row to the left."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Summed leaf values of rows without missing inputs; a row goes left where input <= threshold."""
        out = np.full(len(x), self.base)
        every = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            out += value[_leaf(lambda f, node: x[every, f] > threshold[node], feature, len(x))]
        return out

    def leaf(self, tree: int, x: np.ndarray) -> np.ndarray:
        """Leaf numbers of one tree."""
        every, threshold = np.arange(len(x)), self.threshold[tree]
        return _leaf(lambda f, node: x[every, f] > threshold[node], self.feature[tree], len(x))


def _leaf(right: Callable, feature: np.ndarray, n: int) -> np.ndarray:
    node = np.zeros(n, dtype=np.int64)
    inner = len(feature)
    for _ in range(inner.bit_length()):
        f = feature[node]
        node = 2 * node + 1 + (right(np.maximum(f, 0), node) & (f >= 0))
    return node - inner


def place_in_level(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Places of rows among the nodes of a level, from binned inputs: one comparison a node, for all rows at once."""
    place = np.zeros(bins.shape[1], dtype=np.min_scalar_type((2 << depth) - 1))
    for level in range(depth):
        right = np.zeros(bins.shape[1], dtype=bool)
        for k, node in enumerate(range((1 << level) - 1, (2 << level) - 1)):
            if feature[node] >= 0:
                right |= (bins[feature[node]] > np.uint8(cut[node])) & (place == k)
        place = place * 2 + right
    return place


def bin_edges(rows: DataFrame, outers: int, width: int) -> list[list[np.ndarray]]:
    """At most 31 cut points per outer set and input: exact quantiles of its own training rows."""
    found = exact_ranks(rows, Fits(outers, 1), width, lambda n: [-(-n * i // BINS) - 1 for i in range(1, BINS)], EDGE_BITS)
    return [[np.unique(np.array(found[j * width + c], dtype=float)) for c in range(width)] for j in range(outers)]


def best_split(total: np.ndarray, width: int, spec: BoostSpec) -> np.ndarray:
    """Feature, bin, and gradient and curvature left and right of the best split of a node's histogram.

    Feature -1 where no split has enough on both sides or gains anything; all is left then.
    """
    g, h, n = total.reshape(3, width, BINS).cumsum(axis=2)
    all_g, all_h, all_n = g[0, -1], h[0, -1], n[0, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g**2 / h + (all_g - g) ** 2 / (all_h - h) - all_g**2 / max(all_h, 1e-300)
    fair = (n >= spec.min_rows) & (all_n - n >= spec.min_rows)
    fair &= (h >= spec.min_curvature) & (all_h - h >= spec.min_curvature)
    gain = np.where(fair, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[f, b] > 1e-9:
        return np.array([-1, 0, all_g, all_h, 0, 0])
    return np.array([f, b, g[f, b], h[f, b], all_g - g[f, b], all_h - h[f, b]])


def boosted_trees(
    rows: DataFrame, fits: Fits, median: np.ndarray, counts: np.ndarray, spec: BoostSpec, store: Callable
) -> list[Trees]:
    """Second-order boosting for log loss, all fits side by side, one pass for every level of every round.

    Inputs are cut into at most 32 bins once for each outer set. A pass finds each training row's
    node and sums gradient, curvature and rows by (fit, node, input, bin); the sums of
    a node meet in one task, which returns its best split. Margins are stored with the
    rows every ten rounds by ``store``, which also ends the lineage; between, a pass
    adds the trees since then. The first pass of a round also sums the loss of the rows
    held out.
    """
    members, width = fits.members, median.shape[1]
    edges = bin_edges(rows, fits.outers, width)
    slots = (1 << spec.depth) - 1
    losses = len(members) * slots
    base = np.log(np.clip((counts[:, 1] + 1e-9) / np.maximum(counts[:, 0], 1e-9), 1e-6, 1 - 1e-6))
    base -= np.log1p(-np.exp(base))
    missing = np.array(
        [[np.searchsorted(edges[j - 1][c], np.nan_to_num(median[f, c])) for c in range(width)] for f, (j, _) in enumerate(members)],
        dtype=np.uint8,
    )
    made = [Trees(float(base[f]), np.empty((0, slots), int), np.empty((0, slots)), np.empty((0, slots + 1))) for f in range(len(members))]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            batch = read_batch(raw)
            bins = np.full((len(batch.x), fits.outers, width), 255, dtype=np.uint8)
            for j in range(fits.outers):
                for c in range(width):
                    has = ~np.isnan(batch.x[:, c])
                    bins[has, j, c] = np.searchsorted(edges[j][c], batch.x[has, c])
            margins = np.broadcast_to(base, (len(batch.x), len(members)))
            yield _state(raw, bins, margins)

    def _state(raw: pa.RecordBatch, bins: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
        n = raw.num_rows
        flat = pa.array(np.ascontiguousarray(margins).ravel(), pa.float64())
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * margins.shape[1] if n else np.zeros(1, np.int32))
        packed = pa.array([row.tobytes() for row in bins], pa.binary())
        columns = [raw.column(c) for c in ("label", "block", "inner")]
        return pa.RecordBatch.from_arrays(
            [*columns, packed, pa.ListArray.from_arrays(offsets, flat)], names=["label", "block", "inner", "bins", "x"]
        )

    def bins_of(batch: Batch) -> np.ndarray:
        packed, size = batch.raw.column("bins"), fits.outers * width
        flat = np.frombuffer(packed.buffers()[2], dtype=np.uint8) if len(packed) else np.empty(0, np.uint8)
        return flat[packed.offset * size : (packed.offset + len(packed)) * size].reshape(-1, fits.outers, width)

    def own_bins(bins: np.ndarray, f: int) -> np.ndarray:
        """Bins of a fit, one row an input."""
        mine = np.ascontiguousarray(bins[:, members[f][0] - 1].T)
        return np.where(mine == 255, missing[f][:, None], mine)

    def add(margin: np.ndarray, bins: np.ndarray, trees: list) -> np.ndarray:
        for feature, cut, value in trees:
            margin = margin + value[place_in_level(bins, feature, cut, spec.depth)]
        return margin

    schema = T.StructType(
        [rows.schema[c] for c in ("label", "block", "inner")]
        + [T.StructField("bins", T.BinaryType()), T.StructField("x", T.ArrayType(T.DoubleType()))]
    )
    state = store(rows.select("label", "block", "inner", "x").mapInArrow(start, schema))
    since: list[list] = [[] for _ in members]
    best = [(np.inf, 0)] * len(members)
    active = list(range(len(members)))
    for round_number in range(spec.rounds):
        feature = np.full((len(members), slots), -1, dtype=np.int64)
        cut = np.zeros((len(members), slots), dtype=np.int64)
        value = np.zeros((len(members), slots + 1))
        held: dict[int, np.ndarray] = {}
        for level in range(spec.depth):
            first = (1 << level) - 1
            grown, cuts = feature[:, :first].copy(), cut[:, :first].copy()

            def partial(batch: Batch) -> Iterator[tuple[int, np.ndarray]]:
                bins = bins_of(batch)
                for f in active:
                    if not first:
                        out = batch.held_out(members[f])
                        margin = add(batch.x[out, f], own_bins(bins[out], f), since[f])
                        loss = np.logaddexp(0, margin).sum() - (batch.label[out] * margin).sum()
                        yield losses + f, np.array([loss, len(out)])
                    mine = batch.training(members[f])
                    if not len(mine):
                        continue
                    own = own_bins(bins[mine], f)
                    p = probability(add(batch.x[mine, f], own, since[f]))
                    node = place_in_level(own, grown[f], cuts[f], level).astype(np.int64)
                    weights = (p - batch.label[mine], p * (1 - p), None)
                    sums = np.empty((1 << level, 3, width, BINS))
                    for c in range(width):
                        place = node * BINS + own[c]
                        for k, w in enumerate(weights):
                            sums[:, k, c] = np.bincount(place, weights=w, minlength=BINS << level).reshape(-1, BINS)
                    for k in np.unique(node).tolist():
                        yield f * slots + first + k, sums[k].ravel()

            def finish(key: int, total: np.ndarray) -> np.ndarray:
                return total if key >= losses else best_split(total, width, spec)

            for key, split in summed(state, partial, finish).items():
                if key >= losses:
                    held[key - losses] = split
                    continue
                f, node = divmod(int(key), slots)
                feature[f, node], cut[f, node] = int(split[0]), int(split[1])
                if level == spec.depth - 1:
                    for side in (0, 1):
                        g, h = split[2 + 2 * side : 4 + 2 * side]
                        value[f, 2 * node + 1 + side - slots] = -spec.step * g / h if h > 0 else 0.0
            if not level:
                for f, (loss, n) in held.items():
                    if n and loss < best[f][0] - 1e-7 * n:
                        best[f] = (loss, round_number)
                active = [f for f in active if held.get(f, (0, 0))[1] == 0 or round_number - best[f][1] < spec.patience]
                if not active:
                    break
        if not active:
            break
        for f in active:
            j = members[f][0]
            since[f].append((feature[f], cut[f], value[f]))
            real = [edges[j - 1][c][b] if c >= 0 else 0.0 for c, b in zip(feature[f], cut[f])]
            made[f].feature = np.vstack([made[f].feature, feature[f]])
            made[f].threshold = np.vstack([made[f].threshold, real])
            made[f].value = np.vstack([made[f].value, value[f]])
        if (round_number + 1) % STORE_EVERY == 0 and round_number + 1 < spec.rounds:

            def advance(batches: Iterator[pa.RecordBatch], since=since) -> Iterator[pa.RecordBatch]:
                for raw in batches:
                    batch = read_batch(raw)
                    bins = bins_of(batch)
                    margins = [add(batch.x[:, f], own_bins(bins, f), since[f]) for f in range(len(members))]
                    yield _state(raw, bins, np.column_stack(margins))

            state = store(state.mapInArrow(advance, schema))
            since = [[] for _ in members]
    for f, trees in enumerate(made):
        if np.isfinite(best[f][0]) and f not in active:
            trees.feature, trees.threshold, trees.value = (x[: best[f][1]] for x in (trees.feature, trees.threshold, trees.value))
    return made


# ---- isotonic calibration ----------------------------------------------------------


def pool(points: np.ndarray) -> np.ndarray:
    """Adjacent violators pooled: rows of lowest score, highest score, weight and sum of labels, by score.

    Pooling is associative: pools of two neighbouring ranges of scores, put one after
    the other and pooled, are the pools of both.
    """
    out: list[list[float]] = []
    for row in points.tolist():
        out.append(row)
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            low, high = out[-2], out.pop()
            out[-1] = [low[0], high[1], low[2] + high[2], low[3] + high[3]]
    return np.array(out).reshape(-1, 4)


RANGES = 256
FAN = 16


def calibrator_pools(points: DataFrame) -> DataFrame:
    """Pools of every ``fit``: ``lo``, ``hi``, ``weight`` and ``rate``, from ``fit``, ``score``, ``label``.

    Scores are cut to a grid of a millionth and counted, which bounds what is left by
    the grid. Each of 256 ranges of scores is pooled in its own task, then 16
    neighbours together, then all: three rounds of the same merge. Scores outside 0 to
    1, missing scores and missing labels belong to no pool.
    """
    kept = points.filter(F.col("score").between(0, 1) & F.col("label").isNotNull() & ~F.isnan("score"))
    counted = kept.groupBy("fit", F.bround("score", 6).alias("lo")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum(F.col("label").cast("double")).alias("hits")
    )
    now = counted.select(
        "fit", F.least(F.floor(F.col("lo") * RANGES), F.lit(RANGES - 1)).cast("long").alias("part"), "lo", F.col("lo").alias("hi"), "weight", "hits"
    )
    kind = "fit long, part long, lo double, hi double, weight double, hits double"

    def merged(group: pa.Table) -> pa.Table:
        values = np.column_stack([group[c].to_numpy() for c in ("lo", "hi", "weight", "hits")])
        pools = pool(values[np.argsort(values[:, 0], kind="stable")])
        n = len(pools)
        fit, part = group["fit"][0].as_py(), group["part"][0].as_py()
        return pa.table(
            [pa.array([fit] * n, pa.int64()), pa.array([part] * n, pa.int64()), *(pa.array(c) for c in pools.T)],
            names=["fit", "part", "lo", "hi", "weight", "hits"],
        )

    span = 1
    while True:
        now = now.select(F.col("fit").cast("long").alias("fit"), "part", "lo", "hi", "weight", "hits")
        now = now.groupBy("fit", "part").applyInArrow(merged, kind)
        if span >= RANGES:
            break
        now = now.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
        span *= FAN
    return now.select("fit", "lo", "hi", "weight", (F.col("hits") / F.col("weight")).alias("rate"))
