"""Near-duplicate vectors by lattice hashing.

A table projects unit vectors at random onto blocks of eight coordinates and takes
each block to the nearest point of the E8 lattice; the points are the cell. Close
vectors fall into one cell or into neighbouring ones, so a vector also looks into
the cells of the lattice points next nearest to it. Most vectors that meet in a cell
are strangers: short sketches, which no two close vectors can tell apart, go to the cells
first, and whole vectors only where a sketch found company. Every pair is confirmed
by its cosine, inside the task that holds the cell: only link counts and stars leave it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import cut_lineage

from .arrow import append_columns
from .components import connected_components

DIMS = 8


@dataclass(frozen=True)
class LatticeSpec:
    """Size of the cells, tables, blocks a table, and neighbouring cells probed a block.

    Measured on random pairs of 64 dimensions at a cosine of 0.95, one table of
    these parameters finds one half, at 0.97 seven tenths; 16 tables miss one or
    two in a hundred thousand at 0.95. Unrelated vectors share a probed cell with a
    chance of about one in a hundred thousand a table. A task meets two chunks of a
    cell at a time, of about ``chunk`` vectors each.
    """

    cosine: float = 0.95
    tables: int = 16
    blocks: int = 2
    probes: int = 4
    spacing: float = 0.6
    seed: int = 11
    chunk: int = 4096

    @property
    def per_table(self) -> int:
        return 1 + self.blocks * self.probes


@cache
def roots() -> np.ndarray:
    """The 240 shortest E8 points: two entries of one, or eight of one half with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(DIMS), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(DIMS)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=DIMS):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum: round, and where the sum is odd round the worst entry the other way."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of even integer points and those moved by one half."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def projection(spec: LatticeSpec, table: int, dims: int) -> np.ndarray:
    """Columns keep squared lengths on average in each block, in units of the cell size."""
    rng = np.random.default_rng([spec.seed, table, dims])
    width = DIMS * spec.blocks
    raw = rng.normal(size=(dims, width))
    if dims >= width:
        raw = np.linalg.qr(raw)[0] * np.sqrt(dims)
    return raw / np.sqrt(DIMS) / spec.spacing


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _cell_key(points: list[np.ndarray], table: int, dims: int) -> np.ndarray:
    # Mixed before the first coordinate too: small table numbers and coordinates would cancel out.
    h = _mixed(np.full(len(points[0]), table + 1 + (dims << 16), dtype=np.uint64))
    for block in points:
        for column in (2 * block).astype(np.int64).T:
            h = _mixed(h ^ column.astype(np.uint64))
    return h.view(np.int64)


def cells(unit: np.ndarray, spec: LatticeSpec) -> np.ndarray:
    """Keys of every vector: per table its own cell first, then the probed ones."""
    keys = []
    for table in range(spec.tables):
        projected = unit @ projection(spec, table, unit.shape[1])
        blocks = [projected[:, DIMS * b : DIMS * (b + 1)] for b in range(spec.blocks)]
        own = [nearest_e8(x) for x in blocks]
        keys.append(_cell_key(own, table, unit.shape[1]))
        for b, (x, point) in enumerate(zip(blocks, own)):
            near = np.argsort(-((x - point) @ roots().T), axis=1, kind="stable")[:, : spec.probes]
            for k in range(spec.probes):
                moved = own[:b] + [point + roots()[near[:, k]]] + own[b + 1 :]
                keys.append(_cell_key(moved, table, unit.shape[1]))
    return np.stack(keys, axis=1)


# A sketch has three coordinates out of eight, each a byte over five deviations of a random unit vector.
SKETCHED, DEVIATIONS, TOP = 0.375, 5.0, 127


def _sketch_width(dims: int) -> int:
    return min(dims, DIMS * int(np.ceil(dims * SKETCHED / DIMS)))


def _sketch_step(dims: int) -> float:
    return DEVIATIONS / TOP / np.sqrt(dims)


@cache
def _sketch_basis(dims: int, seed: int) -> np.ndarray:
    """Orthonormal columns, so that no distance grows."""
    rng = np.random.default_rng([seed, dims])
    return np.linalg.qr(rng.normal(size=(dims, _sketch_width(dims))))[0]


def sketches(unit: np.ndarray, spec: LatticeSpec) -> np.ndarray:
    """Some coordinates of every vector in a turned basis, as bytes; clipping and rounding move each by little."""
    dims = unit.shape[1]
    turned = unit @ _sketch_basis(dims, spec.seed)
    return np.clip(np.rint(turned / _sketch_step(dims)), -TOP, TOP).astype(np.int8)


def sketch_bound(dims: int, spec: LatticeSpec) -> float:
    """Squared distance of two sketches that vectors at the wanted cosine cannot exceed.

    Projecting and clipping bring points no further apart; rounding moves each
    coordinate of a difference by one step at most.
    """
    apart = np.sqrt(max(0.0, 2 - 2 * spec.cosine) + 1e-9)
    step = _sketch_step(dims)
    return float((apart / step + np.sqrt(_sketch_width(dims))) ** 2 * (1 + 1e-9))


def usable(vector: Column) -> Column:
    """A vector with entries, all finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


STRIP = 256  # rows of a block product
_NEAR = 1e-12  # cosines this close to the bound are added up once more in order


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after links ``a`` - ``b``: the smallest position reachable."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _first_met(own: np.ndarray, keys: np.ndarray, a: np.ndarray, b: np.ndarray, table: int, key: int) -> np.ndarray:
    """Which pairs meet in the cell ``key`` of ``table`` and in none before it.

    ``own`` holds a key a table, ``keys`` all keys of each table. Cells come in order
    of tables; the two cells of one table in which neighbours meet, in order of keys.
    """
    left = np.arange(len(a))
    for t in range(table):
        x, y = a[left], b[left]
        met = np.zeros(len(left), dtype=bool)
        for k in range(keys.shape[2]):
            met |= (own[x, t] == keys[y, t, k]) | (own[y, t] == keys[x, t, k])
        left = left[~met]
        if not len(left):
            return left
    x, y = a[left], b[left]
    # The pair's other cell of this table, if both look into both.
    other = np.where(own[x, table] == key, own[y, table], own[x, table])
    again = (own[x, table][:, None] == keys[y, table]).any(1) & (own[y, table][:, None] == keys[x, table]).any(1)
    return left[~again | (other >= key)]


def _links_of_cell(
    unit: np.ndarray, keys: np.ndarray, owner: np.ndarray, side: np.ndarray, weight: np.ndarray, key: int, table: int, spec: LatticeSpec
) -> tuple[np.ndarray, np.ndarray]:
    """For every row its weight of links first met here, and its component's first row.

    ``side`` is 0 and 1 for two chunks laid over each other, 0 throughout for one with itself.
    """
    keys = keys.reshape(len(unit), spec.tables, spec.per_table)
    own = np.ascontiguousarray(keys[:, :, 0])
    label = np.arange(len(unit))
    around = np.zeros(len(unit))
    rows, columns = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
    across = side.max() == 1
    for start in range(0, len(rows), STRIP):
        strip = rows[start : start + STRIP]
        cosine = unit[strip] @ unit[columns].T
        near = (cosine >= spec.cosine - _NEAR) & (owner[strip][:, None] | owner[columns][None, :])
        if not across:
            near &= strip[:, None] < columns[None, :]
        i, j = np.nonzero(near)
        a, b = strip[i], columns[j]
        close = np.flatnonzero(np.abs(cosine[i, j] - spec.cosine) <= _NEAR)
        if len(close):
            total = np.zeros(len(close))
            for d in range(unit.shape[1]):
                total += unit[a[close], d] * unit[b[close], d]
            gone = np.zeros(len(a), dtype=bool)
            gone[close[total < spec.cosine]] = True
            a, b = a[~gone], b[~gone]
        first = _first_met(own, keys, a, b, table, key)
        a, b = a[first], b[first]
        if len(a):
            around += np.bincount(a, weight[b], len(unit)) + np.bincount(b, weight[a], len(unit))
            label = _joined(label, a, b)
    return around.astype(np.int64), label


def _look(spec: LatticeSpec):
    """Nodes to a row for each cell they look into: its key, node and place as one number, and the sketch."""
    places = spec.tables * spec.per_table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A node becomes many rows, so batches are cut.
        for batch in (b.slice(low, STRIP) for b in batches for low in range(0, b.num_rows, STRIP)):
            units = batch.column("unit")
            sizes = np.diff(units.offsets.to_numpy())
            flat, starts = units.values.to_numpy(), units.offsets.to_numpy()[:-1]
            nodes = batch.column("node").to_numpy()
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                unit = flat[starts[mine][:, None] + np.arange(size)]
                tags = nodes[mine][:, None] * places + np.arange(places)
                short = [s.tobytes() for s in sketches(unit, spec)]
                made = [
                    pa.array(cells(unit, spec).ravel()),
                    pa.array(tags.ravel()),
                    pa.array(short, pa.binary()).take(pa.array(np.repeat(np.arange(len(mine)), places))),
                ]
                yield pa.RecordBatch.from_arrays([*made, pa.array(np.full(tags.size, size, np.int32))], names=["key", "tag", "sketch", "dims"])

    return run


FEW = 64  # rows of a cell up to which its pairs are formed beside those of other cells


def _in_company(key: np.ndarray, own: np.ndarray, sketch: np.ndarray, bound: float) -> np.ndarray:
    """Which rows, sorted by cell, have another one of their cell within ``bound``, one of the two its owner."""
    met = np.zeros(len(key), dtype=bool)
    starts = np.concatenate([[0], 1 + np.flatnonzero(key[1:] != key[:-1])])
    size = np.diff(np.append(starts, len(key)))
    owned = np.add.reduceat(own, starts, dtype=np.int64) > 0
    # Rows of small cells beside the row k places on, for all cells at once.
    ends = np.repeat(np.where(owned & (size <= FEW), starts + size, 0), size)
    left = np.arange(len(key))
    for k in range(1, FEW):
        left = left[left + k < ends[left]]
        if not len(left):
            break
        a = left[own[left] | own[left + k]]
        apart = sketch[a].astype(np.int32) - sketch[a + k]
        near = a[np.einsum("ij,ij->i", apart, apart) <= bound]
        met[near] = met[near + k] = True
    for c in np.flatnonzero(owned & (size > FEW)):
        rows = np.arange(starts[c], starts[c] + size[c])
        short = sketch[rows].astype(np.float64)
        length = (short**2).sum(1)
        for low in range(0, len(rows), STRIP):
            part = slice(low, low + STRIP)
            near = length[part, None] + length - 2 * short[part] @ short.T <= bound
            near &= own[rows[part]][:, None] | own[rows]
            near[np.arange(near.shape[0]), np.arange(low, low + near.shape[0])] = False
            met[rows[part]] |= near.any(1)
    return met


def _find_company(spec: LatticeSpec):
    """Rows sorted by cell to ``key`` and ``tag`` of those that may have a link there.

    A cell of more than a chunk is not looked at here: all its rows go on, and are cut into chunks then.
    """

    def judged(cells: pa.Table) -> pa.RecordBatch | None:
        key, tag = cells.column("key").to_numpy(), cells.column("tag").to_numpy()
        # Cells of one row are most of all.
        other = np.concatenate([[False], key[1:] == key[:-1], [False]])
        rows = np.flatnonzero(other[1:] | other[:-1])
        dims = cells.column("dims").to_numpy()[rows]
        short = cells.column("sketch").take(pa.array(rows))
        found = []
        for size in np.unique(dims):
            mine = np.flatnonzero(dims == size)
            packed = np.frombuffer(b"".join(short.take(pa.array(mine)).to_pylist()), dtype=np.int8).reshape(len(mine), -1)
            at = rows[mine]
            found.append(at[_in_company(key[at], tag[at] % spec.per_table == 0, packed, sketch_bound(int(size), spec))])
        if not found:
            return None
        kept = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(tag[kept])], names=["key", "tag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        crowd = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            if crowd is not None:
                own = int(np.searchsorted(key != crowd, True)) if key[-1] != crowd else len(key)
                yield batch.slice(0, own).select(["key", "tag"])
                batch, key = batch.slice(own), key[own:]
                if not len(key):
                    continue
                crowd = None
            # All cells but the last one are whole.
            last = int(len(key) - np.searchsorted(key[::-1] != key[-1], True)) if key[0] != key[-1] else 0
            if last or (held and held[-1].column("key")[-1].as_py() != key[0]):
                found = judged(pa.Table.from_batches([*held, batch.slice(0, last)]))
                if found is not None and found.num_rows:
                    yield found
                held = []
            held.append(batch.slice(last))
            if sum(b.num_rows for b in held) > spec.chunk:
                crowd = key[-1]
                yield from (b.select(["key", "tag"]) for b in held)
                held = []
        if held:
            found = judged(pa.Table.from_batches(held))
            if found is not None and found.num_rows:
                yield found

    return run


def _link_cells(spec: LatticeSpec):
    """Rows sorted by cell to ``node``, ``around`` and ``star``, one row for each linked row of a cell."""
    place = ["key", "lo", "hi"]

    def links(cell: pa.Table) -> pa.RecordBatch | None:
        n = cell.num_rows
        packed = np.frombuffer(b"".join(cell.column("pack").to_pylist()), dtype=np.int64).reshape(n, -1)
        width = spec.tables * spec.per_table
        one = {c: cell.column(c)[0].as_py() for c in ("key", "lo", "hi", "at")}
        numbers = {c: cell.column(c).to_numpy() for c in ("chunk", "weight")}
        side = (numbers["chunk"] != one["lo"]).astype(int)
        # A chunk whose partner is empty has nothing to meet there.
        if one["lo"] != one["hi"] and (side.min() == side.max()):
            return None
        around, label = _links_of_cell(
            np.ascontiguousarray(packed[:, width:]).view(np.float64),
            packed[:, :width],
            cell.column("own").to_numpy(zero_copy_only=False),
            side,
            numbers["weight"],
            one["key"],
            one["at"] // spec.per_table,
            spec,
        )
        linked = np.flatnonzero(around)
        node = cell.column("node").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [node.take(pa.array(linked)), pa.array(around[linked]), node.take(pa.array(label[linked]))],
            names=["node", "around", "star"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in place], axis=1)
            starts = np.concatenate([[0], 1 + np.flatnonzero((cell[1:] != cell[:-1]).any(1)), [len(cell)]])
            for low, high in itertools.pairwise(starts):
                now = tuple(cell[low])
                if held and now != last:
                    found = links(pa.Table.from_batches(held))
                    if found is not None and found.num_rows:
                        yield found
                    held = []
                held.append(batch.slice(low, high - low))
                last = now
        if held:
            found = links(pa.Table.from_batches(held))
            if found is not None and found.num_rows:
                yield found

    return run


def linked_vectors(
    vectors: DataFrame,
    spec: LatticeSpec | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows with a cosine of at least ``spec.cosine`` in
    double precision; ``component_id`` is the smallest id reachable over links.
    Vectors that are null, empty, zero or hold null or non-finite entries link with
    nothing, as do rows with a null id (no component, kept) and vectors of
    different lengths with each other. Repeated rows are copies and count as
    links. An empty table gives an empty table. Other columns are ignored.

    Equal vectors are one node with a weight before anything is paired. Sketches go to
    the cells and say which vectors may have a link there, none that has one being left
    out: only those are sent, so that they grow with the links and not with the strangers
    that meet. A crowded cell is cut into chunks, two of which meet in a task. Pairs exist only
    there, as block products: a link counts in the first cell its vectors share, and
    what comes out is a count and a star edge for each vector of a cell.
    """
    spec = spec or LatticeSpec()
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    ).withColumn("h1", F.when(F.col("id").isNotNull() & usable(F.col("v")), F.xxhash64("v")))
    rows = rows.withColumn("h2", F.when(F.col("h1").isNotNull(), F.xxhash64(F.lit(1), "v")))
    # One row per distinct vector; -0.0 and 0.0 hash apart and are then found as a pair.
    groups = rows.filter("h1 is not null").groupBy("h1", "h2")
    nodes = cut_lineage(
        groups.agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.any_value("v").alias("v"))
        # Stored at once, so that the numbers stay.
        .withColumn("node", F.monotonically_increasing_id())
        # Scaled by the largest entry first, so that squares neither overflow nor vanish.
        .withColumn("top", F.array_max(F.transform("v", lambda x: F.abs(x))))
        .withColumn("v", F.transform("v", lambda x: x / F.col("top")))
        .withColumn("length", F.sqrt(_dot(F.col("v"), F.col("v"))))
        .withColumn("unit", F.transform("v", lambda x: x / F.col("length")))
        .drop("v", "top", "length")
    )

    places = spec.tables * spec.per_table
    looked = cut_lineage(
        nodes.select("node", "unit")
        .mapInArrow(_look(spec), "key long, tag long, sketch binary, dims int")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_find_company(spec), "key long, tag long")
        .select("key", F.expr(f"tag div {places}").alias("node"), (F.col("tag") % places).cast("int").alias("at"))
        .withColumn("own", F.col("at") % spec.per_table == 0)
    )

    def start():
        def compute(units: list) -> list[list]:
            packs: list = [None] * len(units)
            by_size: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                by_size.setdefault(len(u), []).append(i)
            for at in by_size.values():
                unit = np.array([units[i] for i in at])
                for i, u, keys in zip(at, unit, cells(unit, spec)):
                    packs[i] = keys.tobytes() + u.tobytes()
            return [packs]

        return compute

    found_some = nodes.join(looked.select("node").distinct(), "node", "left_semi")
    keyed = cut_lineage(append_columns(found_some, "unit", [("pack", T.BinaryType())], start, ["node", "weight"]))
    # Somebody must own a cell and somebody else look into it. Owners fill the first chunks.
    crowds = (
        looked.groupBy("key")
        .agg(F.count_if("own").alias("owners"), F.count_if(~F.col("own")).alias("guests"))
        .filter("owners >= 1 and owners + guests >= 2")
        .select(
            "key",
            F.ceil(F.col("owners") / spec.chunk).cast("int").alias("owned"),
            F.ceil(F.col("guests") / spec.chunk).cast("int").alias("visited"),
        )
    )
    dealt = F.xxhash64("node", "key")
    met = (
        looked.join(crowds, "key")
        .withColumn(
            "chunk",
            F.when(F.col("own"), F.pmod(dealt, "owned")).otherwise(F.col("owned") + F.pmod(dealt, F.greatest("visited", F.lit(1)))).cast("int"),
        )
        # Chunks of owners meet all chunks, others only those of owners.
        .withColumn("partners", F.when(F.col("own"), F.col("owned") + F.col("visited")).otherwise(F.col("owned")))
        .select("node", "key", "at", "own", "chunk", F.explode(F.sequence(F.lit(0), F.col("partners") - 1)).alias("with"))
        .select("node", "key", "at", "own", "chunk", F.least("chunk", "with").alias("lo"), F.greatest("chunk", "with").alias("hi"))
    )
    laid = met.join(keyed.select("node", "weight", "pack"), "node")
    found = cut_lineage(
        laid.repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi")
        .mapInArrow(_link_cells(spec), "node long, around long, star long")
    )
    degree = found.groupBy("node").agg(F.sum("around").alias("around"))
    links = found.filter("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b")).distinct()
    weights = nodes.select("node", "weight", "rep")
    labels = connected_components(links)
    smallest = (
        weights.join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .groupBy("component")
        .agg(F.min("rep").alias("first"))
    )
    of_node = (
        nodes.select("node", "h1", "h2", "weight")
        .join(degree, "node", "left")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(smallest, "component")
        .select("h1", "h2", (F.col("weight") - 1 + F.coalesce("around", F.lit(0))).alias("n_links"), "first")
    )
    usable_rows = rows.filter("h1 is not null").select("id", "h1", "h2").join(of_node, ["h1", "h2"])
    others = rows.filter("h1 is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("first"))
    return (
        usable_rows.select("id", "n_links", "first")
        .unionByName(others)
        .select(
            F.col("id").alias(id_col),
            F.col("n_links").cast("long").alias("n_links"),
            F.col("first").alias("component_id"),
            F.coalesce(F.col("id") == F.col("first"), F.lit(True)).alias("kept"),
        )
    )
