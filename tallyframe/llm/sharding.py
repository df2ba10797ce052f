"""Sharding by histogram sort: probe the key space until the splitters balance, then exchange once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.session import cut_lineage

from .arrow import packed

LOW = -(1 << 63)
HIGH = (1 << 63) - 1
DIGIT_BITS = 8
FAN = 1 << DIGIT_BITS
HOT_SHARE = 1000
SALTS = 256


@dataclass(frozen=True)
class Splitter:
    """First key of a shard: a text hash and, inside one group of equal texts, an id."""

    hash: int
    id: int = LOW


def row_size(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(16)).cast("long")


@dataclass
class _Probe:
    """One splitter on its way: the key range it lies in and the bytes before that range."""

    target: int
    below: int = 0
    lo: int = LOW
    hash: int | None = None  # set once the range is inside one hash; lo is then an id
    depth: int = 0
    found: Splitter | None = None
    done: bool = False

    @property
    def range(self) -> tuple[bool, int, int, int]:
        return self.hash is not None, self.hash or 0, self.lo, self.depth


def _width(depth: int) -> int:
    return 1 << (64 - DIGIT_BITS * depth)


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float) -> list[Splitter | None]:
    """Keys that cut ``(hash, id, size)`` rows into shards of equal bytes.

    Each round counts, in one aggregate over all partitions, the exact bytes in
    256 equal slices of every open key range, and so the exact bytes below each
    slice's border. A splitter is settled at the border nearest its target once
    that is within ``tolerance`` of a shard; else its range shrinks to the slice
    holding the target. Ranges that shrink to one hash, a group of equal texts
    too heavy for one shard, go on over ids. At most 16 rounds, each returning
    at most 256 * (n_shards - 1) sums. ``None``: no key is that high.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    allowed = tolerance * total / n_shards
    probes = [_Probe(target=total * j // n_shards) for j in range(1, n_shards)]
    while open_ones := [p for p in probes if not p.done]:
        ranges = sorted({p.range for p in open_ones})
        where = F.lit(None).cast("int")
        for i, (inside, h, lo, depth) in enumerate(ranges):
            value = F.col("id") if inside else F.col("hash")
            hit = value.between(F.lit(lo), F.lit(lo + _width(depth) - 1))
            where = F.when((F.col("hash") == F.lit(h)) & hit if inside else hit, F.lit(i)).otherwise(where)

        def of_range(values: list) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), F.col("range"))

        # Unsigned digit of the value at the range's depth; flipping the sign bit keeps the order.
        value = F.when(of_range([r[0] for r in ranges]), F.col("id")).otherwise(F.col("hash")).bitwiseXOR(F.lit(LOW))
        shift = of_range([64 - DIGIT_BITS * (r[3] + 1) for r in ranges])
        slices = (
            keys.withColumn("range", where)
            .filter(F.col("range").isNotNull())
            .withColumn("digit", F.call_function("shiftright", value, shift).bitwiseAND(F.lit(FAN - 1)))
            .groupBy("range", "digit")
            .agg(
                F.sum("size").alias("bytes"),
                F.min("hash").alias("h_min"),
                F.max("hash").alias("h_max"),
                F.min("id").alias("id_min"),
                F.max("id").alias("id_max"),
            )
            .collect()
        )
        found: list[dict] = [{} for _ in ranges]
        for r in slices:
            found[r["range"]][r["digit"]] = r
        index = {key: i for i, key in enumerate(ranges)}
        for p in open_ones:
            _narrow(p, found[index[p.range]], allowed)
    return [p.found for p in probes]


def _after(h: int, i: int) -> Splitter | None:
    """The least key above (h, i)."""
    if i < HIGH:
        return Splitter(h, i + 1)
    return Splitter(h + 1) if h < HIGH else None


def _narrow(p: _Probe, slices: dict, allowed: float) -> None:
    """Settle a splitter at a slice's border, or shrink its range to the slice with the target."""
    step = _width(p.depth) // FAN
    before, best, holder = p.below, (abs(p.below - p.target), 0), None
    for d in sorted(slices):
        if before <= p.target:
            holder = (d, before)
        before += slices[d]["bytes"]
        best = min(best, (abs(before - p.target), d + 1))
    if holder is None or best[0] <= allowed:
        edge = p.lo + best[1] * step
        if p.hash is None:
            p.found = Splitter(edge) if edge <= HIGH else None
        else:
            p.found = _after(p.hash, edge - 1) if edge > LOW else Splitter(p.hash)
        p.done = True
        return
    digit, below = holder
    held = slices[digit]
    p.below = below
    if held["h_min"] < held["h_max"]:
        p.lo, p.depth = p.lo + digit * step, p.depth + 1
    elif held["id_min"] < held["id_max"]:
        if p.hash is None:
            p.hash, p.lo, p.depth = held["h_min"], LOW, 0
        else:
            p.lo, p.depth = p.lo + digit * step, p.depth + 1
    else:  # one key: the nearer of its two sides
        h, i = held["h_min"], held["id_min"]
        near = abs(below - p.target) <= abs(below + held["bytes"] - p.target)
        p.found = Splitter(h, i) if near else _after(h, i)
        p.done = True


def shard_of(hash_col: Column, id_col: Column, splitters: list[Splitter | None]) -> Column:
    """Number of splitters at or below a key."""
    shard = F.lit(0)
    for s in splitters:
        if s is not None:
            above = (hash_col > F.lit(s.hash)) | ((hash_col == F.lit(s.hash)) & (id_col >= F.lit(s.id)))
            shard = shard + above.cast("int")
    return shard.cast("int")


def assign_shards(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.01,
) -> DataFrame:
    """All rows with ``size``, ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in a shard).

    The law is equal bytes: shards differ from the mean by ``tolerance`` of a
    shard at most, or by one row where rows are larger than that. Keys are
    (hash of the text, id), so equal texts lie together; a group is cut only
    where a border runs through it and moving the border to the group's edge would
    break the tolerance.

    A null text has no bytes, so its size is 16, and is a group of its own. A null
    id sorts first. Rows equal in id and text stay in one shard. An empty table
    gives an empty table. Columns named like results are replaced.

    Rounds read a checkpointed table of hash, id and size only. The texts are
    exchanged once, by (shard, slice of the hash): slots are a running count over
    slices plus a row number inside one, so no task holds a shard. Slices with over
    a thousandth of all rows are salted by id.
    """
    rest, names = packed(docs, ["size", "shard", "slot"])
    # An id of another type than an integer is ordered by its hash.
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    rank = F.col(f"`{id_col}`").cast("long") if whole else F.xxhash64(F.col(f"`{id_col}`"))
    key_id = F.coalesce(rank, F.lit(LOW))
    key_hash = F.xxhash64(F.col(f"`{text_col}`"))
    keys = cut_lineage(
        docs.select(key_hash.alias("hash"), key_id.alias("id"), row_size(F.col(f"`{text_col}`")).alias("size"))
    )
    splitters = find_splitters(keys, n_shards, tolerance)

    slice_of = lambda h: F.shiftright(h, 48).cast("int")
    total = keys.count()
    hot = [
        r[0]
        for r in keys.groupBy(slice_of(F.col("hash")).alias("__slice"))
        .count()
        .filter(F.col("count") * HOT_SHARE > F.lit(total))
        .select("__slice")
        .collect()
    ]

    def salt(slice_col: Column, id_value: Column) -> Column:
        if not hot:
            return F.lit(0)
        return F.when(slice_col.isin(hot), F.pmod(F.xxhash64(id_value), F.lit(SALTS)).cast("int")).otherwise(0)

    placed = keys.select(
        shard_of(F.col("hash"), F.col("id"), splitters).alias("shard"),
        slice_of(F.col("hash")).alias("__slice"),
        salt(slice_of(F.col("hash")), F.col("id")).alias("__salt"),
    )
    running = Window.partitionBy("shard").orderBy("__slice", "__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "__slice", "__salt")
        .agg(F.count("*").alias("n"))
        .select("shard", "__slice", "__salt", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("__start"))
    )
    keyed = docs.select(
        rest.alias("__rest"), row_size(F.col(f"`{text_col}`")).alias("size"), key_hash.alias("__hash"), key_id.alias("__id")
    ).select(
        "*",
        shard_of(F.col("__hash"), F.col("__id"), splitters).alias("shard"),
        slice_of(F.col("__hash")).alias("__slice"),
        salt(slice_of(F.col("__hash")), F.col("__id")).alias("__salt"),
    )
    inside = Window.partitionBy("shard", "__slice", "__salt").orderBy("__hash", "__id")
    return keyed.join(starts, ["shard", "__slice", "__salt"]).select(
        *[F.col("__rest").getField(c).alias(c) for c in names],
        "size",
        "shard",
        (F.col("__start") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
    )
