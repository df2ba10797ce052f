"""Windows over entities of any size.

``partitionBy(entity)`` puts all rows of an entity into one task. That is right
until one entity holds a large share of the table. Here such entities are cut
into contiguous chunks of their own order, and every chunk carries a copy of the
last rows of the chunk before it (a halo), so that a bounded look-back sees the
same rows as in the uncut window. Entities below the threshold are left alone,
and with none above it the plan is the plain window.

What is collected or broadcast is bounded by construction: an entity is hot only
with more than ``total / max_chunks`` rows, hence there are fewer than
``max_chunks`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHUNK = "__chunk"
_HALO = "__halo"
_BOUNDS = "__bounds"


@dataclass(frozen=True)
class SplitPolicy:
    """When to cut and how finely.

    ``min_rows``: never cut an entity with fewer rows; ``max_chunks``: upper
    bound on hot entities and, up to sampling noise, on chunks in the table.
    """

    min_rows: int = 2_000_000
    max_chunks: int = 2_000
    sample_per_chunk: int = 64


DEFAULT_POLICY = SplitPolicy()


@dataclass(frozen=True)
class SplitPlan:
    """Cut points of the hot entities; empty when nothing is hot."""

    entity: tuple[str, ...]
    order: tuple[str, ...]
    lookback: int
    bounds: DataFrame | None = None

    @property
    def active(self) -> bool:
        return self.bounds is not None


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[f"__{name}"])
    return condition


def _keyed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"__{n}" for n in names})


def plan_splits(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    lookback: int,
    policy: SplitPolicy = DEFAULT_POLICY,
    bound_by: DataFrame | None = None,
) -> SplitPlan:
    """Find entities too large for one task and the points where to cut them.

    One aggregate with map-side combine reads only the entity columns. Cut points
    come from a hash sample of the order key: a sample decides where the cuts
    fall, never which rows are used. Every chunk but the last holds at least
    ``max(sample_per_chunk, lookback + 1)`` sampled keys, so one chunk always
    covers the look-back of the next.

    ``bound_by`` is any cheaper frame with at least as many rows of every entity
    (the table ``df`` was derived from, say). While no entity is large there,
    ``df`` itself is not looked at.
    """
    entity, order = tuple(entity), tuple(order)
    none = SplitPlan(entity, order, lookback)
    if bound_by is not None:
        sizes = bound_by.groupBy(*entity).agg(F.count(F.lit(1)).alias("__n"))
        if (sizes.agg(F.max("__n")).first()[0] or 0) <= policy.min_rows:
            return none
    counts = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("__n"))
    total, biggest = counts.agg(F.sum("__n"), F.max("__n")).first()
    if not total:
        return none
    limit = max(policy.min_rows, math.ceil(total / policy.max_chunks))
    if biggest <= limit:
        return none

    # Fewer than max_chunks rows: each has more than total / max_chunks.
    hot = df.sparkSession.createDataFrame(
        counts.filter(F.col("__n") > limit).select(*entity).collect(),
        T.StructType([df.schema[c] for c in entity]),
    )
    per_chunk = max(policy.sample_per_chunk, lookback + 1)
    keep_one_in = max(1, limit // per_chunk)
    keys = df.select(*entity, *order)
    hot_keys = _keyed(hot, entity)
    ranked = (
        keys.join(F.broadcast(hot_keys), _null_safe(keys, hot_keys, entity), "left_semi")
        .filter(F.pmod(F.xxhash64(*entity, *order), F.lit(keep_one_in)) == 0)
        .distinct()
        .withColumn(
            "__rank",
            F.row_number().over(Window.partitionBy(*entity).orderBy(*order)),
        )
    )
    cuts = ranked.filter((F.col("__rank") > 1) & ((F.col("__rank") - 1) % per_chunk == 0))
    rows = cuts.select(*entity, F.struct(*order).alias("__cut")).collect()
    if not rows:
        return none
    grouped: dict[tuple, list] = {}
    for row in rows:
        grouped.setdefault(tuple(row[: len(entity)]), []).append(row["__cut"])
    schema = T.StructType(
        [T.StructField(f"__{c}", df.schema[c].dataType, True) for c in entity]
        + [T.StructField(_BOUNDS, T.ArrayType(T.StructType([df.schema[c] for c in order])), True)]
    )
    bounds = df.sparkSession.createDataFrame([(*k, v) for k, v in grouped.items()], schema)
    return SplitPlan(
        entity, order, lookback, bounds.withColumn(_BOUNDS, F.array_sort(_BOUNDS))
    )


def _chunk_number(bounds: Column, key: Column) -> Column:
    """How many cut points lie at or below ``key``: a binary search by doubling steps."""
    steps = F.array(*[F.lit(1 << s) for s in range(24, -1, -1)])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= key), at + step
        ).otherwise(at),
    )
    return F.when(bounds.isNull(), F.lit(0)).otherwise(found)


def assign_chunks(df: DataFrame, plan: SplitPlan) -> DataFrame:
    """Add the chunk number; rows of entities that are not cut get 0."""
    joined = df.join(F.broadcast(plan.bounds), _null_safe(df, plan.bounds, plan.entity), "left")
    chunk = _chunk_number(F.col(_BOUNDS), F.struct(*[df[c] for c in plan.order]))
    return joined.withColumn(_CHUNK, chunk).drop(*[f"__{c}" for c in plan.entity])


@dataclass(frozen=True)
class WindowInput:
    """Rows ready for a window, the columns to partition by, and how to finish."""

    rows: DataFrame
    partition_cols: list[str]
    halo: bool

    def finish(self, df: DataFrame) -> DataFrame:
        return df.filter(~F.col(_HALO)).drop(_HALO, _CHUNK) if self.halo else df


def window_input(df: DataFrame, plan: SplitPlan) -> WindowInput:
    """Cut hot entities and add the halo rows that ``plan.lookback`` needs."""
    if not plan.active:
        return WindowInput(df, list(plan.entity), False)
    chunked = assign_chunks(df, plan)
    newest_first = Window.partitionBy(*plan.entity, _CHUNK).orderBy(
        *[F.col(c).desc_nulls_last() for c in plan.order]
    )
    # Top rows per chunk: the limit is applied before the shuffle as well, so
    # only look-back many rows per chunk and task move.
    halo = (
        chunked.filter(F.col(_BOUNDS).isNotNull() & (F.col(_CHUNK) < F.size(_BOUNDS)))
        .withColumn("__tail", F.row_number().over(newest_first))
        .filter(F.col("__tail") <= plan.lookback)
        .drop("__tail")
        .withColumn(_CHUNK, F.col(_CHUNK) + 1)
        .withColumn(_HALO, F.lit(True))
    )
    rows = chunked.withColumn(_HALO, F.lit(False)).unionByName(halo).drop(_BOUNDS)
    return WindowInput(rows, [*plan.entity, _CHUNK], True)
