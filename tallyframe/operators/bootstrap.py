"""Bootstrap intervals in one pass: every row draws its own weight in every replicate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chances that a Poisson variable of mean 1 is at most 0, 1, ... 6.
POISSON_STEPS = (0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317, 0.99940581518, 0.99991675885)
BITS = 31
MASK = np.uint64((1 << BITS) - 1)


def replicate_weights(keys: np.ndarray, replicates: int) -> np.ndarray:
    """Poisson weights of rows (down) in replicates (across), from row numbers alone.

    Plain arithmetic below 2 ** 63, so that SQL can say the same: three multiplications
    modulo 2 ** 31 with shifted bits folded in between.
    """
    x = (keys.astype(np.int64) % (1 << BITS)).astype(np.uint64)[:, None]
    r = np.arange(replicates, dtype=np.uint64)[None, :]
    x = (x * np.uint64(1664525) + r * np.uint64(1013904223) + np.uint64(12345)) & MASK
    x = ((x ^ (x >> np.uint64(15))) * np.uint64(739982445)) & MASK
    x = ((x ^ (x >> np.uint64(13))) * np.uint64(1181783497)) & MASK
    u = (x ^ (x >> np.uint64(16))).astype(np.float64) / (1 << BITS)
    return np.searchsorted(np.array(POISSON_STEPS), u, side="right").astype(np.float64)


def weight_sql(key: str, replicate: str) -> str:
    """The same weight as a SQL expression over whole numbers."""
    m = 1 << BITS
    x = f"(({key} % {m} + {m}) % {m} * 1664525 + {replicate} * 1013904223 + 12345) % {m}"
    for shift, factor in ((15, 739982445), (13, 1181783497)):
        x = f"(xor({x}, ({x}) >> {shift}) * {factor}) % {m}"
    u = f"xor({x}, ({x}) >> 16) / {m}.0::DOUBLE"
    return "(" + " + ".join(f"({u} >= {step})::INTEGER" for step in POISSON_STEPS) + ")"


def replicate_sums(rows: DataFrame, key: Column, columns: Sequence[str], replicates: int) -> DataFrame:
    """Weight and weighted sum of each column in each replicate: ``metric``, ``replicate``, ``weight``, ``total``.

    Rows are not copied: a task adds weights up for all replicates at once and sends
    one row a column and replicate. Nulls and NaN count in neither sum.
    """
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]
    number = F.coalesce(key, F.lit(0)).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(columns), 2, replicates))
        for raw in batches:
            if raw.num_rows:
                weights = replicate_weights(raw.column(0).to_numpy(), replicates)
                for i in range(len(columns)):
                    v = raw.column(i + 1).to_numpy(zero_copy_only=False)
                    has = ~np.isnan(v)
                    acc[i, 0] += weights[has].sum(axis=0)
                    acc[i, 1] += v[has] @ weights[has]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(columns, dtype=object), replicates), pa.string()),
                pa.array(np.tile(np.arange(replicates), len(columns)), pa.int32()),
                pa.array(acc[:, 0].ravel()),
                pa.array(acc[:, 1].ravel()),
            ],
            names=["metric", "replicate", "weight", "total"],
        )

    read = rows.select(number.alias("k"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    parts = read.mapInArrow(run, "metric string, replicate int, weight double, total double")
    return parts.groupBy("metric", "replicate").agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))


def bootstrap_means(
    rows: DataFrame, key: Column, columns: Sequence[str], replicates: int = 200, level: float = 0.95
) -> DataFrame:
    """Mean of each column with a percentile interval: ``metric``, ``n``, ``estimate``, ``low``, ``high``.

    ``key`` is a whole number that tells rows apart; rows that share it draw alike, as
    one block. The draws depend on keys only, so intervals do not change with
    partitioning or a lost executor. A column without values has a null mean and interval.
    """
    sums = replicate_sums(rows, key, columns, replicates)
    draws = sums.filter("weight > 0").withColumn("mean", F.col("total") / F.col("weight"))
    edge = (1 - level) / 2
    spread = draws.groupBy(F.col("metric").alias("m")).agg(
        F.percentile("mean", F.lit(edge)).alias("low"), F.percentile("mean", F.lit(1 - edge)).alias("high")
    )
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    plain = rows.agg(*[F.struct(F.count(v).alias("n"), F.avg(v).alias("estimate")).alias(c) for c, v in value.items()])
    long = plain.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`.n"), F.col(f"`{c}`.estimate")) for c in columns])))
    # One row a column on both sides.
    return long.join(spread, F.col("metric") == F.col("m"), "left").select("metric", "n", "estimate", "low", "high")
