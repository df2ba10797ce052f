"""Inner folds that hold both labels: rows dealt by their rank within a label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def stratified_folds(rows: DataFrame, folds: int, outers: int = 1, key: str = "game_id") -> DataFrame:
    """Add ``inner``, the fold of a row within each training set: one number per outer set, -1 outside.

    ``rows`` carries ``block`` and ``label``; outer set j holds the labelled rows with
    ``block < j``, j from 1. Rows are ranked within their label by a hash of ``key``
    and dealt round, so the folds of a label differ by one row at most and each fold
    has both labels as soon as there are enough rows. Ranks depend on keys only.

    A label has many rows, so no task ranks them all: rows are ranked within one of
    1,024 hash ranges, and each range starts where the ranges before it end. Rows with
    one key are ranked in any order. Rows without a label get -1 throughout.
    """
    h = F.xxhash64(F.col(key).cast("string"))
    seen = rows.withColumn("__h", h).withColumn("__range", F.shiftrightunsigned("__h", 54).cast("int"))
    labelled = F.col("label").isNotNull()
    inside = {j: (labelled & (F.col("block") < j)).cast("long") for j in range(1, outers + 1)}
    sizes = seen.groupBy("label", "__range").agg(*[F.sum(inside[j]).alias(f"__n{j}") for j in inside])
    before = Window.partitionBy("label").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("label").alias("__label"),
        F.col("__range").alias("__r"),
        *[F.coalesce(F.sum(f"__n{j}").over(before), F.lit(0)).alias(f"__s{j}") for j in inside],
    )
    upto = Window.partitionBy("label", "__range").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, 0)
    ranked = seen.select("*", *[F.sum(inside[j]).over(upto).alias(f"__k{j}") for j in inside])
    # At most 1,024 ranges a label, so the starts are broadcast.
    met = ranked.join(
        F.broadcast(starts),
        F.col("label").eqNullSafe(F.col("__label")) & (F.col("__range") == F.col("__r")),
    )
    numbers = [
        F.when(inside[j] == 1, F.pmod(F.col(f"__s{j}") + F.col(f"__k{j}") - 1, F.lit(folds))).otherwise(-1).cast("int")
        for j in inside
    ]
    return met.select(*rows.columns, F.array(*numbers).alias("inner"))


def fold_sizes(dealt: DataFrame, outers: int = 1) -> DataFrame:
    """Rows per outer set, inner fold and label."""
    numbered = dealt.select("label", F.posexplode("inner").alias("place", "inner_fold")).filter("inner_fold >= 0")
    return numbered.groupBy((F.col("place") + 1).alias("outer_fold"), "inner_fold", "label").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
