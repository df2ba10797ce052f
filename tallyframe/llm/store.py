"""Intermediate tables in the shared folder, and a bit table that tells wanted keys from others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_table(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A bit per slot that some 64-bit key falls into, as bytes; its size never changes.

    At most ``bits / 64`` packed words reach the driver, 2 MB for 2 ** 24 bits. More
    keys fill it up and let more others through; none of its own is ever lost.
    """
    slot = F.pmod(key, F.lit(bits))
    packed = (
        keys.select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"))
        .toArrow()
    )
    table = np.zeros(bits // 64, dtype=np.int64)
    table[packed["word"].to_numpy()] = packed["mask"].to_numpy()
    return table.view(np.uint8)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys' bits are set."""
    slot = np.mod(keys, len(table) * 8)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
