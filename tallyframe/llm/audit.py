"""How filters overlap: which documents each of them removes, in every order they can be applied.

Filters on a document alone are a bit each. The filter on copies is an existential
self-join: a left semi join on hash, exact text and smaller id. Its ids are put
beside the others' failures, and only counts of bit combinations go further: every
order follows from these.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bit_table, in_table, written

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class AuditSpec:
    """Bounds of the filters A to D; E has none. ``filter_bits`` fixes the size of the only broadcast table."""

    min_words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10
    symbols: str = "#$%&*|"
    filter_bits: int = 1 << 24


def failures(text: Column, spec: AuditSpec) -> dict[str, Column]:
    """Failure conditions on one text, by letter. Words are runs without ASCII white space, case-sensitive."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    symbols = "".join("\\" + c for c in spec.symbols)
    return {
        "A": n_words < spec.min_words,
        "B": n_distinct.cast("long") * 100 < n_words.cast("long") * spec.distinct_percent,
        "C": upper.cast("long") * 100 > F.char_length(text).cast("long") * spec.upper_percent,
        "D": text.rlike(f"[{symbols}]"),
    }


def copies_of_smaller(texts: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """Rows of ``texts`` (``id``, ``h``, ``text`` and others) whose text a row of smaller id has too, without the text.

    ``keys`` holds every row's ``id`` and ``h``. Hashes found once cannot repeat: a bit
    table of fixed size lets the others through, so that hardly more than the copies'
    texts are shuffled. Of each text only the smallest id can matter to the others, so
    the right side is summed to that before it is shuffled; it is written, and has one
    row for a text however often it occurs, so that AQE may split a hot left side.
    """
    repeated = keys.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    shared = texts.sparkSession.sparkContext.broadcast(bit_table(repeated, F.col("h"), bits))

    @F.pandas_udf("boolean")
    def may_repeat(h: pd.Series) -> pd.Series:
        return pd.Series(in_table(shared.value, h.to_numpy()))

    candidates = texts.filter(may_repeat("h"))
    firsts = written(
        candidates.groupBy("h", "text").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "audit-firsts",
    )
    same = (
        (candidates["h"] == firsts["h"]) & (candidates["text"] == firsts["text"]) & (firsts["first"] < candidates["id"])
    )
    return candidates.join(firsts, same, "left_semi").drop("text")


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    spec: AuditSpec | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Documents by ``part`` and ``mask`` of failed filters: ``n``, ``good`` and ``toxic`` ones.

    The bits of A to E are 1 to 16. A null text is an empty one; a null part is empty
    text. Every row of ``docs`` is counted; rows of one id and different texts are
    judged apart. A row without an id has no smaller one and is none to others. Labels
    of one id count if any of its rows says 1; others are 0, and a label without an id marks none. Either table may be
    empty. Other columns are not read.
    """
    spec = spec or AuditSpec()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.xxhash64(text).alias("h"),
    )
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(F.col("text"), spec).values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    alone = written(texts.select("id", "part", "h", mask.alias("mask"), F.lit(1).cast("long").alias("n")), "audit-alone")
    copies = copies_of_smaller(texts, alone, spec.filter_bits).select(
        "id", "part", "h", F.lit(16).alias("mask"), F.lit(0).cast("long").alias("n")
    )
    masks = (
        alone.unionByName(copies)
        .groupBy("id", "part", "h")
        .agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    )
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    return (
        masks.join(marks, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def order_audit(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every order of the filters, step by step, from counts of bit combinations.

    One row per part, ``filter_order`` and ``step`` with ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``. At
    most ``2 ** len(letters)`` combinations of a part meet. A document that fails k
    filters is removed by each of them in the same share of all orders, so ``shapley``
    is its number of orders divided by k.
    """
    bit = {c: 1 << i for i, c in enumerate(letters)}
    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = [
        {"filter_order": o, "step": i + 1, "own": bit[c], "before": sum(bit[x] for x in o[:i])}
        for o in orders
        for i, c in enumerate(o)
    ]
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    rows = parts.select("part", "found", F.inline(table))
    own, before = F.col("own"), F.col("before")

    def has(x: Column, bits: Column) -> Column:
        return x["mask"].bitwiseAND(bits) != 0

    def total(condition, value=lambda x: x["n"]) -> Column:
        return F.aggregate(F.filter("found", condition), F.lit(0).cast("long"), lambda acc, x: acc + value(x))

    def gone(x: Column) -> Column:
        return has(x, own) & ~has(x, before)

    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda x: ~has(x, own.bitwiseOR(before))).alias("kept"),
        total(gone).alias("removed"),
        total(lambda x: has(x, own) & has(x, before)).alias("redundant"),
        total(lambda x: x["mask"] == own).alias("unique_fails"),
        total(gone, lambda x: x["good"]).alias("good_lost"),
        total(gone, lambda x: x["toxic"]).alias("toxic_lost"),
        total(
            lambda x: has(x, own),
            lambda x: x["n"] * (F.lit(len(orders)) / F.bit_count(x["mask"])).cast("long"),
        ).alias("shapley"),
    )
