"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import cut_lineage

from .arrow import packed

SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PARTS = 16384  # of all shared lines, the most that one common line sends to a task

_ID, _TEXT, _ROW = "__line_id", "__line_text", "__line_row"


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_line_hashes(text: Column, min_chars: int) -> Column:
    """Position and 128-bit hash of the key of every line whose key is long enough.

    The key is the line without ASCII white space at its ends and with A-Z in
    lower case, which does not change its length.
    """
    trimmed = F.transform(
        split_lines(text),
        lambda line, pos: F.struct(pos.alias("pos"), F.btrim(line, F.lit(SPACE)).alias("key")),
    )
    long_ones = F.filter(trimmed, lambda x: F.char_length(x["key"]) >= min_chars)
    lowered = F.transform(
        long_ones,
        lambda x: F.struct(x["pos"].alias("pos"), F.translate(x["key"], UPPER, UPPER.lower()).alias("key")),
    )
    return F.transform(
        lowered,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            F.xxhash64(x["key"]).alias("h1"),
            F.xxhash64(F.lit("second"), x["key"]).alias("h2"),
        ),
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    counts: bool = True,
) -> DataFrame:
    """Drop lines that many documents share, keeping them in the document of the largest id.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines except those of the largest id holding it; a
    line repeated inside that document stays repeated. Returns all columns of
    ``docs`` with the text rebuilt and, with ``counts``, ``n_lines`` (before) and
    ``n_dropped``.

    A null or empty text is one empty line and comes back empty. Rows of one id
    count as one document and are treated alike; a null id is an id of its own,
    smaller than all others. Repeated rows stay repeated. An empty table gives an
    empty table. Other columns pass through unread, whatever their names, but for
    ``n_lines`` and ``n_dropped``, which are replaced.

    Only hashes and positions of long lines are shuffled for counting: two longs
    a line, summed before the shuffle, so a line found everywhere is a few rows a
    task. Where lines meet their keepers, one that makes up more than a ``PARTS``-th
    of all shared lines is dealt by document over parts no larger than that; such
    lines are fewer than ``PARTS``, whatever the input, and only they are broadcast.
    The texts move once, to meet the positions they lose.
    """
    row = F.xxhash64(F.col(text_col))
    lines = docs.select(
        F.col(id_col).alias(_ID), row.alias(_ROW), F.inline(long_line_hashes(F.col(text_col), min_chars))
    )
    # One row per hash and document first, so that a document counts once.
    shared = cut_lineage(
        lines.groupBy("h1", "h2", _ID)
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.max(_ID).alias("keeper"))
        .filter(F.col("n") >= min_docs)
    )
    total = max(1, shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    parts = F.ceil(F.col("n") * PARTS / F.lit(total)).cast("int")
    common = shared.filter(F.col("n") * PARTS > F.lit(total)).select("h1", "h2", parts.alias("parts"))
    dealt = lines.join(F.broadcast(common), ["h1", "h2"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64(_ID, _ROW), "parts"), F.lit(0)).cast("int")
    )
    keepers = shared.select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)).alias("part"))
    dropped = (
        dealt.join(keepers, ["h1", "h2", "part"])
        .filter(~F.col(_ID).eqNullSafe(F.col("keeper")))
        .groupBy(_ID, _ROW)
        .agg(F.collect_set("pos").alias("gone"))
    )
    added = ["n_lines", "n_dropped"] if counts else []
    # The text goes beside the other columns, not with them: it is shuffled once.
    rest, _ = packed(docs, [*added, text_col])
    names = [c for c in docs.columns if c.lower() not in added]
    left = docs.select(
        rest.alias("rest"), F.col(f"`{id_col}`").alias("own_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("whole"), row.alias("own_row")
    )
    joined = left.join(
        dropped, left["own_id"].eqNullSafe(dropped[_ID]) & (left["own_row"] == dropped[_ROW]), "left"
    ).withColumn("lines", split_lines(F.col("whole")))
    positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rebuilt = F.array_join(F.transform(positions, lambda p: F.get(F.col("lines"), p)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(rebuilt)
    numbers = {
        "n_lines": F.size("lines").cast("long"),
        "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
    }
    return joined.select(
        *[text.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in names],
        *[numbers[c].alias(c) for c in added],
    )
