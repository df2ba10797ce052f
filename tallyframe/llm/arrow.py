"""Appending computed columns batch by batch, leaving all other columns as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

Compute = Callable[[list], list[list]]


def unused(names: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no name equals it in whatever case."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def packed(df: DataFrame, replaced: list[str] = ()) -> tuple[Column, list[str]]:
    """All columns as one struct, so that working columns can have any name beside it, and their names.

    Columns named like one of ``replaced``, in whatever case, are left out.
    """
    gone = {r.lower() for r in replaced}
    names = [c for c in df.columns if c.lower() not in gone]
    return (F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(None)), names


def append_columns(
    df: DataFrame,
    source: str,
    fields: list[tuple[str, T.DataType]],
    start: Callable[[], Compute],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from the values of ``source``, in Arrow batches.

    ``start`` runs once a task and returns a function from a list of values to one
    list per field. ``keep`` names the columns that stay (all by default). Columns
    named like a field, in whatever case, are replaced. Others pass as Arrow, so nulls
    in integers, nested and binary values come back unchanged.
    """
    fresh = {name.lower() for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in fresh]
    read = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(unused(kept, "__source")))
    schema = T.StructType(read.schema.fields[:-1] + [T.StructField(n, t) for n, t in fields])
    types = [to_arrow_type(t) for _, t in fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            made = compute(batch.column(len(kept)).to_pylist())
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(values, type=kind) for values, kind in zip(made, types)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return read.mapInArrow(run, schema)
