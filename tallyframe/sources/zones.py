"""Partitioned Parquet zones: schema-checked reads, partition-safe writes, audits."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.schema import ODDS, ROLLING, TEAM_GAME, conform

GAME_PARTITIONS = ("season", "game_date")
SEASON_PARTITIONS = ("season",)
DATE_PARTITIONS = ("game_date",)
ODDS_PARTITIONS = ("game_date", "snapshot")
ODDS_SNAPSHOTS = T.StructType([*ODDS.fields, T.StructField("snapshot", T.StringType())])
RECORDS_PER_FILE = 5_000_000


def read_zone(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Zone with its declared schema; footers are never sampled for one."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def path_is_missing(error: AnalysisException) -> bool:
    """Whether a read failed only because nothing has been written there yet."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_zone_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As :func:`read_zone`; a zone that does not exist yet has no rows."""
    try:
        return read_zone(spark, path, schema)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def read_csv_zone(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and explicit types, so ids keep leading zeros.

    The header says which column is which: one in another order is followed, columns
    the schema does not know are left out, missing ones are NULL. A file whose header
    differs from the others' is refused by the reader.
    """
    declared = {f.name: f for f in schema.fields}
    found = spark.read.option("header", True).csv(path).columns
    written = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in found])
    rows = spark.read.option("header", True).option("enforceSchema", False).schema(written).csv(path)
    return conform(rows, schema)


def guard_path(path: str, forbidden: tuple[str, ...]) -> None:
    """Refuse a target inside a zone that must not be overwritten."""
    parts = path.replace("\\", "/").rstrip("/").split("/")
    for zone in forbidden:
        if zone in parts:
            raise ValueError(f"refusing to write to a {zone}/ path: {path}")


def by_partition(df: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Bring the rows of a directory together before writing it.

    Without this every task writes a file into every directory. The rebalance
    hint shuffles by the partition columns, merges small days into one task and
    splits a day too large for one task into several.
    """
    return df.hint("rebalance", *[F.col(c) for c in partitions])


def write_zone(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partitions: tuple[str, ...],
    forbidden: tuple[str, ...] = (),
    whole: bool = False,
    gathered: bool = False,
) -> str:
    """Replace the partitions ``df`` touches and no others, or with ``whole`` all of them.

    The frame is conformed first, so all files of a zone share one schema. An
    empty frame touches nothing: earlier days stay. ``gathered`` says that the rows of
    a directory lie together already.
    """
    guard_path(path, forbidden)
    rows = conform(df, schema)
    (
        (rows if gathered else by_partition(rows, partitions))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return path


def write_processed(df: DataFrame, path: str) -> str:
    return write_zone(df, path, TEAM_GAME, GAME_PARTITIONS, ("raw",))


def write_features(df: DataFrame, path: str, gathered: bool = False) -> str:
    return write_zone(df, path, ROLLING, SEASON_PARTITIONS, ("raw", "processed"), gathered=gathered)


def stage_then_promote(
    df: DataFrame,
    staging: str,
    path: str,
    schema: T.StructType = TEAM_GAME,
    partitions: tuple[str, ...] = GAME_PARTITIONS,
) -> str:
    """Write aside, read back with the declared schema, then replace the target.
    The target is touched only after the computation has succeeded in full. What an
    earlier attempt left in staging is replaced with it."""
    write_zone(df, staging, schema, partitions, ("raw",), whole=True)
    return write_zone(read_zone(df.sparkSession, staging, schema), path, schema, partitions, ("raw",))


def zone_has_rows(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Whether the zone exists and holds anything; one that cannot be read raises."""
    return not read_zone_or_empty(spark, path, schema).isEmpty()


def read_odds_for_date(spark: SparkSession, path: str, day: dt.date | str) -> DataFrame:
    """One day's prices, all snapshots of it; the filter prunes to that partition."""
    return read_zone(spark, path, ODDS).filter(F.col("game_date") == F.lit(str(day)).cast("date"))


def missing_dates(
    dates: DataFrame,
    end: dt.date | str | None = None,
    start: dt.date | str | None = None,
    column: str = "game_date",
    cold_start: dt.date | str | None = None,
    interior: bool = True,
) -> DataFrame:
    """Days without data up to ``end``.

    ``kind`` is ``tail`` after the newest stored day (what a catch-up run has to
    load) or ``hole`` between stored days. With nothing stored the range begins
    at ``cold_start``.
    """
    days = dates.select(F.to_date(column).alias("day")).filter("day is not null").distinct()

    def bound(value, fallback):
        return F.lit(str(value)).cast("date") if value is not None else fallback

    span = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        bound(start, F.coalesce("lo", bound(cold_start, F.lit(None).cast("date")))).alias("lo"),
        bound(end, F.col("hi")).alias("end"),
        F.col("hi"),
    )
    wanted = span.filter(F.col("lo") <= F.col("end")).select(
        "hi", F.explode(F.sequence("lo", "end", F.expr("interval 1 day"))).alias("day")
    )
    gaps = wanted.join(days, "day", "left_anti")
    kind = F.when(F.col("hi").isNull() | (F.col("day") > F.col("hi")), "tail").otherwise("hole")
    out = gaps.select(F.col("day").alias("missing_date"), kind.alias("kind"))
    return out if interior else out.filter(F.col("kind") == "tail")


def zone_audit(zones: dict[str, DataFrame]) -> DataFrame:
    """Row count per zone."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("zone"), "n_rows")
        for name, df in zones.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def zone_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Newest file time and file count of a zone: a listing, no data is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "modificationTime")
    )
    return files.agg(F.max("modificationTime").alias("newest"), F.count(F.lit(1)).alias("n_files"))
