"""Landed files to totals as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.aggregate import (
    join_team_advanced,
    team_advanced,
    team_game_stats,
    with_null_columns,
)
from tallyframe.schema import PLAYER_GAME, PLAYER_GAME_ADVANCED, TEAM_GAME
from tallyframe.sources.zones import GAME_PARTITIONS, read_zone, write_zone, zone_has_rows


def touched_partitions(batch: DataFrame, full: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """All stored rows of the partitions a batch touches.

    Whole partitions are re-read, since replacing a date with one file's rows
    would lose those of the files before it. The least and the greatest value of
    each partition column, NULL kept where the batch holds it, prune directories;
    a null-safe semi-join then picks the exact ones. Their keys are broadcast, so stored
    rows stay where they are read: one key a directory, of which the reader lists all anyway.
    """
    keys = batch.select(*partitions).distinct()
    bounds = keys.agg(
        *[F.min(c).alias(f"{c}_lo") for c in partitions],
        *[F.max(c).alias(f"{c}_hi") for c in partitions],
        *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"{c}_null") for c in partitions],
    ).first()
    near = F.lit(True)
    for c in partitions:
        inside = F.col(c).between(F.lit(bounds[f"{c}_lo"]), F.lit(bounds[f"{c}_hi"]))
        near = near & (F.coalesce(inside, F.lit(False)) | F.col(c).isNull() if bounds[f"{c}_null"] else inside)
    wanted = keys.select(*[F.col(c).alias(f"__{c}") for c in partitions])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partitions]
    return full.filter(near).join(F.broadcast(wanted), same, "left_semi")


def incremental_totals(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    checkpoint: str,
    raw_schema: T.StructType,
    out_schema: T.StructType,
    aggregate: Callable[[DataFrame], DataFrame],
    partitions: tuple[str, ...] = GAME_PARTITIONS,
    files_per_batch: int = 1000,
    stored: tuple[str, T.StructType] | None = None,
) -> StreamingQuery:
    """Process what has been landed since the last run, then stop.

    A batch recomputes its partitions from stored rows and overwrites exactly
    those, so a batch that is replayed after a failure changes nothing. ``stored``
    names the zone whose rows are recomputed, if it is not the one that streams.
    """
    source, source_schema = stored or (raw_path, raw_schema)
    stream = (
        spark.readStream.schema(raw_schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(raw_path)
    )

    def run(batch: DataFrame, _batch_id: int) -> None:
        full = read_zone(batch.sparkSession, source, source_schema)
        write_zone(aggregate(touched_partitions(batch, full, partitions)), out_path, out_schema, partitions)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def incremental_team_game(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    checkpoint: str,
    advanced_path: str | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Player-game files to the processed zone, ratings joined where landed.

    Both feeds start a recomputation of the partitions they touch, so ratings that
    arrive after the box scores of their day reach the zone too.
    """

    def totals_of(rows: DataFrame) -> DataFrame:
        totals = team_game_stats(rows, with_leaders=True)
        session = rows.sparkSession
        if advanced_path and zone_has_rows(session, advanced_path, PLAYER_GAME_ADVANCED):
            rated = touched_partitions(
                rows, read_zone(session, advanced_path, PLAYER_GAME_ADVANCED), GAME_PARTITIONS
            )
            return join_team_advanced(totals, team_advanced(rated))
        return with_null_columns(totals)

    incremental_totals(
        spark, raw_path, out_path, f"{checkpoint}/box", PLAYER_GAME, TEAM_GAME, totals_of,
        files_per_batch=files_per_batch,
    ).awaitTermination()
    if advanced_path and zone_has_rows(spark, advanced_path, PLAYER_GAME_ADVANCED):
        incremental_totals(
            spark, advanced_path, out_path, f"{checkpoint}/ratings", PLAYER_GAME_ADVANCED, TEAM_GAME, totals_of,
            files_per_batch=files_per_batch, stored=(raw_path, PLAYER_GAME),
        ).awaitTermination()
