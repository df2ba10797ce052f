"""Published decisions: JSON documents for reading, Parquet for analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.decisions import pick_json
from tallyframe.schema import PICKS, conform

from .zones import DATE_PARTITIONS, by_partition


def publish_picks(picks: DataFrame, json_path: str, parquet_path: str | None = None) -> str:
    """Write one JSON document per pick, partitioned by date, and optionally the
    typed rows with every guardrail field. A date written again replaces itself.

    Both outputs come from one computation: the rows are kept while they are
    written, and recomputed only where an executor is lost in between.
    """
    kept = by_partition(conform(picks, PICKS), DATE_PARTITIONS).persist()
    try:
        docs = pick_json(kept).select(F.col("doc").alias("value"), "game_date")
        docs.sortWithinPartitions("game_date", "value").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*DATE_PARTITIONS).text(json_path)
        if parquet_path is not None:
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *DATE_PARTITIONS
            ).parquet(parquet_path)
    finally:
        kept.unpersist()
    return json_path


def read_picks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PICKS).parquet(path).select(*PICKS.names)
