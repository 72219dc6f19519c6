"""Batches that arrive as files, taken up once each; an addition to the batch engine."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files below `folder`."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def dedup_arriving(rows: DataFrame, keys: Sequence[str], time: str, late: str = "30 days") -> DataFrame:
    """Rows delivered twice within the watermark count once; state older than it goes."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def monthly(rows: DataFrame, time: str, keys: Sequence[str], late: str = "30 days") -> DataFrame:
    """Counts per 30-day window and key, with late rows taken in up to the watermark."""
    from pyspark.sql import functions as F

    return rows.withWatermark(time, late).groupBy(F.window(time, "30 days"), *keys).count()


def run_available(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Takes up what is there, hands each micro-batch to `sink` and ends; a rerun with the same checkpoint goes on."""
    query = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
