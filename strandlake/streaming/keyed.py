"""Beyond the batch operators: keyed sums and the junction rule over event streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_sums(events: DataFrame, time: str, keys: Sequence[str], values: Sequence[str], late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Sums by key and time window; a window closes when the watermark has passed it."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, window), *keys).agg(*(F.sum(v).alias(f"sum_{v}") for v in values), F.count("*").alias("n"))


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Run a streaming DataFrame over all that is there now, into an in-memory table."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
