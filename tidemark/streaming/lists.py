"""Filing rows as they arrive, appended once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_rows(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], late: str = "7 days") -> StreamingQuery:
    """Read JSON lines from a folder and append rows whose keys weren't seen within `late` of event time.

    schema has event_time. State holds only the keys inside the watermark; restarts go on from the checkpoint.
    """
    rows = spark.readStream.schema(schema).json(source).withWatermark("event_time", late).dropDuplicatesWithinWatermark(keys)
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def counts_by_day(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """Rows of a stream (event_time, ...) counted by day of event time."""
    return rows.withWatermark("event_time", late).groupBy(F.window("event_time", "1 day").alias("day")).agg(F.count("*").alias("n"))
