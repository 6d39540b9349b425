"""Crawl state kept up to date from a stream of its log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gleanery.operators.ingest import fold_state

LOG = "source_id string, url string, kind string, seq long, updated_at timestamp, raw_file string, message string"


def windowed_outcomes(log: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts of each kind in tumbling windows of event time; events later than the watermark are left out."""
    return log.withWatermark("updated_at", late).groupBy(F.window("updated_at", width), "source_id", "kind").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "source_id", "kind", "n")


def follow(log: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch of the log to a Parquet folder, by batch, so a batch that is run again replaces itself.
    `current` folds it. The stream holds no state."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark, folder: str) -> DataFrame:
    return fold_state(spark.read.schema(LOG + ", batch int").parquet(folder).drop("batch"))
