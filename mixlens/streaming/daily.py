"""Streaming twin of the incremental refresh: a daily fact kept up to date from event files."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mixlens.functions.cleaning import MONEY


def events_since(events: DataFrame, as_of: str, lookback_days: int = 3) -> DataFrame:
    """The events a refresh needs: from midnight UTC, ``lookback_days`` before ``as_of``, on.

    The condition is on the raw column, so it reaches the scan and a refresh
    does not read the whole history.
    """
    midnight = datetime.fromisoformat(as_of).replace(tzinfo=timezone.utc) - timedelta(days=lookback_days)
    if dict(events.dtypes)["ts"] == "timestamp_ntz":
        return events.where(F.col("ts") >= F.lit(midnight.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz"))
    return events.where(F.col("ts") >= F.lit(midnight))


def daily_from_events(events: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Impressions, clicks, orders, spend and sales per UTC day; works on batches and on streams.

    On a stream, rows that arrive later than ``lateness`` are ignored, as in
    the incremental refresh.
    """
    kind, amount = F.col("event_type"), F.col("value").cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    # Day windows start at midnight UTC, which need not be midnight in the session's zone.
    start = F.col("window.start")
    if dict(events.dtypes)["ts"] == "timestamp":
        start = F.to_utc_timestamp(start, F.current_timezone())
    return (
        rows.groupBy(F.window("ts", "1 day"))
        .agg(
            F.count_if(kind == "view").alias("impressions"),
            F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "purchase").alias("orders"),
            F.sum(F.when(kind == "click", amount).otherwise(zero)).alias("spend"),
            F.sum(F.when(kind == "purchase", amount).otherwise(zero)).alias("sales"),
        )
        .select(start.cast("date").alias("date_id"), "impressions", "clicks", "orders", "spend", "sales")
    )


def stream_daily(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str = "ts timestamp, event_type string, value double",
    lateness: str = "3 days",
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Read all waiting event files and rewrite the days they touch.

    Every batch carries the full totals of its changed days, and a day is one
    partition, so a batch that is run again after a failure writes the same.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(source)

    def rewrite_days(days: DataFrame, _batch: int) -> None:
        (
            days.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_id")
            .parquet(target)
        )

    return (
        daily_from_events(events, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(rewrite_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
