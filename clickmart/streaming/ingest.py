"""Streams: enrichment, raw sink, duplicate removal, live sessions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart import constants as C
from clickmart.functions.scalar import event_time
from clickmart.operators.dedup import EVENT_KEY
from clickmart.sources import raw


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_ts", event_time(F.col("timestamp")))


def dedup_stream(events: DataFrame, delay: str = C.RETENTION, keys=EVENT_KEY) -> DataFrame:
    """First arrival per key within the late-data limit; state is dropped after it."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(keys))


def session_stream(
    events: DataFrame, gap_seconds: int = C.SESSION_GAP_SECONDS, delay: str = C.RETENTION
) -> DataFrame:
    """Sessions emitted once no late event can change them any more."""
    bought = F.col("event_type") == C.PURCHASE
    return (
        events.withWatermark("event_ts", delay)
        .groupBy("user_id", F.session_window("event_ts", f"{gap_seconds} seconds").alias("window"))
        .agg(
            F.min("event_ts").alias("session_start"),
            F.max("event_ts").alias("session_end"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(bought).alias("items_purchased"),
            F.sum(F.when(bought, F.col("price"))).alias("total_revenue"),
        )
        .drop("window")
    )


def raw_sink(
    enriched: DataFrame, path: str, checkpoint: str, interval: str | None = C.DELIVERY_INTERVAL
) -> StreamingQuery:
    """JSON lines under year/month/day of the processing time, one delivery per interval.

    Without an interval everything available is delivered, then the query ends.
    """
    day = F.col("processed_ts")
    writer = (
        enriched.withColumns(
            {
                "year": F.date_format(day, "yyyy"),
                "month": F.date_format(day, "MM"),
                "day": F.date_format(day, "dd"),
            }
        )
        .writeStream.format("json")
        .partitionBy("year", "month", "day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def table_sink(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything available into a Parquet table."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class RecordCount:
    """Input records of a query, exact over any number of batches.

    A query keeps its newest progress entries only (100 by default), so they are added
    up while it runs.  ``update`` must be called before that many batches have passed;
    a batch that went by unseen raises instead of being left out.
    """

    def __init__(self, query: StreamingQuery):
        self.query, self.total = query, 0
        self._last, self._rows = -1, 0

    def update(self) -> int:
        for entry in self.query.recentProgress:
            batch, rows = entry["batchId"], entry["numInputRows"]
            if batch < self._last:
                continue
            if batch > self._last:
                if self._last >= 0 and batch > self._last + 1:
                    raise RuntimeError(f"batches {self._last + 1} to {batch - 1} were not seen")
                self._last, self._rows = batch, 0
            # an idle trigger reports the number of the next batch, without rows
            more = max(0, rows - self._rows)
            self.total, self._rows = self.total + more, self._rows + more
        return self.total


def count_until_done(query: StreamingQuery, poll_seconds: float = 0.2) -> int:
    """Wait for a query that ends by itself; its input records."""
    count = RecordCount(query)
    while not query.awaitTermination(poll_seconds):
        count.update()
    return count.update()


def delivered_records(spark: SparkSession, path: str) -> int:
    """Records that raw delivery has committed to ``path``, over all runs of the query."""
    return spark.read.text(path).count()


def reject_sink(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = C.DELIVERY_INTERVAL
) -> StreamingQuery:
    """Unreadable lines as they came, with the reason, as JSON lines."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        raw.rejects(rows)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
