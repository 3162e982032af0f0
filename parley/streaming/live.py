"""Streaming forms of the hourly count and the alerts.

State is one counter per open (cluster, hour). A closed hour is written to a bucket table, and the
scoring of a micro-batch reads only the last `window` hours of that table.
"""

import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley import constants as C
from parley.functions.display import in_utc
from parley.operators.alerts import HOUR_MICROS, dense_hours, hour_offset, scored_buckets

BUCKETS = "cluster_id int, bucket_ts timestamp, n long, batch_id long, dt date"
STATE = "cluster_id int, last int"


def hourly_counts_stream(events: DataFrame, delay="1 hour") -> DataFrame:
    """Counts per cluster and hour of a stream; an hour is emitted once no event of it can come.

    Events later than `delay` behind the newest one are dropped by the watermark.
    """
    windows = events.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour"), "cluster_id")
    return windows.agg(F.count("*").alias("n")).select(
        "cluster_id", F.col("window.start").alias("bucket_ts"), "n"
    )


def write_hourly_counts(events: DataFrame, path, checkpoint, delay="1 hour", trigger=None) -> StreamingQuery:
    """Append closed hours to a Parquet table; exactly once through the file sink's own log."""
    return (
        hourly_counts_stream(events, delay).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


class AlertSink:
    """foreachBatch writer: stores closed hours, scores the new ones, stores their alerts.

    What a batch needs of the past is the last hour and the clusters so far, which the batch before has
    left in a small state table, and the buckets of the last `window` hours, found by date. So what a
    batch reads does not grow with the history. A batch writes to folders that carry its number and
    overwrites them, so a batch that is run again after a failure leaves the same tables.
    """

    def __init__(self, spark: SparkSession, path, start: datetime, clusters: DataFrame = None,
                 threshold=C.ANOMALY_THRESHOLD, minimum_count=C.MIN_EVENT_COUNT,
                 window=C.HISTORY_WINDOW, min_history=C.MIN_HISTORY, std_floor=C.STD_FLOOR):
        if start.tzinfo is None:
            start = start.replace(tzinfo=timezone.utc)
        self.spark, self.path, self.start, self.clusters = spark, path, start, clusters
        self.threshold, self.minimum_count = threshold, minimum_count
        self.scoring = {"window": window, "min_history": min_history, "std_floor": std_floor}
        self.buckets_path = os.path.join(path, "buckets")
        self.alerts_path = os.path.join(path, "alerts")
        self.state_path = os.path.join(path, "state")

    def buckets(self) -> DataFrame:
        return self.spark.read.schema(BUCKETS).parquet(self.buckets_path)

    def alerts(self) -> DataFrame:
        return self.spark.read.parquet(self.alerts_path)

    def _state(self, batch_id):
        return os.path.join(self.state_path, f"batch_id={batch_id}")

    def __call__(self, closed: DataFrame, batch_id: int) -> None:
        folder = os.path.join(self.buckets_path, f"batch_id={batch_id}")
        closed.withColumn("dt", F.to_date(in_utc("bucket_ts"))).write.mode("overwrite").partitionBy("dt").parquet(folder)
        stored = self.spark.read.schema("cluster_id int, bucket_ts timestamp, n long, dt date").parquet(folder)
        hour = hour_offset("bucket_ts", self.start)
        now = stored.agg(F.max(hour).alias("last")).first()["last"]
        if batch_id > 0:
            before = self.spark.read.schema(STATE).parquet(self._state(batch_id - 1))
        else:
            before = self.spark.createDataFrame([], STATE)
        past = before.agg(F.max("last").alias("last")).first()["last"]
        past = -1 if past is None else past
        last = past if now is None else max(past, now)
        clusters = before.select("cluster_id").union(stored.select("cluster_id")).distinct()
        clusters.withColumn("last", F.lit(last)).write.mode("overwrite").parquet(self._state(batch_id))
        if now is None:
            return
        # Hours are emitted in order, so all up to the newest one are closed, empty ones too.
        first = past + 1
        since = max(first - self.scoring["window"], 0)
        recent = self.start + timedelta(hours=since)
        day = recent.astimezone(timezone.utc).date()
        counts = self.buckets().where(
            (F.col("batch_id") <= batch_id) & (F.col("dt") >= F.lit(day)) & (hour >= since)
        ).select("cluster_id", (hour - since).alias("hour"), "n")
        known = self.clusters
        if known is None:
            known = self.spark.read.schema(STATE).parquet(self._state(batch_id)).select("cluster_id")
        series = dense_hours(counts, known, recent, last - since + 1)
        new_from = F.lit((self.start + timedelta(hours=first)))
        found = scored_buckets(series, **self.scoring).where(
            (F.col("bucket_ts") >= new_from) & (F.col("current_count") >= self.minimum_count)
            & (F.col("anomaly_score") >= self.threshold)
        )
        found.write.mode("overwrite").parquet(os.path.join(self.alerts_path, f"batch_id={batch_id}"))


def write_alerts_stream(events: DataFrame, sink: AlertSink, checkpoint, delay="1 hour", trigger=None) -> StreamingQuery:
    return (
        hourly_counts_stream(events, delay).writeStream.foreachBatch(sink).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# ---- counts that keep late events ----

OPEN_COUNTS = "cluster_id int, hour int, n long"
PROGRESS = "high long, base long"
COMPACT_EVERY = 20


class LateCountSink:
    """foreachBatch writer of raw events: hourly counts, and late events kept beside them.

    The watermark is that of the stream: the newest event time of the batches before, less `delay`. An event
    whose hour had closed by then is late. It changes no count that was given out, and is written to a table of
    its own with the batch it came in, where a stream's window would have dropped it unseen.

    A batch writes partial counts, late events and its progress (newest event time, and the last compacted
    batch) to folders that carry its number, progress last, and overwrites them, so a batch that is run again
    leaves the same tables. Every COMPACT_EVERY batches the partial counts so far become one folder, so what is read
    does not grow with the number of batches.
    """

    def __init__(self, spark: SparkSession, path, delay=timedelta(hours=1), compact_every=COMPACT_EVERY):
        self.spark, self.path, self.delay, self.compact_every = spark, path, delay, compact_every

    def _folder(self, kind, batch_id):
        return os.path.join(self.path, kind, f"batch_id={batch_id}")

    def _progress(self, batch_id):
        """(newest event time in microseconds or None, last compacted batch or None) after a batch."""
        if batch_id < 0:
            return None, None
        row = self.spark.read.schema(PROGRESS).parquet(self._folder("progress", batch_id)).first()
        return row.high, row.base

    def _closed_before(self, high):
        """The first hour since 1970 that is open under a newest event time; None if all are."""
        if high is None:
            return None
        return (high - int(self.delay.total_seconds() * 1_000_000)) // HOUR_MICROS

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        high, base = self._progress(batch_id - 1)
        open_from = self._closed_before(high)
        hour = F.floor(F.unix_micros("ts") / HOUR_MICROS).cast("int")
        late = F.lit(False) if open_from is None else F.coalesce(hour < open_from, F.lit(False))
        newest = F.max(F.unix_micros("ts")).alias("high")
        on_time = events.where(~late).groupBy("cluster_id", hour.alias("hour")).agg(F.count("*").alias("n"), newest)
        on_time.write.mode("overwrite").parquet(self._folder("counts", batch_id))
        events.where(late).write.mode("overwrite").parquet(self._folder("late", batch_id))
        # late events are older than the newest time so far, so those on time are enough to know it
        now = self.spark.read.schema("high long").parquet(self._folder("counts", batch_id)).agg(F.max("high").alias("high")).first().high
        high = now if high is None else max(high, high if now is None else now)
        if (batch_id + 1) % self.compact_every == 0:
            self._partial_counts(batch_id, base).groupBy("cluster_id", "hour").agg(F.sum("n").alias("n")).write.mode(
                "overwrite").parquet(self._folder("compacted", batch_id))
            base = batch_id
        self.spark.createDataFrame([(high, base)], PROGRESS).coalesce(1).write.mode("overwrite").parquet(self._folder("progress", batch_id))

    def _partial_counts(self, batch_id, base) -> DataFrame:
        first = 0 if base is None else base + 1
        paths = [self._folder("counts", i) for i in range(first, batch_id + 1)]
        if base is not None:
            paths.append(self._folder("compacted", base))
        return self.spark.read.schema(OPEN_COUNTS).parquet(*paths)

    def closed_counts(self, batch_id) -> DataFrame:
        """(cluster_id, bucket_ts, n) of the hours that are closed after a batch."""
        high, base = self._progress(batch_id)
        open_from = self._closed_before(high)
        counts = self._partial_counts(batch_id, base).groupBy("cluster_id", "hour").agg(F.sum("n").alias("n"))
        closed = counts.where(F.col("hour") < (open_from if open_from is not None else -(2 ** 31)))
        return closed.select("cluster_id", F.timestamp_micros(F.col("hour").cast("long") * HOUR_MICROS).alias("bucket_ts"), "n")

    def late_events(self, batch_id) -> DataFrame:
        """The late events of the batches up to one, with the `batch_id` they came in."""
        late = self.spark.read.parquet(os.path.join(self.path, "late"))
        return late.where(F.col("batch_id") <= batch_id)


def write_counts_with_late(events: DataFrame, sink: LateCountSink, checkpoint, trigger=None) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
