"""Hourly counts per cluster, trailing z-score, alerts.

The hourly count reduces the raw events; windows and joins that follow see the hours that have events,
whatever the number of events. The dense grid of hours x clusters is made only where it is asked for.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as C
from parley.functions import display as D
from parley.operators.ranking import top_per_group

HOUR_MICROS = 3_600_000_000


def _start_micros(start: datetime) -> int:
    if start.tzinfo is None:
        start = start.replace(tzinfo=timezone.utc)
    return int(start.timestamp()) * 1_000_000 + start.microsecond


def hour_offset(ts, start: datetime):
    """Whole hours from `start`, rounded down, so a time before it is negative."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    passed = F.unix_micros(ts) - F.lit(_start_micros(start))
    return F.floor(passed / F.lit(HOUR_MICROS)).cast("int")


def bucket_start(offset, start: datetime):
    offset = F.col(offset) if isinstance(offset, str) else offset
    return F.timestamp_micros(
        F.lit(_start_micros(start)) + offset.cast("long") * F.lit(HOUR_MICROS)
    )


def _outside(start, hours, cluster_count=None):
    hour = hour_offset("ts", start)
    bad = F.coalesce(~hour.between(0, hours - 1), F.lit(True))
    if cluster_count is not None:
        bad = bad | F.coalesce(~F.col("cluster_id").between(0, cluster_count - 1), F.lit(True))
    return bad


def out_of_range_events(events: DataFrame, start, hours, cluster_count=None) -> DataFrame:
    """Events without a time, outside the hours, or of a cluster id outside 0..cluster_count-1."""
    return events.where(_outside(start, hours, cluster_count))


def observed_hours(events: DataFrame) -> tuple[datetime, int]:
    """(first hour in UTC, hours up to the last event's) of a table of events; one hour when it is empty."""
    ends = events.agg(F.unix_micros(F.min("ts")).alias("lo"), F.unix_micros(F.max("ts")).alias("hi")).first()
    if ends.lo is None:
        return datetime.fromtimestamp(0, timezone.utc), 1
    first, last = ends.lo // HOUR_MICROS, ends.hi // HOUR_MICROS
    return datetime.fromtimestamp(first * 3600, timezone.utc), int(last - first + 1)


def hourly_counts(events: DataFrame, start, hours, cluster_count=None, rejects=False):
    """(cluster_id, hour, n) of the hours that have events.

    An event that is out of range stops the job when it is met. With `rejects` the result is
    (counts, out-of-range events) instead, and nothing is lost either.
    """
    if hours < 1:
        raise ValueError("there must be an hour at least")
    bad, hour = _outside(start, hours, cluster_count), hour_offset("ts", start)
    if rejects:
        events, handed_back = events.where(~bad), events.where(bad)
    else:
        hour = F.when(bad, F.raise_error(F.lit("event out of range")).cast("int")).otherwise(hour)
    counts = events.groupBy("cluster_id", hour.alias("hour")).agg(F.count("*").alias("n"))
    return (counts, handed_back) if rejects else counts


def epoch_hour_counts(events: DataFrame, key="cluster_id") -> DataFrame:
    """(key, hour, n): events per key and hour since 1970. Needs no first look at the data, so the events
    are read once; `numbered_from` turns the hours into those of a series. An event without a time stops the job."""
    hour = F.floor(F.unix_micros("ts") / F.lit(HOUR_MICROS)).cast("int")
    met = F.when(hour.isNull(), F.raise_error(F.lit("event without a time")).cast("int")).otherwise(hour)
    return events.groupBy(key, met.alias("hour")).agg(F.count("*").alias("n"))


def numbered_from(counts: DataFrame):
    """(counts with hours from the first one on, start in UTC, hours) of a small written table of
    `epoch_hour_counts`."""
    ends = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).first()
    first = 0 if ends.lo is None else ends.lo
    hours = 1 if ends.lo is None else ends.hi - ends.lo + 1
    start = datetime.fromtimestamp(first * 3600, timezone.utc)
    return counts.withColumn("hour", F.col("hour") - first), start, hours


def cluster_range(spark, cluster_count) -> DataFrame:
    return spark.range(cluster_count).select(F.col("id").cast("int").alias("cluster_id"))


def dense_hours(counts: DataFrame, clusters: DataFrame, start, hours) -> DataFrame:
    """Every cluster x every hour, with 0 where nothing happened."""
    if hours < 1:
        raise ValueError("there must be an hour at least")
    grid = clusters.select(
        "cluster_id", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("hour")
    )
    return grid.join(counts, ["cluster_id", "hour"], "left").select(
        "cluster_id", "hour", bucket_start("hour", start).alias("bucket_ts"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def dense_hourly_counts(events, start, hours, clusters=None, cluster_count=None):
    """Dense hourly series. The clusters are those given, 0..cluster_count-1, or those seen. An event out
    of range stops the job; `hourly_counts` can hand such events back."""
    counts = hourly_counts(events, start, hours, cluster_count)
    if clusters is None:
        if cluster_count is not None:
            clusters = cluster_range(events.sparkSession, cluster_count)
        else:
            clusters = counts.select("cluster_id").distinct()
    return dense_hours(counts, clusters, start, hours)


def _score(history: DataFrame, min_history, std_floor) -> DataFrame:
    """Scores from `_k` buckets before a row's own, their sum `_s` and their sum of squares `_ss`.

    Mean and population deviation come from integer sums, so no rounding drifts at the threshold.
    """
    k, s, ss = F.col("_k"), F.col("_s"), F.col("_ss")
    scored = (
        history.where((k >= min_history) & (k > 0))
        .withColumn("historical_mean", s / k)
        .withColumn("historical_std", F.sqrt((k * ss - s * s).cast("double")) / k)
    )
    mean = F.col("historical_mean")
    return scored.select(
        "bucket_ts", "cluster_id", F.col("n").alias("current_count"), "historical_mean",
        "historical_std",
        ((F.col("n") - mean) / F.greatest("historical_std", F.lit(float(std_floor)))).alias("anomaly_score"),
        F.when(mean > 0, F.col("n") / mean).alias("increase_ratio"),
    )


def scored_buckets(series: DataFrame, window=C.HISTORY_WINDOW, min_history=C.MIN_HISTORY,
                   std_floor=C.STD_FLOOR) -> DataFrame:
    """Score every bucket of a dense series against the `window` buckets before it.

    A bucket with less than `min_history` buckets before it has no score and is left out.
    """
    w = Window.partitionBy("cluster_id").orderBy("bucket_ts").rowsBetween(-window, -1)
    history = (
        series.withColumn("_k", F.count("n").over(w))
        .withColumn("_s", F.sum("n").over(w))
        .withColumn("_ss", F.sum(F.col("n") * F.col("n")).over(w))
    )
    return _score(history, min_history, std_floor)


def scored_counts(counts: DataFrame, start: datetime, window=C.HISTORY_WINDOW, min_history=C.MIN_HISTORY,
                  std_floor=C.STD_FLOOR) -> DataFrame:
    """Score the hours that have events, from their counts (cluster_id, hour, n) alone.

    The same scores as `scored_buckets` gives these hours in the dense series from `start`: an hour
    without events adds nothing to the sums, and how many hours came before follows from the hour's
    number. So a gap of any length costs nothing, and an event with a stray date adds one row.
    """
    w = Window.partitionBy("cluster_id").orderBy("hour").rangeBetween(-window, -1)
    n = F.col("n").cast("long")
    history = counts.select(
        "cluster_id", bucket_start("hour", start).alias("bucket_ts"), n.alias("n"),
        F.least(F.col("hour"), F.lit(window)).cast("long").alias("_k"),
        F.coalesce(F.sum(n).over(w), F.lit(0)).alias("_s"), F.coalesce(F.sum(n * n).over(w), F.lit(0)).alias("_ss"),
    )
    return _score(history, min_history, std_floor)


def _alerting(scored: DataFrame, threshold, minimum_count) -> DataFrame:
    return scored.where((F.col("current_count") >= minimum_count) & (F.col("anomaly_score") >= threshold))


def detect_alerts(series: DataFrame, threshold=C.ANOMALY_THRESHOLD, minimum_count=C.MIN_EVENT_COUNT,
                  **scoring) -> DataFrame:
    """Buckets of a dense series with enough history, enough events and a high enough score."""
    return _alerting(scored_buckets(series, **scoring), threshold, minimum_count)


def alerts_of_counts(counts: DataFrame, start: datetime, threshold=C.ANOMALY_THRESHOLD,
                     minimum_count=C.MIN_EVENT_COUNT, **scoring) -> DataFrame:
    """The alerts that `detect_alerts` finds in the dense series from `start`, without that series.

    Only an hour with events can be an alert, so the count must be asked for at least one event.
    """
    if minimum_count < 1:
        raise ValueError("an alert needs an event at least; use detect_alerts on the dense series")
    return _alerting(scored_counts(counts, start, **scoring), threshold, minimum_count)


def in_order(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("bucket_ts", "cluster_id")


def attach_terms(df: DataFrame, terms: DataFrame, cluster_col="cluster_id") -> DataFrame:
    """Add the descriptive terms of a row's cluster; an empty array when it has none.

    `terms` has one short row per cluster of a fitted model, so its size is that of the model.
    """
    named = terms.select(F.col("cluster_id").alias("_cluster"), "descriptive_terms")
    return df.join(named, F.col(cluster_col) == F.col("_cluster"), "left").drop("_cluster").withColumn(
        "descriptive_terms", F.coalesce("descriptive_terms", F.array().cast("array<string>"))
    )


def alert_events(events: DataFrame, alerts: DataFrame, start, event_id="event_id", limit=3) -> DataFrame:
    """First events, in event order, of every alert's cluster and hour; hours count from `start`, as those
    of the alerts do, whatever the session's time zone.

    Alerts are few: events that are in none go first, by a semi-join on the alert keys. What is left is
    cut to `limit` rows per hour in every task ahead of the shuffle, so a hot hour is never moved whole.
    """
    keyed = events.withColumn("bucket_ts", bucket_start(hour_offset("ts", start), start))
    keys = alerts.select("cluster_id", "bucket_ts")
    return top_per_group(keyed.join(keys, ["cluster_id", "bucket_ts"], "left_semi"), ["cluster_id", "bucket_ts"],
                         ["ts", event_id], limit)


def alert_diff(control: DataFrame, changed: DataFrame) -> DataFrame:
    """Alerts of two series side by side: in both, or in one only."""
    keys = ["cluster_id", "bucket_ts"]
    a = control.select(*keys, F.col("current_count").alias("control_count"))
    b = changed.select(*keys, F.col("current_count").alias("changed_count"))
    status = (
        F.when(F.col("control_count").isNull(), F.lit("changed only"))
        .when(F.col("changed_count").isNull(), F.lit("control only"))
        .otherwise(F.lit("both"))
    )
    return a.join(b, keys, "full_outer").withColumn("status", status)


def alert_summary(alerts: DataFrame, target, period_start) -> DataFrame:
    """Alerts in all, in the target cluster and elsewhere; was the target seen in the period?"""
    on_target = F.coalesce(F.col("cluster_id") == target, F.lit(False))
    in_period = F.col("bucket_ts") >= period_start
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.count_if(on_target).alias("target_alerts"),
        F.count_if(~on_target).alias("other_alerts"),
        F.coalesce(F.bool_or(on_target & in_period), F.lit(False)).alias("detected_in_period"),
    )


def largest_group(labels: DataFrame, minimum_size=2 * C.MIN_EVENT_COUNT, group_col="cluster_id"):
    """Largest group of at least `minimum_size` rows; the smaller id wins a tie.

    Empty when there is none; `require_group` turns that into an error.
    """
    return (
        labels.groupBy(group_col).agg(F.count("*").alias("n"))
        .where(F.col("n") >= minimum_size).orderBy(F.desc("n"), group_col).limit(1)
    )


def largest_of_counts(counts: DataFrame, minimum_size=2 * C.MIN_EVENT_COUNT, group_col="cluster_id"):
    """The same from counts per group and hour."""
    return (
        counts.groupBy(group_col).agg(F.sum("n").alias("n"))
        .where(F.col("n") >= minimum_size).orderBy(F.desc("n"), group_col).limit(1)
    )


def require_group(group: DataFrame) -> DataFrame:
    if not group.limit(1).collect():
        raise ValueError("no group is large enough")
    return group


def alert_json(alerts: DataFrame) -> DataFrame:
    """One JSON document per alert, with an ISO timestamp and the terms."""
    fields = F.struct(
        D.iso_timestamp("bucket_ts").alias("timestamp"), "cluster_id", "current_count",
        "historical_mean", "historical_std", "anomaly_score", "increase_ratio", "descriptive_terms",
    )
    return alerts.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def alert_text(alerts: DataFrame) -> DataFrame:
    """Alerts as a reader sees them: minute, counts, scores with fixed decimals, a sentence."""
    return alerts.select(
        D.utc_minute("bucket_ts").alias("time"),
        F.col("cluster_id").cast("string").alias("cluster"),
        F.col("current_count").cast("string").alias("current"),
        D.decimals("historical_mean", 2).alias("usual"),
        D.decimals("anomaly_score", 4).alias("score"),
        D.ratio("increase_ratio").alias("ratio"),
        D.alert_sentence("descriptive_terms").alias("summary"),
    )
