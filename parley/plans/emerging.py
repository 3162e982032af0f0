"""Emerging-issue report: alerts with their terms and the first texts of each alert's hour."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.operators.alerts import (
    alert_events, alerts_of_counts, attach_terms, epoch_hour_counts, numbered_from,
)
from parley.sources.workspace import written


@dataclass
class EmergingReport:
    alerts: DataFrame
    samples: DataFrame


def emerging_report(events: DataFrame, terms: DataFrame, event_id="event_id", texts=None,
                    text_key="conversation_id", text_col="customer_text", samples=3, chars=180, **detection) -> EmergingReport:
    """Count, score and filter; then terms per alert and up to `samples` previews.

    `events` has cluster_id, ts and, for previews, the key of its text; hours count from the first event's.
    The hourly counts and the alerts are small and written once, so the events are read twice in all: to
    count them, and to find those of the alerts. The texts are joined last, to the few rows that are shown.
    """
    counts, start, _ = numbered_from(written(epoch_hour_counts(events), "event-counts"))
    alerts = written(alerts_of_counts(counts, start, **detection), "alerts")
    shown = written(alert_events(events, alerts, start, event_id, samples), "alert-events")
    keep = ["cluster_id", "bucket_ts", "rank", event_id]
    if texts is not None:
        # only the texts that are shown move, and only their first characters
        wanted = texts.join(shown.select(text_key).distinct(), text_key, "left_semi")
        wanted = wanted.select(text_key, T.one_line(text_col, chars).alias("preview"))
        shown = shown.join(wanted, text_key, "left")
        keep.append("preview")
    return EmergingReport(attach_terms(alerts, terms), shown.select(*keep))


def report_rows(report: EmergingReport) -> DataFrame:
    """One row per alert, with its samples as an ordered array."""
    has_text = "preview" in report.samples.columns
    value = "preview" if has_text else "rank"
    grouped = report.samples.groupBy("cluster_id", "bucket_ts").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("_v")))), lambda s: s["_v"]
        ).alias("samples")
    )
    return report.alerts.join(grouped, ["cluster_id", "bucket_ts"], "left")
