"""Queries: hourly counts, scores, alerts, report, streaming forms."""

from pyspark.sql import functions as F

from parley.operators import alerts as A
from parley.operators import clusters as K
from parley.operators import features as X
from parley.operators.centers import CenterMatrix, mean_centers, nearest_center
from parley.plans import emerging as M
from parley.registry import inputs as I
from parley.registry.base import query, sql_text, table
from parley.registry.inputs import ALERTS_SQL, DESCRIBE_SQL, LIVE_ALERTS_SQL, LIVE_EVENTS_SQL
from parley.sources.workspace import new_path, written
from parley.streaming import live as L

_STAMP = "yyyy-MM-dd HH:mm:ss"
_SCORES = ("historical_mean", "historical_std", "anomaly_score", "increase_ratio")


def _shown(df, *extra):
    """Scored rows in a form that compares across engines."""
    return df.select(
        F.date_format("bucket_ts", _STAMP).alias("bucket"), "cluster_id", "current_count",
        *[F.round(c, 6).alias(c) for c in _SCORES], *extra,
    )


_BUCKET = "strftime(bucket_ts, '%Y-%m-%d %H:%M:%S') AS bucket"
_SCORES_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in _SCORES)


def series(spark, sf):
    counts, start, hours = I.cluster_counts(I.kind_counts(spark, sf))
    return A.dense_hours(counts, counts.select("cluster_id").distinct(), start, hours)


def alerts(spark, sf):
    counts, start, _ = I.cluster_counts(I.kind_counts(spark, sf))
    return A.alerts_of_counts(counts, start)


def document_terms(spark, sf):
    """Descriptive terms of the documents of each language, as terms of numbered clusters."""
    docs = I.document_conversations(spark, sf)
    labels = I.language_clusters(docs.select("conversation_id", "domain")).select("conversation_id", "cluster_id")
    return K.terms_table(K.descriptive_terms(X.tfidf_weights(docs), labels))


_TERMS_SQL = DESCRIBE_SQL + """,
  named_terms AS (SELECT cluster_id, string_agg(term, '|' ORDER BY rank) AS terms FROM described GROUP BY ALL)"""


@query("hourly_dense", f"WITH {ALERTS_SQL} SELECT cluster_id, hour, {_BUCKET}, n FROM series")
def hourly_dense(spark, sf):
    return series(spark, sf).select(
        "cluster_id", "hour", F.date_format("bucket_ts", _STAMP).alias("bucket"), "n"
    )


@query("scored_buckets", f"WITH {ALERTS_SQL} SELECT {_BUCKET}, cluster_id, current_count, {_SCORES_SQL} FROM scored")
def scored_buckets(spark, sf):
    return _shown(A.scored_buckets(series(spark, sf)))


@query("alerts", f"""WITH {ALERTS_SQL} SELECT {_BUCKET}, cluster_id, current_count, {_SCORES_SQL} FROM alerts
    ORDER BY bucket_ts, cluster_id""")
def alert_rows(spark, sf):
    return _shown(A.in_order(alerts(spark, sf)))


@query("attach_terms", f"""WITH {ALERTS_SQL}, {_TERMS_SQL}
    SELECT {_BUCKET}, a.cluster_id, current_count, {_SCORES_SQL}, coalesce(terms, '') AS terms
    FROM alerts a LEFT JOIN named_terms t ON t.cluster_id = a.cluster_id""")
def attach_terms(spark, sf):
    named = A.attach_terms(alerts(spark, sf), document_terms(spark, sf))
    return _shown(named, F.array_join("descriptive_terms", "|").alias("terms"))


@query("alerts_json_fields", f"""WITH {ALERTS_SQL}, {_TERMS_SQL}
    SELECT strftime(bucket_ts, '%Y-%m-%dT%H:%M:%S+00:00') AS "timestamp", a.cluster_id, current_count,
      round(anomaly_score, 6) AS anomaly_score, coalesce(terms, '') AS terms
    FROM alerts a LEFT JOIN named_terms t ON t.cluster_id = a.cluster_id""")
def alerts_json_fields(spark, sf):
    named = A.attach_terms(alerts(spark, sf), document_terms(spark, sf))
    schema = (
        "timestamp string, cluster_id int, current_count long, anomaly_score double, descriptive_terms array<string>"
    )
    read = A.alert_json(named).select(F.from_json("value", schema).alias("r")).select("r.*")
    return read.withColumn("terms", F.array_join("descriptive_terms", "|")).drop("descriptive_terms").withColumn(
        "anomaly_score", F.round("anomaly_score", 6)
    )


_OPEN, _CLOSE = A.C.ALERT_SUBJECT_WITH_TERMS


def _fixed(c, places):
    """Decimals of the exact value. Only a multiple of 1/2^(places + 1) can be a true half, which goes up."""
    ties = 2 ** (places + 1)
    return f"printf('%.{places}f', CASE WHEN {c} * {ties} = floor({c} * {ties}) THEN {c} + 1e-9 ELSE {c} END)"


@query("alert_text", f"""WITH {ALERTS_SQL}, {DESCRIBE_SQL},
  three AS (SELECT cluster_id, string_agg(term, ', ' ORDER BY rank) AS terms FROM described WHERE rank <= 3 GROUP BY ALL)
  SELECT strftime(bucket_ts, '%Y-%m-%d %H:%M') || ' UTC' AS time, CAST(a.cluster_id AS VARCHAR) AS cluster,
    CAST(current_count AS VARCHAR) AS current, {_fixed('historical_mean', 2)} AS usual,
    {_fixed('anomaly_score', 4)} AS score,
    CASE WHEN increase_ratio IS NULL THEN '—' ELSE {_fixed('increase_ratio', 2)} || '×' END AS ratio,
    CASE WHEN terms IS NULL THEN {sql_text(A.C.ALERT_SUBJECT_PLAIN)}
      ELSE {sql_text(_OPEN)} || terms || {sql_text(_CLOSE)} END || {sql_text(A.C.ALERT_PREDICATE)} AS summary
  FROM alerts a LEFT JOIN three t ON t.cluster_id = a.cluster_id""")
def alert_text(spark, sf):
    return A.alert_text(A.attach_terms(alerts(spark, sf), document_terms(spark, sf)))


@query("alert_events", f"""WITH {ALERTS_SQL}
  SELECT event_id, a.cluster_id, {_BUCKET}, CAST(rank AS INTEGER) AS rank FROM (
    SELECT e.event_id, x.cluster_id, x.bucket_ts,
      row_number() OVER (PARTITION BY x.cluster_id, x.bucket_ts ORDER BY e.ts, e.event_id) AS rank
    FROM alerts x JOIN ev e ON e.cluster_id = x.cluster_id AND e.hour = x.hour) a WHERE rank <= 3""")
def alert_events(spark, sf):
    kinds = I.kind_counts(spark, sf)
    counts, start, _ = I.cluster_counts(kinds)
    found = A.alert_events(I.cluster_events(spark, sf, kinds), written(A.alerts_of_counts(counts, start), "alerts"), start)
    return found.select("event_id", "cluster_id", F.date_format("bucket_ts", _STAMP).alias("bucket"), "rank")


def _once_per_user(events):
    """(event_type, hour, n): every user counted once per kind and hour since 1970."""
    hour = F.floor(F.unix_micros("ts") / A.HOUR_MICROS).cast("int").alias("hour")
    return events.select("event_type", "user_id", hour).distinct().groupBy("event_type", "hour").agg(F.count("*").alias("n"))


@query("alert_diff", f"""WITH {ALERTS_SQL},
  once AS (SELECT DISTINCT cluster_id, hour, user_id FROM ev),
  {I.sql_series('once', 'series2')}, {I.sql_scored('series2', 'scored2')}, {I.sql_alerts('scored2', 'alerts2')}
  SELECT coalesce(a.cluster_id, b.cluster_id) AS cluster_id,
    strftime(coalesce(a.bucket_ts, b.bucket_ts), '%Y-%m-%d %H:%M:%S') AS bucket,
    coalesce(a.current_count, 0) AS control_count, coalesce(b.current_count, 0) AS changed_count,
    CASE WHEN a.cluster_id IS NULL THEN 'changed only' WHEN b.cluster_id IS NULL THEN 'control only' ELSE 'both' END AS status
  FROM alerts a FULL OUTER JOIN alerts2 b ON a.cluster_id = b.cluster_id AND a.bucket_ts = b.bucket_ts""")
def alert_diff(spark, sf):
    counts, start, _ = I.cluster_counts(I.kind_counts(spark, sf))
    # the same hours and kinds have events in both, so they are numbered alike
    once, _, _ = I.cluster_counts(written(_once_per_user(I.given_events(spark, sf)), "user-counts"))
    diff = A.alert_diff(A.alerts_of_counts(counts, start), A.alerts_of_counts(once, start))
    return diff.select(
        "cluster_id", F.date_format("bucket_ts", _STAMP).alias("bucket"), "status",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("control_count", "changed_count")],
    )


@query("largest_group", """SELECT source, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) >= 16
    ORDER BY n DESC, source LIMIT 1""")
def largest_group(spark, sf):
    return A.largest_group(table(spark, sf, "documents"), group_col="source")


@query("alert_summary", f"""WITH {ALERTS_SQL}, target AS (SELECT cluster_id FROM ev GROUP BY 1 HAVING count(*) >= 16
    ORDER BY count(*) DESC, cluster_id LIMIT 1)
  SELECT count(*) AS total_alerts, count(*) FILTER (cluster_id = (FROM target)) AS target_alerts,
    count(*) FILTER (cluster_id <> (FROM target)) AS other_alerts,
    coalesce(bool_or(cluster_id = (FROM target) AND bucket_ts >= TIMESTAMP '2024-01-15'), false) AS detected_in_period
  FROM alerts""")
def alert_summary(spark, sf):
    counts, start, _ = I.cluster_counts(I.kind_counts(spark, sf))
    target = A.largest_of_counts(counts).select("cluster_id").scalar()
    period = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return A.alert_summary(A.alerts_of_counts(counts, start), target, period)


def user_calls(spark, sf):
    """Events as calls of their user, with the cluster (by language) of the user's document; an event of a
    user without a document belongs to cluster -1."""
    docs = I.language_clusters(table(spark, sf, "documents").select(F.col("doc_id").alias("user_id"), "lang"), "lang")
    calls = I.given_events(spark, sf).drop("event_type").join(docs.drop("lang"), "user_id", "left")
    return calls.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


@query("emerging_report", f"""WITH {I.EVENTS_SQL}, spoken AS (SELECT doc_id, text,
    {I.LANGUAGE_CLUSTER_SQL.format(column='lang')} AS cluster_id FROM documents),
  calls AS (SELECT event_id, ts, text, coalesce(d.cluster_id, -1) AS cluster_id, hour
    FROM ev LEFT JOIN spoken d ON doc_id = user_id),
  {I.sql_series('calls')}, {I.sql_scored()}, {I.sql_alerts()}, {_TERMS_SQL},
  samples AS (SELECT x.cluster_id, x.bucket_ts, substr(replace(c.text, chr(10), ' '), 1, 180) AS preview,
      row_number() OVER (PARTITION BY x.cluster_id, x.bucket_ts ORDER BY c.ts, c.event_id) AS rank
    FROM alerts x JOIN calls c ON c.cluster_id = x.cluster_id AND c.hour = x.hour QUALIFY rank <= 3),
  told AS (SELECT cluster_id, bucket_ts, string_agg(preview, '||' ORDER BY rank) AS samples FROM samples GROUP BY ALL)
  SELECT {_BUCKET.replace('bucket_ts', 'a.bucket_ts')}, a.cluster_id, current_count, {_SCORES_SQL},
    coalesce(terms, '') AS terms, samples
  FROM alerts a LEFT JOIN named_terms t ON t.cluster_id = a.cluster_id
  LEFT JOIN told s ON s.cluster_id = a.cluster_id AND s.bucket_ts = a.bucket_ts""")
def emerging_report(spark, sf):
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("user_id"), "text")
    report = M.emerging_report(user_calls(spark, sf), document_terms(spark, sf), texts=texts, text_key="user_id", text_col="text")
    return _shown(
        M.report_rows(report), F.array_join("descriptive_terms", "|").alias("terms"),
        F.array_join("samples", "||").alias("samples"),
    )


def placed_vectors(spark, sf):
    """(user_id, cluster_id): the cluster of each user's text vector, by the nearest centre."""
    given = table(spark, sf, "embeddings")
    centers = CenterMatrix.collect(mean_centers(given, "label", "embedding"))
    return nearest_center(given.select(F.col("vec_id").alias("user_id"), "embedding"), "embedding", centers).select("user_id", "cluster_id")


@query("emerging_issue_report", f"""WITH {I.PLACED_SQL}, {I.EVENTS_SQL},
  calls AS (SELECT event_id, ts, doc_id, text, coalesce(p.cluster_id, -1) AS cluster_id, hour
    FROM ev LEFT JOIN placed p ON vec_id = user_id LEFT JOIN documents ON doc_id = user_id),
  {I.sql_series('calls')}, {I.sql_scored()}, {I.sql_alerts()},
  {I.sql_described('SELECT conversation_id, cluster_id FROM docs JOIN placed ON CAST(vec_id AS VARCHAR) = conversation_id')},
  named_terms AS (SELECT cluster_id, string_agg(term, '|' ORDER BY rank) AS terms FROM described GROUP BY ALL),
  samples AS (SELECT x.cluster_id, x.bucket_ts, substr(replace(c.text, chr(10), ' '), 1, 180) AS preview,
      row_number() OVER (PARTITION BY x.cluster_id, x.bucket_ts ORDER BY c.ts, c.event_id) AS rank
    FROM alerts x JOIN calls c ON c.cluster_id = x.cluster_id AND c.hour = x.hour QUALIFY rank <= 3),
  told AS (SELECT cluster_id, bucket_ts, string_agg(preview, '||' ORDER BY rank) AS samples FROM samples GROUP BY ALL)
  SELECT {_BUCKET.replace('bucket_ts', 'a.bucket_ts')}, a.cluster_id, current_count, {_SCORES_SQL},
    coalesce(terms, '') AS terms, coalesce(samples, '') AS samples
  FROM alerts a LEFT JOIN named_terms t ON t.cluster_id = a.cluster_id
  LEFT JOIN told s ON s.cluster_id = a.cluster_id AND s.bucket_ts = a.bucket_ts""")
def emerging_issue_report(spark, sf):
    """Texts to vectors to clusters to events to alerts: the report over the clusters of the users' texts."""
    docs = I.document_conversations(spark, sf)
    placed = written(placed_vectors(spark, sf), "placed-vectors")
    labels = placed.select(F.col("user_id").cast("string").alias("conversation_id"), "cluster_id").join(
        docs.select("conversation_id"), "conversation_id")
    terms = K.terms_table(K.descriptive_terms(X.tfidf_weights(docs), labels))
    calls = I.given_events(spark, sf).drop("event_type").join(placed, "user_id", "left").withColumn(
        "cluster_id", F.coalesce("cluster_id", F.lit(-1)))
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("user_id"), "text")
    report = M.emerging_report(calls, terms, texts=texts, text_key="user_id", text_col="text")
    return _shown(
        M.report_rows(report), F.array_join("descriptive_terms", "|").alias("terms"),
        F.coalesce(F.array_join("samples", "||"), F.lit("")).alias("samples"),
    )


def event_stream(spark, sf):
    """The events table, a file or a folder of files, as a stream of cluster events."""
    events = table(spark, sf, "events")
    source = spark.readStream.schema(events.schema)
    if any(f.rstrip("/").endswith("/events.parquet") for f in events.inputFiles()):
        # a single file can only be streamed by way of its folder
        rows = source.option("pathGlobFilter", "events.parquet").parquet(sf)
    else:
        rows = source.parquet(f"{sf}/events.parquet")
    rows = I.with_kind(rows, "event_type", events)
    return rows.select(F.col("ts").cast("timestamp").alias("ts"), "cluster_id")


_CLOSED_SQL = "bucket_ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@query("live_hourly_counts", f"""WITH {LIVE_EVENTS_SQL}, b AS (
    SELECT cluster_id, (SELECT h0 FROM span) + to_hours(hour) AS bucket_ts, count(*) AS n FROM ev GROUP BY ALL)
  SELECT cluster_id, {_BUCKET}, n FROM b WHERE {_CLOSED_SQL}""")
def live_hourly_counts(spark, sf):
    path = new_path(spark, "live-counts")
    L.write_hourly_counts(event_stream(spark, sf), path, new_path(spark, "live-counts-log")).awaitTermination()
    counts = spark.read.schema("cluster_id int, bucket_ts timestamp, n long").parquet(path)
    return counts.select("cluster_id", F.date_format("bucket_ts", _STAMP).alias("bucket"), "n")


@query("live_alerts", f"""WITH {LIVE_ALERTS_SQL} SELECT {_BUCKET}, cluster_id, current_count, {_SCORES_SQL} FROM alerts
    WHERE {_CLOSED_SQL}""")
def live_alerts(spark, sf):
    start, _ = A.observed_hours(table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts")))
    sink = L.AlertSink(spark, new_path(spark, "live-alerts"), start)
    L.write_alerts_stream(event_stream(spark, sf), sink, new_path(spark, "live-alerts-log")).awaitTermination()
    return _shown(sink.alerts())


# ---- late events ----

PORTIONS = 4
_PORTIONS_SQL = f"""portions AS (SELECT *, event_id % {PORTIONS} AS portion, date_trunc('hour', ts) AS bucket_ts FROM ev),
  highs AS (SELECT portion, max(max(ts)) OVER (ORDER BY portion ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
    FROM portions GROUP BY portion),
  marked AS (SELECT p.*, coalesce(bucket_ts + INTERVAL 1 HOUR <= high - INTERVAL 1 HOUR, false) AS late
    FROM portions p JOIN highs USING (portion))"""


@query("live_late_events", f"""WITH {LIVE_EVENTS_SQL}, {_PORTIONS_SQL}
  SELECT cluster_id, {_BUCKET}, count(*) FILTER (NOT late) AS n_counted, count(*) FILTER (late) AS n_late FROM marked
  WHERE {_CLOSED_SQL} GROUP BY cluster_id, bucket_ts""")
def live_late_events(spark, sf):
    """Closed hours of a stream that comes in portions, each over the whole time: what was counted in time, and the
    events that came too late, which are kept."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows = I.with_kind(events, "event_type").select("event_id", "ts", "cluster_id")
    folder, log = new_path(spark, "event-portions"), new_path(spark, "late-log")
    sink = L.LateCountSink(spark, new_path(spark, "late-counts"), compact_every=3)
    for portion in range(PORTIONS):
        rows.where(F.col("event_id") % PORTIONS == portion).write.mode("append").parquet(folder)
        L.write_counts_with_late(spark.readStream.schema(rows.schema).parquet(folder), sink, log).awaitTermination()
    last = PORTIONS - 1
    hour = F.timestamp_micros(F.floor(F.unix_micros("ts") / A.HOUR_MICROS) * A.HOUR_MICROS)
    late = sink.late_events(last).groupBy("cluster_id", hour.alias("bucket_ts")).agg(F.count("*").alias("n_late"))
    both = sink.closed_counts(last).join(late, ["cluster_id", "bucket_ts"], "full_outer")
    return both.select(
        "cluster_id", F.date_format("bucket_ts", _STAMP).alias("bucket"),
        F.coalesce("n", F.lit(0)).alias("n_counted"), F.coalesce("n_late", F.lit(0)).alias("n_late"),
    )
