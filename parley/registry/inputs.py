"""The given tables seen as channel records, conversations, events and vectors, in Spark and in SQL.

A few hand-made rows are added where the tables hold no broken row of a kind that an operator must
find; they come on top of the whole table.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as C
from parley.operators.alerts import epoch_hour_counts, numbered_from
from parley.operators.conversations import assemble_channels
from parley.registry.base import sql_list, sql_text, table
from parley.schemas import CHANNEL_RECORD
from parley.sources.splits import union_splits
from parley.sources.workspace import written

# ---- channel records ----

BROKEN_RECORDS = [
    # split, file_name, role, text, domain, speaker_id, accent, gender
    ("labelled", "hand/ok_channel1.wav", "customer", "The kettle has no lid.", "kitchen", "s1", "a", "f"),
    ("labelled", "hand/ok_channel2.wav", "agent", "Let me look at it.", "telecom", "s2", "a", "m"),
    ("labelled", "hand/nodomain_channel1.wav", "customer", "Hello.", None, None, None, None),
    ("labelled", "hand/nodomain_channel2.wav", "agent", "Good day.", None, "s2", None, "m"),
    ("labelled", "hand/alone_channel1.wav", "customer", "Anyone there?", "travel", "s3", "b", "f"),
    ("labelled", "hand/agents_channel1.wav", "agent", "One.", "travel", "s4", "b", "f"),
    ("labelled", "hand/agents_channel2.wav", "agent", "Two.", "travel", "s5", "b", "f"),
    ("unlabelled", "hand/same_channel1.wav", "customer", "One.", "travel", "s6", "b", "f"),
    ("unlabelled", "hand/same_channel1.wav", "agent", "Two.", "travel", "s7", "b", "f"),
    ("unlabelled", "hand/domains_channel1.wav", "customer", "One.", "travel", "s6", "b", "f"),
    ("unlabelled", "hand/domains_channel2.wav", "agent", "Two.", "food", "s7", "b", "f"),
    ("unlabelled", "hand/halfdomain_channel1.wav", "customer", "One.", "travel", "s6", "b", "f"),
    ("unlabelled", "hand/halfdomain_channel2.wav", "agent", "Two.", None, "s7", "b", "f"),
    ("unlabelled", "hand/norole_channel1.wav", None, "One.", "travel", "s6", "b", "f"),
    ("unlabelled", "hand/norole_channel2.wav", "agent", "Two.", "travel", "s7", "b", "f"),
    ("unlabelled", "hand/nochannel.wav", "agent", " \t\n ", "travel", "s7", "b", "f"),
    ("unlabelled", "hand/three_channel3.wav", "agent", " ", "travel", "s7", "b", "f"),
    ("unlabelled", None, "agent", None, None, None, None, None),
]


def _sql_value(v):
    if v is None:
        return "NULL"
    return sql_text(v) if isinstance(v, str) else str(v)


def sql_rows(rows) -> str:
    return ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in rows)


def _side_information(spark, sf_dir):
    """Domain, accent and gender of a call: language, source and label of the like-numbered document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def _as_records(turns: DataFrame, side: DataFrame) -> DataFrame:
    number = (
        F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(3)
    )
    joined = turns.join(side, turns.conv_id == side.doc_id, "left")
    role = F.when(F.col("role") == "user", "customer").when(F.col("role") == "assistant", "agent").otherwise(
        F.col("role")
    )
    return joined.select(
        F.when(F.col("quality").isNull(), "unlabelled").otherwise("labelled").alias("split"),
        F.concat(F.lit("conv/"), "conv_id", F.lit("_channel"), number, F.lit(".wav")).alias("file_name"),
        role.alias("role"), "text", F.col("lang").alias("domain"),
        F.when(number == 1, F.concat(F.lit("cust-"), "conv_id"))
        .when(number == 2, F.concat(F.lit("agent-"), "source")).alias("speaker_id"),
        F.col("source").alias("accent"),
        F.when(F.col("quality") == 1, "f").when(F.col("quality") == 0, "m").alias("gender"),
    )


def _broken(spark):
    return spark.createDataFrame(BROKEN_RECORDS, CHANNEL_RECORD)


def turn_records(spark, sf_dir) -> DataFrame:
    """Every turn as a channel record: calls of many sizes, and malformed names for system turns."""
    turns = table(spark, sf_dir, "conversations")
    return _as_records(turns, _side_information(spark, sf_dir)).unionByName(_broken(spark))


def channel_records(spark, sf_dir) -> DataFrame:
    """One record per call and role, the turns joined in order. A role that is no side of a call has a file name
    without a channel, and so is a reject of the pairing."""
    channels = assemble_channels(table(spark, sf_dir, "conversations"), ["conv_id", "role"])
    return _as_records(channels, _side_information(spark, sf_dir)).unionByName(_broken(spark))


_RECORDS_SQL = """
  SELECT CASE WHEN l.quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS split,
         'conv/' || c.conv_id || '_channel'
           || CASE c.role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END || '.wav' AS file_name,
         CASE c.role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'agent' ELSE c.role END AS role,
         c.text AS text, d.lang AS domain,
         CASE c.role WHEN 'user' THEN 'cust-' || c.conv_id WHEN 'assistant' THEN 'agent-' || d.source END AS speaker_id,
         d.source AS accent,
         CASE l.quality WHEN 1 THEN 'f' WHEN 0 THEN 'm' END AS gender
  FROM {source} c LEFT JOIN documents d ON d.doc_id = c.conv_id LEFT JOIN labels l ON l.doc_id = c.conv_id
  UNION ALL SELECT * FROM (VALUES {broken})
"""
CALL_SQL = (
    "regexp_extract(coalesce(file_name, ''), '^([^\\n]+)_channel([12])\\.wav$', 1) AS call_id, "
    "TRY_CAST(regexp_extract(coalesce(file_name, ''), '^([^\\n]+)_channel([12])\\.wav$', 2) AS INTEGER) AS channel"
)
TURN_RECORDS_SQL = (
    "records AS (" + _RECORDS_SQL.format(source="conversations", broken=sql_rows(BROKEN_RECORDS)) + "), "
    f"named AS (SELECT *, {CALL_SQL} FROM records)"
)
CHANNEL_RECORDS_SQL = (
    "channels AS (SELECT conv_id, role, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations "
    "GROUP BY ALL), "
    "records AS (" + _RECORDS_SQL.format(source="channels", broken=sql_rows(BROKEN_RECORDS)) + "), "
    f"named AS (SELECT *, {CALL_SQL} FROM records)"
)

# ---- blank text in SQL ----

WS_SQL = sql_text(C.WHITESPACE)
# The white space of C.WHITESPACE as an RE2 class.
WS_RE = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NWS_RE = "[^" + WS_RE[1:]


def sql_blank(column) -> str:
    return f"trim(coalesce({column}, ''), {WS_SQL}) = ''"


# ---- documents as labelled conversations ----


def document_conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("conversation_id"), F.col("lang").alias("domain"),
        F.col("text").alias("customer_text"), "source",
    )


DOCUMENTS_SQL = (
    "docs AS (SELECT CAST(doc_id AS VARCHAR) AS conversation_id, lang AS domain, text AS customer_text, "
    "source FROM documents)"
)


def language_clusters(docs, column="domain") -> DataFrame:
    """`docs` with a cluster_id per language found in them, for operators that describe given clusters."""
    return with_kind(docs, column)


LANGUAGE_CLUSTER_SQL = "CAST(dense_rank() OVER (ORDER BY {column} NULLS FIRST) - 1 AS INTEGER)"


def rule_predictions(spark, sf_dir) -> DataFrame:
    """A given prediction per document: the language its special letters speak for."""
    text = F.col("customer_text")
    predicted = (
        F.when(text.rlike("[äöüß]"), "de").when(text.rlike("[èêç]"), "fr")
        .when(text.rlike("[ñóí]"), "es").otherwise("en")
    )
    return document_conversations(spark, sf_dir).select(
        "conversation_id", "customer_text", F.col("domain").alias("actual"), predicted.alias("predicted")
    )


PREDICTIONS_SQL = DOCUMENTS_SQL + """, predictions AS (
  SELECT conversation_id, customer_text, domain AS actual,
         CASE WHEN regexp_matches(customer_text, '[äöüß]') THEN 'de'
              WHEN regexp_matches(customer_text, '[èêç]') THEN 'fr'
              WHEN regexp_matches(customer_text, '[ñóí]') THEN 'es' ELSE 'en' END AS predicted
  FROM docs)"""

# ---- events ----

# An event long after the others, of a kind of its own: hours and clusters must follow the data.
LATE_EVENT = (-1, -1, "2024-02-20 07:30:00", "odd")


def given_events(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    late = spark.createDataFrame([LATE_EVENT], "event_id long, user_id long, ts string, event_type string")
    return events.unionByName(late.withColumn("ts", F.col("ts").cast("timestamp")))


def numbered_kinds(df, column) -> DataFrame:
    """(column, cluster_id): the distinct values numbered from 0 by name; a null is the first of them."""
    kinds = df.select(column).distinct()
    return kinds.select(column, (F.row_number().over(Window.orderBy(F.col(column).asc_nulls_first())) - 1).alias("cluster_id"))


def with_kind(df, column, seen=None) -> DataFrame:
    """`df` with the cluster_id of its value, joined null-safe from the values that the data (`seen`, or
    `df` itself) have."""
    kinds = numbered_kinds(df if seen is None else seen, column).withColumnRenamed(column, "_kind")
    return df.join(kinds, F.col(column).eqNullSafe(F.col("_kind")), "left").drop("_kind")


def kind_counts(spark, sf_dir) -> DataFrame:
    """(event_type, hour, n) of all events, by hours since 1970: a small table, written once, that the series,
    the numbers of the kinds and the alerts are all made from."""
    return written(epoch_hour_counts(given_events(spark, sf_dir), "event_type"), "event-counts")


def cluster_counts(counts: DataFrame):
    """(counts per cluster and hour, first hour, hours): cluster_id = place of the event type by name."""
    numbered, start, hours = numbered_from(counts)
    return with_kind(numbered, "event_type").select("cluster_id", "hour", "n"), start, hours


def cluster_events(spark, sf_dir, counts: DataFrame) -> DataFrame:
    """Events with the cluster_id of their type, which comes from the counts: the events are not shuffled."""
    return with_kind(given_events(spark, sf_dir), "event_type", counts)


_TABLE_EVENTS = "SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, event_type FROM events"
_LATE_SQL = f" UNION ALL SELECT {LATE_EVENT[0]}, {LATE_EVENT[1]}, TIMESTAMP '{LATE_EVENT[2]}', '{LATE_EVENT[3]}'"
_SPAN_SQL = """,
  span AS (SELECT date_trunc('hour', min(ts)) AS h0,
    CAST(date_diff('hour', date_trunc('hour', min(ts)), max(ts)) AS INTEGER) + 1 AS hours FROM given_ev)"""
_NUMBERED_SQL = """, ev AS (
  SELECT event_id, user_id, ts, event_type,
         CAST(dense_rank() OVER (ORDER BY event_type NULLS FIRST) - 1 AS INTEGER) AS cluster_id,
         CAST(floor((epoch_us(ts) - epoch_us((SELECT h0 FROM span))) / 3600000000.0) AS INTEGER) AS hour
  FROM given_ev)"""
EVENTS_SQL = f"given_ev AS ({_TABLE_EVENTS}{_LATE_SQL}){_SPAN_SQL}{_NUMBERED_SQL}"
#: The same without the late event: what a stream of the table sees.
LIVE_EVENTS_SQL = f"given_ev AS ({_TABLE_EVENTS}){_SPAN_SQL}{_NUMBERED_SQL}"


def sql_series(source="ev", name="series") -> str:
    return f"""{name}_counts AS (SELECT cluster_id, hour, count(*) AS n FROM {source}
    GROUP BY ALL),
  {name} AS (SELECT k.cluster_id, h.hour, (SELECT h0 FROM span) + to_hours(h.hour) AS bucket_ts,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM (SELECT DISTINCT cluster_id FROM {name}_counts) k
  CROSS JOIN (SELECT CAST(unnest(range(hours)) AS INTEGER) AS hour FROM span) h
  LEFT JOIN {name}_counts c ON c.cluster_id = k.cluster_id AND c.hour = h.hour)"""


def sql_scored(series="series", name="scored") -> str:
    return f"""{name}_w AS (SELECT *, count(*) OVER w AS k, sum(n) OVER w AS s, sum(n * n) OVER w AS ss FROM {series}
    WINDOW w AS (PARTITION BY cluster_id ORDER BY hour ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
  {name}_m AS (SELECT bucket_ts, hour, cluster_id, n AS current_count, s / CAST(k AS DOUBLE) AS historical_mean,
    sqrt(CAST(k * ss - s * s AS DOUBLE)) / k AS historical_std FROM {name}_w WHERE k >= 12),
  {name} AS (SELECT *, (current_count - historical_mean) / greatest(historical_std, 1.0) AS anomaly_score,
    CASE WHEN historical_mean > 0 THEN current_count / historical_mean END AS increase_ratio FROM {name}_m)"""


def sql_alerts(scored="scored", name="alerts") -> str:
    return f"{name} AS (SELECT * FROM {scored} WHERE current_count >= 8 AND anomaly_score >= 3.0)"


ALERTS_SQL = ", ".join([EVENTS_SQL, sql_series(), sql_scored(), sql_alerts()])
LIVE_ALERTS_SQL = ", ".join([LIVE_EVENTS_SQL, sql_series(), sql_scored(), sql_alerts()])

# ---- a text with a request in it ----

CUE_SENTENCE = " I would like to change my order. "


def cue_texts(spark, sf_dir) -> DataFrame:
    """Every turn, as it is and with a request in the middle, plus texts with odd edges."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    plain = turns.withColumn("kind", F.lit("plain"))
    asked = turns.withColumn("kind", F.lit("asked")).withColumn(
        "text", F.concat("text", F.lit(CUE_SENTENCE), "text")
    )
    odd = spark.createDataFrame(ODD_TEXTS, "conv_id long, turn long, text string, kind string")
    return plain.unionByName(asked).unionByName(odd)


ODD_TEXTS = [
    (-1, 0, "Good evening to you. I want to move the delivery to Friday. Nothing else.", "odd"),
    (-1, 1, "Is that the shop? I'm calling about a kettle without a lid. It came today.", "odd"),
    (-1, 7, "Well\x1cI'd\x1clike to pay", "odd"),
    (-1, 2, "  \t Well  I'd like to " + "pay the bill now " * 20, "odd"),
    (-1, 3, "He said \"I can't do it\"", "odd"),
    (-1, 4, "Yes! 😀 calling about a parcel", "odd"),
    (-1, 5, "couldn't", "odd"),
    (-1, 6, "Short. Then a longer sentence follows without a cue.", "odd"),
]
CUE_SQL = f"""texts AS (
  SELECT conv_id, turn, text, 'plain' AS kind FROM conversations
  UNION ALL SELECT conv_id, turn, text || {sql_text(CUE_SENTENCE)} || text, 'asked' FROM conversations
  UNION ALL SELECT * FROM (VALUES {sql_rows(ODD_TEXTS)}))"""

_CUE_RE = "(?i)" + C.REQUEST_CUE.replace("'", "''").replace(r"\s", WS_RE)
FOCUS_SQL = f"""cut AS (SELECT *, regexp_matches(text, '{_CUE_RE}') AS cue,
    regexp_split_to_array(text, '{_CUE_RE}')[1] AS pre FROM texts),
  parts AS (SELECT *, regexp_replace(regexp_extract(pre, '((?:{NWS_RE}+{WS_RE}+){{0,2}}{NWS_RE}*)$', 1),
      '(?s)^.*[.!?]{WS_RE}+', '') AS lead, regexp_extract(pre, '({NWS_RE}*)$', 1) AS broken FROM cut),
  focused AS (SELECT conv_id, turn, kind, text, cue, CASE WHEN NOT cue THEN text ELSE
      substr(lead, 1, length(lead) - length(broken)) || regexp_extract(
        substr(text, length(pre) - length(broken) + 1), '^({NWS_RE}+(?:{WS_RE}+{NWS_RE}+){{0,44}})', 1)
      END AS focus FROM parts)"""
EXCERPT_SQL = f"""stripped AS (SELECT *, trim(focus, {WS_SQL}) AS ex FROM focused),
  ended AS (SELECT *, regexp_matches(ex, '[.!?](?:{WS_RE}|$)') AS found,
      regexp_split_to_array(ex, '[.!?](?:{WS_RE}|$)')[1] AS sentence FROM stripped),
  excerpts AS (SELECT *, trim(substr(CASE WHEN found AND least(length(sentence) + 2, length(ex)) >= 25
      THEN substr(ex, 1, length(sentence) + 1) ELSE ex END, 1, 180), {WS_SQL}) AS excerpt FROM ended)"""

# ---- TF-IDF in SQL ----

TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def sql_terms(source, id_col, text_col, stop_words=True, name="terms") -> str:
    found = f"regexp_extract_all(lower({text_col}), '{TOKEN_RE}')"
    if stop_words:
        found = f"list_filter({found}, lambda t: NOT list_contains([{sql_list(C.stop_words())}], t))"
    return f"""{name}_tok AS (SELECT {id_col}, {found} AS t FROM {source}),
  {name} AS (SELECT {id_col}, unnest(list_concat(t, list_transform(range(1, len(t)),
    lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM {name}_tok)"""


TFIDF_SQL = ", ".join([DOCUMENTS_SQL, sql_terms("docs", "conversation_id", "customer_text")]) + """,
  tf AS (SELECT conversation_id, term, count(*) AS tf FROM terms GROUP BY ALL),
  freq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term),
  vocab AS (SELECT term, ln((1.0 + (SELECT count(*) FROM docs)) / (1 + df)) + 1 AS idf FROM freq
    WHERE df >= 3 AND df <= 0.85 * (SELECT count(*) FROM docs) ORDER BY total DESC, term LIMIT 12000),
  raw AS (SELECT conversation_id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
  weights AS (SELECT conversation_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY conversation_id)) AS weight FROM raw)"""
def sql_described(lab) -> str:
    """Descriptive terms of the clusters that `lab` (conversation_id, cluster_id) gives the documents."""
    return TFIDF_SQL + f""",
  lab AS ({lab}),
  sizes AS (SELECT cluster_id, count(*) AS size FROM lab GROUP BY ALL),
  means AS (SELECT cluster_id, term, sum(weight) / any_value(size) AS weight
    FROM weights JOIN lab USING (conversation_id) JOIN sizes USING (cluster_id) GROUP BY ALL HAVING sum(weight) > 0),
  described AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(weight, 12) DESC, term) AS rank
    FROM means QUALIFY rank <= 8)"""


DESCRIBE_SQL = sql_described(f"SELECT conversation_id, {LANGUAGE_CLUSTER_SQL.format(column='domain')} AS cluster_id FROM docs")

# ---- vectors ----

VECTORS_SQL = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
    generate_subscripts(embedding, 1) AS d FROM embeddings),
  centers AS (SELECT label, d, avg(v) AS m FROM e GROUP BY ALL)"""
DISTANCES_SQL = VECTORS_SQL + """, pairs AS (
    SELECT e.vec_id, any_value(e.label) AS own, c.label AS cluster_id, sqrt(sum((v - m) * (v - m))) AS distance,
      sum(v * m) / sqrt(sum(v * v) * sum(m * m)) AS similarity
    FROM e JOIN centers c ON c.d = e.d GROUP BY e.vec_id, c.label)"""
#: Cluster of each vector: the label whose centre is nearest.
PLACED_SQL = DISTANCES_SQL + """, placed AS (SELECT vec_id, cluster_id FROM pairs
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster_id) = 1)"""


def text_splits(spark, sf_dir) -> DataFrame:
    """Three tables of texts as splits of one dataset; the benchmark has no language, pages no source."""
    return union_splits({
        "benchmark": table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"),
        "documents": table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source"),
        "pages": table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("id"), F.col("html").alias("text"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang")
        ),
    })


SPLITS_SQL = """splits AS (
  SELECT 'benchmark' AS split, item_id AS id, text, NULL AS lang, NULL AS source FROM benchmark
  UNION ALL SELECT 'documents', doc_id, text, lang, source FROM documents
  UNION ALL SELECT 'pages', page_id, html, regexp_extract(html, 'lang="([a-z]+)"', 1), NULL FROM pages)"""
