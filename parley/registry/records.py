"""Queries: splits, profile, pairing, row checks."""

import os

from pyspark.sql import functions as F

from parley.functions import display as D
from parley.functions import text as T
from parley.operators import conversations as V
from parley.operators import profile as P
from parley.operators import quality as Q
from parley.registry import inputs as I
from parley.registry.base import query, sql_text, table
from parley.registry.inputs import (
    CHANNEL_RECORDS_SQL, DOCUMENTS_SQL, SPLITS_SQL, TURN_RECORDS_SQL, WS_SQL, sql_blank, sql_rows,
)
from parley.schemas import CHANNEL_RECORD
from parley.sources import splits as S


@query("scan_splits", f"WITH {SPLITS_SQL} SELECT split, id, lang, source, md5(text) AS digest FROM splits")
def scan_splits(spark, sf):
    return I.text_splits(spark, sf).select("split", "id", "lang", "source", F.md5("text").alias("digest"))


@query("split_counts", f"""WITH {SPLITS_SQL} SELECT coalesce(split, 'all') AS split, count(*) AS n
    FROM splits GROUP BY ROLLUP (split)""")
def split_counts(spark, sf):
    return P.split_counts(I.text_splits(spark, sf)).withColumn("split", F.coalesce("split", F.lit("all")))


@query("split_counts_of_files", """WITH c AS (SELECT 'benchmark' AS split, count(*) AS n FROM benchmark
    UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages)
  SELECT coalesce(split, 'all') AS split, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ROLLUP (split)""")
def split_counts_of_files(spark, sf):
    """The same from the files' footers."""
    paths = {name: os.path.join(sf, f"{name}.parquet") for name in ("benchmark", "documents", "pages")}
    return S.split_counts_of_files(spark, paths).withColumn("split", F.coalesce("split", F.lit("all")))


_EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


def _sql_summary(source, name, kind):
    """A column's row of the summary."""
    bits = {n: bit for n, bit, _ in P.OBSERVED}
    if kind == "string":
        tried = " ".join(f"WHEN regexp_matches(trim({name}, {WS_SQL}), '{pattern}') THEN {bit}" for _, bit, pattern in P.OBSERVED)
        bit = f"CASE WHEN length({name}) > {P.LONGEST_LITERAL} THEN {P.TEXT} WHEN trim({name}, {WS_SQL}) = '' THEN {P.BLANK} {tried} ELSE {P.TEXT} END"
    elif kind == "double":
        bit = f"CASE WHEN isfinite({name}) AND floor({name}) = {name} THEN {bits['integer']} ELSE {bits['decimal']} END"
    else:
        bit = str(bits["timestamp" if kind.startswith("timestamp") else "integer"])
    said = " ".join(f"WHEN (k & ~{allowed}) = 0 THEN '{n}'" for n, allowed in P.OBSERVED_AS)
    length = f"length({name})" if kind == "string" else "NULL"
    return f"""SELECT '{source}' AS source, '{name}' AS name, '{kind}' AS type, true AS nullable,
      CASE WHEN k IS NULL THEN 'none' {said} ELSE 'text' END AS observed, rows, nulls, min_length, max_length FROM (
      SELECT bit_or(CAST(CASE WHEN {name} IS NOT NULL THEN {bit} END AS INTEGER)) AS k, count(*) AS rows, count(*) - count({name}) AS nulls,
        CAST(min({length}) AS DOUBLE) AS min_length, CAST(max({length}) AS DOUBLE) AS max_length FROM {source})"""


@query("schema_summary", f"WITH {TURN_RECORDS_SQL} " + " UNION ALL ".join(
    [_sql_summary("records", f.name, "string") for f in CHANNEL_RECORD.fields]
    + [_sql_summary("events", name, kind) for name, kind in _EVENT_TYPES.items()]))
def schema_summary(spark, sf):
    """Declared and observed types of the channel records and of the events."""
    tables = {"records": I.turn_records(spark, sf), "events": table(spark, sf, "events")}
    named = [P.schema_summary(df).withColumn("source", F.lit(name)) for name, df in tables.items()]
    lengths = {c: F.col(c).cast("double") for c in ("min_length", "max_length")}
    return named[0].unionByName(named[1]).withColumns(lengths)


@query("preview_rows", f"""SELECT page_id, url, CASE WHEN length(html) > 300
    THEN substr(html, 1, 300) || {sql_text(T.C.CUT_MARK)} ELSE html END AS html
    FROM pages ORDER BY page_id LIMIT 3""")
def preview_rows(spark, sf):
    return S.preview(table(spark, sf, "pages"), "page_id", 3)


@query("call_id_extract", f"""WITH {TURN_RECORDS_SQL}
    SELECT file_name, call_id, coalesce(channel, 0) AS channel, count(*) AS n FROM named GROUP BY ALL""")
def call_id_extract(spark, sf):
    channel = F.coalesce(T.channel("file_name"), F.lit(0))
    return (
        I.turn_records(spark, sf)
        .select("file_name", T.call_id("file_name").alias("call_id"), channel.alias("channel"))
        .groupBy("file_name", "call_id", "channel").agg(F.count("*").alias("n"))
    )


BLANKS = [(-1, ""), (-2, "   "), (-3, " \t\n "), (-4, "  "), (-5, None), (-6, "\x1c\x1f"), (-7, " x ")]


@query("nonblank_text", f"""SELECT doc_id, NOT ({sql_blank('text')}) AS filled FROM (
    SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {sql_rows(BLANKS)})) t(doc_id, text)""")
def nonblank_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    extra = spark.createDataFrame(BLANKS, docs.schema)
    return docs.unionByName(extra).select("doc_id", T.not_blank("text").alias("filled"))


@query("malformed_names", f"""WITH {TURN_RECORDS_SQL}
    SELECT split, file_name, count(*) AS n FROM named WHERE call_id = '' GROUP BY ALL""")
def malformed_names(spark, sf):
    bad = Q.malformed_names(I.turn_records(spark, sf))
    return bad.groupBy("split", "file_name").agg(F.count("*").alias("n"))


@query("split_qualified_id", f"""WITH {SPLITS_SQL} SELECT split || ':' || id AS qualified_id FROM splits""")
def split_qualified_id(spark, sf):
    rows = I.text_splits(spark, sf)
    return rows.select(
        V.split_qualified_id("split", "id", V.count_splits(rows)).alias("qualified_id")
    )


_PAIRS_SQL = CHANNEL_RECORDS_SQL + """,
  sides AS (SELECT split, call_id, count(*) AS n, min(channel) AS c1, max(channel) AS c2,
    count(role) AS nr, min(role) AS r1, max(role) AS r2,
    max(CASE WHEN role = 'customer' THEN domain END) AS cd, max(CASE WHEN role = 'agent' THEN domain END) AS ad,
    max(CASE WHEN role = 'customer' THEN text END) AS ct, max(CASE WHEN role = 'agent' THEN text END) AS agt,
    max(CASE WHEN role = 'customer' THEN speaker_id END) AS cs, max(CASE WHEN role = 'agent' THEN speaker_id END) AS ags
    FROM named WHERE call_id <> '' GROUP BY ALL),
  judged AS (SELECT *, CASE WHEN n <> 2 THEN 'not two records'
    WHEN NOT (c1 = 1 AND c2 = 2) THEN 'channels are not 1 and 2'
    WHEN NOT coalesce(nr = 2 AND r1 = 'agent' AND r2 = 'customer', false) THEN 'roles are not customer and agent'
    WHEN cd IS DISTINCT FROM ad THEN 'domains differ' END AS reject_reason FROM sides)"""


@query("pair_rejects", f"""WITH {_PAIRS_SQL}
    SELECT split, call_id AS name, reject_reason FROM judged WHERE reject_reason IS NOT NULL
    UNION ALL SELECT split, file_name, 'malformed file name' FROM named WHERE call_id = ''""")
def pair_rejects(spark, sf):
    return V.build_conversations(I.channel_records(spark, sf), split_count=2)[1]


@query("build_conversations", f"""WITH {_PAIRS_SQL}
    SELECT split || ':' || call_id AS conversation_id, cd AS domain, ct AS customer_text, agt AS agent_text,
      cs AS customer_speaker_id, ags AS agent_speaker_id FROM judged WHERE reject_reason IS NULL""")
def build_conversations(spark, sf):
    return V.build_conversations(I.channel_records(spark, sf), split_count=2)[0]


BAD_EXAMPLES = [("-1", "", "en"), ("-2", " \n", "en"), ("-3", None, "en"), ("-4", "fine", None), ("-5", "fine", "")]


@query("prepare_examples", f"""WITH {DOCUMENTS_SQL}, rows AS (
    SELECT conversation_id, customer_text, domain FROM docs UNION ALL SELECT * FROM (VALUES {sql_rows(BAD_EXAMPLES)}))
    SELECT conversation_id, domain, CAST(coalesce(length(customer_text), 0) AS BIGINT) AS chars,
      CASE WHEN {sql_blank('customer_text')} THEN 'blank text' WHEN coalesce(domain, '') = '' THEN 'missing label'
      ELSE 'good' END AS verdict FROM rows""")
def prepare_examples(spark, sf):
    rows = I.document_conversations(spark, sf).select("conversation_id", "customer_text", "domain")
    rows = rows.unionByName(spark.createDataFrame(BAD_EXAMPLES, rows.schema))
    good, bad = Q.training_examples(rows)
    both = good.withColumn("reject_reason", F.lit("good")).unionByName(bad)
    return both.select(
        "conversation_id", "domain", F.coalesce(F.length("customer_text"), F.lit(0)).cast("long").alias("chars"),
        F.col("reject_reason").alias("verdict"),
    )


@query("duplicate_ids", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return Q.duplicate_ids(table(spark, sf, "events"), "user_id")


@query("explode_lines", f"""SELECT doc_id, CAST(rank - 1 AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rank FROM (
      SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (
        SELECT doc_id, regexp_split_to_array(text, '\\r?\\n') AS l FROM documents))
    WHERE NOT ({sql_blank('line')}))""")
def explode_lines(spark, sf):
    return S.text_lines(table(spark, sf, "documents"), "text", "doc_id")


_LABELLED = "CASE lang WHEN 'en' THEN 'TELECOM' WHEN 'fr' THEN 'travel' WHEN 'de' THEN 'Banking' ELSE lang END"


@query("domain_labels", f"""SELECT code, CASE lower(code) WHEN 'telecom' THEN {sql_text(T.C.DOMAIN_LABELS['telecom'])}
    WHEN 'travel' THEN {sql_text(T.C.DOMAIN_LABELS['travel'])} WHEN 'banking' THEN {sql_text(T.C.DOMAIN_LABELS['banking'])}
    ELSE code END AS label, count(*) AS n FROM (SELECT {_LABELLED} AS code FROM documents) GROUP BY ALL""")
def domain_labels(spark, sf):
    codes = table(spark, sf, "documents").select(F.expr(_LABELLED).alias("code"))
    return codes.groupBy("code", D.domain_label("code").alias("label")).agg(F.count("*").alias("n"))


@query("value_counts", f"""WITH {TURN_RECORDS_SQL}
    SELECT 'role' AS name, role AS value, count(*) AS n FROM records GROUP BY ALL
    UNION ALL SELECT 'domain', domain, count(*) FROM records GROUP BY ALL
    UNION ALL SELECT 'accent', accent, count(*) FROM records GROUP BY ALL
    UNION ALL SELECT 'gender', gender, count(*) FROM records GROUP BY ALL""")
def value_counts(spark, sf):
    return P.value_counts(I.turn_records(spark, sf))


@query("profile_nulls", f"""WITH {TURN_RECORDS_SQL} SELECT count(*) AS total,
    count(*) FILTER ({sql_blank('text')}) AS blank_text, count(*) AS null_audio FROM records""")
def profile_nulls(spark, sf):
    return P.profile_nulls(I.turn_records(spark, sf))


@query("distinct_speakers", f"""WITH {TURN_RECORDS_SQL}
    SELECT count(DISTINCT speaker_id) AS distinct_speakers FROM records""")
def distinct_speakers(spark, sf):
    return P.distinct_speakers(I.turn_records(spark, sf))


@query("text_length_stats", f"""WITH {TURN_RECORDS_SQL}, lens AS (
    SELECT CAST(length(text) AS INTEGER) AS len FROM records WHERE NOT ({sql_blank('text')}))
    SELECT min(len) AS min_length, max(len) AS max_length, round(avg(len), 6) AS mean_length,
      round(CAST(quantile_cont(len, 0.5) AS DOUBLE), 6) AS median_length FROM lens""")
def text_length_stats(spark, sf):
    stats = P.text_length_stats(I.turn_records(spark, sf))
    return stats.select(
        "min_length", "max_length", F.round("mean_length", 6).alias("mean_length"),
        F.round("median_length", 6).alias("median_length"),
    )


@query("call_group_sizes", f"""WITH {TURN_RECORDS_SQL}, g AS (
    SELECT count(*) AS group_size FROM named WHERE call_id <> '' GROUP BY split, call_id)
    SELECT group_size, count(*) AS calls FROM g GROUP BY ALL""")
def call_group_sizes(spark, sf):
    return P.call_group_sizes(I.turn_records(spark, sf))


_GROUPS_SQL = """groups AS (SELECT split, call_id, count(*) AS n,
    coalesce(min(channel) = 1 AND max(channel) = 2, false) AS channels_ok,
    coalesce(count(role) = 2 AND min(role) = 'agent' AND max(role) = 'customer', false) AS roles_ok,
    len(list_distinct(list(coalesce('=' || domain, 'null')))) = 1 AS domain_ok
    FROM named WHERE call_id <> '' GROUP BY split, call_id)"""


@query("pair_completeness", f"""WITH {CHANNEL_RECORDS_SQL}, {_GROUPS_SQL}, c AS (
    SELECT count(*) AS calls, count(*) FILTER (n = 2) AS exactly_two,
      count(*) FILTER (n = 2 AND channels_ok AND roles_ok AND domain_ok) AS complete FROM groups),
    m AS (SELECT count(*) AS malformed FROM named WHERE call_id = '')
    SELECT calls, exactly_two, complete, malformed, calls - complete + malformed AS broken FROM c, m""")
def pair_completeness(spark, sf):
    return P.pair_completeness(I.channel_records(spark, sf))


@query("pair_anomalies", f"""WITH {CHANNEL_RECORDS_SQL}, {_GROUPS_SQL}
    SELECT count(*) FILTER (n <> 2) AS record_count_not_2,
      count(*) FILTER (n = 2 AND NOT channels_ok) AS duplicate_or_missing_channel,
      count(*) FILTER (n = 2 AND NOT roles_ok) AS role_mismatch,
      count(*) FILTER (n = 2 AND NOT domain_ok) AS domain_mismatch FROM groups""")
def pair_anomalies(spark, sf):
    return P.pair_anomalies(I.channel_records(spark, sf))


@query("channel_role_crosstab", f"""WITH {TURN_RECORDS_SQL}
    SELECT channel, role, count(*) AS n FROM named WHERE call_id <> '' GROUP BY ALL""")
def channel_role_crosstab(spark, sf):
    return P.channel_role_crosstab(I.turn_records(spark, sf))
