"""Column contracts of the tables the operators read and write."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

CHANNEL_RECORD = _struct(
    ("split", _S), ("file_name", _S), ("role", _S), ("text", _S), ("domain", _S),
    ("speaker_id", _S), ("accent", _S), ("gender", _S),
)

CONVERSATION = _struct(
    ("conversation_id", _S), ("domain", _S), ("customer_text", _S), ("agent_text", _S),
    ("customer_speaker_id", _S), ("agent_speaker_id", _S),
)

ISSUE = _struct(
    ("conversation_id", _S), ("domain", _S), ("customer_text", _S), ("issue_statement", _S),
    ("issue_source", _S), ("input_truncated", _B),
)

CLUSTER_EVENT = _struct(("cluster_id", _I), ("ts", T.TimestampType()))

HOURLY_COUNT = _struct(("cluster_id", _I), ("bucket_ts", T.TimestampType()), ("n", _L))

ALERT = _struct(
    ("bucket_ts", T.TimestampType()), ("cluster_id", _I), ("current_count", _L),
    ("historical_mean", _D), ("historical_std", _D), ("anomaly_score", _D),
    ("increase_ratio", _D), ("descriptive_terms", T.ArrayType(_S)),
)

ANALYSIS_METADATA = _struct(
    ("domain_model", _S), ("domain_input_mode", _S), ("embedding_model", _S),
    ("semantic_cluster_count", _I),
)

CLUSTER_TERMS = _struct(("cluster_id", _I), ("descriptive_terms", T.ArrayType(_S)))
