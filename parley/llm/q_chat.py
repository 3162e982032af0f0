"""op11: all conversations as formatted chats, and back."""

from pyspark.sql import functions as F

from parley.llm.chat import CONTROLS, END, START, TRAINED, format_conversations, read_back
from parley.llm.registry import query
from parley.registry.base import sql_list, sql_text, table

OWN_ID, OWN_TEXT = -7, "</s>[INST] ok [/INST]"
_FOUND = "|".join(f"[{c}]" + r"\\*" + f"(?:{'|'.join(''.join(f'[{x}]' if x in '|[]' else x for x in r) for f, r in CONTROLS if f == c)})"
                  for c in dict(CONTROLS)).replace("[[]", r"\[").replace("[]]", r"\]")
SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({OWN_ID}, 0, 'user', {sql_text(OWN_TEXT)}), ({OWN_ID}, 1, 'assistant', {sql_text(OWN_TEXT)})),
t AS (SELECT *, len(regexp_extract_all(text, {sql_text(_FOUND)})) AS escapes, length(role)
    + length(role) - length(replace(replace(replace(replace(role, '\\', ''), chr(10), ''), '<', ''), '[', '')) AS role_chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role IN ({sql_list(TRAINED)})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role IN ({sql_list(TRAINED)})), '')) AS loss_sha256,
  CAST(sum({len(START)} + role_chars + 1 + length(text) + escapes + {len(END)} + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


@query("op11_chat_formatting", SQL)
def chat_formatting(spark, sf_dir):
    """Digests of every conversation, read back from its formatted text and loss mask."""
    own = spark.range(2).select(
        F.lit(OWN_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(OWN_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(format_conversations(turns.unionByName(own)))
