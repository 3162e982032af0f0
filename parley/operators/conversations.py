"""Pairing of customer and agent records into conversations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.operators.profile import exactly
from parley.operators.quality import require_none

TURN_SEPARATOR = "\n"


def assemble_channels(turns: DataFrame, keys, turn_col="turn", text_col="text") -> DataFrame:
    """Turn texts of a channel joined in turn order into one text.

    A channel is one record of one call, a cell of the table by the data model; whatever its size, it
    is treated alike, and a text that exceeds what a cell can hold stops the job.
    """
    keys = list(keys)
    ordered = F.array_sort(F.collect_list(F.struct(turn_col, text_col)))
    texts = F.transform(ordered, lambda t: t[text_col])
    return turns.groupBy(*keys).agg(F.array_join(texts, TURN_SEPARATOR).alias(text_col))


def paired_calls(records: DataFrame) -> DataFrame:
    """One row per (split, call) with both sides picked by role and the first broken rule, if any.

    The two records of a call meet by conditional aggregation: one shuffle on the call, no
    self-join, and nothing but one record per role is kept of a group of any size.
    """
    grouped = (
        records.withColumn("call_id", T.call_id("file_name"))
        .withColumn("channel", T.channel("file_name"))
        .where("call_id <> ''")
    )
    side = {
        role: F.min(F.when(F.col("role") == role, F.struct("domain", "text", "speaker_id")))
        for role in ("customer", "agent")
    }
    calls = grouped.groupBy("split", "call_id").agg(
        F.count("*").alias("n"),
        exactly("channel", 1, 2).alias("channels_ok"),
        exactly("role", "agent", "customer").alias("roles_ok"),
        side["customer"].alias("customer"),
        side["agent"].alias("agent"),
    )
    reason = (
        F.when(F.col("n") != 2, F.lit("not two records"))
        .when(~F.col("channels_ok"), F.lit("channels are not 1 and 2"))
        .when(~F.col("roles_ok"), F.lit("roles are not customer and agent"))
        .when(
            ~F.col("customer.domain").eqNullSafe(F.col("agent.domain")), F.lit("domains differ")
        )
    )
    return calls.withColumn("reject_reason", reason)


def split_qualified_id(split_col, id_col, split_count):
    """Id with its split in front when there is more than one split."""
    if split_count > 1:
        return F.concat_ws(":", F.col(split_col), F.col(id_col))
    return F.col(id_col)


def count_splits(records: DataFrame) -> int:
    """Number of splits, counted on the driver: a handful of names."""
    return records.select("split").distinct().count()


def build_conversations(records: DataFrame, split_count=None, strict=False):
    """(conversations, rejects).

    A reject is (split, file_name or call id, reason). Strict mode raises on the first bad group
    or name and gives no partial result.
    """
    if split_count is None:
        split_count = count_splits(records)
    calls = paired_calls(records)
    rejects = calls.where("reject_reason IS NOT NULL").select(
        "split", F.col("call_id").alias("name"), "reject_reason"
    ).unionByName(
        records.where(T.call_id("file_name") == "").select(
            "split", F.col("file_name").alias("name"), F.lit("malformed file name").alias("reject_reason")
        )
    )
    if strict:
        require_none(rejects, "records do not pair up")
    good = calls.where("reject_reason IS NULL").select(
        split_qualified_id("split", "call_id", split_count).alias("conversation_id"),
        F.col("customer.domain").alias("domain"),
        F.col("customer.text").alias("customer_text"),
        F.col("agent.text").alias("agent_text"),
        F.col("customer.speaker_id").alias("customer_speaker_id"),
        F.col("agent.speaker_id").alias("agent_speaker_id"),
    )
    return good, rejects
