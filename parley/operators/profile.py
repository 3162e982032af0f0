"""Profile of a channel-record table and audit of how its records pair up into calls.

Everything here is a grouped aggregate with a fixed-size state, so Spark combines it before the
shuffle and a call or value that holds most rows costs no more than any other.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as T

CATEGORIES = ("role", "domain", "accent", "gender")


def split_counts(records: DataFrame) -> DataFrame:
    """Rows per split, and in total in the row whose split is null."""
    return records.rollup("split").agg(F.count("*").alias("n"))


#: What a value can be seen as, each with a bit of its own; the patterns are tried in this order.
OBSERVED = (
    ("boolean", 2, "(?i)^(true|false)$"),
    ("integer", 4, "^[+-]?[0-9]{1,18}$"),
    ("decimal", 8, r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]{1,3})?$"),
    ("date", 16, "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", 32, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"),
)
BLANK, TEXT, DECLARED = 1, 64, 128
LONGEST_LITERAL = 64
#: What columns are that hold values of these kinds only; the first line that covers all of them holds.
OBSERVED_AS = (("blank", BLANK), ("boolean", 3), ("integer", 5), ("decimal", 13), ("date", 17), ("timestamp", 49))


def _kind_bit(field) -> Column:
    """Bit of what a value is seen as; null for a null."""
    c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
    bits = {name: bit for name, bit, _ in OBSERVED}
    if kind == "string":
        short, value = F.length(c) <= LONGEST_LITERAL, T.strip(c)
        seen = F.when(~short, F.lit(TEXT)).when(value == "", F.lit(BLANK))
        for _, bit, pattern in OBSERVED:
            seen = seen.when(value.rlike(pattern), F.lit(bit))
        seen = seen.otherwise(F.lit(TEXT))
    elif kind in ("double", "float", "decimal"):
        # a quotient of a number that is not finite equals nothing
        seen = F.when((c - c == 0) & (F.floor(c.cast("double")) == c), F.lit(bits["integer"])).otherwise(F.lit(bits["decimal"]))
    elif kind in ("byte", "short", "integer", "long"):
        seen = F.lit(bits["integer"])
    else:
        seen = F.lit(bits.get(kind.removesuffix("_ntz"), DECLARED))
    return F.when(c.isNotNull(), seen)


def _measured_length(field) -> Column:
    c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
    if kind in ("string", "binary"):
        return F.length(c)
    if kind in ("array", "map"):
        return F.when(c.isNotNull(), F.size(c))
    return F.lit(None).cast("int")


def schema_summary(df: DataFrame) -> DataFrame:
    """One row per column: name, declared type, nullable, the type that all its values are seen as, rows, nulls,
    least and greatest length (characters, bytes or elements).

    Every row is looked at, in one aggregate for all columns. What a column has been seen as is a set of bits
    that tasks combine by OR, so the state is one number however many values there are. Text that holds only
    literals of a kind is of that kind; blank text goes with any. A column without a value is 'none'.
    """
    fields = df.schema.fields
    state = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        length = _measured_length(f)
        state += [F.count(F.col(f"`{f.name}`")).alias(f"_c{i}"), F.bit_or(_kind_bit(f)).alias(f"_k{i}"),
                  F.min(length).alias(f"_l{i}"), F.max(length).alias(f"_m{i}")]

    def observed(i, f):
        seen = F.col(f"_k{i}")
        said = F.when(seen.isNull(), F.lit("none")).when(seen >= DECLARED, F.lit(f.dataType.simpleString()))
        for name, allowed in OBSERVED_AS:
            said = said.when(seen.bitwiseAND(F.lit(~allowed)) == 0, F.lit(name))
        return said.otherwise(F.lit("text"))

    rows = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
                 observed(i, f).alias("observed"), F.col("_rows").alias("rows"), (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"),
                 F.col(f"_l{i}").alias("min_length"), F.col(f"_m{i}").alias("max_length"))
        for i, f in enumerate(fields)
    ]
    return df.agg(*state).select(F.inline(F.array(*rows)))


def value_counts(records: DataFrame, columns=CATEGORIES) -> DataFrame:
    """Rows per value of every category column, null kept as a value; one pass over the table."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        records.select(F.inline(pairs)).groupBy("name", "value").agg(F.count("*").alias("n"))
    )


def profile_nulls(records: DataFrame) -> DataFrame:
    """Total rows, blank texts and missing audio. Audio is tested for null, never decoded."""
    audio = F.col("audio") if "audio" in records.columns else F.lit(None)
    return records.agg(
        F.count("*").alias("total"),
        F.count_if(T.is_blank("text")).alias("blank_text"),
        F.count_if(audio.isNull()).alias("null_audio"),
    )


def distinct_speakers(records: DataFrame, approximate=False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return records.agg(count(F.col("speaker_id")).alias("distinct_speakers"))


def text_length_stats(records: DataFrame, text_col="text") -> DataFrame:
    """Min, max, mean and exact median length of the non-blank texts.

    The lengths are counted first, so the last step sees one row per distinct length.
    """
    lengths = (
        records.where(T.not_blank(text_col)).groupBy(F.length(text_col).alias("len"))
        .agg(F.count("*").alias("n"))
    )
    return lengths.agg(
        F.min("len").alias("min_length"),
        F.max("len").alias("max_length"),
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean_length"),
        F.percentile("len", 0.5, F.col("n")).alias("median_length"),
    )


def named_records(records: DataFrame, malformed=False) -> DataFrame:
    """Records with call_id and channel; those with a malformed file name only if asked for."""
    named = records.withColumn("call_id", T.call_id("file_name")).withColumn("channel", T.channel("file_name"))
    return named if malformed else named.where("call_id <> ''")


def one_value(column: str) -> Column:
    """One distinct value in the group, null counted as a value."""
    filled = F.count(F.col(column))
    return (filled == 0) | (
        (filled == F.count("*")) & F.min(column).eqNullSafe(F.max(column))
    )


def exactly(column: str, *values) -> Column:
    """In a group of as many rows as values: every value is held by one row."""
    held = [F.count_if(F.col(column) == v) == 1 for v in values]
    return reduce(lambda a, b: a & b, held)


def call_groups(records: DataFrame, malformed=False) -> DataFrame:
    """One row per (split, call): group size and which pairing rules hold. With `malformed`, records
    without a call id are counted too, under the id ''."""
    return named_records(records, malformed).groupBy("split", "call_id").agg(
        F.count("*").alias("n"),
        exactly("channel", 1, 2).alias("channels_ok"),
        exactly("role", "agent", "customer").alias("roles_ok"),
        one_value("domain").alias("domain_ok"),
    )


def call_group_sizes(records: DataFrame) -> DataFrame:
    """Histogram of the number of records per call."""
    return call_groups(records).groupBy(F.col("n").alias("group_size")).agg(
        F.count("*").alias("calls")
    )


def _nameless() -> Column:
    return F.col("call_id") == ""


def _complete() -> Column:
    return (F.col("n") == 2) & F.col("channels_ok") & F.col("roles_ok") & F.col("domain_ok")


def pair_completeness(records: DataFrame) -> DataFrame:
    """Calls, calls of exactly two records, complete pairs, malformed names, broken groups."""
    return call_groups(records, malformed=True).agg(
        F.count_if(~_nameless()).alias("calls"),
        F.count_if(~_nameless() & (F.col("n") == 2)).alias("exactly_two"),
        F.count_if(~_nameless() & _complete()).alias("complete"),
        F.coalesce(F.sum(F.when(_nameless(), F.col("n"))), F.lit(0)).alias("malformed"),
    ).withColumn("broken", F.col("calls") - F.col("complete") + F.col("malformed"))


def pair_anomalies(records: DataFrame) -> DataFrame:
    """Four counters; the last three look at groups of two only and may overlap."""
    two = F.col("n") == 2
    return call_groups(records).agg(
        F.count_if(~two).alias("record_count_not_2"),
        F.count_if(two & ~F.col("channels_ok")).alias("duplicate_or_missing_channel"),
        F.count_if(two & ~F.col("roles_ok")).alias("role_mismatch"),
        F.count_if(two & ~F.col("domain_ok")).alias("domain_mismatch"),
    )


def channel_role_crosstab(records: DataFrame) -> DataFrame:
    return named_records(records).groupBy("channel", "role").agg(F.count("*").alias("n"))
