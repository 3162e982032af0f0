"""Reading tables that come as named splits."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.schemas import CHANNEL_RECORD


def union_splits(splits: dict) -> DataFrame:
    """All rows of named tables with their split name; a column a split lacks is null there."""
    if not splits:
        raise ValueError("there is no split to read")
    named = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def read_splits(spark: SparkSession, paths: dict, fmt="parquet", schema=None) -> DataFrame:
    """Read every split of a dataset, given as {name: path}."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return union_splits({name: reader.load(path) for name, path in paths.items()})


#: Formats whose files say how many rows they hold.
COUNTED_FORMATS = ("parquet", "orc")


def footer_counts(spark: SparkSession, paths: dict, fmt="parquet") -> DataFrame:
    """(split, n) of {name: path}, in a session of its own: the push-down is a setting of that session, and
    the caller's stays as it is."""
    session = spark.newSession()
    if fmt in COUNTED_FORMATS:
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set(f"spark.sql.{fmt}.aggregatePushdown", "true")
    return reduce(DataFrame.unionAll, [
        session.read.format(fmt).load(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("split"), "n")
        for name, path in paths.items()
    ])


def split_counts_of_files(spark: SparkSession, paths: dict, fmt="parquet") -> DataFrame:
    """Rows per split of {name: path}, and in total in the row whose split is null.

    The counts of Parquet and ORC files come from their footers, by aggregate push-down: no column is read.
    Files of other formats are counted row by row. One number per split comes to the driver.
    """
    if not paths:
        raise ValueError("there is no split to read")
    # a pushed-down count of no file is null
    counts = [(r.split, r.n or 0) for r in footer_counts(spark, paths, fmt).collect()]
    return spark.createDataFrame([*counts, (None, sum(n for _, n in counts))], "split string, n long")


def with_schema(df: DataFrame, schema=CHANNEL_RECORD) -> DataFrame:
    """Exactly the columns of `schema`; a missing one is null. Audio and the like are never read."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def preview(df: DataFrame, order_col, limit=3) -> DataFrame:
    """First rows by key, with long texts cut and binary values hidden."""
    shown = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "binary":
            value = F.when(F.col(field.name).isNotNull(), F.lit(T.C.BINARY_MARK))
        elif kind == "struct" and "bytes" in field.dataType.names:
            value = F.when(F.col(field.name).isNotNull(), F.lit(T.C.BINARY_MARK))
        elif kind == "string":
            value = T.display_value(field.name)
        else:
            value = F.col(field.name)
        shown.append(value.alias(field.name))
    return df.orderBy(order_col).limit(limit).select(*shown)


def text_lines(df: DataFrame, text_col, id_col) -> DataFrame:
    """One row per non-blank line: (id, line_no, line)."""
    # The outer form keeps the lines from being cut a second time for an inferred filter.
    rows = df.select(id_col, F.posexplode_outer(T.lines(text_col)).alias("line_no", "line"))
    return rows.where(F.col("line").isNotNull())
