"""Observed types and counts from footers."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from parley.operators import profile as P
from parley.sources import splits as S

COLUMNS = {
    "whole": ["7", " -12", None, "+0", ""], "number": ["7", "1.5", ".5", "2e3", None], "flag": ["true", "FALSE", None, " ", "True"],
    "day": ["2024-02-30", None, None, None, "1999-12-31"], "moment": ["2024-02-03", "2024-02-03 10:11", "2024-02-03T10:11:12.5Z", "2024-02-03 10:11:12+01:00", None],
    "words": ["7", "seven", None, "8", "9"], "mixed": ["true", "7", None, None, None], "blank": ["", " \t", None, "\x1c", " "], "nothing": [None] * 5,
    "long": ["1" * 19, None, None, None, None], "digits": ["9" * 65, None, None, None, None],
}
SEEN = {"whole": "integer", "number": "decimal", "flag": "boolean", "day": "date", "moment": "timestamp", "words": "text", "mixed": "text",
        "blank": "blank", "nothing": "none", "long": "decimal", "digits": "text"}


def test_observed_types_of_text(spark):
    rows = spark.createDataFrame(list(zip(*COLUMNS.values())), ", ".join(f"{c} string" for c in COLUMNS))
    got = {r.name: r for r in P.schema_summary(rows.repartition(4)).collect()}
    assert {n: r.observed for n, r in got.items()} == SEEN and list(got) == list(COLUMNS)
    for name, values in COLUMNS.items():
        filled = [len(v) for v in values if v is not None]
        r = got[name]
        assert (r.type, r.nullable, r.rows, r.nulls) == ("string", True, 5, values.count(None))
        assert (r.min_length, r.max_length) == (min(filled, default=None), max(filled, default=None))


def test_observed_types_of_other_columns(spark):
    shape = "`a.b` long, d double, e double, c decimal(6,2), t timestamp, y date, f boolean, x binary, l array<int>, m map<string,int>, s struct<z:int>"
    day = datetime.date(2024, 5, 6)
    full = (1, 2.0, float("nan"), decimal.Decimal("2.50"), datetime.datetime(2024, 5, 6), day, True, bytearray(b"123"), [1, 2], {"k": 1}, (1,))
    rows = spark.createDataFrame([full, (None,) * 11, (2, -3.0, 1.0, decimal.Decimal("3.00"), None, day, None, bytearray(b""), [], {}, None)], shape)
    got = {r.name: (r.observed, r.nulls, r.min_length, r.max_length) for r in P.schema_summary(rows).collect()}
    assert got == {
        "a.b": ("integer", 1, None, None), "d": ("integer", 1, None, None), "e": ("decimal", 1, None, None), "c": ("decimal", 1, None, None),
        "t": ("timestamp", 2, None, None), "y": ("date", 1, None, None), "f": ("boolean", 2, None, None), "x": ("binary", 1, 0, 3),
        "l": ("array<int>", 1, 0, 2), "m": ("map<string,int>", 1, 0, 1), "s": ("struct<z:int>", 2, None, None),
    }
    assert {r.observed for r in P.schema_summary(rows.limit(0)).collect()} == {"none"}


def test_the_summary_is_one_aggregate(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("string").alias("x"), "id").write.parquet(str(tmp_path / "t"))
    plan = P.schema_summary(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1


def test_counts_come_from_the_footers(spark, tmp_path):
    paths = {}
    for name, n in (("a", 70), ("b", 5), ("empty", 0)):
        paths[name] = str(tmp_path / name)
        spark.range(n).repartition(3).write.parquet(paths[name])
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counted = S.split_counts_of_files(spark, paths)
    assert {r.split: r.n for r in counted.collect()} == {"a": 70, "b": 5, "empty": 0, None: 75}
    plan = S.footer_counts(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    spark.range(4).selectExpr("cast(id as string) AS value").write.text(str(tmp_path / "text"))
    assert {r.split: r.n for r in S.split_counts_of_files(spark, {"t": str(tmp_path / "text")}, "text").collect()} == {"t": 4, None: 4}
    with pytest.raises(ValueError):
        S.split_counts_of_files(spark, {})
