import pytest
from pyspark.sql import functions as F

from parley.constants import WHITESPACE
from parley.functions import text as T
from parley.operators import conversations as V
from parley.operators import profile as P
from parley.operators import quality as Q
from parley.schemas import CHANNEL_RECORD
from parley.sources import splits as S


def record(name, role, text="text", domain="telecom", speaker="s", split="train"):
    return (split, name, role, text, domain, speaker, None, None)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHANNEL_RECORD)


GOOD = [record("a/call_channel1.wav", "customer", "  My text. "), record("a/call_channel2.wav", "agent", "Hi")]


def test_pairing_keeps_texts_unchanged(spark):
    good, rejects = V.build_conversations(frame(spark, GOOD), strict=True)
    row = good.first()
    assert row.conversation_id == "a/call" and row.customer_text == "  My text. " and row.agent_text == "Hi"
    assert rejects.count() == 0


@pytest.mark.parametrize("rows,reason", [
    (GOOD[:1], "not two records"),
    ([record("c_channel1.wav", "agent"), record("c_channel2.wav", "agent")], "roles are not customer and agent"),
    ([record("c_channel1.wav", "customer"), record("c_channel1.wav", "agent")], "channels are not 1 and 2"),
    ([record("c_channel1.wav", "customer"), record("c_channel2.wav", "agent", domain="food")], "domains differ"),
    ([record("c_channel1.wav", "customer"), record("c_channel2.wav", "agent", domain=None)], "domains differ"),
    ([record("c_channel1.wav", None), record("c_channel2.wav", "agent")], "roles are not customer and agent"),
    ([record("tape-17.wav", "agent")], "malformed file name"),
    ([record(None, "agent")], "malformed file name"),
    ([record("x_channel1.wav", "customer"), record("y_channel2.wav", "agent")], "not two records"),
])
def test_pair_rejects(spark, rows, reason):
    good, rejects = V.build_conversations(frame(spark, rows))
    assert good.count() == 0
    assert {r.reject_reason for r in rejects.collect()} == {reason}
    with pytest.raises(Q.DataQualityError):
        V.build_conversations(frame(spark, rows), strict=True)


def test_null_domains_are_equal_and_splits_do_not_mix(spark):
    rows = [record("c_channel1.wav", "customer", domain=None), record("c_channel2.wav", "agent", domain=None)]
    rows += [record("c_channel1.wav", "customer", split="test"), record("c_channel2.wav", "agent", split="test")]
    good, _ = V.build_conversations(frame(spark, rows))
    assert {r.conversation_id for r in good.collect()} == {"train:c", "test:c"}


def test_blank_is_pythons_strip(spark):
    samples = ["", " ", WHITESPACE, " ", " \n", " x ", "​", None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.b for r in rows.select("i", T.is_blank("s").alias("b")).collect()}
    assert got == {i: s is None or not s.strip() for i, s in enumerate(samples)}


@pytest.mark.parametrize("name,expected", [
    ("a_channel1.wav", ("a", 1)), ("x/y_channel2.wav", ("x/y", 2)), ("a_channel3.wav", ("", None)),
    ("_channel1.wav", ("", None)), ("a_channel1.wav\n", ("", None)), ("a_channel1.wav.bak", ("", None)),
    ("a_channel1.wav_channel2.wav", ("a_channel1.wav", 2)), (None, ("", None)),
])
def test_file_name(spark, name, expected):
    row = spark.createDataFrame([(name,)], "n string").select(T.call_id("n").alias("c"), T.channel("n").alias("k")).first()
    assert (row.c, row.k) == expected


def test_profile_counts(spark):
    rows = GOOD + [
        record("d_channel1.wav", "customer", domain=None), record("d_channel2.wav", "agent", domain="food"),
        record("e_channel1.wav", "agent"), record("e_channel1.wav", "agent", text=" "), record("bad", None, None, None, None),
    ]
    df = frame(spark, rows)
    assert P.pair_completeness(df).first().asDict() == {
        "calls": 3, "exactly_two": 3, "complete": 1, "malformed": 1, "broken": 3
    }
    assert P.pair_anomalies(df).first().asDict() == {
        "record_count_not_2": 0, "duplicate_or_missing_channel": 1, "role_mismatch": 1, "domain_mismatch": 1
    }
    assert P.profile_nulls(df).first().asDict() == {"total": 7, "blank_text": 2, "null_audio": 7}
    counts = {(r.name, r.value): r.n for r in P.value_counts(df).collect()}
    assert counts[("role", None)] == 1 and counts[("accent", None)] == 7


def test_length_stats_of_no_rows_and_even_median(spark):
    empty = P.text_length_stats(frame(spark, [record("a_channel1.wav", "agent", " ")])).first()
    assert empty.asDict() == {"min_length": None, "max_length": None, "mean_length": None, "median_length": None}
    texts = [record("a_channel1.wav", "agent", t) for t in ("a", "ab", "abcd", "😀" * 7)]
    stats = P.text_length_stats(frame(spark, texts)).first()
    assert (stats.min_length, stats.max_length, stats.mean_length, stats.median_length) == (1, 7, 3.5, 3.0)


def test_turns_join_in_order(spark):
    turns = spark.createDataFrame(
        [(1, "u", 2, "third"), (1, "u", 0, "first"), (1, "u", 1, "second"), (2, "u", 0, "x" * 50), (2, "u", 1, "y")],
        "conv int, role string, turn int, text string",
    )
    channels = V.assemble_channels(turns, ["conv", "role"])
    assert sorted((r.conv, r.text) for r in channels.collect()) == [(1, "first\nsecond\nthird"), (2, "x" * 50 + "\ny")]


def test_splits(spark):
    with pytest.raises(ValueError):
        S.union_splits({})
    a = spark.createDataFrame([(1, "x")], "id int, text string")
    b = spark.createDataFrame([(2,)], "id int")
    rows = {(r.split, r.id, r.text) for r in S.union_splits({"a": a, "b": b}).collect()}
    assert rows == {("a", 1, "x"), ("b", 2, None)}
    assert S.with_schema(a).columns == CHANNEL_RECORD.names


def test_audio_is_pruned_from_the_scan(spark, tmp_path):
    path = str(tmp_path / "sound")
    frame(spark, GOOD).withColumn("audio", F.lit(b"wave")).write.parquet(path)
    plan = S.with_schema(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "audio:" not in plan.split("ReadSchema")[1]


def test_preview(spark):
    df = spark.createDataFrame([(1, "x" * 301, bytearray(b"1")), (2, "y", None)], "id int, t string, raw binary")
    first, second = S.preview(df, "id").collect()
    assert first.t.startswith("x" * 300 + "…") and first.raw != b"1" and second.t == "y"


def test_examples_and_duplicates(spark):
    rows = spark.createDataFrame(
        [("1", "text", "a"), ("1", "more", "a"), ("2", " ", "a"), ("3", "text", None)],
        "conversation_id string, customer_text string, domain string",
    )
    good, bad = Q.training_examples(rows)
    assert good.count() == 2 and {r.reject_reason for r in bad.collect()} == {"blank text", "missing label"}
    assert [(r.conversation_id, r.n) for r in Q.duplicate_ids(good).collect()] == [("1", 2)]
    with pytest.raises(Q.DataQualityError):
        Q.require_none(bad, "incomplete")
    with pytest.raises(Q.DataQualityError):
        Q.require_rows(rows, 4)
