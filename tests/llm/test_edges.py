"""Every operator and stage on nulls, empty and very long texts, repeated rows, clashing columns, no rows."""


import public_tokenizers
import pytest

import corpus_pipeline
from parley.llm import bpe, fingerprints, jaccard, licenses, lm, packing, quality, substrings, urls, warc

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (6, "Héllo, wörld!  日本語 🙂 ΣΑΣ"),
    (None, "no id at all here"), (7, LONG), (8, LONG), (9, "a" * 20_000), (10, "the " * 3_000), (2_000_000_000_000, "far id"),
]
OPERATORS = {
    "quality": quality.judge,
    "jaccard": jaccard.link_components,
    "licenses": licenses.scan,
    "lm": lm.score,
    "fingerprints": fingerprints.fingerprint_pairs,
    "substrings": substrings.find_repeats,
    "packing": lambda d: packing.pack(d, WORDS),
    "bpe": lambda d: bpe.digests(d, RANKS, public_tokenizers.PATTERN),
}
PER_ROW = ("quality", "jaccard", "licenses", "lm", "bpe", "fingerprints")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(docs, name):
    rows = OPERATORS[name](docs(ODD, extra=True)).collect()
    if name in PER_ROW:
        assert len(rows) == len(ODD)
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    if name == "packing":
        assert {r.doc_id for r in rows} == {i for i, _ in ODD}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(docs, name):
    assert OPERATORS[name](docs([])).collect() == []


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=lambda s: s.__name__)
def test_stages(spark, docs, stage):
    for rows in (ODD, []):
        d = docs(rows, extra=True)
        got = stage(spark, d, None)
        got.collect()
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert got.columns == d.columns


def test_urls_and_archives(spark):
    shape = "page_id long, url string, html string, host long, score string"
    rows = [(1, None, None, 1, "x"), (2, "no scheme", "", 1, "x"), (3, "http://a.example.com/en/1", "é" * 90, 1, "x"),
            (4, "HTTP://B.example.net/fr/é?x=1#y", "é" * 90, 1, "x"), (4, "http://b", "é" * 90, None, None), (None, "x://", "short", 2, None)]
    pages = spark.createDataFrame(rows, shape)
    got = {(r.page_id, r.host): r for r in urls.judge(pages).collect()}
    assert len(got) == 6 and got[3, "a.example.com"].rule == "example.com/en/" and got[4, "b.example.net"].verdict == "block"
    back = warc.round_trip(pages).collect()
    assert sorted(str((r.page_id, r.record_type, r.refers_to, r.error)) for r in back) == sorted(map(str, [
        (1, "response", None, None), (2, "response", None, None), (3, "response", None, None), (4, "revisit", 3, None),
        (4, "revisit", 3, None), (None, "response", None, None)]))
    empty = spark.createDataFrame([], shape)
    assert urls.judge(empty).collect() == [] and warc.round_trip(empty).collect() == []
