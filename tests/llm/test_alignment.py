"""op13 against a plain version that tokenizes whole texts and pairs tokens one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from parley.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", "ing", "hello", "World", " ", " ", "\n", "\t", " ", "é", "Straße", "日本", "🙂", "▁", "'s", "don't", "123", "...", ",", ".", ". ",
         "--", "\x00", "\x01", "\x1c", "é", "<s>", "<|endoftext|>", "</s>", "\r\n", "  ", "​", "﻿", "　", "aaaaaaaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def units():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return alignment.Units(f.read(), g.read())


def plain(units, texts):
    """{row: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)}"""
    docs, held = [], Counter()
    for t in texts:
        a = units.a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = units.b.encode(t) if t else []
        raw = (" " + (t or "")).encode()
        if not t or b"".join(units.a_bytes[i] for i in a) != raw or b"".join(units.b_bytes[i] for i in b) != raw:
            docs.append(None)
            continue
        ends = []
        for ids, names in ((a, units.a_bytes), (b, units.b_bytes)):
            at, out = 0, []
            for i in ids:
                at += len(names[i])
                out.append(at)
            ends.append(out)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = {e: ([], []) for e in both}
        for side, ids in enumerate((a, b)):
            for i, e in zip(ids, ends[side]):
                groups[next(x for x in both if x >= e)][side].append(i)
        pairs = Counter((x, y) for e in both for x in groups[e][0] for y in groups[e][1])
        held.update(pairs.keys())
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups.values())
        docs.append((len(a), len(b), len(both), pairs, hashlib.sha256(said.encode()).hexdigest()))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], d[3].total(), sum(m for (x, y), m in d[3].items() if held[x, y] == most[x]), sum(m * held[p] for p, m in d[3].items()), d[4])
            for d in docs]


def rows_of(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_units_give_whole_texts_ids(units):
    assert units.cut and units.marks
    draw = random.Random(3)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(1, 25))) for _ in range(3000)]
    for t, (a, b) in zip(texts, units.of(texts)):
        raw, ids_a, ids_b = (" " + t).encode(), units.a.encode(" " + t, add_special_tokens=False).ids, units.b.encode(t)
        if b"".join(units.a_bytes[i] for i in ids_a) != raw or b"".join(units.b_bytes[i] for i in ids_b) != raw:
            ids_a = ids_b = []
        assert [int.from_bytes(a[i:i + 4], "little") for i in range(0, len(a), 4)] == ids_a
        assert [int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)] == ids_b


def test_alignment_against_plain_version(docs, units, monkeypatch):
    monkeypatch.setattr(alignment, "RANGE_BYTES", 1000)
    draw = random.Random(4)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 30))) for _ in range(300)] + [
        None, "", " ", "one two", "one two", "x" * 5000, "▁", "🙂" * 300, "日本語の文章" * 100, "w " * 2000]
    got = rows_of(alignment.align(docs(list(enumerate(texts)), extra=True).repartition(3), A, B))
    assert [got[i] for i in range(len(texts))] == plain(units, texts)


def test_groups_of_many_tokens(units, monkeypatch):
    """Large groups are paired by distinct ids, with the same result."""
    texts = ["🙂🙃😀" * 20, "naïve café, übergrößenträger. " * 10, "don't stop the 123456 www.example.com/en?x=1"]
    ids = alignment._pairs(units.of(texts))
    aligner = alignment.Aligner(units.a_bytes, units.b_bytes)
    want = aligner.align(*ids)
    monkeypatch.setattr(alignment, "MANY_LINKS", 2)
    got = aligner.align(*ids)
    for c in ("pair", "doc", "links", "n_links"):
        assert got[c].tolist() == want[c].tolist()


def test_given_documents(spark, docs, units):
    """The registered query's path over a whole table, repeated rows included."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = rows_of(alignment.align(docs(rows), A, B))
    assert [got[i] for i, _ in rows] == plain(units, [t for _, t in rows])


def test_no_rows_and_odd_ids(docs, units):
    assert alignment.align(docs([]), A, B).collect() == []
    assert alignment.align(docs([(1, None), (2, "")]), A, B).select("n_a", "groups_sha256").collect() == [(0, ""), (0, "")]
    got = alignment.align(docs([(None, "same text"), (5, "same text"), (5, "same text")]), A, B).collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "5", "None"] and len({r[1:] for r in got}) == 1
    assert got[0].count_sum == 3 * got[0].n_links
