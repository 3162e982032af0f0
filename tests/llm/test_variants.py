"""op12 against a plain version that compares every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from parley.llm import variants


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """Edit distance of one, by trying every edit."""
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def corpus(seed, documents, syllables):
    """Words of a few syllables, so that many are anagrams, with typing errors and very unequal counts."""
    draw, rows = random.Random(seed), []
    stock = ["".join(draw.choices(syllables, k=draw.randint(3, 4))) for _ in range(60)]
    for i in range(documents):
        words = []
        for _ in range(60):
            w = stock[min(int(draw.expovariate(0.12)), 59)]
            if draw.random() < 0.08:
                k = draw.randrange(len(w))
                w = w[:k] + draw.choice(["", draw.choice("aeéÿ×") + w[k], draw.choice("aebÀ")]) + w[k + 1:]
            words.append(draw.choice([w, w.capitalize(), w]))
        rows.append((i, draw.choice([" ", ", ", "日", "_"]).join(words)))
    return rows


@pytest.mark.parametrize("branch", [20_000, 25])
def test_variants_against_plain_version(docs, monkeypatch, branch):
    monkeypatch.setattr(variants, "BRANCH", branch)
    monkeypatch.setattr(variants, "PIECE", 64)
    monkeypatch.setattr(variants, "FLUSH", 100)
    rows = corpus(8, 300, ["tion", "ent", "ité", "ver", "ung", "an", "na"])
    got = [tuple(r) for r in variants.group_variants(docs(rows, extra=True).repartition(4)).collect()]
    assert set(got) == plain(rows) and len(got) == len(set(got))
    assert any(r[1] for r in got)


def test_chains_and_ties(docs):
    rows = [(i, "aaaaaaab " * 3) for i in range(50)] + [(100 + i, "aaaaaaac " * 3) for i in range(50)]
    rows += [(300 + i, "bcbcbcbc " * 12) for i in range(60)] + [(400, "bcbcbcbd " * 30), (401, "bcbcbcdd bcbcbcdd")]  # d, then b, then the root
    rows += [(200, "aaaaaaaa " * 10), (200, "aaaaaaaa"), (201, "aaaaaaaad aaaaaaaad")]
    got = [tuple(r) for r in variants.group_variants(docs(rows)).collect()]
    assert set(got) == plain(rows) and any(r[1] and r[2] != r[1] for r in got)


def test_long_words_and_odd_rows(docs):
    long = "".join(random.Random(9).choices("abcdefgh", k=5000))
    rows = [(1, long), (2, long), (3, long[:70] + long[71:]), (4, long[:70] + long[71:]), (5, long[:60]), (6, long[:60]), (7, long[:59] + "x"), (8, long[:59] + "x"),
            (9, None), (10, ""), (11, "日本語 123"), (None, "without number " * 5), (None, None), (12, "Straße straße STRASSE" * 3), (12, "Straße straße STRASSE" * 3),
            (13, "×÷×÷×÷× ×÷×÷×÷×"), (14, "repeated " * 20_000), (15, "repeatet repeatet")]
    got = [tuple(r) for r in variants.group_variants(docs(rows, extra=True)).collect()]
    assert set(got) == plain(rows) and len(got) == len(set(got))
    assert variants.group_variants(docs([])).collect() == []
    assert variants.group_variants(docs([(1, "short"), (2, None)])).collect() == []


def test_given_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(variants, "BRANCH", 300)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert {tuple(r) for r in variants.group_variants(docs(rows)).collect()} == plain(rows)
