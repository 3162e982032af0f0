"""The operators against plain versions of the same definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parley.llm import bpe, fingerprints, jaccard, licenses, lm, packing, quality, substrings, urls, warc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact copies, edited copies from light to heavy, shared passages and short texts."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(900)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, rows = text(70), []
    for n in (3, 6, 12, 40, 80, 160):
        base = text(n)
        rows += [list(base), list(base)]
        for share in (0.01, 0.03, 0.05, 0.08):
            rows += [[w if r.random() > share else r.choice(vocabulary) for w in base] for _ in range(6)]
    rows += [text(60) + passage + text(r.randrange(10, 60)) for _ in range(8)]
    rows += [text(r.randrange(1, 90)) for _ in range(30)]
    r.shuffle(rows)
    return [(i * 3, " ".join(w)) for i, w in enumerate(rows)]


def true_components(corpus):
    sets = {}
    for d, t in corpus:
        w = words(t)
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return sets, {d: top(d) for d in sets}


@pytest.mark.parametrize("block", [1024, 4])
def test_jaccard_components(docs, corpus, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    sets, expected = true_components(corpus)
    got = {r.doc_id: r for r in jaccard.link_components(docs(corpus)).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(sets[d]), expected[d]) for d in sets}
    kept = {r.doc_id for r in jaccard.keep_one(docs(corpus)).collect()}
    assert kept == set(expected.values())


@pytest.mark.parametrize("block", [1024, 4])
def test_links_are_counted_whole(docs, corpus, monkeypatch, block):
    for name, value in (("BLOCK", block), ("COLUMNS", 7 * block)):
        monkeypatch.setattr(jaccard, name, value)
    base = [f"b{i}" for i in range(200)]
    rows = [*corpus, *((10_000 + i, " ".join([*base[: 100 + i], "edit", *base[101 + i:]])) for i in range(30)), (10_000, " ".join(base))]
    sets = [(d, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset({tuple(w)})) for d, w in ((d, words(t)) for d, t in rows)]
    expected = Counter((d, sum(100 * len(s & z) >= 75 * len(s | z) for k, (_, z) in enumerate(sets) if k != j)) for j, (d, s) in enumerate(sets))
    got = jaccard.link_components(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == expected and max(n for _, n in expected) >= 30


def test_pairs_of_small_sets_find_what_single_shingles_find():
    for size in range(2, 60):
        assert jaccard.least_need(size) >= 2  # else pairs would miss a link
        for other in range(size, 80):
            if 4 * size >= 3 * other:
                assert jaccard.need(size, other) >= max(jaccard.least_need(size), jaccard.least_need(other))


def test_long_runs_and_near_paragraphs(docs, corpus):
    rows = [r for r in substrings.find_repeats(docs(corpus)).collect()]
    seen = defaultdict(set)
    split = {d: words(t) for d, t in corpus}
    run = substrings.WINDOW + 1
    for d, w in split.items():
        for i in range(len(w) - run + 1):
            seen[tuple(w[i:i + run])].add(d)
    expected = set()
    for d, w in split.items():
        for i in range(len(w) - run + 1):
            if min(seen[tuple(w[i:i + run])]) != d:
                expected |= {(d, k) for k in range(i, i + run)}
    got = {(r.doc_id, k) for r in rows if r.kind == "run" and not r.kept for k in range(r.start_word, r.start_word + r.n_words)}
    assert expected <= got and len(got - expected) <= 0.02 * len(got)
    near = [r for r in rows if r.kind == "paragraph"]
    assert near and all(len({r.kept for r in near if r.component == c}) == 2 for c in {r.component for r in near})
    left = substrings.remove_repeats(docs(corpus)).collect()
    assert all(r.n_chars == len(r.text) for r in left)
    again = Counter(k for r in left for k in {tuple(words(r.text)[i:i + run]) for i in range(len(words(r.text)) - run + 1)})
    assert not [k for k, n in again.items() if n > 1]
    clean = {d for d, t in corpus} - {r.doc_id for r in rows}
    texts = dict(corpus)
    assert all(r.text == texts[r.doc_id] for r in left if r.doc_id in clean)


def test_short_and_wrapped_paragraphs_are_signed(docs):
    r = random.Random(8)
    text = lambda n, k: [f"{k}{r.randrange(10**6)}" for _ in range(n)]
    wrap = lambda w, n: "\n".join(" ".join(w[i: i + n]) for i in range(0, len(w), n))
    short, line, long = text(30, "s"), text(6, "l"), text(160, "w")
    near = short[:28] + ["edited"] + short[29:] + text(2, "t")
    edited = [f"edited{i}" if i % 45 == 40 else w for i, w in enumerate(long)]
    rows = [(1, " ".join(short)), (2, " ".join(near)), (3, wrap(long, 9)), (4, wrap(edited, 13)), (5, " ".join(long)),
            (6, "alone here\n" + " ".join(line)), (7, " ".join(line) + "\nother words"), (8, "one two three four\none two three four")]
    got = {(x.doc_id, x.kept) for x in substrings.find_repeats(docs(rows).coalesce(1)).collect() if x.kind == "paragraph"}
    assert {(1, True), (2, False), (3, True), (4, False), (6, True), (7, False)} <= got
    assert 8 not in {d for d, _ in got}  # repeats itself only
    left = {x.doc_id: x.text for x in substrings.remove_repeats(docs(rows).coalesce(1)).collect()}
    assert set(left) == {1, 3, 6, 7, 8} and left[7].strip() == "other words"


def test_copies_of_a_passage_share_a_class(docs):
    r = random.Random(9)
    text = lambda n: [f"p{r.randrange(10**6)}" for _ in range(n)]
    one, two = text(150), text(80)
    parts = [text(5) + one + text(70) + two, one[:70] + text(60), text(20) + one[60:], text(9) + one[90:145] + text(30), two + text(20)]
    rows = substrings.find_repeats(docs([(i, " ".join(w)) for i, w in enumerate(parts)]).coalesce(1)).collect()
    runs = [x for x in rows if x.kind == "run"]
    at = lambda d: {x.component for x in runs if x.doc_id == d}
    assert len(at(0)) == 2 and all(len(at(d)) == 1 for d in (1, 2, 3, 4)) and None not in at(0)
    assert at(1) == at(2) == at(3) != at(4) and at(1) | at(4) == at(0)
    assert all({x.kept for x in runs if x.component == c} == {True, False} for c in at(0))


def test_lm_counts_weights_and_base(docs, corpus):
    got = {r.doc_id: r for r in lm.score(docs(corpus)).collect()}
    fold = lambda d: zlib.crc32(str(d).encode()) % 10
    tokens = {d: words(t) + [None] for d, t in corpus}
    c = Counter(w for d, ws in tokens.items() if fold(d) for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(d) == 0, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in ws))
        assert r.score < 0


def test_lm_predicts_held_out_text_better_than_the_base(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_em_finds_the_weights_of_a_mixture():
    import pandas as pd

    cells = pd.DataFrame({"bucket": 3, "f2": [-8, 1, -16], "f1": [-40, -24, -48], "n": [400, 500, 100]})
    a2, a1, a0 = lm.learn_weights(cells, 2.0 ** -20)[3]
    assert a2 + a1 + a0 == pytest.approx(1) and a2 > 0.3 and a1 > 0.3 and a0 < 0.01


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 9_000), max_size=60))
def test_packing_is_whole_gapless_and_tight(lengths):
    p = packing.Packer(0)
    ids = {i: np.arange(n, dtype="<u4").tobytes() for i, n in enumerate(lengths)}
    for i, x in ids.items():
        p.add(i, x)
    p.finish()
    out = p.take()
    for i, x in ids.items():
        mine = out[out.doc_id == i].sort_values("start")
        assert mine.length.sum() * 4 == len(x) and list(mine.start) == list(np.cumsum([0, *mine.length])[:-1])[: len(mine)]
        assert all(zlib.crc32(x[4 * s: 4 * (s + n)]) == c for s, n, c in zip(mine.start, mine.length, mine.ids_crc32))
    padding = 0
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == list(np.cumsum([0, *s.length])[:-1]) and s.length.sum() <= packing.CAPACITY
        n = int(s.length.sum())
        padding += 0 if n & (n - 1) == 0 else packing.CAPACITY - n
    assert padding <= packing.TOLERANCE * packing.CAPACITY * max(1, out.sequence_id.nunique())


ALPHABET = "ab cA.,\n\t́é ΣΑσ 　'sl12<|>_!İK日本🙂"


def test_word_ids_equal_the_tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(2)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(70))) for _ in range(3000)] + ["x<|endoftext|>y.", "Ünder. Ähre,", "..a,.b"]
    got = list(packing.document_ids(texts, packing.WordIds(t)))
    assert got == [np.array([*e.ids, 2], "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_equals_the_reference_encoder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.read_ranks(path)
    table = bpe.PerfectHash(tokens)
    assert all(table.get(t) == i for i, t in enumerate(tokens)) and table.get(b"no such token here") is None
    assert sorted(table.slots) == list(range(len(tokens)))  # minimal: every slot is used once
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    r = random.Random(3)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(90))) for _ in range(2000)] + ["a" * 3000, "日本" * 900]
    got = bpe.encode(texts, bpe.Encoder(table), regex.compile(public_tokenizers.PATTERN))
    assert got == [plain.encode_ordinary(t) for t in texts]
    assert [bpe.decode(i, tokens).decode() for i in got] == texts


def test_fingerprints(docs, corpus):
    got = {r.doc_id: r for r in fingerprints.fingerprint_pairs(docs(corpus)).collect()}
    rows = sorted(corpus, reverse=True)
    for i, (d, t) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = defaultdict(set)
    for d, t in corpus:
        by_text[t].add(got[d].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    # some neighbours are copies of each other, so the next document may be near too
    assert sum(r.near_edited for r in got.values()) > 2 * sum(r.near_next for r in got.values())


def test_order_changes_the_fingerprint_and_repeats_count(spark):
    a = " ".join(f"a{i}" for i in range(400))
    b = " ".join(f"a{i}" for i in [*range(200, 400), *range(200)])  # the same runs but two, halves swapped
    rows = spark.createDataFrame([(a,), (b,), (a + " " + a,)], "t string")
    got = [r.f for r in fingerprints.with_fingerprint(rows, "t", "f").collect()]
    like = lambda x, y: len(set(x.split(".")) & set(y.split("."))) / 64
    assert like(got[0], got[1]) < 0.85 and got[0] != got[2]


def test_rules_of_urls(spark):
    cases = {
        "http://a.com/": ("a.com", "/", "com/", "allow"), "http://a.com": ("a.com", "", None, None),
        "https://X.example.com/en/1?q#f": ("x.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://b.net/es/x": ("b.net", "/es/x", "net/es/", "block"),
        "x": ("", "", None, None), "http://u#/en/": ("u", "", None, None), "a://b://c/d": ("b:", "//c/d", None, None),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict is None or got[i].verdict == verdict


def test_trees_learn_what_the_labels_show(spark):
    from parley.llm.registry import QUERIES

    rows = QUERIES["op6_url_filters"](spark, "/root/testdata/sf0.01").collect()
    known = [(r.score > 0.5) == (r.verdict == "block") for r in rows if r.rule]
    assert sum(known) > 0.9 * len(known)


def test_license_filters_lose_nothing(docs):
    r = random.Random(4)
    fill = [f"q{i}" for i in range(50)]
    rows = []
    for i in range(120):
        label, text = r.choice(licenses.TEMPLATES)
        kept = [w for w in text.split() if r.random() > r.choice([0, 0.1, 0.3])]
        rows.append((i, " ".join([r.choice(fill) for _ in range(r.randrange(60))] + kept + [r.choice(fill) for _ in range(r.randrange(60))])))
    got = {x.doc_id: x for x in licenses.scan(docs(rows), marks=()).collect()}
    half = licenses.BLOCK // 2
    for d, t in rows:
        w, best = t.split(), {}
        for s in range(0, max(len(w) - half, 1), half):
            block = set(w[s: s + licenses.BLOCK])
            for label, text in licenses.TEMPLATES:
                tokens = set(text.split())
                if len(block & tokens) >= math.ceil(licenses.THRESHOLD * len(tokens)):
                    best[label] = max(best.get(label, 0), len(block & tokens) / len(tokens))
        base = {k for k, p in licenses.PHRASES if f" {p} " in f" {t} "}
        assert got[d].labels == ",".join(sorted(set(best) | base)) and got[d].base_labels == ",".join(sorted(base))


def test_each_notice_is_its_own_license_only(docs):
    rows = list(enumerate(text for _, text in licenses.TEMPLATES))
    rows += [(100, "released under the old license"), (101, "see the license under which it is released"), (102, "licensed under cc by nd 4 0")]
    got = {x.doc_id: x.labels for x in licenses.scan(docs(rows)).collect()}
    expected = {i: label for i, (label, _) in enumerate(licenses.TEMPLATES)} | {100: "", 101: "", 102: ""}
    assert got == expected
    assert all(set(m) <= set(t.split()) for (_, t), m in zip(licenses.TEMPLATES, licenses.MARKS, strict=True))


def test_archive_faults_are_rows(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{'text ' * 40}{i}</p>") for i in range(300)], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "a")
    warc.write_archives(pages, path)
    (file,) = [p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-")]
    data = file.read_bytes()
    assert data[:4] == warc.MAGIC.to_bytes(4, "little")  # the dictionary comes first
    dictionary, frames = warc._split_frames(data)
    assert dictionary and len(frames) == 300
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    record = unzip.decompress(frames[5][1])
    assert warc.parse_record(record)["record_type"] == "response"
    for bad in (record[:-1], record.replace(b"WARC/1.1", b"HTTP/1.1", 1), record.replace(b"text", b"tent", 1), record + b"x"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    at = frames[7][0] + len(frames[7][1]) - 6  # the frame's checksum no longer fits
    spoilt = tmp_path / "b"
    spoilt.mkdir()
    (spoilt / "part-0").write_bytes(data[:at] + bytes([data[at] ^ 255]) + data[at + 1:])
    rows = warc.read_archives(spark, str(spoilt)).collect()
    assert len(rows) == 300 and sum(r.error is not None for r in rows) == 1
    (spoilt / "part-0").write_bytes(data[:-20])
    assert [bool(r.error) for r in warc.read_archives(spark, str(spoilt)).collect()] == [True]


def test_sketches_merge_and_stay_close(spark):
    values = [int(random.Random(i).expovariate(0.01)) for i in range(4000)]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b")).collect()
    assert all(r.b <= r.v < max(r.b + 1, r.b * (1 + 1 / 32) + 1) for r in rows)


def test_fences_follow_their_group(spark):
    """What is far is decided by the group: two groups have fences of their own, repeated lines are rejected where
    they are rare and kept where they are usual."""
    r = random.Random(5)

    def text(letters, repeated=0):
        word = lambda: "".join(r.choices("abcdefgh", k=max(1, round(r.gauss(letters, 1)))))
        lines = [" ".join(word() for _ in range(28)) for _ in range(4)]
        return "\n".join(lines + [" ".join(word() for _ in range(4))] * (repeated + 1 if repeated else 0))

    rows = [(i, text(4), "en", "plain", "x") for i in range(260)] + [(1000 + i, text(9), "en", "long", "x") for i in range(260)]
    rows += [(2000 + i, text(4, 5), "en", "plain", "x") for i in range(10)] + [(3000 + i, text(4, 5), "en", "twice", "x") for i in range(260)]
    rows += [(4000 + i, text(9), "en", "plain", "x") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    stats = quality.with_stats(df.select("doc_id", "lang", "source", "text")).drop("text").persist()
    limits = {x.source: x for x in quality.fences(quality.sketches(stats)).collect()}
    assert limits["plain"].word_length_high < limits["long"].word_length_low < limits["long"].word_length_high
    assert limits["plain"].dup_line_share_high < 500 < limits["twice"].dup_line_share_high
    kept = {x.doc_id for x in quality.judge(df).collect() if x.kept}
    assert not kept & {2000 + i for i in range(10)} and not kept & {4000 + i for i in range(5)}
    for first in (0, 1000, 3000):
        assert len(kept & {first + i for i in range(260)}) >= 255
    assert {x.doc_id for x in quality.keep_good(df).collect()} == kept


def test_a_rare_label_stays_in_the_sample(spark):
    """Two blocked urls among thousands are fitted on, whatever their hash."""
    rows = [(i, f"http://site{i % 97}.com/a/{i}") for i in range(3000)] + [(9001, "http://x.example.com/en/1"), (9002, "http://y.example.com/en/2")]
    rows += [(9100 + i, f"http://other{i}.org/zz") for i in range(5)] + [(9200, "http://z.example.com/en/9")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, fit_rows=200, trees=5).collect()}
    assert len(got) == len(rows) and all(got[i].verdict == "block" for i in (9001, 9002, 9200))
    assert len({round(r.score, 6) for r in got.values()}) > 1  # trees, and no constant
    assert all(got[9100 + i].verdict == "allow" for i in range(5))


def test_pipeline_equals_its_stages_by_hand(spark):
    """run() against plain versions of its decisions."""
    packed = corpus_pipeline.run(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    _, component = true_components(texts)
    alone = {d for d in component if component[d] == d}
    assert {r.doc_id for r in packed} <= alone
    assert len({r.doc_id for r in packed}) >= 0.97 * len(alone)  # only texts without a word of their own go
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in packed)
