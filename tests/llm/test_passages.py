"""Substring dedup: units against a plain version, near paragraphs against brute force, and rows of any plan."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from parley.llm import jaccard, substrings


def plain_paragraphs(text):
    """(first word, words) of a text's paragraphs, line by line."""
    found, at, short = [], 0, []
    for line in [*text.split("\n"), ""]:
        words = line.split()
        if not 0 < len(words) < substrings.PARAGRAPH_WORDS:
            if len(short) > 1 and sum(short) >= 5:
                found.append((at - sum(short), sum(short)))
            short = []
        if words:
            if len(words) >= 5:
                found.append((at, len(words)))
            at += len(words)
            if len(words) < substrings.PARAGRAPH_WORDS:
                short.append(len(words))
    return found


def shingle_set(words):
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


def test_units_equal_a_plain_version():
    draw = random.Random(2)
    texts = ["\n".join(" ".join(draw.choices("abc", k=draw.choice([0, 1, 4, 5, 6, 9, 30, 39, 40, 60]))) for _ in range(draw.randint(0, 12)))
             for _ in range(60)] + ["", "\n\n", "one", "a a a a a a a a\nb b b b b"]
    c = substrings._Chunk(texts, 64)
    got, sets = defaultdict(list), {}
    for p, (i, start, words) in enumerate(zip(c.p_doc.tolist(), c.p_start.tolist(), c.p_words.tolist())):
        got[i].append((start - int(c.begin[i]), words))
        sets[i, start - int(c.begin[i]), words] = frozenset(c.values[c.p_at[p]: c.p_at[p + 1]].tolist())
    keys = defaultdict(set)
    for p, k in zip(c.key_of.tolist(), c.band_keys.tolist()):
        keys[p].add(k)
    by_set = defaultdict(set)
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(plain_paragraphs(t))
        words = t.split()
        assert int(c.words[i]) == len(words) and int((c.run_doc == i).sum()) == max(0, len(words) - substrings.WINDOW + 1)
        for start, n in got[i]:
            want = shingle_set(words[start: start + n])
            assert len(sets[i, start, n]) == len(want)
            by_set[frozenset(want)].add(sets[i, start, n])
    assert all(len(hashes) == 1 for hashes in by_set.values())
    # equal sets have equal keys, and one or two shingles have one key, however often they come
    same = defaultdict(set)
    for p, (i, start, n) in enumerate(zip(c.p_doc.tolist(), c.p_start.tolist(), c.p_words.tolist())):
        s = sets[i, start - int(c.begin[i]), n]
        same[s].add(frozenset(keys[p]))
        assert len(keys[p]) == (1 if len(s) < 3 else substrings.BANDS)
    assert all(len(k) == 1 for k in same.values())


def test_words_have_hashes_of_their_own():
    draw = random.Random(7)
    texts = ["".join(draw.choices(["a", "b", "ab", "é", "\x00", " ", "\n", "\t\x0b", "\x1c", "z" * 40, "日"], k=draw.randint(0, 60))) for _ in range(400)]
    texts += ["x" * 5000 + "a", "x" * 5000 + "b", "ax" + "x" * 4999, "", "\n", "ABC abc"]
    hashes, words, doc = substrings._hashed(texts)
    want, lines = [], []
    for i, t in enumerate(texts):
        for line in t.encode().split(b"\n"):
            lines.append((i, len(line.split())))
            want += [w.lower() for w in line.split()]
    assert list(zip(doc.tolist(), words.tolist())) == lines and len(hashes) == len(want)
    assert len(set(zip(hashes.tolist(), want))) == len(set(hashes.tolist())) == len(set(want))


def brute_classes(rows):
    """{(place, start, words)} -> class, from exact Jaccard of every two paragraphs that share a shingle."""
    units, sets = [], []
    for place, (_, text) in enumerate(rows):
        words = (text or "").lower().split()
        for start, n in plain_paragraphs((text or "").lower()):
            units.append((place, start, n))
            sets.append(shingle_set(words[start: start + n]))
    inverted = defaultdict(list)
    for u, s in enumerate(sets):
        for x in s:
            inverted[x].append(u)
    links = []
    for u, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for v in inverted[x]:
                if v < u:
                    common[v] += 1
        links += [(v, u) for v, n in common.items() if 100 * n >= 75 * (len(s) + len(sets[v]) - n) and units[v][0] != units[u][0]]
    return units, links


def test_near_paragraphs_against_brute_force(spark, docs):
    """Of the pairs of near paragraphs in different documents that no exact passage covers, 0.99 and more share a class."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    found = substrings.find_repeats(docs(rows).coalesce(1)).collect()
    place = {p: k for k, p in enumerate(sorted({r.place for r in found} | set(range(len(rows)))))}
    assert set(place) == set(range(len(rows)))
    mine = {(r.place, r.start_word, r.n_words): r.component for r in found if r.kind == "paragraph"}
    gone = defaultdict(set)
    for r in found:
        if r.kind == "run" and not r.kept:
            gone[r.place] |= set(range(r.start_word, r.start_word + r.n_words))
    units, links = brute_classes(rows)
    covered = [gone[p].issuperset(range(s, s + n)) for p, s, n in units]
    pairs = [(units[a], units[b]) for a, b in links if not covered[a] and not covered[b]]
    caught = sum(mine.get(a) is not None and mine.get(a) == mine.get(b) for a, b in pairs)
    assert len(pairs) > 50 and caught >= 0.99 * len(pairs)
    # whatever is in a class links with something there
    linked = {u for a, b in links for u in (units[a], units[b])}
    assert set(mine) <= linked | {u for u in units if mine.get(u) in {mine.get(v) for v in linked}}
    heads = {}
    for r in found:
        if r.kind == "paragraph":
            heads[r.component] = min(heads.get(r.component, r.place), r.place)
    assert all(r.kept == (r.place == heads[r.component]) for r in found if r.kind == "paragraph")


def test_rows_of_any_plan_are_cut_where_they_repeat(spark):
    """After a shuffle, with a wide column and columns that carry the operator's own names."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("bcdfgaeiou", k=7))
    passage = " ".join(word() for _ in range(80))
    rows = [(i, (" ".join(word() for _ in range(30)) + " " + passage + " " + " ".join(word() for _ in range(20))) if i % 10 == 0
             else " ".join(word() for _ in range(130)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    for name in ("_place", "_at", "_cut", "_left", "_gone", "place", "node"):
        df = df.withColumn(name, F.lit(name))
    df = df.withColumn("wide", F.repeat(F.sha2(F.col("doc_id").cast("string"), 512), 200)).repartition(7, "doc_id")
    texts = {i: t for i, t, _ in rows}
    left = substrings.remove_repeats(df)
    assert left.columns == df.columns
    got = left.collect()
    assert len(got) == 400 and sum(passage in r.text for r in got) == 1
    for r in got:
        assert r.n_chars == len(r.text) and r._place == "_place" and r._cut == "_cut"
        if r.doc_id % 10:
            assert r.text == texts[r.doc_id]
        elif passage not in r.text:
            assert r.text.split() == texts[r.doc_id].split()[:30] + texts[r.doc_id].split()[110:]
    assert jaccard.keep_one(df).count() == 400


def test_copies_meet_across_tasks_beside_empty_texts(spark):
    """Names of sets and spans have 64 bits; a row without one in the same task must not round them."""
    draw = random.Random(6)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(70)) for _ in range(12)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(100, None, 0), (101, "", 0)] + [(200 + i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int")
    two = df.where("part = 0").coalesce(1).unionByName(df.where("part = 1").coalesce(1)).select("doc_id", "text")
    got = {r.doc_id: r.component_id for r in jaccard.link_components(two).collect()}
    assert all(got[200 + i] == got[i] == i for i in range(12))
    found = [r for r in substrings.find_repeats(two).collect() if r.kind == "run"]
    assert {(r.doc_id, r.kept) for r in found} == {(i, True) for i in range(12)} | {(200 + i, False) for i in range(12)}
    for i in range(12):
        assert len({r.component for r in found if r.doc_id in (i, 200 + i)}) == 1


def test_bitmaps_keep_every_link():
    """Sets that link differ in no more bits than the filter allows."""
    draw = np.random.default_rng(3)
    for _ in range(300):
        n = int(draw.integers(3, 200))
        a = draw.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate((a[int(draw.integers(0, 1 + n // 7)):], draw.integers(0, 1 << 63, int(draw.integers(0, 1 + n // 7)), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            mask = (1 << 64) - 1
            apart = sum(((x & mask) ^ (y & mask)).bit_count() for x, y in zip(substrings._bitmaps(a), substrings._bitmaps(b)))
            assert apart <= 25 * (len(a) + len(b)) // 175
