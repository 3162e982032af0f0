"""Memory of workers: what one task holds, and what stays in a worker process."""

import sys
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers

from parley.llm import chunks, jaccard, packing, substrings


def test_texts_are_cut_once(spark, docs):
    """One call per row, and so one worker per task, although what is left is filtered, counted and returned."""
    passage = " ".join(f"w{i}" for i in range(90))
    one, two = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    left = substrings.remove_repeats(docs([(0, passage), (1, f"{one} {passage} {two}"), (2, passage), (3, None)]).coalesce(1))
    assert left._jdf.queryExecution().executedPlan().toString().count("+- ArrowEvalPython") == 1
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()} == {0: (passage, len(passage)), 1: (f"{one} {two}", len(one) + len(two) + 1), 3: (None, None)}


def test_a_hub_group_of_many_shingles_stays_small():
    """Sets that share 100,000 shingles, two by two, and one pair that links."""
    draw = np.random.default_rng(5)
    n, size = 400, 500
    every = draw.choice(1 << 40, n * size // 2, replace=False)
    sets = list(draw.permutation(np.repeat(every, 2)).reshape(n, size))
    sets[7] = np.concatenate((sets[3][:450], draw.choice(1 << 40, 50) + (1 << 41)))
    sets = [np.unique(s) for s in sets]
    # all are far from the hub; a set is in its block and in the block it meets
    group = pd.DataFrame([(i, False, far, s) for far in (False, True) for i, s in enumerate(sets)], columns=["node", "near", "far", "shingles"])
    tracemalloc.start()
    got = jaccard._compare(75)((0, 0, 0), group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = set()
    for i in range(n):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True)) if j == 3 or i == 3 else 0
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                want.add((j, i))
    assert want == {(3, 7)} == {(min(x), max(x)) for x in got.itertuples(index=False)}
    assert peak < 150e6, peak


def test_other_operators_drop_what_packing_keeps():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        model = f.read()
    known = packing.worker_words(model)
    chunks.release_memory(packing.NAME)
    assert packing.worker_words(model) is known
    chunks.release_memory()
    assert not packing._WORKER and packing.worker_words(model) is not known


def _texts(n_bytes: int) -> list[str]:
    """Some MB of documents of short and long lines."""
    draw = np.random.default_rng(6)
    vocabulary = [f"word{i}" for i in range(5000)]
    out, size = [], 0
    while size < n_bytes:
        words = [vocabulary[i] for i in draw.integers(0, 5000, 400)]
        out.append("\n".join(" ".join(words[i: i + k]) for i, k in ((0, 60), (60, 8), (68, 30), (98, 302))))
        size += len(out[-1])
    return out


def test_words_of_a_chunk_are_hashed_in_portions(monkeypatch):
    texts = _texts(substrings.CHUNK_BYTES)
    tracemalloc.start()
    chunk = substrings._Chunk(texts, 49)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert chunk.words.tolist() == [400] * len(texts)
    assert peak < 100e6, peak
    # portions end between words, wherever they are cut, and a word may be longer than one
    odd = ["", " \n", "x" * 3000 + " a\tb", "\u00e9 " * 50, "B\n\nc", *texts[:3]]
    got = []
    for size in (1, 7, 1 << 30):
        monkeypatch.setattr(substrings, "PORTION_BYTES", size)
        got.append(substrings._hashed(odd))
    for x in got[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(got[0], x))


def test_found_bands_are_columns_not_rows_of_objects(monkeypatch):
    """All keys shared: every band of every different paragraph comes once, with its paragraph's facts."""
    texts = _texts(1_000_000)
    bits, ranges = 49, 3
    monkeypatch.setattr(substrings, "block_of", lambda chunk: chunk)
    docs = pd.DataFrame({"doc_id": pd.array([None, *range(1, len(texts))], "Int64"), "place": range(len(texts)), "text": texts})
    asked = pd.concat(substrings._requests(ranges, bits)(iter([docs[["doc_id", "text"]]])))
    answers = asked.assign(code=[chunks.pack(np.full(n, int(kind == "b"), np.uint64)) for n, kind in zip(asked["n"], asked["kind"])])
    tracemalloc.start()
    got = substrings._found(bits, ranges)((0,), docs, answers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    bands, units = got[got["kind"] == "band"], got[got["kind"] == "paragraph"].drop_duplicates("node").set_index("node")
    chunk = substrings._Chunk(texts, bits)
    want = {(int(units.index[p]), int(k)) for p, k in zip(chunk.key_of, chunk.band_keys.view(np.int64))}
    assert len(units) == len(chunk.p_doc) and len(bands) == len(want)
    assert {(int(a), int(b)) for a, b in zip(bands["node"], bands["sig"])} == want
    first = bands.iloc[0]
    mine = units.loc[first["node"], "shingles"].view(np.uint64)
    assert first["words"] == len(mine) and [first[b] for b in substrings.BITMAPS] == substrings._bitmaps(mine)
    assert bands[["doc_id", "place", "shingles", "kept", "keys", "names", "name_of"]].isna().all(axis=None)
    assert peak < 45e6, peak


def test_arrow_batches_of_texts_are_small(spark, docs):
    """The texts of a task come in batches of some MB, and a limit of the session's own stays."""
    name, text = "spark.sql.execution.arrow.maxBytesPerBatch", "x" * 100_000
    before = spark.conf.get(name)
    big = docs([(0, "")]).selectExpr("explode(sequence(1, 120)) as doc_id", f"repeat('{text[:100]}', 1000) as text").coalesce(1)

    def most():
        sizes = big.mapInPandas(lambda batches: (pd.DataFrame({"n": [b["text"].str.len().sum()]}) for b in batches), "n long")
        return max(r.n for r in sizes.collect())

    try:
        spark.conf.unset(name)
        for operator in (jaccard.link_components, substrings.find_repeats, lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json"))):
            spark.conf.unset(name)
            operator(docs([(0, "a b c d e f")]))
            assert most() < 2 * chunks.BATCH_BYTES
        spark.conf.set(name, "20m")
        packing.pack(docs([(0, "a")]), public_tokenizers.path("word_bpe_49k.json"))
        assert most() == 12_000_000
    finally:
        spark.conf.set(name, before)


def test_words_of_the_older_generation_are_not_tokenised_again(monkeypatch):
    """A full memory becomes the older generation, and what comes again from there costs the tokenizer nothing."""
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, inner):
            self.inner, self.seen = inner, []

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **more):
            self.seen += [w for t in texts for w in t.split()]
            return self.inner.encode_batch_fast(texts, **more)

    monkeypatch.setattr(packing, "MEMO_SIZE", 40)
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counting = Counting(plain)
    known = packing.WordIds(counting)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyz"]  # 48: more than a generation
    texts = [" ".join(words[:30]), " ".join(words[30:]), " ".join(words[:30]), "b12 " + "long" * 30, "b12 " + "long" * 30]
    got = [ids for t in texts for ids in known.of([t])]
    assert got == [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert len(counting.seen) == len(words) + 3, counting.seen  # the long word alone is not kept


def test_rows_found_are_made_without_a_call_for_each(monkeypatch):
    """A null beside the columns of the bands costs no call of its own."""
    texts = _texts(1_000_000)
    bits, ranges = 49, 3
    monkeypatch.setattr(substrings, "block_of", lambda chunk: chunk)
    docs = pd.DataFrame({"doc_id": pd.array(range(len(texts)), "Int64"), "place": range(len(texts)), "text": texts})
    asked = pd.concat(substrings._requests(ranges, bits)(iter([docs[["doc_id", "text"]]])))
    answers = asked.assign(code=[chunks.pack(np.full(n, int(kind == "b"), np.uint64)) for n, kind in zip(asked["n"], asked["kind"])])
    monkeypatch.setattr(substrings, "release_memory", lambda *own: None)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call" and "pandas" in frame.f_code.co_filename

    sys.setprofile(count)
    try:
        got = substrings._found(bits, ranges)((0,), docs, answers)
    finally:
        sys.setprofile(None)
    assert len(got) > 20_000 and calls < len(got), (calls, len(got))


def test_links_of_near_copies_are_not_held_together():
    """A block of far members that all link: a tree of them, without a million links in memory."""
    n = jaccard.BLOCK
    sets = [np.append(np.arange(40), 100 + i).astype(np.int64) for i in range(n)]
    group = pd.DataFrame([(i, False, far, s) for far in (False, True) for i, s in enumerate(sets)], columns=["node", "near", "far", "shingles"])
    tracemalloc.start()
    got = jaccard._compare(75)((0, 0, 0), group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == n - 1 and set(got["a"]) | set(got["b"]) == set(range(n))
    assert peak < 100e6, peak
