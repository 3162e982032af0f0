"""Language-model scoring by deleted interpolation.

P(w | h) = a2 c(h w) / c(h) + a1 c(w) / N + a0 / (V + 1); the weights depend on the bucket (powers of two)
of the context's count and are learnt by expectation-maximisation on held-out counts: of the training
documents, those with remainder 1 are held out, the others are counted; the scores then use the counts of
all training documents. Documents with remainder 0 teach nothing.

How it runs. A partition of documents is cut into chunks of some MB of text, in the order of its rows. A
chunk's distinct words and word pairs, as sorted 64-bit keys with its own counts, go by key range to a
reducer, as packed arrays: a key is sent once per chunk, however often it occurs, so no hot word is a hot
group. The reducer adds up and answers each chunk with the totals in the order of its keys; the chunk's
texts meet the answers, and everything is looked up in arrays. Nothing that grows with the corpus reaches
the driver: it gets the counts N and V, and a histogram of bounded size for the weights.

The table must give the same rows in the same order in each partition whenever it is read, as files do;
a chunk whose keys do not fit its answer stops the job rather than score wrongly.

Null text: an empty one, of the end token only. A null doc_id is a training document. Rows that repeat a
doc_id are scored and counted one by one. No rows: no rows.
"""

import math
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from parley.llm.chunks import block_of, chunk_rows, pack, range_ends, unpack
from parley.llm.common import written

FOLDS, TEST, HELD = 10, 0, 1
#: Characters of text per key range: it sets how much one reducer call holds.
RANGE_CHARS = 4_000_000
MEMO_SIZE = 400_000
ADD = 0.1
STEPS, FLOOR = 8, -40  # the histogram's steps per octave, and its least octave
ITERATIONS = 60
END = np.uint64(xxhash.xxh3_64_intdigest(b""))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def tokens(text: str, known: dict) -> np.ndarray:
    """Hashes of a text's words and of the end."""
    words = text.encode("utf-8").translate(_LOWER).split()
    out = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return np.append(out, END)


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = h * np.uint64(0x9E3779B97F4A7C15) + w * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def contexts(w: np.ndarray) -> np.ndarray:
    """What stands before each token; before the first, the end."""
    return np.concatenate((w[-1:], w[:-1]))


def fold_of(doc_id) -> int:
    return FOLDS - 1 if pd.isna(doc_id) else zlib.crc32(str(int(doc_id)).encode()) % FOLDS


def _requests(ranges: int):
    """For mapInPandas: each chunk's keys and counts by range."""

    def rows(block, held, docs):
        if not docs:
            return
        trains = np.concatenate([np.full(len(w), held or f != TEST) for f, w in docs])
        words = np.concatenate([w for _, w in docs])
        pairs = np.concatenate([pair_keys(contexts(w), w) for _, w in docs])
        for kind, all_keys in (("w", words), ("p", pairs)):
            keys, at = np.unique(all_keys, return_inverse=True)
            counts = np.bincount(at, weights=trains, minlength=len(keys)).astype(np.uint64)
            ends = range_ends(keys, ranges, 64)
            for i in range(ranges):
                a, b = ends[i], ends[i + 1]
                if b > a:
                    deltas = np.diff(keys[a:b], prepend=np.uint64(0))
                    yield i, block, kind, int(b - a), pack(deltas), pack(counts[a:b])

    names = ["r", "block", "kind", "n", "keys", "counts"]

    def run(batches):
        known, now, parts = _Words(), None, {True: [], False: []}
        for chunk, part in chunk_rows(batches):
            if now is not None and chunk != now:
                for held, docs in parts.items():
                    yield pd.DataFrame(list(rows(block_of(now) | int(held), held, docs)), columns=names)
                parts = {True: [], False: []}
            now = chunk
            for doc, text in zip(part["doc_id"], part["text"]):
                f = fold_of(doc)
                parts[f == HELD].append((f, tokens(text, known)))
        for held, docs in parts.items():
            if docs:
                yield pd.DataFrame(list(rows(block_of(now) | int(held), held, docs)), columns=names)

    return run


def _answer(key, group):
    """Totals of one key range and kind, for each chunk that asked; a row with block -1 has N and V."""
    r, kind = key
    keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in group["keys"]]
    counts = [unpack(c) for c in group["counts"]]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    both = np.concatenate(counts).astype(np.float64)
    held = np.repeat(group["block"].to_numpy() & 1 == 1, [len(k) for k in keys])
    kept = np.bincount(at, weights=both * ~held, minlength=len(every)).astype(np.uint64)
    train = np.bincount(at, weights=both, minlength=len(every)).astype(np.uint64)
    out, a = [], 0
    for block, k in zip(group["block"], keys):
        mine = at[a: a + len(k)]
        a += len(k)
        out.append((int(block), kind, int(r), len(k), pack(kept[mine]), pack(train[mine]), 0, 0, 0, 0))
    if kind == "w":
        out.append((-1, kind, int(r), 0, b"", b"", int(kept.sum()), int((kept > 0).sum()), int(train.sum()), int((train > 0).sum())))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERS.split(", ")])


ANSWERS = ("block long, kind string, r int, n long, kept binary, train binary, kept_tokens long, kept_words long, "
           "train_tokens long, train_words long")


def _tagged(batches):
    """For mapInPandas: rows with their block."""
    for chunk, part in chunk_rows(batches):
        held = np.array([fold_of(d) == HELD for d in part["doc_id"]], bool)
        yield pd.DataFrame({"block": block_of(chunk) | held.astype(np.int64), "doc_id": part["doc_id"], "text": part["text"]})


def _looked_up(docs: pd.DataFrame, answers: pd.DataFrame, column: str):
    """Per document: its fold, and per token the counts of token, context and pair; and their lengths."""
    known = _Words()
    texts = [tokens(t, known) for t in docs["text"]]
    words = np.concatenate(texts)
    before = np.concatenate([contexts(w) for w in texts])
    got = []
    for kind, all_keys in (("w", words), ("p", pair_keys(before, words))):
        keys, at = np.unique(all_keys, return_inverse=True)
        mine = answers[answers["kind"] == kind].sort_values("r")
        totals = np.concatenate([unpack(b) for b in mine[column]]) if len(mine) else np.empty(0, np.uint64)
        if len(totals) != len(keys):
            raise RuntimeError(f"a chunk has {len(keys)} keys, its answer {len(totals)}: the table's rows came in another order")
        totals = totals.astype(np.float64)
        got.append(totals[at])
        if kind == "w":
            got.append(totals[np.searchsorted(keys, before)])
    w, h, p = got
    return w, h, p, np.array([len(t) for t in texts])


def _bucket(h: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(h > 0, 1 + np.floor(np.log2(np.maximum(h, 1))), 0).astype(np.int64)


def _parts(w, h, p, n):
    """Maximum-likelihood estimates of a pair and of a word."""
    return np.divide(p, h, out=np.zeros_like(p), where=h > 0), w / max(n, 1)


def _histogram(n: int):
    """For cogroup: how often held-out tokens meet (bucket, pair estimate, word estimate), on a log grid."""
    names = ["bucket", "f2", "f1", "n"]

    def run(_, docs, answers):
        if not len(docs):
            return pd.DataFrame(columns=names).astype("int64")
        w, h, p, _ = _looked_up(docs, answers, "kept")
        cell = [np.where(f > 0, np.round(STEPS * np.maximum(np.log2(np.where(f > 0, f, 1)), FLOOR)), 1).astype(np.int64)
                for f in _parts(w, h, p, n)]
        rows, counts = np.unique(np.stack([_bucket(h), *cell], 1), axis=0, return_counts=True)
        return pd.DataFrame(np.column_stack([rows, counts]), columns=names)

    return run


def learn_weights(cells: pd.DataFrame, uniform: float) -> dict[int, tuple[float, float, float]]:
    """Weights of pair, word and uniform estimate per bucket, by expectation-maximisation."""
    f2, f1 = (np.where(cells[c] > 0, 0.0, 2.0 ** (cells[c].to_numpy(float) / STEPS)) for c in ("f2", "f1"))
    f0 = np.full(len(cells), uniform)
    out = {}
    for b in sorted(set(cells["bucket"])):
        mine = (cells["bucket"] == b).to_numpy()
        f = np.stack([f2[mine], f1[mine], f0[mine]])
        n = cells["n"].to_numpy(float)[mine]
        a = np.full(3, 1 / 3)
        for _ in range(ITERATIONS):
            share = a[:, None] * f
            a = (share / share.sum(0) * n).sum(1) / n.sum()
        a = np.maximum(a, 1e-6)  # nothing becomes impossible
        out[int(b)] = tuple(a / a.sum())
    return out


def _scores(n: int, v: int, weights: dict):
    top = max(weights, default=0)
    # an unlearnt bucket takes the next lower one's weights; without any, all three count alike
    table, last = [], (1 / 3, 1 / 3, 1 / 3)
    for b in range(max(64, top + 1)):
        last = weights.get(b, last)
        table.append(last)
    table = np.array(table)
    names = [c.split()[0] for c in SCORES.split(", ")]

    def run(_, docs, answers):
        if not len(docs):
            return pd.DataFrame(columns=names)
        w, h, p, sizes = _looked_up(docs, answers, "train")
        f2, f1 = _parts(w, h, p, n)
        a = table[_bucket(h)].T
        logs = np.log10(a[0] * f2 + a[1] * f1 + a[2] / (v + 1))
        base = np.log10((w + ADD) / (n + ADD * (v + 1)))
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return pd.DataFrame({
            "doc_id": docs["doc_id"].to_numpy(), "held_out": [fold_of(d) == TEST for d in docs["doc_id"]], "n_tokens": sizes,
            "n_known": np.add.reduceat((w > 0).astype(np.int64), at), "train_tokens": n,
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(logs, at)})

    return run


def score(docs: DataFrame) -> DataFrame:
    """SCORES of every row of `docs` (doc_id, text)."""
    d = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(chars / RANGE_CHARS))
    asked = d.mapInPandas(_requests(ranges), "r int, block long, kind string, n long, keys binary, counts binary")
    answers = written(asked.groupBy("r", "kind").applyInPandas(_answer, ANSWERS), "lm-answers")
    kept_n, kept_v, n, v = answers.filter("block = -1").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("kept_tokens", "kept_words", "train_tokens", "train_words")]).first()
    answers = answers.filter("block >= 0")
    tagged = d.mapInPandas(_tagged, "block long, doc_id long, text string")
    held = lambda x: x.filter(F.col("block").bitwiseAND(1) == 1).groupBy("block")
    cells = held(tagged).cogroup(held(answers.select("block", "kind", "r", "kept"))).applyInPandas(
        _histogram(kept_n), "bucket long, f2 long, f1 long, n long")
    cells = cells.groupBy("bucket", "f2", "f1").agg(F.sum("n").alias("n")).toPandas()  # a grid of bounded size
    weights = learn_weights(cells, 1 / (kept_v + 1))
    return tagged.groupBy("block").cogroup(answers.select("block", "kind", "r", "train").groupBy("block")).applyInPandas(
        _scores(int(n), int(v), weights), SCORES)
