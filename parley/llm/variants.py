"""Spelling variants: words one code point apart, grouped under the frequent form that they come near.

Words are arranged in a trie by their frequency vectors: a word's way from the root is how many letters of the
first letter group it has, of the second, and so on. One inserted, deleted or replaced code point adds at most
one to one count and takes at most one from another, so a depth-first search that may spend one surplus and
one deficit on its way reaches every leaf that holds a near word; the leaf's words are then verified. The
search carries many words at a time as arrays, on a stack of pieces of bounded size.

Letter groups come from the words: the most frequent letters stand alone, the others share a few groups of about
equal weight. The trie is cut at a depth at which no branch holds more than BRANCH words, counted over all words;
branches are dealt to buckets by hash, and a word visits the buckets of the branches within its budget. A bucket
sends back, per visitor, how many near words it holds and the most frequent one, never pairs.

Occurrences are counted per task before they are shuffled, so a hot word is one row per task. Words have seven
code points at least and two occurrences.

Null or empty text: no words. A null doc_id is the empty string before the colon. Repeated rows count again. A text
of any length is read whole, a word of any length is compared whole. Other columns are not read. No rows: no rows.
"""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from parley.llm.common import written

MIN_CHARS, MIN_COUNT, TIMES, LOST = 7, 2, 10, 31
LONE, SHARED = 12, 4  # levels of one letter, levels that share the rest
LEVELS = LONE + SHARED
BRANCH = 20_000
FLUSH = 200_000  # words that a task counts before it sends them
PIECE = 200_000  # search states, or pairs to verify, at a time
WIDTH = 48  # words up to here are verified as a matrix
MAX_ROUNDS = 64
#: Latin-1: A-Z lower-cased, other letters of the class kept, all else a blank.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def document_words(doc_id: str, text: str) -> Counter:
    """Words of a text, as Latin-1, less the code point that some runs give up."""
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(w) >= MIN_CHARS)
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for w, n in runs.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode("utf-8"), start)
        if h % LOST == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1:]
        if len(w) >= MIN_CHARS:
            out[w] += n
    return out


def _count(batches):
    counts = Counter()

    def rows():
        return pd.DataFrame({"word": [w.decode("latin-1") for w in counts], "n": list(counts.values())})

    for b in batches:
        for doc_id, text in zip(b["doc_id"], b["text"].fillna("")):
            counts.update(document_words(doc_id, text))
            if len(counts) >= FLUSH:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with MIN_COUNT occurrences."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = d.mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


def letter_levels(words: DataFrame) -> np.ndarray:
    """Level of each Latin-1 letter: one row per letter comes to the driver, 256 at most."""

    def tally(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer("".join(b["word"]).encode("latin-1"), np.uint8), minlength=256)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"letter": used, "n": total[used]})

    seen = words.select("word").mapInPandas(tally, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    level, weight = np.full(256, LEVELS - 1), [0] * SHARED
    for i, row in enumerate(sorted(seen, key=lambda r: (-r.n, r.letter))):
        if i < LONE:
            level[row.letter] = i
        else:
            least = weight.index(min(weight))
            weight[least] += row.n
            level[row.letter] = LONE + least
    return level


def vectors(words: list[bytes], level: np.ndarray) -> np.ndarray:
    """Letters per level of each word."""
    size = np.array([len(w) for w in words], np.int64)
    at = np.repeat(np.arange(len(words)), size) * LEVELS + level[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(at, minlength=len(words) * LEVELS).reshape(len(words), LEVELS)


def budget_moves(depth: int) -> np.ndarray:
    """Every way to spend a surplus and a deficit of at most one each on `depth` counts."""
    one = np.eye(depth, dtype=np.int64)
    none = np.zeros((1, depth), np.int64)
    moves = [none, one, -one, *[one[[i]] - one[[j]] for i in range(depth) for j in range(depth) if i != j]]
    return np.concatenate(moves)


def _bucket(prefix: np.ndarray, buckets: int) -> np.ndarray:
    h = np.zeros(prefix.shape[:-1], np.uint64)
    for k in range(prefix.shape[-1]):
        h = (h ^ prefix[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(31))
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


class Trie:
    """Words in the order of their vectors; a node of a level is a range of them."""

    def __init__(self, words: list[bytes], n: np.ndarray, level: np.ndarray):
        self.level = level
        v = vectors(words, level)
        order = np.lexsort(v.T[::-1])
        self.words, self.n, v = [words[i] for i in order], n[order], v[order]
        by_text = sorted(range(len(words)), key=self.words.__getitem__)
        self.rank = np.empty(len(words), np.int64)
        self.rank[by_text] = np.arange(len(words))
        self.keys, self.wide = [], []
        node = np.zeros(len(words), np.int64)
        for k in range(LEVELS):
            wide = int(v[:, k].max()) + 2
            keys, node = np.unique(node * wide + v[:, k], return_inverse=True)
            self.keys.append(keys)
            self.wide.append(wide)
        self.first = np.searchsorted(node, np.arange(len(self.keys[-1]) + 1))
        self.forward, self.backward, self.size = _matrix(self.words)

    def leaves(self, v: np.ndarray):
        """(word, leaf) within the budget, for words with the vectors `v`, in pieces."""
        stack = [(0, i, np.zeros(len(i), np.int64), np.zeros(len(i), np.int8)) for i in _pieces(len(v))]
        while stack:
            depth, word, node, spent = stack.pop()  # spent: 1 for the surplus, 2 for the deficit
            if depth == LEVELS:
                yield word, node
                continue
            keys, wide, own = self.keys[depth], self.wide[depth], v[word, depth]
            found = []
            for step, price in ((0, 0), (1, 1), (-1, 2)):
                count = own + step
                ok = np.flatnonzero((count >= 0) & (count < wide) & ((spent & price) == 0))
                key = node[ok] * wide + count[ok]
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                hit = keys[at] == key
                ok, at = ok[hit], at[hit]
                found.append((word[ok], at, spent[ok] | np.int8(price)))
            word, node, spent = (np.concatenate(x) for x in zip(*found))
            stack += [(depth + 1, word[i], node[i], spent[i]) for i in _pieces(len(word))]

    def near(self, words: list[bytes]):
        """Per word: how many words here are near, and the place of the most frequent one or -1; ties go to
        the first in code-point order."""
        count, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
        forward, backward, size = _matrix(words)
        for word, leaf in self.leaves(vectors(words, self.level)):
            ends = np.cumsum(self.first[leaf + 1] - self.first[leaf])
            for s in range(0, int(ends[-1]) if len(ends) else 0, PIECE):
                i = np.arange(s, min(s + PIECE, int(ends[-1])))
                of = np.searchsorted(ends, i, side="right")
                here = self.first[leaf[of] + 1] - (ends[of] - i)
                q = word[of]
                longest = np.maximum(size[q], self.size[here])
                same = _common(forward, self.forward, q, here, longest) + _common(backward, self.backward, q, here, longest)
                ok = (np.abs(size[q] - self.size[here]) <= 1) & (same >= longest - 1) & (same < 2 * longest) & (longest <= WIDTH)
                for k in np.flatnonzero(longest > WIDTH):
                    ok[k] = one_apart(words[q[k]], self.words[here[k]])
                q, here = q[ok], here[ok]
                count += np.bincount(q, minlength=len(words))
                order = np.lexsort((self.rank[here], -self.n[here], q))
                q, here = q[order], here[order]
                first = np.flatnonzero(np.diff(q, prepend=-1))
                q, here = q[first], here[first]
                old = best[q]
                better = (old < 0) | (self.n[here] > self.n[old]) | ((self.n[here] == self.n[old]) & (self.rank[here] < self.rank[old]))
                best[q[better]] = here[better]
        return count, best


def _pieces(n: int):
    return [np.arange(s, min(s + PIECE, n)) for s in range(0, n, PIECE)]


def _matrix(words: list[bytes]):
    """Words as rows from the left and, reversed, from the right, up to WIDTH letters, and their lengths."""
    n, width = len(words), max(1, min(WIDTH, max(map(len, words), default=1)))
    rows = [np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in x), np.uint8).reshape(n, width)
            for x in (words, (w[:-width - 1:-1] for w in words))]
    return *rows, np.array([len(w) for w in words], np.int64)


def _common(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """How many letters the rows i of a and j of b have in common from their start."""
    width = min(a.shape[1], b.shape[1])
    differ = a[i, :width] != b[j, :width]
    at = differ.argmax(1)
    at[~differ.any(1)] = width
    return np.minimum(at, longest)


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter turns a into another word b."""
    longest = max(len(a), len(b))
    same = len(os.path.commonprefix([a, b])) + len(os.path.commonprefix([a[::-1], b[::-1]]))
    return a != b and abs(len(a) - len(b)) <= 1 and same >= longest - 1


VISIT = "bucket long, word string, n long, home boolean"
NEAR = "word string, n long, n_near long, best_n long, best string"


def _visits(level: np.ndarray, depth: int, buckets: int):
    moves = budget_moves(depth)

    def run(batches):
        for b in batches:
            for s in range(0, len(b), 2000):
                part = b.iloc[s: s + 2000]
                prefix = vectors([w.encode("latin-1") for w in part["word"]], level)[:, :depth]
                around = prefix[:, None, :] + moves[None, :, :]
                to = np.where((around >= 0).all(2), _bucket(around, buckets), -1)
                to = np.sort(to, axis=1)
                new = np.ones(to.shape, bool)
                new[:, 1:] = to[:, 1:] != to[:, :-1]
                row, k = np.nonzero(new & (to >= 0))
                bucket = to[row, k]
                yield pd.DataFrame({"bucket": bucket, "word": part["word"].to_numpy()[row], "n": part["n"].to_numpy()[row],
                                    "home": bucket == _bucket(prefix, buckets)[row]})

    return run


def _meet(level: np.ndarray):
    """For groups by bucket: what each visitor finds among the words at home."""

    def run(group):
        words, home = [w.encode("latin-1") for w in group["word"]], group["home"].to_numpy(bool)
        at_home = np.flatnonzero(home)
        if not len(at_home):
            return pd.DataFrame(columns=[c.split()[0] for c in NEAR.split(", ")])
        trie = Trie([words[i] for i in at_home], group["n"].to_numpy(np.int64)[at_home], level)
        count, best = trie.near(words)
        keep = home | (count > 0)
        found = best[keep]
        return pd.DataFrame({
            "word": group["word"].to_numpy()[keep], "n": group["n"].to_numpy()[keep], "n_near": count[keep],
            "best_n": np.where(found >= 0, trie.n[found], 0),
            "best": [trie.words[i].decode("latin-1") if i >= 0 else None for i in found.tolist()],
        })

    return run


def branch_depth(words: DataFrame, level: np.ndarray) -> int:
    """The least depth at which no branch holds more than BRANCH words, or the whole vector's."""
    for depth in range(2, LEVELS, 2):

        def prefix(batches, depth=depth):
            for b in batches:
                v = vectors([w.encode("latin-1") for w in b["word"]], level)[:, :depth]
                v, n = np.unique(v, axis=0, return_counts=True)
                yield pd.DataFrame({"branch": [",".join(map(str, x)) for x in v.tolist()], "n": n})

        most = words.select("word").mapInPandas(prefix, "branch string, n long").groupBy("branch").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= BRANCH:
            return depth
    return LEVELS


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best) of a written table (word, n): near words, and the most frequent of them."""
    total = words.count()
    level = letter_levels(words)
    buckets = max(1, math.ceil(total / BRANCH))
    depth = branch_depth(words, level) if buckets > 1 else 1
    met = words.select("word", "n").mapInPandas(_visits(level, depth, buckets), VISIT).groupBy("bucket").applyInPandas(_meet(level), NEAR)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))))
    found = met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word of the chain from each word of `links` (word, form). A form is ten times as
    frequent as its word, so chains are short and end; every round doubles the steps taken."""
    state = written(links.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        state = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return state
    raise RuntimeError(f"chains of forms do not end after {MAX_ROUNDS} rounds")


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `docs` (doc_id, text)."""
    words = written(word_counts(docs), "variant-words")
    near = near_words(words)
    is_form = F.col("best_n") >= TIMES * F.col("n")
    forms = written(near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variant-forms")
    last = roots(forms.filter("form is not null"))
    return forms.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
