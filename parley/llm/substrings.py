"""Substring dedup: paragraphs that come near another, and long passages that come word for word again.

Paragraphs are the lines of WORDS words or more, and, as a paragraph may be wrapped, the runs of lines under
PARAGRAPH_WORDS words up to a blank or a longer line. They get a MinHash of their 5-word shingles, cut into BANDS
bands of ROWS values: at a similarity of 0.75 a pair shares a band with a chance of 1 - (1 - 0.75^4)^20,
over 0.999; sets of one or two shingles link with their equals only and have one key. Paragraphs that share a band are joined by way of hubs (see `jaccard.link_lists`), verified by
exact Jaccard and put into components; in each, the first paragraph in table order stays.

A passage may also sit inside a longer paragraph, which no paragraph signature shows. So every run of
WINDOW words is a key as well; where neighbouring keys (over WINDOW words, then) stand in several documents,
they stay in the first of them in table order, and in the others the words of these runs go. Keys are cut to
SPARE_BITS more bits than number the corpus' characters; that two neighbours both fall on a foreign key is
below one case in 10^12 of them.

Keys travel as in the language model: packed, once per chunk, and answered with whether a key stands in
more than one document and whether this chunk is the first that has it. Unshared keys make no rows. A span
is named by its first key; spans that hold the same shared key are linked, by key range again, and components
of these links are the classes of the exact passages: a copy that goes shares one with each that stays. Both
kinds of removal keep what comes first, so nothing loses its last copy.

Null or empty text: nothing to remove. What repeats only within one document stays. Repeated rows count as
several documents, and the first stays. Texts are never cut off. No rows: no rows.
"""

import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from parley.llm.chunks import block_of, chunk_rows, key_check, pack, range_ends, release_memory, small_batches, unpack
from parley.llm.common import written
from parley.llm.graph import components
from parley.llm.jaccard import RANGE_CHARS, SHARE, WORDS, _LOWER, _MIX, _scramble, link_lists

WINDOW = 50
PARAGRAPH_WORDS = 40
BANDS, ROWS = 20, 4
CHUNK_BYTES = 4_000_000
BANDED = 16_384  # sets whose bands are made at a time
PORTION_BYTES = 262_144  # of a chunk's texts, whose words are hashed at a time
SPARE_BITS = 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_rng = np.random.default_rng(11)
_IN_WORD = np.array([not (c == 0x20 or 0x09 <= c <= 0x0D) for c in range(256)])
LONG_WORD = 1024  # bytes; longer words are hashed one by one
_BYTE = np.random.default_rng(12).integers(1, 1 << 64, 256, dtype=np.uint64) * _IN_WORD.astype(np.uint64)
_PLACE = np.random.default_rng(13).integers(1, 1 << 64, LONG_WORD, dtype=np.uint64) | np.uint64(1)
_A = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def _runs(w: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` values, from runs of powers of two."""
    if len(w) < width:
        return np.empty(0, np.uint64)
    n = len(w) - width + 1
    out, at, power, size = np.full(n, np.uint64(width)), 0, w, 1
    while True:
        if width & size:
            out = _scramble(out * _MIX[0] + power[at: at + n])
            at += size
        size *= 2
        if size > width:
            return out
        power = _scramble(power[: len(power) - size // 2] * _MIX[1] + power[size // 2:])


def _bands(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Band keys of shingle sets, one row per set; `values` holds them one after the other. A value that comes
    again in its set changes no minimum."""
    at = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros((len(sizes), BANDS), np.uint64)
    for i in range(0, len(sizes), BANDED):
        j = min(i + BANDED, len(sizes))
        every, here = (values[at[i]: at[j]] >> np.uint64(32)).astype(np.uint32), at[i:j] - at[i]
        mixed = np.empty_like(every)
        for r in range(ROWS):
            low = np.empty((j - i, BANDS), np.uint32)
            for k in range(BANDS):
                np.multiply(every, _A[k * ROWS + r], out=mixed)
                mixed += _B[k * ROWS + r]
                low[:, k] = np.minimum.reduceat(mixed, here)
            out[i:j] = _scramble(out[i:j] * _MIX[2] + low)
    return _scramble(out + np.arange(BANDS, dtype=np.uint64))


def _hashed(texts):
    """(hashes of all words, words of each line, text of each line). A word's hash is the sum of its bytes' numbers,
    each times a number of its place, scrambled with its length."""
    raw = [t.encode("utf-8") for t in texts]
    whole = b"\n".join(raw).translate(_LOWER)
    b = np.frombuffer(whole, np.uint8)
    word = _IN_WORD[b]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    start = np.flatnonzero(begins)
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    size = np.flatnonzero(ends) + 1 - start
    h, i = np.empty(len(start), np.uint64), 0
    while i < len(start):  # a portion of whole words at a time, as each of its bytes takes some forty here
        j = int(np.searchsorted(start, start[i] + PORTION_BYTES))
        a, z = int(start[i]), int(start[j]) if j < len(start) else len(b)
        at = start[i:j] - a
        place = np.arange(z - a, dtype=np.int32) - np.repeat(at.astype(np.int32), np.diff(at, append=z - a))
        h[i:j] = np.add.reduceat(_BYTE[b[a:z]] * _PLACE[place & (LONG_WORD - 1)], at)  # blanks count nothing
        i = j
    h = _scramble(h + size.astype(np.uint64) * _MIX[3])
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        h[k] = xxhash.xxh3_64_intdigest(whole[start[k]: start[k] + size[k]])
    breaks = np.flatnonzero(b == 10)
    line = np.concatenate(([0], breaks + 1))
    begin = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    words = np.bincount(np.searchsorted(breaks, start), minlength=len(line))
    return h, words, np.searchsorted(begin, line, side="right") - 1


def _paragraphs(words: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """(document, first word, words) of the paragraphs, by document, from the words, document and first word of
    each line: lines of WORDS words at least, and runs of several lines under PARAGRAPH_WORDS words."""
    alone = words >= WORDS
    short = (words > 0) & (words < PARAGRAPH_WORDS)
    begins = short.copy()
    begins[1:] &= ~(short[:-1] & (doc[1:] == doc[:-1]))
    first = np.flatnonzero(begins)
    run = np.cumsum(begins)[short] - 1
    lines, total = np.bincount(run, minlength=len(first)), np.bincount(run, words[short], minlength=len(first)).astype(np.int64)
    several = (lines > 1) & (total >= WORDS)
    found = [np.concatenate(x) for x in zip((doc[alone], start[alone], words[alone]), (doc[first][several], start[first][several], total[several]))]
    order = np.lexsort((found[1], found[0]))
    return [x[order] for x in found]


class _Chunk:
    """A chunk's texts with their keys. Kind "w": runs; kind "b": bands."""

    def __init__(self, texts, bits):
        h, words, line_doc = _hashed(texts)
        self.words = np.bincount(line_doc, words, minlength=len(texts)).astype(np.int64)
        self.begin = np.cumsum(self.words) - self.words  # first word of each text
        of_word = np.repeat(np.arange(len(texts), dtype=np.int32), self.words)
        runs = _runs(h, WINDOW)
        inside = of_word[: len(runs)] == of_word[WINDOW - 1:]
        runs, self.run_doc = runs[inside], of_word[: len(runs)][inside]
        cut = np.uint64(64 - bits)
        self.keys, self.at, self.docs_of, self.first = {}, {}, {}, {}
        self._number("w", runs >> cut, self.run_doc)
        del of_word, inside, runs

        # shingles of the paragraphs, one paragraph after the other
        self.p_doc, self.p_start, self.p_words = _paragraphs(words, line_doc, np.cumsum(words) - words)
        sizes = self.p_words - WORDS + 1
        self.p_at = np.concatenate(([0], np.cumsum(sizes)))
        n = len(sizes)
        of = np.repeat(np.arange(n, dtype=np.int32), sizes)
        self.values = _runs(h, WORDS)[np.arange(self.p_at[-1]) - np.repeat(self.p_at[:-1] - self.p_start, sizes)]
        del h
        if n:
            low, high = np.minimum.reduceat(self.values, self.p_at[:-1]), np.maximum.reduceat(self.values, self.p_at[:-1])
            # one or two different shingles: such a set links with its equals only, and has one key
            few = np.logical_and.reduceat((self.values == low[of]) | (self.values == high[of]), self.p_at[:-1])
            own = _scramble(low[few] * _MIX[0] + _scramble(high[few] + _MIX[1]))
            banded = _bands(self.values[~few[of]], sizes[~few])
            self.key_of = np.concatenate((np.flatnonzero(few), np.repeat(np.flatnonzero(~few), BANDS)))
            self.band_keys = np.concatenate((own, banded.reshape(-1)))
        else:
            self.key_of, self.band_keys = np.empty(0, np.int64), np.empty(0, np.uint64)

        del of
        self._number("b", self.band_keys >> cut, self.p_doc[self.key_of])

    def _number(self, kind, keys, doc):
        """Distinct keys in order with their number of documents and the first; and which of them each key is."""
        order = np.argsort(keys)
        k = keys[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        several = ~new
        several[:-1] |= several[1:]
        several = np.flatnonzero(several)  # only keys that come again need their documents in order
        again = order[several]
        order[several] = again[np.lexsort((doc[again], keys[again]))]
        d = doc[order]
        other = new.copy()
        other[1:] |= d[1:] != d[:-1]
        self.keys[kind], self.first[kind] = k[new], d[new]
        del k, d, several, again
        number = np.cumsum(new, dtype=np.int32) - np.int32(1)
        self.docs_of[kind] = np.bincount(number, weights=other).astype(np.uint64) if len(number) else np.empty(0, np.uint64)
        self.at[kind] = np.empty(len(number), np.int32)
        self.at[kind][order] = number


def _requests(ranges: int, bits: int):
    names = ["r", "block", "kind", "n", "check", "keys", "counts"]

    def rows(chunk, texts):
        c, out = _Chunk(texts, bits), []
        for kind in ("w", "b"):
            keys, counts = c.keys[kind], c.docs_of[kind]
            ends = range_ends(keys, ranges, bits)
            for i in range(ranges):
                a, b = ends[i], ends[i + 1]
                if b > a:
                    out.append((i, block_of(chunk), kind, int(b - a), key_check(keys[a:b]), pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b])))
        return pd.DataFrame(out, columns=names)

    def run(batches):
        release_memory()
        now, texts = None, []
        for chunk, part in chunk_rows(batches, CHUNK_BYTES):
            if now is not None and chunk != now:
                yield rows(now, texts)
                texts = []
            now = chunk
            texts += list(part["text"])
        if texts:
            yield rows(now, texts)
        texts, part = [], None
        release_memory()  # the worker may stand idle beside other stages

    return run


ANSWERS = "block long, kind string, r int, n long, check long, code binary"


def _answer(key, group):
    """Per key of each chunk: 0 in one document only, 1 in several and this chunk is the first, 2 it is not."""
    group = group.sort_values("block")
    keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in group["keys"]]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    df = np.bincount(at, weights=np.concatenate([unpack(c) for c in group["counts"]]).astype(float))
    seen, out, a = np.zeros(len(every), bool), [], 0
    for block, check, k in zip(group["block"], group["check"], keys):
        mine = at[a: a + len(k)]
        a += len(k)
        code = np.where(df[mine] > 1, np.where(seen[mine], 2, 1), 0)
        seen[mine] = True
        out.append((int(block), key[1], int(key[0]), len(k), int(check), pack(code.astype(np.uint64))))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERS.split(", ")])


SENT = ("kind string, doc_id long, place long, start int, words int, node long, sig long, weight int, bits0 long, bits1 long, bits2 long, bits3 long, "
        "shingles array<long>, kept boolean, r int, keys binary, names binary, name_of binary")
BITMAPS = ("bits0", "bits1", "bits2", "bits3")
WHOLE = ("doc_id", "place", "start", "words", "node", "sig", "weight", *BITMAPS, "r")


def _spans(covered: np.ndarray):
    """(start, end) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _widen(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Words covered by runs of WINDOW that begin where `starts` is True."""
    steps = np.zeros(n_words + 1, np.int64)
    i = np.flatnonzero(starts)
    np.add.at(steps, i, 1)
    np.add.at(steps, i + WINDOW, -1)
    return np.cumsum(steps[:-1]) > 0


def _bitmaps(shingles: np.ndarray) -> list[int]:
    """256 bits in which every shingle sets one, as signed numbers."""
    word, bit = (shingles >> np.uint64(6)) & np.uint64(3), np.uint64(1) << (shingles & np.uint64(63))
    out = np.zeros(len(BITMAPS), np.uint64)
    np.bitwise_or.at(out, word, bit)
    return out.view(np.int64).tolist()


def _links(keys: np.ndarray, nodes: np.ndarray, ranges: int, bits: int):
    """(range, keys, names, which name) of the distinct pairs of a key and the span that holds it, packed."""
    names, at = np.unique(nodes, return_inverse=True)
    order = np.lexsort((at, keys))
    keys, at = keys[order], at[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
    keys, at = keys[new], at[new]
    ends = range_ends(keys, ranges, bits)
    for i in range(ranges):
        a, b = ends[i], ends[i + 1]
        if b > a:
            used, of = np.unique(at[a:b], return_inverse=True)
            yield i, pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(names[used]), pack(of)


def _joined(key, group):
    """Links between the names of spans that hold the same key: each with the least of them."""
    keys = np.concatenate([np.cumsum(unpack(k), dtype=np.uint64) for k in group["keys"]])
    names = np.concatenate([unpack(n)[unpack(of).astype(np.int64)] for n, of in zip(group["names"], group["name_of"])]).view(np.int64)
    order = np.lexsort((names, keys))
    keys, names = keys[order], names[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    least = names[new][np.cumsum(new) - 1]
    pairs = np.unique(np.stack([least, names], 1)[least != names], axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _band_rows(bands, of: np.ndarray, keys: np.ndarray, names) -> pd.DataFrame:
    """A row for each distinct key of the paragraphs in `bands` (number, words, node, weight, bitmaps; in order);
    `of`: the paragraph's number for each of `keys`."""
    numbers, *facts = (np.array(x, np.int64) for x in zip(*bands))
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
    at = np.minimum(np.searchsorted(numbers, of), len(numbers) - 1)
    new &= numbers[at] == of
    at, keys = at[new], keys[new]
    have = dict(zip(("words", "node", "weight", *BITMAPS), (x[at] for x in facts))) | {"sig": keys}
    rows = {x: np.full(len(keys), None) for x in ("shingles", "keys", "names", "name_of")}
    for x in WHOLE:
        rows[x] = pd.array(have[x], "Int64") if x in have else pd.array([pd.NA], "Int64").repeat(len(keys))
    rows["kind"], rows["kept"] = np.full(len(keys), "band", object), pd.array([pd.NA], "boolean").repeat(len(keys))
    return pd.DataFrame(rows, columns=names)


def _found(bits: int, ranges: int):
    """For cogroup: spans that repeat word for word, and paragraphs that share a band, with their bands."""
    names = [c.split()[0] for c in SENT.split(", ")]

    def run(_, docs, answers):
        if not len(docs):
            return pd.DataFrame(columns=names)
        release_memory()
        docs = docs.sort_values("place")
        c = _Chunk(list(docs["text"]), bits)
        code = {}
        for kind in ("w", "b"):
            mine, keys = answers[answers["kind"] == kind].sort_values("r"), c.keys[kind]
            ends = range_ends(keys, ranges, bits)
            own = [(i, key_check(keys[ends[i]: ends[i + 1]])) for i in range(ranges) if ends[i + 1] > ends[i]]
            if own != list(zip(mine["r"].tolist(), mine["check"].tolist())):
                raise RuntimeError("a chunk's keys are not those that were answered: the table's rows came in another order")
            code[kind] = np.concatenate([unpack(b) for b in mine["code"]]) if len(mine) else np.empty(0, np.uint64)
        shared = code["w"][c.at["w"]]
        beside = (shared[1:] > 0) & (shared[:-1] > 0) & (c.run_doc[1:] == c.run_doc[:-1])
        shared = np.where(np.append(beside, False) | np.insert(beside, 0, False), shared, 0)
        first_here = c.first["w"][c.at["w"]] == c.run_doc
        gone = (shared == 2) | ((shared == 1) & ~first_here)
        stays = (shared == 1) & first_here
        out, a, passages, seen = [], 0, [], set()
        run_keys = c.keys["w"][c.at["w"]]
        ids, places = docs["doc_id"].tolist(), docs["place"].tolist()
        covered = np.zeros(int(c.words.sum()), bool)  # words of runs that go
        for i, words in enumerate(c.words.tolist()):
            doc = None if pd.isna(ids[i]) else int(ids[i])
            n = max(0, words - WINDOW + 1)
            if not shared[a: a + n].any():
                a += n
                continue
            mine = _widen(gone[a: a + n], words)
            covered[c.begin[i]: c.begin[i] + words] = mine
            for kept, mask, starts in ((False, mine, gone), (True, _widen(stays[a: a + n], words), stays)):
                spans = _spans(mask)
                if spans:  # a span starts with a shared key, and that names it
                    heads, own = np.array([s for s, _ in spans]), np.flatnonzero(starts[a: a + n])
                    passages.append((run_keys[a + own], run_keys[a + heads[np.searchsorted(heads, own, side="right") - 1]]))
                for s, e in spans:
                    out.append(("run", doc, places[i], s, e - s, int(run_keys[a + s].view(np.int64)), *[None] * 7, kept, *[None] * 4))
            a += n
        left = np.concatenate(([0], np.cumsum(~covered)))  # a paragraph all of whose words go is in no class of its own
        band = code["b"][c.at["b"]] > 0
        weight = np.bincount(c.key_of[band], minlength=len(c.p_doc))
        bands = []
        for p in np.flatnonzero((weight > 0) & (left[c.p_start + c.p_words] > left[c.p_start])).tolist():
            i, s = int(c.p_doc[p]), np.unique(c.values[c.p_at[p]: c.p_at[p + 1]])
            doc, node = None if pd.isna(ids[i]) else int(ids[i]), xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
            # a set that comes again in this chunk needs no second set of keys
            new = node not in seen
            seen.add(node)
            out.append(("paragraph", doc, places[i], int(c.p_start[p] - c.begin[i]), int(c.p_words[p]), node, *[None] * 6,
                        s.view(np.int64) if new else None, *[None] * 5))
            if new:  # the weight is how many bands another document has too
                bands.append((p, len(s), node, int(weight[p]), *_bitmaps(s)))
        if passages:
            keys, nodes = (np.concatenate(x) for x in zip(*passages))
            out += [("link", *[None] * 13, *x) for x in _links(keys, nodes, ranges, bits)]
        named, keys = c.key_of[band], c.band_keys[band].view(np.int64)
        del c, docs, code, shared, beside, first_here, gone, stays, run_keys, covered, left, band
        got = pd.DataFrame(out, columns=names, dtype=object)  # a null beside them must not turn 64-bit names into floats
        out.clear()
        for x in WHOLE:
            got[x] = got[x].astype("Int64")
        got["kept"] = got["kept"].astype("boolean")
        if not bands:
            return got
        more = _band_rows(bands, named, keys, names)
        # column by column: a concat of whole frames looks at each null of a column of objects
        return pd.DataFrame({x: pd.concat([got[x], more[x]], ignore_index=True) for x in names})

    return run


def find_repeats(docs: DataFrame, share: int = SHARE, place: str = None) -> DataFrame:
    """Repeats: doc_id, place (row in table order, or the column `place`), start_word, n_words, kind (run or paragraph),
    component (the class: of exact passages that share words, or of near paragraphs), kept (true for a copy that
    stays: in the document that comes first). Words count from 0 over the whole text. Other columns are not read."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.col(place).alias("place")] if place else []))
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(chars / RANGE_CHARS))
    bits = min(64, max(1, chars).bit_length() + SPARE_BITS)
    asked = d.select("doc_id", "text").mapInPandas(
        _requests(ranges, bits), "r int, block long, kind string, n long, check long, keys binary, counts binary")
    answers = written(asked.groupBy("r", "kind").applyInPandas(_answer, ANSWERS), "substring-answers")

    def tagged(batches):
        for chunk, part in chunk_rows(batches, CHUNK_BYTES):
            if not place:
                part = part.assign(place=part["row"] + (TaskContext.get().partitionId() << 40))
            yield part.assign(block=block_of(chunk))[["block", "place", "doc_id", "text"]]

    blocks = d.mapInPandas(tagged, "block long, place long, doc_id long, text string")
    sent = written(blocks.groupBy("block").cogroup(answers.select("block", "kind", "r", "check", "code").groupBy("block"))
                   .applyInPandas(_found(bits, ranges), SENT), "substring-sent")
    units = sent.filter("kind = 'paragraph'").select("doc_id", "place", "start", "words", "node")
    sets = written(sent.filter("kind = 'paragraph'").groupBy("node").agg(F.first("shingles", ignorenulls=True).alias("shingles")).select(
        "node", F.size("shingles").alias("n"), "shingles"), "substring-sets")
    bands = sent.filter("kind = 'band'").groupBy("sig", "node").agg(F.first("words").alias("n"), F.max("weight").alias("weight"), *[F.first(b).alias(b) for b in BITMAPS])
    first = bands.groupBy("sig").agg(F.max(F.struct("weight", "node")).alias("hub"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    first = first.filter("lo < hi").select("sig", F.col("hub.node").alias("lead"), F.col("hub.weight").alias("lead_weight"))
    met = written(bands.drop("weight").withColumn("place", F.lit(-1)).join(first, "sig"), "substring-lists")
    votes = met.groupBy("node", "lead").agg(F.count(F.lit(1)).alias("c"), F.max("lead_weight").alias("weight"))
    _, found = link_lists(met, votes, sets, share, BITMAPS)
    named = units.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.struct("place", "start")
    head = named.groupBy("component").agg(F.min(order).alias("lo"), F.max("place").alias("hi")).filter("lo.place < hi").drop("hi")
    near = named.join(head, "component").select(
        "doc_id", "place", F.col("start").alias("start_word"), F.col("words").alias("n_words"), F.lit("paragraph").alias("kind"),
        # what comes again within the first document is no repeat across documents, and stays with it
        "component", (F.col("place") == F.col("lo.place")).alias("kept"))
    linked = components(sent.filter("kind = 'link'").select("r", "keys", "names", "name_of").groupBy("r").applyInPandas(_joined, "a long, b long"))
    runs = sent.filter("kind = 'run'").join(linked, "node", "left").select(
        "doc_id", "place", F.col("start").alias("start_word"), F.col("words").alias("n_words"), "kind",
        F.coalesce("component", "node").alias("component"), "kept")
    return runs.unionByName(near)


@F.pandas_udf(StringType())
def _without(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    def one(t, a, b):
        if a is None or len(a) == 0:
            return t
        at = [m.start() for m in _WORD.finditer(t)]
        out, here = [], 0
        for s, e in sorted(zip(a, b)):
            x, y = at[s], at[e] if e < len(at) else len(t)
            if x > here:
                out.append(t[here:x])
            here = max(here, y)
        return "".join([*out, t[here:]])

    return pd.Series([one(*x) for x in zip(text, starts, ends)], dtype=object)


#: Otherwise the filter on what is left would be pushed below it and cut every text once more, in a second worker per task.
_without = _without.asNondeterministic()


def remove_repeats(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """`docs` with the repeats that do not stay cut from the texts; a text of which no word is left goes.
    Columns are unchanged, whatever their names; n_chars, where there is one, is that of the text that is left.

    The rows are numbered and written once, and repeats are found in that table and cut from it, so any plan
    may stand before it."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("_row")
    x = written(docs.select(row, F.monotonically_increasing_id().alias("_place")), "substring-rows")
    found = find_repeats(x.select("_row.doc_id", "_row.text", "_place"), share, "_place").filter("not kept")
    cut = found.groupBy(F.col("place").alias("_place")).agg(F.collect_list(F.struct("start_word", "n_words")).alias("_cut"))
    text = F.col("_row.text")
    rest = _without(F.coalesce(text, F.lit("")), F.transform("_cut", lambda c: c["start_word"]),
                    F.transform("_cut", lambda c: c["start_word"] + c["n_words"]))
    x = x.join(cut, "_place", "left").withColumn("_left", F.when(F.col("_cut").isNull(), text).otherwise(rest))
    x = x.filter(F.col("_cut").isNull() | F.col("_left").rlike(r"[^\x20\x09-\x0D]"))
    fixed = {"text": F.col("_left")} | ({"n_chars": F.length("_left").cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})
    return x.select(*[(fixed[c] if c in fixed else F.col(f"_row.`{c}`")).alias(c) for c in names])
