"""Exact Jaccard join of word shingles: a size-aware join with a heavy and a light part.

Two documents link when |A & B| / |A | B| >= 0.75 over their sets of 5-word shingles. Equal sets are one
class from the start. For the rest, shingles are ordered by how many documents hold them, rarest first
(counts over all documents); then a pair of linked sets shares at least

* one shingle in the first |A| - need + 1 of each: LARGE sets send these shingles, and the inverted list of
  a shingle is scanned for partners;
* two shingles in the first |A| - need + 2: SMALL sets send every pair of these (subsets of fixed size 2),
  and only sets with an equal pair meet.

The boundary between small and large is where sending all pairs costs as much as scanning the lists, taken
from the measured mean length of a list; small sets near it send both, as a partner may be large. A shingle
held by one document only can meet nothing and is never sent.

Counts per shingle: as in the language model, a chunk of texts sends its distinct shingles as packed keys
by range and is answered with counts in the same order. Keys are cut to as many bits as the corpus needs to
keep false sharing rare: that may only move a shingle in the order, alike everywhere.

Links without all pairs of a group: in the first round every set meets one hub, the set of its lists whose
shingles most documents hold (the original among edited copies), so a group of thousands of near copies
costs as many pairs as members. Sets that are far from their hub then meet all others of that hub, in
blocks whose overlaps are one matrix product; a block gives a spanning forest of its links, never the pairs.
Last, lists that still hold several components give the pairs across them that have no hub in common, all
of them. Nothing is left out, so components are exact. Linked sets lie in one component, so the links of every
set are counted there afterwards: members meet in salted blocks whose overlaps are one matrix product, and a
block gives sums per member, never pairs. `n_links` is the number of other rows with an id whose set links
with the row's, equal sets included. The comparisons of a component still grow with the square of its sets.

Null or empty text, or text of white space: the empty set, linked with nothing. Fewer than five words: the
whole sequence is the one shingle. Rows that repeat a doc_id are one node each by their text; a null doc_id
gets a null component. Texts are never cut. No rows: no rows.
"""

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from parley.llm.chunks import block_of, chunk_rows, pack, range_ends, release_memory, small_batches, unpack
from parley.llm.common import attach_small, written
from parley.llm.graph import components

WORDS, SHARE = 5, 75  # shingle length; percent
RANGE_CHARS = 4_000_000
MEMO_SIZE = 100_000  # words, of some 150 bytes each with their hash
SPARE_BITS = 12  # key bits beyond those that number the corpus' shingles
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _scramble(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(29)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(32)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(29)
    return y


def shingles(text: str, known: dict, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(w) - width + 1
    if n < 1:  # the sequence; its length goes in, so that it is no shingle's prefix
        x = np.array([len(w)], np.uint64) * _MIX[4]
        for v in w:
            x = _scramble(x ^ v)
        return x
    x = np.zeros(n, np.uint64)
    for k in range(width):
        x = _scramble(x * _MIX[k % 5] + w[k: k + n])
    return np.unique(x)


def need(a: int, b: int, share: int = SHARE) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-share * (a + b) // (100 + share))


def least_need(a: int, share: int = SHARE) -> int:
    """Least overlap of a set of this size with any linked one."""
    return -(-share * a // 100)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(s.tobytes())
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _chunk_sets(docs: pd.DataFrame, known: dict):
    return [shingles(t, known) for t in docs["text"]]


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def _requests(ranges: int, bits: int):
    """For mapInPandas: the distinct cut keys of each chunk, by range, with the count of its documents."""
    names = ["r", "block", "n", "keys", "counts"]

    def rows(chunk, sets):
        keys = _cut(np.concatenate(sets), bits) if sets else np.empty(0, np.uint64)
        keys, counts = np.unique(keys, return_counts=True)
        ends = range_ends(keys, ranges, bits)
        out = []
        for i in range(ranges):
            a, b = ends[i], ends[i + 1]
            if b > a:
                out.append((i, block_of(chunk), int(b - a), pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b])))
        return pd.DataFrame(out, columns=names)

    def run(batches):
        release_memory()
        known, now, sets = _Words(), None, []
        for chunk, part in chunk_rows(batches):
            if now is not None and chunk != now:
                yield rows(now, sets)
                sets = []
            now = chunk
            sets += _chunk_sets(part, known)
        if sets:
            yield rows(now, sets)
        known, sets, part = None, [], None
        release_memory()  # the worker may stand idle beside other stages

    return run


ANSWERS = "block long, r int, n long, df binary, lists double, held double"


def _answer(key, group):
    """Documents per key, for each chunk that asked; block -1 has how many lists there are, and their length."""
    keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in group["keys"]]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    df = np.bincount(at, weights=np.concatenate([unpack(c) for c in group["counts"]]).astype(float)).astype(np.uint64)
    out, a = [], 0
    for block, k in zip(group["block"], keys):
        out.append((int(block), int(key[0]), len(k), pack(df[at[a: a + len(k)]]), 0.0, 0.0))
        a += len(k)
    shared = df[df > 1].astype(float)
    out.append((-1, int(key[0]), 0, b"", float(len(shared)), float(shared.sum())))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERS.split(", ")])


def boundary(mean_list: float, share: int = SHARE) -> int:
    """The largest size whose pairs cost no more to send than its lists to scan."""
    size = 4
    while True:
        p = size + 1 - least_need(size + 1, share)
        if (p + 2) * (p + 1) / 2 > (p + 1) * max(mean_list, 2.0) or size >= 10_000:
            return size
        size += 1


SENT = "kind string, doc_id long, f1 long, f2 long, n int, sig long, place int, weight int, shingles array<long>"


def _senders(bits: int, small: int, share: int):
    """For cogroup: a row per document, and signatures and the set of those that may have partners."""
    names = [c.split()[0] for c in SENT.split(", ")]

    def run(_, docs, answers):
        if not len(docs):
            return pd.DataFrame(columns=names)
        release_memory()
        sets = _chunk_sets(docs, _Words())
        keys, at = np.unique(_cut(np.concatenate(sets), bits), return_inverse=True)
        mine = answers.sort_values("r")
        df = np.concatenate([unpack(b) for b in mine["df"]]) if len(mine) else np.empty(0, np.uint64)
        if len(df) != len(keys):
            raise RuntimeError(f"a chunk has {len(keys)} keys, its answer {len(df)}: the table's rows came in another order")
        df, a = df[at], 0
        del keys, at
        out, seen = [], set()
        for doc, s in zip(docs["doc_id"], sets):
            doc = None if pd.isna(doc) else int(doc)
            mine, a = df[a: a + len(s)], a + len(s)
            f1, f2 = _fingerprint(s) if len(s) else (None, None)
            out.append(("doc", doc, f1, f2, len(s), None, None, None, None))
            if not len(s) or (f1, f2) in seen or not (mine > 1).any():
                continue
            p = len(s) - least_need(len(s), share) + 1
            order = np.lexsort((s, mine))[: p + 1]
            sent = []
            shared = mine[order] > 1
            if len(s) > small or 100 * len(s) >= share * small:  # large, or with large partners
                sent += [(int(x), i) for i, x in enumerate(s[order[:p]].view(np.int64)) if shared[i]]
            if len(s) <= small and len(s) > 1:
                k = np.flatnonzero(shared)
                i, j = np.triu_indices(len(k), 1)
                x = s[order[k]]
                lo, hi = np.minimum(x[i], x[j]), np.maximum(x[i], x[j])
                sent += [(int(v), -1) for v in _scramble(lo * _MIX[0] + _scramble(hi + _MIX[1])).view(np.int64)]
            if sent:
                seen.add((f1, f2))
                weight = int(64 * math.log2(float(mine.mean())))
                out.append(("set", doc, f1, f2, len(s), None, None, weight, s.view(np.int64)))
                out += [("sig", doc, f1, f2, len(s), v, i, weight, None) for v, i in sent]
        del sets, df, mine, docs, answers
        got = pd.DataFrame(out, columns=names, dtype=object)  # a null beside them must not turn 64-bit names into floats
        out.clear()
        for c in ("doc_id", "f1", "f2", "n", "sig", "place", "weight"):
            got[c] = got[c].astype("Int64")
        return got

    return run


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(a, b) of the pairs whose sets link; the common partner of many pairs stands in b."""
    x = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa")), "a")
    x = x.join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return x.withColumn("both", both).filter(100 * F.col("both") >= share * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _sizes_fit(a, b, share):
    return (100 * F.least(a, b) >= share * F.greatest(a, b))


BLOCK = 1024  # members of a hub's group that one task compares at a time
COLUMNS = 4096  # shingles of a matrix at a time
RELEASE = 256  # members of a group for which a worker gives earlier memory back


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered `a` with those numbered `b`, COLUMNS shingles at a time."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column, hot = np.cumsum(counts > 1) - 1, counts[at] > 1  # what one set alone has is in no overlap
    row, column = row[hot], column[at[hot]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(a), len(b)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for c in range(0, width, COLUMNS):
        x, y = np.searchsorted(column, (c, c + COLUMNS))
        m = np.zeros((len(sets), min(COLUMNS, width - c)), np.float32)
        m[row[x:y], column[x:y] - c] = 1
        both += m[a] @ m[b].T
    return both


def _forest(n: int, pairs) -> list[tuple[int, int]]:
    """Of pairs of 0..n-1, those that join what was apart, by the two names that come with each."""
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b, *names in pairs:
        x, y = top(a), top(b)
        if x != y:
            parent[x] = y
            out.append(tuple(names))
    return out


def _compare(share: int):
    """For groups by (hub, i, j): links between the far members of block i and the members of block j, as
    few as keep together what they join. Members near the hub are together already."""

    def run(key, group):
        if len(group) > RELEASE:
            release_memory()  # what earlier tasks of this worker freed would stand beside the matrices
        far, sets = group["far"].to_numpy(bool), [np.asarray(s) for s in group["shingles"]]
        nodes, near = group["node"].to_numpy(), group["near"].to_numpy(bool)
        sizes = np.array([len(s) for s in sets])
        a, b = np.flatnonzero(far), np.flatnonzero(~far)
        both = _overlaps(sets, a, b)
        linked = (100 * both >= share * (sizes[a][:, None] + sizes[b][None, :] - both)) & (nodes[a][:, None] != nodes[b][None, :])
        name = {}
        row = [name.setdefault("near" if near[k] else int(nodes[k]), len(name)) for k in range(len(nodes))]
        # far members' links one after the other: those of a group of near copies are too many to hold
        pairs = ((row[p], row[q], p, q) for p, linked_with in zip(a.tolist(), linked) for q in b[linked_with].tolist())
        return pd.DataFrame([(nodes[p], nodes[q]) for p, q in _forest(len(name), pairs)], columns=["a", "b"]).astype("int64")

    return run


def link_lists(met: DataFrame, votes: DataFrame, sets: DataFrame, share: int = SHARE, bitmaps=()):
    """(links compared and found, components of them) among the sets that meet in lists.

    met: (sig, node, n, place; -1 for no place), a written table of lists with two nodes at least;
    votes: (node, lead, weight, c), leads of a node's lists; sets: (node, n, shingles), written.
    bitmaps: columns of `met` that hold together a bitmap of each set's shingles; pairs whose bitmaps differ in more
    places than linked sets have shingles apart are left out, as each such place is a shingle that one of them lacks."""
    # round 1: each set with one hub, the heaviest that leads a list of it
    best = votes.filter("node <> lead").groupBy("node").agg(F.max_by("lead", F.struct("weight", "lead")).alias("hub"))
    best = written(best, "hubs")
    pairs1 = best.select(F.col("node").alias("a"), F.col("hub").alias("b"))
    links1 = written(_verified(pairs1, sets, share), "links")

    # round 2: what is far from its hub meets all others of that hub's group, block by block
    group = best.join(links1.select(F.col("a").alias("node"), F.lit(True).alias("near")), "node", "left")
    group = written(group.withColumn("near", F.coalesce("near", F.lit(False))), "hub-groups")
    sizes = group.groupBy("hub").agg(F.count(F.lit(1)).alias("all"), F.count_if(~F.col("near")).alias("apart")).filter("apart > 0 and all > 1")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = sizes.select("hub", blocks("all").alias("nj"), blocks("apart").alias("ni"))
    dealt = group.join(sizes, "hub").withColumns({
        "i": F.pmod(F.xxhash64("node", F.lit(1)), "ni").cast("int"), "j": F.pmod(F.xxhash64("node"), "nj").cast("int")})
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    as_member = dealt.select("hub", F.explode(upto("ni")).alias("i"), "j", "node", "near", F.lit(False).alias("far"))
    as_far = dealt.filter("not near").select("hub", "i", F.explode(upto("nj")).alias("j"), "node", "near", F.lit(True).alias("far"))
    tasks = as_member.unionByName(as_far).join(sets.select("node", "shingles"), "node")
    links2 = tasks.groupBy("hub", "i", "j").applyInPandas(_compare(share), "a long, b long")
    links2 = written(links1.unionByName(links2), "links")
    found = components(links2)

    # round 3: pairs across components and hubs in the lists that still hold several
    own = list(bitmaps)
    at = met.select("sig", "node", "n", "place", *own).join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(best, "node", "left")
    at = at.withColumn("hub", F.coalesce("hub", "node"))
    several = at.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("hub").alias("h0"),
                                    F.max("hub").alias("h1")).filter("lo < hi and h0 < h1").select("sig")
    at = written(at.join(several, "sig").select("sig", "node", "n", "place", "component", "hub", *own), "mixed-lists")
    near = F.lit(True)
    if own:
        apart = F.floor((100 - share) * (F.col("x.n") + F.col("y.n")) / (100 + share))
        near = sum(F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in own) <= apart
    x = at.alias("x").join(at.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") < F.col("y.node"))
                           & (F.col("x.component") != F.col("y.component")) & (F.col("x.hub") != F.col("y.hub"))
                           & _sizes_fit(F.col("x.n"), F.col("y.n"), share) & near
                           & ((F.col("x.place") < 0) | (F.col("y.place") < 0) | (
                               F.least("x.place", "y.place") + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
                               >= F.ceil(share * (F.col("x.n") + F.col("y.n")) / (100 + share)))))
    pairs3 = x.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    links3 = _verified(pairs3, sets, share)
    links = written(links2.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().unionByName(links3), "links")
    return links, components(links)


TASK_ROWS = 4096  # sets that one task of the count reads, about


def _count(share: int):
    """For groups by bucket: per set of each (component, i, j), the rows of the other block it links with."""

    def one(t):
        sets, copies = [np.asarray(s) for s in t["shingles"]], t["copies"].to_numpy(np.float64)
        sizes = np.array([len(s) for s in sets])
        block, i, j = t["own"].to_numpy(), t["i"].iloc[0], t["j"].iloc[0]
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        both = _overlaps(sets, a, b)
        linked = 100 * both >= share * (sizes[a][:, None] + sizes[b][None, :] - both)
        links = np.zeros(len(sets))
        if i == j:
            np.fill_diagonal(linked, False)
            links[a] = linked @ copies[b]
        else:
            links[a], links[b] = linked @ copies[b], linked.T @ copies[a]
        return pd.DataFrame({"f1": t["f1"].to_numpy(), "f2": t["f2"].to_numpy(), "links": links.astype(np.int64)})

    def run(group):
        return pd.concat([one(t) for _, t in group.groupby(["component", "i", "j"], sort=False)])

    return run


def count_links(sets: DataFrame, found: DataFrame, share: int = SHARE) -> DataFrame:
    """(f1, f2, links): per set in a component, the rows of other sets that it links with.

    sets: (f1, f2, node, copies, shingles), written; found: (node, component)."""
    members = written(sets.select("f1", "f2", "node", "copies").join(found, "node").select("f1", "f2", "copies", "component"), "jaccard-members")
    large = members.groupBy("component").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") > BLOCK)
    large = written(large.select("component", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")), "jaccard-large")
    m = attach_small(members, large, ["component"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    m = m.withColumn("own", F.pmod(F.xxhash64("f1", "f2"), "blocks").cast("int"))
    tasks = m.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).withColumns({
        "i": F.least("own", "other"), "j": F.greatest("own", "other")})
    rows = tasks.count()
    buckets = F.lit(max(1, math.ceil(rows / TASK_ROWS)))
    tasks = tasks.select("f1", "f2", "copies", "component", "own", "i", "j", F.pmod(F.xxhash64("component", "i", "j"), buckets).alias("bucket"))
    counted = tasks.join(sets.select("f1", "f2", "shingles"), ["f1", "f2"]).groupBy("bucket").applyInPandas(
        _count(share), "f1 long, f2 long, links long")
    return counted.groupBy("f1", "f2").agg(F.sum("links").alias("links"))


def link_components(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, the number of other rows that link (0 for a null doc_id),
    for each row."""
    rows, classes, sets, found = _linked(docs, share)
    links = count_links(sets, found, share)
    company = _company(classes, found).join(links, ["f1", "f2"], "left")
    company = company.select("f1", "f2", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    own = F.when(F.col("doc_id").isNotNull(), F.col("links"))
    return rows.join(company, ["f1", "f2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(own, F.lit(0)).cast("long").alias("n_links"))


def _company(classes: DataFrame, found: DataFrame) -> DataFrame:
    """Classes with company, and their components; only these need their names joined back to rows."""
    x = classes.join(found, "node", "left").filter("copies > 1 or component is not null")
    return x.select("f1", "f2", "copies", F.coalesce("component", "node").alias("component"))


def _linked(docs: DataFrame, share: int):
    """The documents' rows, classes of equal sets, sets that may have partners, and components of the classes."""
    small_batches(docs.sparkSession)
    d = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(chars / RANGE_CHARS))
    bits = min(64, max(1, chars).bit_length() + SPARE_BITS)
    asked = d.mapInPandas(_requests(ranges, bits), "r int, block long, n long, keys binary, counts binary")
    answers = written(asked.groupBy("r").applyInPandas(_answer, ANSWERS), "jaccard-answers")
    lists, held = answers.filter("block = -1").agg(F.sum("lists"), F.sum("held")).first()
    small = boundary((held or 0.0) / max(lists or 0.0, 1.0), share)

    def tagged(batches):
        for chunk, part in chunk_rows(batches):
            yield part.assign(block=block_of(chunk))[["block", "doc_id", "text"]]

    blocks = d.mapInPandas(tagged, "block long, doc_id long, text string")
    sent = written(blocks.groupBy("block").cogroup(answers.filter("block >= 0").select("block", "r", "df").groupBy("block"))
                   .applyInPandas(_senders(bits, small, share), SENT), "jaccard-sent")
    rows = sent.filter("kind = 'doc'").select("doc_id", "f1", "f2", "n")

    # classes of equal sets, named by their smallest doc_id
    classes = written(rows.filter("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")), "jaccard-classes")
    names = classes.select("f1", "f2", "node")
    sets = sent.filter("kind = 'set'").groupBy("f1", "f2").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    sets = written(sets.join(classes, ["f1", "f2"]).select("f1", "f2", "node", "copies", "n", "shingles"), "jaccard-sets")

    # lists with two sets at least
    sig = sent.filter("kind = 'sig'").select("sig", F.struct("f1", "f2").alias("me"), "n", "place", "weight")
    ranked = F.struct("weight", "me")
    first = sig.groupBy("sig").agg(F.max(ranked).alias("hub"), F.min("me").alias("lo"), F.max("me").alias("hi")).filter("lo <> hi")
    named = lambda x, c, to: x.join(names.select(F.struct("f1", "f2").alias(c), F.col("node").alias(to)), c).drop(c)
    met = sig.join(first.select("sig", F.col("hub.me").alias("hub"), F.col("hub.weight").alias("lead_weight")), "sig").dropDuplicates(["sig", "me"])
    met = written(named(met, "me", "node"), "jaccard-lists")
    votes = met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("c"), F.max("lead_weight").alias("weight"))
    votes = named(votes, "hub", "lead")
    _, final = link_lists(met, votes, sets, share)
    return rows, classes, sets, final


def keep_one(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """The rows of `docs` less all but one of each group of linked documents: that with the smallest doc_id
    stays. Rows that repeat a doc_id share its fate. Empty texts and null ids stay."""
    rows, classes, _, found = _linked(docs, share)
    named = rows.join(_company(classes, found), ["f1", "f2"])
    name = "_gone" + "_" * max(map(len, docs.columns))  # no column of the table
    gone = written(named.filter("doc_id <> component").select(F.col("doc_id").alias(name)).distinct(), "jaccard-gone")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
