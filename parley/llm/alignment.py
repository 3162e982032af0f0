"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often they do so.

Arrow-native: a chunk's ids are list arrays; flattened, with their parent indices and a cumulative sum of
token lengths that starts anew in every document, each token has a key of its document and end. An Acero hash
join of the two sides' keys gives the offsets where both end, which cut a document into groups; a second one,
on groups, gives the links. `Table.group_by` counts, per chunk, in how many documents each pair of ids is
linked. These partial counts go to Spark packed by hash range, are merged there, and come back to the chunks;
an id's highest count is one number per id of the vocabulary and goes along with the last step.

A text is tokenized in units that begin at a single blank or line end between other characters, or at a stop or comma that
ends a word, where it is sure that no token of either side spans the cut (the vocabularies are looked at; else a text
is one unit). Units' ids are remembered, so frequent words are tokenized once per worker.

The chunks' alignments are written once to the shared folder, and both later steps read that table; nothing
depends on a table giving its rows in the same order again.

Null or empty text, or one whose bytes either side doesn't give back: no tokens, zeros, and '' for the digest.
Repeated rows count as documents of their own; a null doc_id stays null. Texts are never cut off; one longer
than a chunk is a chunk of its own. Other columns are not read. No rows: no rows. A group with many tokens on
both sides is paired by its distinct ids and their numbers, never token by token.
"""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from parley.llm.chunks import pack, unpack
from parley.llm.common import written
from parley.llm.memo import Memo

CHUNK_BYTES = 2_000_000
RANGE_BYTES = 4_000_000
#: Units kept with their ids per worker process and generation, and the longest that is kept.
MEMO_SIZE, MEMO_CHARS = 250_000, 48
MANY_LINKS = 4096
#: Begins a unit that follows the one before it without a blank.
_JOINED = "\x01"
_RUN = re.compile(r"\s\s|^\s|\s$|[" + _JOINED + "\u2581]")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_MARK = re.compile(f"(?<={_LETTER})([.,])(?=[ \\n]|$)")
_OPEN_MARK = re.compile(f"(?<!{_LETTER})[.,]|[.,](?![ \\n]|$)")


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the others for 256 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(rest)}


class Units:
    """Ids of both sides for units of text, and the bytes of their tokens."""

    def __init__(self, byte_model: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a, self.b = Tokenizer.from_str(byte_model), sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.a.encode_special_tokens = True
        chars, n = byte_level(), self.a.get_vocab_size()
        self.a_bytes = [bytes(chars[c] for c in t) if (t := self.a.id_to_token(i)) and set(t) <= chars.keys() else (t or "").encode()
                        for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        texts = [t.decode("utf-8", "replace") for t in (*self.a_bytes, *self.b_bytes)]
        lone = all(t == b"\n" or b"\n" not in t for t in self.b_bytes)
        self.cut = lone and not any(map(re.compile(r"\S[ \n]").search, texts))
        self.marks = self.cut and not any(map(re.compile(_LETTER + "[.,]").search, texts))
        self.lead = self.b.encode("\n")  # a blank and a line end, where no token spans a line end
        self.len_a, self.len_b = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.known = Memo(lambda k: self._alone([k])[0], MEMO_SIZE, lambda k: len(k) <= MEMO_CHARS)

    def _keys(self, text: str) -> list:
        """Units of blank + text. A string stands for blank + string, or for itself if it begins with a line end,
        or for what follows _JOINED; a tuple holds a whole unit."""
        if not self.cut:
            return [(" " + text,)]
        if _RUN.search(text):
            return [(p,) for p in _CUT.split(" " + text)]
        if self.marks:
            if _OPEN_MARK.search(text):
                text = _MARK.sub(f" {_JOINED}\\1", text)
            else:
                text = text.replace(".", f" {_JOINED}.").replace(",", f" {_JOINED},")
        return text.replace("\n", " \n").split(" ")

    @staticmethod
    def _unit(key) -> str:
        return key[0] if isinstance(key, tuple) else key if key[:1] == "\n" else key[1:] if key[:1] == _JOINED else " " + key

    def _alone(self, keys: list) -> list:
        """(ids of A, ids of B) per unit as bytes, None where a side's bytes are not the unit's."""
        units = list(map(self._unit, keys))
        ids_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        own = [u[0] == " " for u in units]  # the blank that B puts before a text is the unit's
        ids_b = self.b.encode([u[1:] if o else "\n" + u for u, o in zip(units, own)], num_threads=1)
        out = []
        for u, a, b, o in zip(units, ids_a, ids_b, own):
            if not o:
                b = b[len(self.lead):] if b[: len(self.lead)] == self.lead else []
            raw = u.encode("utf-8")
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else None)
        return out

    def _together(self, keys: list) -> list:
        """The same for string units without _JOINED, tokenized as one text that is cut at the units' ends."""
        units = list(map(self._unit, keys))
        joined = "".join(units)
        ends = np.cumsum([len(u.encode("utf-8")) for u in units])
        cuts = []
        for ids, lengths, skip in ((self.a.encode(joined, add_special_tokens=False).ids, self.len_a, 0),
                                   (self.b.encode("x" + joined), self.len_b, 2)):
            ids = np.array(ids, np.int64)
            at = np.concatenate(([0], np.cumsum(lengths[ids]))) - skip
            cut = np.searchsorted(at, np.concatenate(([0], ends)))
            if at[-1] != ends[-1] or not (at[cut[1:]] == ends).all() or at[cut[0]] != 0:
                return self._alone(keys)
            raw, cut = ids.astype("<u4").tobytes(), (4 * cut).tolist()
            cuts.append([raw[s:e] for s, e in zip(cut[:-1], cut[1:])])
        return list(zip(*cuts))

    def of(self, texts: list[str]):
        """(ids of A, ids of B) per text as bytes; both empty where the text has no tokens."""
        for s in range(0, len(texts), 256):
            keys = [self._keys(t) if t else [] for t in texts[s: s + 256]]
            new = [k for k in set().union(*keys) if k not in self.known and isinstance(k, str) and len(k) <= MEMO_CHARS and k[:1] != _JOINED]
            for k in range(0, len(new), 4096):
                for unit, ids in zip(new[k: k + 4096], self._together(new[k: k + 4096])):
                    self.known.put(unit, ids)
            for mine in keys:
                got = list(map(self.known.__getitem__, mine))
                if None in got:
                    got = []
                yield b"".join([x for x, _ in got]), b"".join([y for _, y in got])


_WORKER = {}


def worker_units(byte_model: str, piece_model: bytes) -> Units:
    """The units of this worker process, which later tasks with the same tokenizers find warm."""
    name = hashlib.sha256(byte_model.encode() + piece_model).digest()
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Units(byte_model, piece_model)
    return _WORKER[name]


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in ids])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int64)))


def _sides(lists: pa.ListArray, lengths: pa.Array):
    """(ids, document, end) of the tokens: ends count bytes from the document's start."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.take(lengths, ids)).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], total))[np.asarray(lists.offsets)[:-1]]
    doc = doc.to_numpy(zero_copy_only=False)
    return ids.to_numpy(zero_copy_only=False), doc, total - before[doc]


class Aligner:
    """Alignment of chunks by the vocabularies of both sides."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.n_a, self.n_b = len(a_bytes), len(b_bytes)
        self.bits = (self.n_a * self.n_b).bit_length()
        self.len_a, self.len_b = pa.array([len(t) for t in a_bytes], pa.int64()), pa.array([len(t) for t in b_bytes], pa.int64())
        self.names = pa.array([f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for i in range(n)], pa.large_string())

    def align(self, ids_a: list[bytes], ids_b: list[bytes]) -> dict:
        """Per document: n_a, n_b, n_groups, n_links, digest; and (document, pair, links) of the pairs that it
        links, by document."""
        lists_a, lists_b = _lists(ids_a), _lists(ids_b)
        n, off_a, off_b = len(ids_a), np.asarray(lists_a.offsets), np.asarray(lists_b.offsets)
        a, doc_a, end_a = _sides(lists_a, self.len_a)
        b, doc_b, end_b = _sides(lists_b, self.len_b)
        key = lambda doc, end: pa.array((doc.astype(np.int64) << 40) | end)
        both = pa.table({"key": key(doc_a, end_a), "i": np.arange(len(a))}).join(
            pa.table({"key": key(doc_b, end_b), "j": np.arange(len(b))}), "key", join_type="inner", use_threads=False)
        last_a, last_b = np.sort(both["i"].to_numpy()), np.sort(both["j"].to_numpy())
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        links, doc = size_a * size_b, doc_a[last_a]

        # decimal ids in order of groups, A before B
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]] = a + self.n_a * ends_a
        code[np.arange(len(b)) + (last_a + 1)[group_b]] = b + 2 * self.n_a + self.n_b * ends_b
        said = pc.take(self.names, pa.array(code))
        at, raw = np.frombuffer(said.buffers()[1], np.int64)[: len(code) + 1], memoryview(said.buffers()[2] or b"")
        cut = at[off_a + off_b] if len(code) else np.zeros(n + 1, np.int64)
        digest = [hashlib.sha256(raw[s: e - 1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]

        one = links == 1  # groups of one token each have their link already
        pairs = [pa.table({"k": (doc[one].astype(np.int64) << self.bits) | (a[last_a[one]] * self.n_b + b[last_b[one]])})]
        few = ~one & (links <= MANY_LINKS)
        t_a, t_b = few[group_a], few[group_b]
        met = pa.table({"g": group_a[t_a], "a": (doc_a[t_a].astype(np.int64) << self.bits) | (a[t_a] * self.n_b)}).join(
            pa.table({"g": group_b[t_b], "b": b[t_b]}), "g", join_type="inner", use_threads=False)
        pairs.append(pa.table({"k": pc.add(met["a"], met["b"])}))
        pairs = [pa.concat_tables(pairs).group_by("k", use_threads=False).aggregate([([], "count_all")]).rename_columns(["k", "m"])]
        for g in np.flatnonzero(links > MANY_LINKS):
            pairs.append(self._large(int(doc[g]), a[last_a[g] + 1 - size_a[g]: last_a[g] + 1], b[last_b[g] + 1 - size_b[g]: last_b[g] + 1]))
        if len(pairs) > 1:
            pairs = [pa.concat_tables(pairs).group_by("k", use_threads=False).aggregate([("m", "sum")]).rename_columns(["k", "m"])]
        k, m = pairs[0]["k"].to_numpy(), pairs[0]["m"].to_numpy()
        order = np.argsort(k)
        k, m = k[order], m[order]
        return {
            "n_a": np.diff(off_a).astype(np.int64), "n_b": np.diff(off_b).astype(np.int64), "n_groups": np.bincount(doc, minlength=n),
            "n_links": np.diff(np.concatenate(([0], np.cumsum(links)))[np.searchsorted(doc, np.arange(n + 1))]), "digest": digest,
            "doc": k >> self.bits, "pair": k & ((1 << self.bits) - 1), "links": m,
        }

    def _large(self, doc: int, a: np.ndarray, b: np.ndarray) -> pa.Table:
        a, times_a = np.unique(a, return_counts=True)
        b, times_b = np.unique(b, return_counts=True)
        return pa.table({"k": ((doc << self.bits) | (a[:, None] * self.n_b + b[None, :])).ravel(), "m": (times_a[:, None] * times_b[None, :]).ravel()})


def _range(pair: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range of each pair, alike in every chunk."""
    h = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return ((h * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _deltas(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=0))


def _rise(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b).astype(np.int64))


CHUNKS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("digest", pa.list_(pa.string())),
    ("ends", pa.binary()), ("at", pa.binary()), ("links", pa.binary()), ("first", pa.binary()),
    ("parts", pa.list_(pa.struct([("r", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))),
])
CHUNKS_DDL = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
              "digest array<string>, ends binary, at binary, links binary, first binary, "
              "parts array<struct<r: int, keys: binary, counts: binary>>")


def _chunk_row(block: int, doc_ids: list, x: dict, n_b: int, ranges: int) -> pa.RecordBatch:
    """A chunk's documents and its partial counts by range. `at` numbers pairs in the order of the parts."""
    counted = pa.table({"pair": x["pair"]}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
    keys, counts = counted["pair"].to_numpy(), counted["count_all"].to_numpy()
    by_pair = np.argsort(keys)
    keys, counts = keys[by_pair], counts[by_pair]
    r = _range(keys, ranges)
    order = np.argsort(r, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    at = place[np.searchsorted(keys, x["pair"])]
    within = np.lexsort((at, x["doc"]))
    at, links = at[within], x["links"][within]
    ends = np.searchsorted(x["doc"], np.arange(1, len(doc_ids) + 1))
    first = np.zeros(len(at), bool)
    first[np.concatenate(([0], ends[:-1]))[np.diff(ends, prepend=0) > 0]] = True
    steps = np.where(first, at, np.diff(at, prepend=0))  # a document's first is counted from 0
    keys, counts, r = keys[order], counts[order], r[order]
    bounds = np.flatnonzero(np.concatenate((r[:1] >= 0, r[1:] != r[:-1], [True]))) if len(r) else np.zeros(1, np.int64)
    parts = [{"r": int(r[s]), "keys": _deltas(keys[s:e]), "counts": pack(counts[s:e])} for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    row = {"block": block, "doc_id": doc_ids, **{c: x[c] for c in ("n_a", "n_b", "n_groups", "n_links", "digest")},
           "ends": _deltas(ends), "at": pack(steps), "links": pack(links), "first": pack(keys // n_b), "parts": parts}
    return pa.RecordBatch.from_pylist([row], CHUNKS)


ANSWERS = pa.schema([("block", pa.int64()), ("r", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])
ANSWERS_DDL = "block long, r int, ids binary, counts binary"


def _merge(n_b: int):
    """Per range: the documents of each pair, for every chunk that holds it; block -1 has the highest of each id."""

    def run(part: pa.Table) -> pa.Table:
        r = part["r"][0].as_py()
        keys = [_rise(k.as_py()) for k in part["keys"]]
        t = pa.table({"pair": np.concatenate(keys), "n": np.concatenate([unpack(c.as_py()).astype(np.int64) for c in part["counts"]])})
        merged = t.group_by("pair", use_threads=False).aggregate([("n", "sum")])
        pair, n = merged["pair"].to_numpy(), merged["n_sum"].to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        best = pa.table({"a": pair // n_b, "n": n}).group_by("a", use_threads=False).aggregate([("n", "max")])
        rows = [{"block": b.as_py(), "r": r, "ids": None, "counts": pack(n[np.searchsorted(pair, k)])} for b, k in zip(part["block"], keys)]
        rows.append({"block": -1, "r": r, "ids": pack(best["a"].to_numpy()), "counts": pack(best["n_max"].to_numpy())})
        return pa.Table.from_pylist(rows, ANSWERS)

    return run


RESULT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                    ("groups_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(highest: np.ndarray):
    """For cogroup by block: a chunk's documents with what their links count."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return RESULT.empty_table()
        (row,) = chunk.to_pylist()
        ends, links, steps = _rise(row["ends"]), unpack(row["links"]).astype(np.int64), unpack(row["at"]).astype(np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        total = np.concatenate(([0], np.cumsum(steps)))
        at = total[1:] - np.repeat(total[starts], ends - starts)
        mine = sorted(answers.select(["r", "counts"]).to_pylist(), key=lambda x: x["r"])
        counts = np.concatenate([unpack(x["counts"]).astype(np.int64) for x in mine]) if mine else np.empty(0, np.int64)
        top = counts == highest[unpack(row["first"]).astype(np.int64)]
        sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))])
        return pa.table([row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], sums(links * top[at]),
                         sums(links * counts[at]), row["digest"]], schema=RESULT)

    return run


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of `docs`.

    byte_path: a byte-level tokenizer (A, reads blank + text); piece_path: a sentence-piece model that puts
    a blank before the text itself (B). Both vocabularies bound what goes along with a task."""
    with open(byte_path, encoding="utf-8") as f:
        byte_model = f.read()
    with open(piece_path, "rb") as f:
        piece_model = f.read()
    units = Units(byte_model, piece_model)
    n_a, n_b = len(units.a_bytes), len(units.b_bytes)
    del units
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))

    def chunks(batches):
        units = worker_units(byte_model, piece_model)
        aligner = Aligner(units.a_bytes, units.b_bytes)
        base, number, ids, texts, held = TaskContext.get().partitionId() << 32, 0, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py() or ""
                if texts and held + len(text) > CHUNK_BYTES:
                    yield _chunk_row(base | number, ids, aligner.align(*_pairs(units.of(texts))), n_b, ranges)
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if texts:
            yield _chunk_row(base | number, ids, aligner.align(*_pairs(units.of(texts))), n_b, ranges)

    made = written(d.mapInArrow(chunks, CHUNKS_DDL), "alignment-chunks")
    asked = made.select("block", F.explode("parts").alias("p")).select("block", "p.r", "p.keys", "p.counts")
    answers = written(asked.groupBy("r").applyInArrow(_merge(n_b), ANSWERS_DDL), "alignment-counts")

    def highest_of(batches):
        most = np.zeros(n_a, np.int64)
        for batch in batches:
            for ids, counts in zip(batch["ids"], batch["counts"]):
                np.maximum.at(most, unpack(ids.as_py()).astype(np.int64), unpack(counts.as_py()).astype(np.int64))
        a = np.flatnonzero(most)
        yield pa.record_batch({"a": a, "n": most[a]})

    # one row per id of A at most: bounded by its vocabulary
    tops = answers.filter("block = -1").select("ids", "counts").mapInArrow(highest_of, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))
    highest = np.zeros(n_a, np.int64)
    for row in tops.toLocalIterator():
        highest[row.a] = row.n
    rest = made.drop("parts").groupBy("block")
    return rest.cogroup(answers.filter("block >= 0").select("block", "r", "counts").groupBy("block")).applyInArrow(_finish(highest), RESULT_DDL)


def _pairs(rows):
    got = list(rows)
    return [a for a, _ in got], [b for _, b in got]
