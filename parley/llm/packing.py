"""Harmonic packing of token ids into training sequences.

Lengths fall into classes by the reciprocal of the capacity: class j takes pieces of up to capacity / j
ids, and j of them fill a sequence. A length that would leave more than TOLERANCE of its slot open is cut:
the largest slot below it is filled exactly and the rest is classed again. A sequence of class j holds
always j pieces, so workers fill their sequences alone, each in its own task and with no shuffle.

What a task has open at its end (fewer than j pieces in class j) is laid end to end and cut at the
capacity, and its last part at powers of two, at which sequences need no padding. So padding is below
TOLERANCE of every sequence at any size. A task keeps at most one open sequence's ids per class.

Null text: an empty one, whose only id is the end. Repeated rows are packed one by one; their pieces carry
the same doc_id. A text of any length is tokenised whole. No rows: no rows.
"""

import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parley.llm.chunks import kept_answers, release_memory, small_batches
from parley.llm.memo import Memo

CAPACITY = 4096
TOLERANCE = 1 / 64
END_ID = 2
#: Words kept with their ids per worker process and generation, and the longest that is kept.
MEMO_SIZE, MEMO_CHARS = 400_000, 48
PORTION = 2048  # texts whose different words are looked up at a time
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, class int")


def cuts(n: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    r = n % capacity
    while r:
        j = capacity // r
        if j * r >= (1 - tolerance) * capacity:
            out.append((r, j))
            break
        slot = capacity // (j + 1)
        out.append((slot, j + 1))
        r -= slot
    return out


WORD_END = "</w>"
#: A stop or comma next to another mark, with which it makes one pre-token. The lower case of U+0130 ends in
#: a mark, and U+001C to U+001F are marks to the tokenizer.
_MARKS_TOGETHER = re.compile(r"[.,](?:(?<=[^\w\s][.,])|(?<=[_\u0130\x1c-\x1f][.,])|(?=[^\w\s]|[_\x1c-\x1f]))")


class Packer:
    """Takes documents' ids (as 4-byte little-endian integers) and gives rows of PIECES."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE):
        self.next_id, self.capacity, self.tolerance = first_id, capacity, tolerance
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _emit(self, pieces, kind: int) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, kind))
            offset += n
        self.next_id += 1

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for length, j in cuts(total, self.capacity, self.tolerance):
            piece = (doc, start, ids[4 * start: 4 * (start + length)], total)
            start += length
            waiting = self.open.setdefault(j, [])
            waiting.append(piece)
            if len(waiting) == j:
                self._emit(waiting, j)
                del self.open[j]

    def finish(self) -> None:
        rest = [p for j in sorted(self.open) for p in self.open[j]]
        self.open = {}
        left = sum(len(p[2]) // 4 for p in rest)
        at = 0  # the place inside rest[0]
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            taken = []
            while room:
                doc, start, ids, total = rest[0]
                n = min(room, len(ids) // 4 - at)
                taken.append((doc, start + at, ids[4 * at: 4 * (at + n)], total))
                room, at = room - n, at + n
                if at == len(ids) // 4:
                    rest.pop(0)
                    at = 0
            self._emit(taken, 0)

    def take(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])


class WordIds:
    """Ids of texts as bytes, by way of the ids of their words.

    A text is cut at blanks and line ends: the tokenizer drops white space and no token spans it, so the
    words' ids in a row are the text's. Where it changes no id, the text is brought to fewer different
    words first: lower case in Latin-1 texts (the tokenizer lower-cases; beyond Latin-1 case and composition
    have more rules), and single stops and commas are set apart (they are tokens of their own). Words not
    known yet go to the tokenizer together."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known = Memo(self._alone, MEMO_SIZE, lambda w: len(w) <= MEMO_CHARS)
        size = tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True

    def _alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of different words; those of up to MEMO_CHARS are kept."""
        learnt = {}
        # letters only: one pre-token, whose last id and no other ends a word
        plain = [w for w in words if len(w) <= MEMO_CHARS and w.isalpha()]
        (e,) = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)
        ids = np.array(e.ids, np.int64)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(plain):
            raw, a = ids.astype("<u4").tobytes(), 0
            for w, b in zip(plain, (4 * ends).tolist()):
                learnt[w] = raw[a:b]
                a = b
        rest = [w for w in words if w not in learnt]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            learnt[w] = np.array(e.ids, "<u4").tobytes()
        for w, ids in learnt.items():
            if len(w) <= MEMO_CHARS:
                self.known.put(w, ids)
        return learnt

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of different words: kept ones, from either generation, or the tokenizer's."""
        ids = self.known.kept(words)
        learnt = self._learn([w for w, got in zip(words, ids) if got is None])
        return [learnt[w] if got is None else got for w, got in zip(words, ids)]

    @staticmethod
    def _parted(text: str) -> str:
        """The text with a blank wherever it is cut into words."""
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        if not _MARKS_TOGETHER.search(text):
            text = text.replace(".", " .").replace(",", " ,")
        return text.replace("\n", " ")

    def of(self, texts: list[str]):
        for k in range(0, len(texts), PORTION):
            cut = pc.split_pattern(pa.array(map(self._parted, texts[k: k + PORTION]), pa.large_string()), " ")
            words = cut.values.dictionary_encode()
            ids = self._ids(words.dictionary.to_pylist())
            at, edges = words.indices.to_numpy(), cut.offsets.to_pylist()
            for a, b in zip(edges, edges[1:]):
                yield b"".join(map(ids.__getitem__, at[a:b].tolist()))


NAME = "packing"
_WORKER = kept_answers(NAME)


def worker_words(model: str) -> WordIds:
    """The answers of this worker process, which later tasks with the same tokenizer find warm; tasks of the join and
    of the passages drop them."""
    from tokenizers import Tokenizer

    if model not in _WORKER:
        _WORKER.clear()
        _WORKER[model] = WordIds(Tokenizer.from_str(model))
    return _WORKER[model]


def document_ids(texts, known: WordIds, end_id: int = END_ID):
    """Ids of each text with the end's, as bytes."""
    end = end_id.to_bytes(4, "little")
    for ids in known.of(list(texts)):
        yield ids + end


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
         tolerance: float = TOLERANCE) -> DataFrame:
    """PIECES of all documents; sequences are numbered by task and then in order."""
    small_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        release_memory(NAME)
        known = worker_words(model)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, tolerance)
        for b in batches:
            texts = list(b["text"].fillna(""))
            for doc, ids in zip(b["doc_id"], document_ids(texts, known, end_id)):
                packer.add(None if pd.isna(doc) else int(doc), ids)
                if len(packer.rows) >= 20_000:
                    yield packer.take()
            yield packer.take()
        packer.finish()
        yield packer.take()
        del packer
        release_memory(NAME)  # the worker may stand idle beside other stages

    return docs.selectExpr("doc_id", "text").mapInPandas(run, PIECES)
