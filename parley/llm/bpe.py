"""Byte-level BPE from a rank file: encoding by a two-tier lookup, and decoding.

First tier: a minimal perfect hash over the vocabulary. Keys fall into small groups; a group stores one
number that sends its keys to free slots, and a table of exactly as many slots as tokens holds the bytes,
so one probe and one comparison tell whether a pre-token is a token. Second tier, for the others: the
bytes are a linked list, a heap holds its neighbouring pairs by (rank, place), and the least pair is
merged until none is a token; n bytes take n log n steps, so a very long run is no trap.

Null text: empty. No ids for an empty text. Repeated rows are encoded alike. Texts are never cut.
"""

import base64
import hashlib
import heapq
from itertools import chain

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame

from parley.llm.memo import Memo

#: Pre-tokens kept with their ids per worker process and generation, and the longest that is kept.
MEMO_SIZE, MEMO_CHARS = 300_000, 48
_MASK = (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of `base64 rank` lines; every rank from 0 is there once."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for a, b in pairs:
        tokens[int(b)] = base64.b64decode(a)
    return tokens


class PerfectHash:
    """token -> rank for the given tokens (each once), None for anything else."""

    def __init__(self, tokens: list[bytes]):
        n = self.n = len(tokens)
        self.groups = max(1, n // 4)
        self.shift = [0] * self.groups
        self.slots: list[int] = [-1] * n
        self.tokens = tokens
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.groups)]
        for rank, t in enumerate(tokens):
            h = xxhash.xxh3_64_intdigest(t)
            members[h % self.groups].append((h, rank))
        lone = []
        for g in sorted(range(self.groups), key=lambda g: -len(members[g])):
            if len(members[g]) == 1:
                lone.append(g)
                continue
            d = 0
            while members[g]:
                at = [self._place(h, d) for h, _ in members[g]]
                if len(set(at)) == len(at) and all(self.slots[s] < 0 for s in at):
                    for s, (_, rank) in zip(at, members[g]):
                        self.slots[s] = rank
                    self.shift[g] = d
                    break
                d += 1
        free = (s for s in range(n) if self.slots[s] < 0)
        for g, s in zip(lone, free):  # a group of one names its slot
            self.slots[s] = members[g][0][1]
            self.shift[g] = -s - 1

    def _place(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        return (x ^ (x >> 29)) % self.n

    def get(self, token: bytes):
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(token)
        d = self.shift[h % self.groups]
        rank = self.slots[-d - 1 if d < 0 else self._place(h, d)]
        return rank if rank >= 0 and self.tokens[rank] == token else None


class Encoder:
    """Ids of pre-tokens."""

    def __init__(self, table: PerfectHash):
        self.table = table
        self.memo = Memo(self.piece, MEMO_SIZE, lambda p: len(p) <= MEMO_CHARS)
        self.ranks = {t: i for i, t in enumerate(table.tokens)}  # for the parts of a pre-token

    def piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8")
        rank = self.table.get(raw)
        return (rank,) if rank is not None else self.merge(raw)

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """Ids of bytes that are no token as a whole."""
        ranks, n = self.ranks, len(raw)
        get, push, pop = ranks.get, heapq.heappush, heapq.heappop
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is merged away
        before = list(range(-1, n))
        # a pair is (rank, start, middle, end)
        heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = pop(heap)
            if end[i] != j or j == n or end[j] != k:  # a part of it has changed since
                continue
            end[i], end[j], before[k] = k, 0, i
            if k < n and (rank := get(raw[i:end[k]])) is not None:
                push(heap, (rank, i, k, end[k]))
            h = before[i]
            if h >= 0 and (rank := get(raw[h:k])) is not None:
                push(heap, (rank, h, i, k))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return tuple(out)


_WORKER = {}


def worker_encoder(table: PerfectHash) -> Encoder:
    """The encoder of this worker process, which later tasks with the same vocabulary find warm."""
    name = hashlib.sha256(b"".join(table.tokens)).digest()
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Encoder(table)
    return _WORKER[name]


def encode(texts, encoder: Encoder, pattern) -> list[list[int]]:
    return [list(chain.from_iterable(map(encoder.memo.__getitem__, pattern.findall(t)))) for t in texts]


def decode(ids, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def with_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and its `ids`."""
    table = PerfectHash(read_ranks(ranks_path))

    def run(batches):
        encoder, split = worker_encoder(table), regex.compile(pattern)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": encode(b["text"].fillna(""), encoder, split)})

    return docs.selectExpr("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the bytes that they decode to."""
    table = PerfectHash(read_ranks(ranks_path))

    def run(batches):
        encoder, split = worker_encoder(table), regex.compile(pattern)
        names, tokens = [str(i) for i in range(table.n)], table.tokens
        for b in batches:
            rows = []
            for text in b["text"].fillna(""):
                (ids,) = encode([text], encoder, split)
                said = ",".join(map(names.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(decode(ids, tokens)).hexdigest()))
            n, a, d = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": d})

    return docs.selectExpr("doc_id", "text").mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
