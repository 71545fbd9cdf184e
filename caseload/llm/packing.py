"""Hierarchical packing of tokenised documents into windows of several context sizes, without padding.

Documents are tokenised and packed inside their input partition, a bounded pool of tokens at a time:

1. A document longer than the longest tier is cut into whole longest windows; its rest, like any shorter document, is
   routed to the shortest tier (a power of two) that holds it.
2. Every tier is packed from the longest down: each document of a tier opens a window of that size, and the gap it
   leaves is filled with the longest documents of shorter tiers that fit, the last gap with the head of one more.
3. What is left when the partition ends, less than one window, is cut along powers of two, so no sequence needs padding.
4. Sequences of one tier are dealt to step groups of ``step_tokens`` tokens, heaviest (by squared piece lengths, the cost
   of attention) first to the lightest open group, so that the groups of a training step cost alike.

A piece is a run of one document's ids; every id lies in one piece. Null texts count as empty; every document ends with
``end_id``, so each has at least one token and one piece. Rows that repeat a doc_id are packed as separate documents. An
empty table gives no rows. Other columns of the input are ignored. sequence_id is the input partition's number times
2^32 plus a counter, and a re-run task makes the same pieces.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.tokens import encoder, read_tokenizer, slices
from caseload.llm.worker import map_batches

#: Context sizes, powers of two.
TIERS = (2048, 1024, 512, 256)
#: Tokens that a task pools before it packs them.
POOL_TOKENS = 1_000_000
#: Tokens of a step group.
STEP_TOKENS = 65_536

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")

#: A piece: its document's place in the pool, the first id, the number of ids.
Piece = tuple[int, int, int]


class _Shelf:
    """Pieces of one tier by length."""

    def __init__(self):
        self.pieces: list[tuple[int, int, int]] = []  # (length, document, start), ascending

    def add(self, piece: Piece) -> None:
        insort(self.pieces, (piece[2], piece[0], piece[1]))

    def longest(self, room: int) -> Piece | None:
        """Take out the longest piece of at most ``room`` ids."""
        at = bisect_right(self.pieces, (room, 1 << 62, 1 << 62))
        if not at:
            return None
        n, doc, start = self.pieces.pop(at - 1)
        return doc, start, n


def route(lengths: list[int], tiers=TIERS) -> dict[int, list[Piece]]:
    """Pieces by tier: whole longest windows, and the rests under the shortest tier that holds them."""
    routed: dict[int, list[Piece]] = {t: [] for t in tiers}
    top = max(tiers)
    for doc, n in enumerate(lengths):
        whole = n // top * top
        for start in range(0, whole, top):
            routed[top].append((doc, start, top))
        if n > whole:
            routed[min(t for t in tiers if t >= n - whole)].append((doc, whole, n - whole))
    return routed


def pack(lengths: list[int], tiers=TIERS, last: bool = True) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences (lists of pieces) and the pieces left over (none if ``last``)."""
    tiers = tuple(sorted(tiers, reverse=True))
    shelves = {t: _Shelf() for t in tiers}
    for t, pieces in route(lengths, tiers).items():
        shelves[t].pieces = sorted((n, doc, start) for doc, start, n in pieces)
    full: list[list[Piece]] = []
    loose: list[Piece] = []

    def shelve(piece: Piece) -> None:
        shelves[min(t for t in tiers if t >= piece[2])].add(piece)

    for k, tier in enumerate(tiers):
        below = tiers[k:]
        while shelves[tier].pieces:
            n, doc, start = shelves[tier].pieces.pop()
            window, room = [(doc, start, n)], tier - n
            while room:
                fits = next((p for p in (shelves[t].longest(room) for t in below) if p), None)
                if fits is None:  # nothing fits whole: the head of the shortest longer piece fills the gap
                    longer = next((shelves[t].pieces.pop(0) for t in reversed(below) if shelves[t].pieces), None)
                    if longer is None:
                        break
                    fits = (longer[1], longer[2], room)
                    shelve((longer[1], longer[2] + room, longer[0] - room))
                window.append(fits)
                room -= fits[2]
            if room:
                loose += window
            else:
                full.append(window)
    if not last:
        return full, loose
    # Less than one longest window is left: cut it along powers of two.
    rest = sum(p[2] for p in loose)
    pieces = iter(loose)
    doc, start, n = next(pieces, (0, 0, 0))
    for power in (1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1):
        window, room = [], power
        while room:
            if not n:
                doc, start, n = next(pieces)
            take = min(room, n)
            window.append((doc, start, take))
            start, n, room = start + take, n - take, room - take
        full.append(window)
    return full, []


def step_groups(costs: list[int], size: int) -> list[int]:
    """A group for each sequence of one tier: groups of at most ``size`` sequences with even total cost."""
    count = -(-len(costs) // size)
    heap = [(0, g) for g in range(count)]
    room = [size] * count
    group = [0] * len(costs)
    for at in sorted(range(len(costs)), key=lambda i: (-costs[i], i)):
        cost, g = heapq.heappop(heap)
        group[at], room[g] = g, room[g] - 1
        if room[g]:
            heapq.heappush(heap, (cost + costs[at], g))
    return group


class _Pool:
    """Documents waiting to be packed."""

    def __init__(self, tiers, step_tokens: int):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        self.sequences = self.groups = 0
        self.docs: list[tuple[int | None, int, int, bytes]] = []  # (doc_id, all its ids, ids packed before, the other ids)
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4, 0, ids))
        self.tokens += len(ids) // 4

    def packed(self, last: bool) -> pa.RecordBatch:
        full, loose = pack([len(d[3]) // 4 for d in self.docs], self.tiers, last)
        out: list[tuple] = []
        sizes = [sum(p[2] for p in window) for window in full]
        for tier in sorted(set(sizes), reverse=True):
            windows = [w for w, n in zip(full, sizes) if n == tier]
            groups = step_groups([sum(p[2] ** 2 for p in w) for w in windows], max(1, self.step_tokens // tier))
            for window, group in zip(windows, groups):
                offset = 0
                for doc, start, n in window:
                    doc_id, total, before, ids = self.docs[doc]
                    out.append((doc_id, before + start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total,
                                self.base + self.sequences, offset, tier, self.base + self.groups + group))
                    offset += n
                self.sequences += 1
            self.groups += max(groups) + 1
        # Rests wait for the next pool; they are less than a window, so a document's rests are few.
        docs = self.docs
        self.docs = [(docs[d][0], docs[d][1], docs[d][2] + s, docs[d][3][4 * s:4 * (s + n)]) for d, s, n in loose]
        self.tokens = sum(n for _, _, n in loose)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        columns = list(zip(*out)) if out else [()] * len(names)
        kinds = [pa.int32() if c == "tier" else pa.int64() for c in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _packer(content: str, end_id: int | None, tiers, pool_tokens: int, step_tokens: int):
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(tiers, step_tokens)
        for batch in batches:
            for part in slices(batch):
                coded = encoder(content).encode(part.column("text").to_pylist())
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), coded):
                    pool.add(doc_id, ids + end)
                if pool.tokens >= pool_tokens:
                    yield pool.packed(False)
        if pool.docs:
            yield pool.packed(True)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, id_col: str = "doc_id",
                   text_col: str = "text", tiers=TIERS, pool_tokens: int = POOL_TOKENS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group."""
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, _packer(read_tokenizer(tokenizer_path), end_id, tuple(tiers), pool_tokens, step_tokens), SCHEMA)
